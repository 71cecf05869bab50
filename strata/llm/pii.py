"""Personal data by candidate gradient boosting (operator 3).

Base spans come from four fixed patterns with checks. Generators with high recall
propose further spans (written-out addresses, numbers without a prefix or with a failed
check, assigned secrets); boosted trees score each candidate from its format and its
context, and thresholds calibrated for each kind select the spans that are added.

No labelled spans exist, so the trees learn from candidates whose label does not follow from
their features: base spans rewritten as people write them out, put back in their context and
proposed again by the generators (of the right kind: personal; of another kind: not), and long
runs of characters that a text assigns to a name like ``token`` (personal), whose features leave
that name out. Other candidates are not personal, but for those that look like a rewritten span
or stand near such a name: they have no label.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import boosting
from strata.llm._util import cut, id_type, slices, strings

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")

#: The base patterns are fixed values. Possessive forms match what greedy ones do here
#: and stay linear on long runs; an email is found from its @.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"\bat\b")  # no written-out address without it

GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: dot [A-Za-z0-9._%+-]{1,64}+){0,8}"
                         r"\s?[\[(]?(?:@|\bat\b)[\])]?\s?[A-Za-z0-9-]{1,63}+"
                         r"(?:\s?[\[(]?(?:\.|\bdot\b)[\])]?\s?[A-Za-z0-9-]{1,63}+){1,8}")),
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,4}+(?:[.,:-][0-9]{1,4}+){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}+(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\(?[0-9]{2,4}\)?[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_+/-]{20,}+(?![A-Za-z0-9_])")),
)
#: Words before or after a span that speak for a kind.
CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "address"),
    "card": ("card", "visa", "account", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("token", "key", "secret", "password", "passwd", "auth"),
}
CONTEXT = 24            # characters of context on either side
SAMPLE = 2_000          # bound on the labelled candidates of a kind and label that the trees are fit on
PRECISION = 0.98        # of added spans on held-out candidates, for each kind
SECRET = KINDS.index("secret")
_ASSIGNED = re.compile(r"(?:token|key|secret|passw(?:or)?d|auth)[A-Za-z0-9_]*[\"']?\s*[:=]\s*[\"']?$", re.IGNORECASE)
_MARKED = re.compile(r"[\[(](?:at|dot)[\])]|\bdot\b")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end), sorted."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all generators; spans of different kinds may overlap."""
    digits = _DIGIT.search(text) is not None
    found = []
    for kind, pattern in GENERATORS:
        if kind == "email" and "@" not in text and not _AT.search(text):
            continue
        if kind in ("ip", "card", "phone") and not digits:
            continue
        found += [(m.start(), KINDS.index(kind), m.end()) for m in pattern.finditer(text)]
    return sorted(found)


def _shape(kind: int, span: str, before: str, after: str) -> list[float]:
    digits = [c for c in span if "0" <= c <= "9"]
    letters = sum(c.isalpha() for c in span)
    counts = Counter(span)
    entropy = -sum(n / len(span) * math.log2(n / len(span)) for n in counts.values())
    numbers = re.findall(r"[0-9]+", span)
    around = f"{before} {after}".lower()
    return [
        kind, len(span), len(digits), letters, len(digits) / len(span), entropy,
        len(numbers), max((int(n[-4:]) for n in numbers), default=0), counts["."], counts["-"] + counts[" "],
        counts["@"] + counts["+"], counts["("] + counts["["],
        float(len(digits) > 12 and luhn("".join(digits))),
        float(span.isupper()) - float(span.islower()),
        sum(c in "0123456789abcdefABCDEF" for c in span) / len(span),
        float(before[-1:].isalnum()) + float(after[:1].isalnum()),
        float(kind != SECRET and any(c in around for c in CUES[KINDS[kind]])),  # these label secrets
        float(kind != SECRET and before.rstrip(" \"'")[-1:] in ("=", ":")) if before else 0.0,
        len(_MARKED.findall(span)), float(re.search(r"\.\s", span) is not None), float(_undone(kind, span) is not None),
        float(span[-2:].isalpha()),
    ]


def _described(text: str, spans: list[tuple[int, int, int]]) -> list[list[float]]:
    return [_shape(k, text[s:e], text[max(0, s - CONTEXT):s], text[e:e + CONTEXT]) for s, k, e in spans]


def _apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``spans`` that overlap none of the sorted ``others``."""
    starts, reach = [o[0] for o in others], list(accumulate((o[2] for o in others), max))
    out = []
    for span in spans:
        before = bisect_left(starts, span[2])
        if not before or reach[before - 1] <= span[0]:
            out.append(span)
    return out


def _disjoint(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Each of ``spans``, in their order, that overlaps none taken before it."""
    taken: list[tuple[int, int, int]] = []
    for span in spans:
        at = bisect_left(taken, span)
        if (at == 0 or taken[at - 1][2] <= span[0]) and (at == len(taken) or span[2] <= taken[at][0]):
            taken.insert(at, span)
    return taken


def _written_out(kind: int, span: str) -> list[str]:
    """Ways in which people write a base span that its pattern misses."""
    if kind == 0:
        return [span.replace("@", " at ").replace(".", " dot "), span.replace("@", " (at) "), span.replace("@", "[at]")]
    if kind == 1:
        return [span.replace(".", ","), span.replace(".", "-")]
    if kind == 2:
        digits = re.sub(r"[^0-9]", "", span)
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    digits = re.sub(r"[^0-9]", "", span)[-10:]
    return [f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"]


def _undone(kind: int, span: str) -> str | None:
    """The base span that a candidate may stand for; None if there is no valid one."""
    if kind == 0:
        plain = re.sub(r"\s?[\[(]?(?:@|\bat\b)[\])]?\s?", "@", span, count=1)
        plain = re.sub(r"\s?[\[(]?\bdot\b[\])]?\s?", ".", plain)
    elif kind == 1:
        plain = re.sub(r"[,:-]", ".", span)
    elif kind == 2:
        plain = span.replace(".", "")
    elif kind == 3:
        plain = "+" + re.sub(r"[^0-9]", "", span)
    else:
        return None
    return plain if (0, kind, len(plain)) in base_spans(plain) else None


def _unsure(kind: int, span: str, before: str, after: str) -> bool:
    """Whether a candidate of a text may well be personal, so that it has no label."""
    if kind == SECRET:
        around = f"{before} {after}".lower()
        return any(c in around for c in CUES["secret"])
    if kind == 0 and _MARKED.search(span):
        return True
    plain = _undone(kind, span)
    return plain is not None and span in _written_out(kind, plain)


def labelled(text: str) -> Iterator[tuple[int, int, str, str, str, str]]:
    """(kind, label, span it comes from, span, before, after) of each labelled candidate."""
    base = base_spans(text)
    for s, k, e in base:
        before, after = text[max(0, s - CONTEXT):s], text[e:e + CONTEXT]
        for form in _written_out(k, text[s:e]):
            window, first, end = before + form + after, len(before), len(before) + len(form)
            for cs, ck, ce in _apart(candidates(window), base_spans(window)):
                if cs < end and first < ce and (ck != k or (cs <= first and end <= ce)):
                    yield (ck, int(ck == k), text[s:e], window[cs:ce],
                           window[max(0, cs - CONTEXT):cs], window[ce:ce + CONTEXT])
    for s, k, e in _apart(candidates(text), base):
        span, before, after = text[s:e], text[max(0, s - CONTEXT):s], text[e:e + CONTEXT]
        if k == SECRET and _ASSIGNED.search(before):
            yield k, 1, span, span, before, after
        elif not _unsure(k, span, before, after):
            yield k, 0, span, span, before, after


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled candidates of a task, repeated ones once: those of the SAMPLE least hashes of each
    kind and label, which hold the task's part of the least hashes of the whole table."""
    least: dict[tuple[int, int], list[tuple[int, tuple]]] = {}
    seen: dict[tuple[int, int], set[int]] = {}
    for batch in slices(batches):
        for text in strings(batch.column("text")):
            for row in labelled(text):
                digest = hashlib.blake2b("\0".join(map(str, row)).encode(), digest_size=8).digest()
                value = -(int.from_bytes(digest, "little") >> 1)
                heap, known = least.setdefault(row[:2], []), seen.setdefault(row[:2], set())
                if value in known or (len(heap) == SAMPLE and value < heap[0][0]):
                    continue
                known.add(value)
                if len(heap) < SAMPLE:
                    heapq.heappush(heap, (value, row))
                else:
                    known.discard(heapq.heappushpop(heap, (value, row))[0])
    rows = [(k, y, -value, zlib.crc32(source.encode()) % 4 == 3, _shape(k, span, before, after))
            for heap in least.values() for value, (k, y, source, span, before, after) in heap]
    columns = list(zip(*rows)) or [()] * 5
    types = (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                     ["kind", "label", "hash", "held", "x"])


def training_rows(docs: DataFrame, text_col: str = "text") -> list:
    """(kind, label, hash, held, x) of labelled candidates of the whole table, in a fixed order.

    Of each kind and label the SAMPLE least hashes of distinct candidates, so a kind that is in one
    document of millions is in the sample and neither order, copies nor file splits change it.
    Hashes are counted by their highest bit; the driver gets those counts and, below the bits that
    hold SAMPLE rows, at most about twice as many rows of each kind and label.
    """
    found = cut(docs.select(F.col(text_col).alias("text")).mapInArrow(
        _training, "kind int, label int, hash long, held boolean, x array<double>"), "pii-labels")
    bits = F.length(F.conv(F.col("hash").cast("string"), 10, 2))
    counts = (found.withColumn("bits", bits).groupBy("kind", "label", "bits")
              .agg(F.count_distinct("hash").alias("n")).collect())
    wanted = F.lit(False)
    for group in {(r.kind, r.label) for r in counts}:
        total, reach = 0, 0
        for r in sorted((r for r in counts if (r.kind, r.label) == group), key=lambda r: r.bits):
            if total < SAMPLE:
                total, reach = total + r.n, r.bits
        wanted |= (F.col("kind") == group[0]) & (F.col("label") == group[1]) & (bits <= reach)
    rows = sorted(found.where(wanted).dropDuplicates(["kind", "label", "hash"]).collect(), key=lambda r: r[:3])
    place = Counter()
    return [r for r in rows if (place.update([r[:2]]) or place[r[:2]]) <= SAMPLE]


def fit_rows(rows: list) -> boosting.BoostedTrees | None:
    """Trees from labelled rows. The candidates that come from three of four spans train; those of
    the others set each kind's threshold (a kind without held-out personal ones adds nothing).
    None if a label is missing."""
    x, y = np.array([r[4] for r in rows], float), np.array([r[1] for r in rows], float)
    kind, held = np.array([r[0] for r in rows], int), np.array([r[3] for r in rows], bool)
    if not len(y) or len(set(y[~held].tolist())) < 2:
        return None
    model = boosting.fit(x[~held], y[~held])
    model.threshold = np.array([boosting.calibrate(model, x[own], y[own], PRECISION)
                                for own in (held & (kind == k) for k in range(len(KINDS)))])
    return model


def fit(docs: DataFrame, text_col: str = "text") -> boosting.BoostedTrees | None:
    """Trees and thresholds from at most SAMPLE labelled candidates of each kind and label."""
    return fit_rows(training_rows(docs, text_col))


def _selected(texts: list[str], model: boosting.BoostedTrees | None):
    """Base and added spans of each text; candidates of all texts are scored at once."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, []) for b in base]
    rest = [_apart(candidates(t), b) for t, b in zip(texts, base)]
    shapes = [s for t, r in zip(texts, rest) for s in _described(t, r)]
    scores = iter(model.probability(np.array(shapes, float)).tolist() if shapes else [])
    threshold = np.broadcast_to(model.threshold, len(KINDS)).tolist()
    out = []
    for b, r in zip(base, rest):
        passed = sorted(((p, c) for c in r if (p := next(scores)) >= threshold[c[1]]), key=lambda v: (-v[0], v[1]))
        out.append((b, _disjoint([c for _, c in passed])))  # of overlapping ones the likeliest
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _spans(model: boosting.BoostedTrees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"]
        for batch in slices(batches):
            found = _selected(strings(batch.column("text")), model)
            counts = [[sum(k == i for _, k, _ in b) for b, _ in found] for i in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in found], pa.string()),
                 pa.array([_listed(b + a) for b, a in found], pa.string())], names)
    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Offsets are code points, ends exclusive. A null text counts as empty, which has no
    spans. Ids may be null and rows may repeat; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(
        _spans(fit(docs, text_col)),
        f"doc_id {id_type(docs, id_col)}, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string")


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each run of overlapping spans becomes one mark, named after its first span."""
    out, end = [], 0
    for s, k, e in sorted(spans):
        if s >= end:
            out += [text[end:s], f"<{KINDS[k].upper()}>"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by <EMAIL>, <IP>, <CARD>, <PHONE> or <SECRET>.

    All columns stay in place; a null text stays null.
    """
    model = fit(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = strings(batch.column(at))
            new = [redact_text(t, b + a) for t, (b, a) in zip(texts, _selected(texts, model))]
            null = batch.column(at).is_null().to_pylist()
            column = pa.array([None if n else t for t, n in zip(new, null)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), column)
    return docs.mapInArrow(run, docs.schema)
