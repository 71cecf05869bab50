"""Spelling variants grouped under their frequent forms (operator 11).

1. One pass over the texts counts the words of each task; Spark adds the counts up.
2. Two words at distance one agree in a half: if the shorter has ``a`` letters, either the
   first or the last a // 2 letters of both are equal. So words meet in groups of one affix
   and one length ``a`` (words of a and a + 1 letters). Large groups are cut into blocks
   of asking words and chunks of standing words; every block meets every chunk.
3. A chunk is a bit-sliced position index: for each position and letter a bitset, one bit a
   word, of the words with that letter there. An asking word walks its letters once; the
   bitset of words without an error so far and those of words with one replaced, inserted
   or deleted letter (the latter two read the index shifted by a position) go along together.
4. The near word of largest count is the form, if frequent enough; roots follow forms by
   pointer jumping. Counts rise tenfold at each step, so chains are short.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import cut, text_slices, utf8

LETTERS = "A-Za-zÀ-ÿ"
LEAST = 7                  # letters of a word
OFTEN = 2                  # occurrences of a word
RATIO = 10                 # a form occurs so many times as often as its variant
SLIPS = 31                 # one of so many (document, word) pairs loses a letter
CHUNK, BLOCK = 8192, 32768 # standing and asking words that meet in one group
_HELD = 300_000            # words whose counts a task holds
_STANDS, _ASKS, _BOTH = 0, 1, 2


def occurrences(doc_id, text: bytes, runs: re.Pattern, least: int = LEAST, slips: int = SLIPS) -> Iterator[tuple[str, int]]:
    """Words of one text with their counts; a null id is written as no digits at all."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs.findall(text.lower().decode())).items():
        h = zlib.crc32(run.encode(), seed)
        if h % slips == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        yield run, n


def _counted(least: int, slips: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile(f"[{LETTERS}]{{{least},}}"), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              ["word", "n"])

        for batch in text_slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                for word, n in occurrences(doc_id, text, runs, least, slips):
                    held[word] += n
            if len(held) > _HELD:
                yield out()
                held.clear()
        yield out()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                slips: int = SLIPS) -> DataFrame:
    """(word, n): occurrences of every word of at least ``least`` letters."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (base.mapInArrow(_counted(least, slips), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


class PositionIndex:
    """Bit-sliced index of words: for each position and letter the bitset of words that have it."""

    def __init__(self, words: Iterable[str]) -> None:
        self.words = list(words)
        self.all = (1 << len(self.words)) - 1
        slices: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(self.words):
            lengths.setdefault(len(word), []).append(i)
            for place in enumerate(word):
                slices.setdefault(place, []).append(i)
        self.at = {k: self._bits(v) for k, v in slices.items()}
        self.long = {k: self._bits(v) for k, v in lengths.items()}

    def _bits(self, members: list[int]) -> int:
        if len(members) < 16:
            return sum(1 << i for i in members)
        out = bytearray(len(self.words) // 8 + 1)
        for i in members:
            out[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(out, "little")

    def near(self, word: str, same: bool = True, longer: bool = True, shorter: bool = True, apart: int = 0) -> int:
        """Bitset of the words at distance one from ``word``: of equal length, with one letter
        more, with one letter less. With ``apart`` only words whose first so many letters differ."""
        at, none = self.at, 0
        exact, replaced, inserted, deleted = self.all, 0, 0, 0
        equal = 0
        for i, letter in enumerate(word):
            here = exact & at.get((i, letter), none)
            if same:
                replaced = (replaced & at.get((i, letter), none)) | (exact ^ here)
            if longer:    # the other word has one more letter before this one
                inserted = (inserted | exact) & at.get((i + 1, letter), none)
            if shorter:   # the other word lacks this letter
                deleted = (deleted & at.get((i - 1, letter), none)) | exact
            exact = here
            if i + 1 == apart:
                equal = exact
        n = len(word)
        found = 0
        if same:
            found |= replaced & self.long.get(n, none)
        if longer:
            found |= (inserted | exact) & self.long.get(n + 1, none)
        if shorter:
            found |= deleted & self.long.get(n - 1, none)
        return found & ~equal if apart else found


def members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and role: near words of each asking word within its group."""
    group, standing, index, asking = None, [], None, []
    found: list[tuple] = []

    def rest(word: str) -> str:
        a = group[1]
        return word[a // 2:] if group[0] == "p" else word[:len(word) - a // 2]

    def ask(word: str) -> None:
        nonlocal index
        if index is None:
            index = PositionIndex(rest(w) for w, _ in standing)
        kind, a = group[:2]
        short = len(word) == a
        bits = index.near(rest(word), short, short, not short, a // 2 if kind == "s" else 0)
        if bits:
            near = [standing[i] for i in members(bits)]
            best = min(near, key=lambda x: (-x[1], x[0]))
            found.append((word, len(near), best[1], best[0]))

    def close() -> None:
        for word in asking:
            ask(word)
        asking.clear()

    def out() -> pa.RecordBatch:
        word, n_near, n, form = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(n_near, pa.int64()), pa.array(n, pa.int64()),
                                           pa.array(form, pa.string())], ["word", "n_near", "form_n", "form"])

    for batch in batches:
        for *key, role, word, n in zip(*(batch.column(c).to_pylist()
                                         for c in ("kind", "a", "affix", "block", "chunk", "role", "word", "n"))):
            if key != group:
                close()
                group, standing, index = key, [], None
            if role != _ASKS:
                standing.append((word, n))
            if role == _BOTH:
                asking.append(word)
            elif role == _ASKS and standing:
                ask(word)
        if len(found) > 50_000:
            yield out()
            found.clear()
    close()
    if found:
        yield out()


def near_words(words: DataFrame, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form): how many words of ``words`` (word, n) are at distance one
    from each, and the one of largest n (ties: smallest). Words without a near one are left out."""
    size = F.length("word")
    half = F.floor(F.col("a") / 2).cast("int")
    keyed = (words.select("word", "n", F.explode(F.array(size, size - 1)).alias("a"))
             .select("word", "n", "a", F.explode(F.array(F.lit("p"), F.lit("s"))).alias("kind"))
             .withColumn("affix", F.when(F.col("kind") == "p", F.substring("word", F.lit(1), half))
                         .otherwise(F.substring("word", F.length("word") - half + 1, half))))
    large = (keyed.groupBy("kind", "a", "affix").count().where(F.col("count") > chunk)
             .select("kind", "a", "affix", F.ceil(F.col("count") / chunk).alias("chunks"),
                     F.ceil(F.col("count") / block).alias("blocks")))
    dealt = keyed.join(large, ["kind", "a", "affix"], "left")
    whole = dealt.where("chunks is null").withColumns(
        {"block": F.lit(0).cast("long"), "chunk": F.lit(0).cast("long"), "role": F.lit(_BOTH)})
    split = (dealt.where("chunks is not null")
             .withColumn("block", F.pmod(F.xxhash64("word"), "blocks"))
             .withColumn("chunk", F.pmod(F.xxhash64("word", F.lit(1)), "chunks")))
    stands = split.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumn("role", F.lit(_STANDS))
    asks = split.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))) \
        .withColumn("role", F.lit(_ASKS))
    cols = ["kind", "a", "affix", "block", "chunk", "role", "word", "n"]
    key = cols[:5]
    met = (whole.select(cols).union(stands.select(cols)).union(asks.select(cols))
           .repartition(*key).sortWithinPartitions(*key, "role")
           .mapInArrow(_meet, "word string, n_near long, form_n long, form string"))
    best = F.struct(-F.col("form_n"), F.col("form"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min_by("form_n", best).alias("form_n"),
                                   F.min_by("form", best).alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last form that is reached from the word.

    Every round doubles the length of the steps; only whether some word moved comes to the driver.
    """
    now = cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut(now.drop("moved").join(on, "root", "left")
                  .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                      often: int = OFTEN, ratio: int = RATIO, slips: int = SLIPS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of letters, A-Z lower-cased, of at least ``least`` letters and ``often``
    occurrences; one of ``slips`` (document, run) pairs loses a letter first. ``form`` is the near
    word of largest n (ties: the smallest in code-point order) if it occurs ``ratio`` times as often,
    else null. Null and empty texts have no words; a null id counts as an id without digits; repeated
    rows count again; a very long run is a word like others. Only the id and the text are read, so other
    columns may have any name. An empty table gives an empty result.
    """
    words = cut(word_counts(docs, id_col, text_col, least, slips).where(F.col("n") >= often), "vocabulary")
    near = near_words(words)
    formed = F.col("form_n") >= ratio * F.col("n")
    judged = cut(words.join(near, "word", "left")
                 .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                         F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    ends = roots(judged.where("form is not null"))
    return (judged.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
