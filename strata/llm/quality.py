"""Quality rules with host-level verdicts (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import cut, id_type, slices, strings

#: The rule patterns of the base: fixed values.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
REPEATED_PERCENT = 50     # more of the words than this in repeated windows fails

SYMBOL_PERCENT = 10       # soft rules: symbols against words,
DUP_LINE_PERCENT = 30     # repeated lines against lines with words,
WORD_CHARS = (2, 15)      # and mean word length outside this range
HOST_REJECT = 0.5         # a host is rejected above this shrunk failure rate
PRIOR_STRENGTH = (10.0, 1e4)  # least and most, in documents


def repeated_words(tokens: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more in the text."""
    n = len(tokens)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(t, len(ids)) for t in tokens), np.int64, n)
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) > 2_000_000:  # three factors would leave 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, count = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def features(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    raw = text.encode()
    tokens = raw.split()  # cuts at \x20 and \x09-\x0D
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(tokens), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(tokens), len(lines))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    for batch in slices(batches):
        found = np.array([features(t) for t in strings(batch.column("text"))], np.int64).reshape(-1, 6)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *(pa.array(c) for c in found.T)],
            ["doc_id", "host", *names])


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength (in documents) of the beta prior of the hosts' failure rates.

    ``hosts`` has (n, failed). Rates of small hosts vary by chance alone, so the spread between
    hosts is compared with that within them: the intra-class correlation r of the
    analysis of variance, and a strength of 1 / r - 1. If no host has two documents, or hosts
    differ no more than by chance, the prior has its largest strength.
    """
    n, x = F.col("n"), F.col("failed")
    row = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("n"), F.sum(x).alias("x"),
                    F.sum((n * n).cast("double")).alias("squares"), F.sum((x * x) / n).alias("between")).first()
    if not row["n"]:
        return 0.0, PRIOR_STRENGTH[1]
    k, total, failed = row["hosts"], row["n"], row["x"]
    mean, correlation = failed / total, 0.0
    if 1 < k < total:
        among = (row["between"] - failed * mean) / (k - 1)
        within = (failed - row["between"]) / (total - k)
        size = (total - row["squares"] / total) / (k - 1)
        spread = among + (size - 1) * within
        correlation = (among - within) / spread if spread > 0 else 0.0
    strength = 1 / correlation - 1 if correlation > 0 else PRIOR_STRENGTH[1]
    return mean, min(max(strength, PRIOR_STRENGTH[0]), PRIOR_STRENGTH[1])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the features, base_failed, soft_failed, host_rate, kept.

    A document fails a rule by its base features or by a soft rule. Failures are counted
    for each host; rates are shrunk to an empirical beta prior (:func:`beta_prior`, worth some ten
    documents at least, so a host is never rejected on the evidence of one), and a host is
    rejected when its shrunk rate is above 0.5. The verdict goes back to the documents: base failures are dropped
    anywhere, soft failures only on rejected hosts, and a document that fails nothing is
    kept wherever it stands. A null text counts as empty; rows without a host get no host
    verdict (host_rate null). An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).alias("text"))
    found = base.mapInArrow(
        _featured, f"doc_id {id_type(docs, id_col)}, host string, n_words long, word_chars long, "
                   "n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    judged = cut(found.select(
        "*", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words")
        .alias("base_failed"),
        F.expr(f"100 * n_symbols > {SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines "
               f"OR word_chars < {WORD_CHARS[0]} * n_words OR word_chars > {WORD_CHARS[1]} * n_words")
        .alias("soft_failed")), "judged")
    hosts = cut(judged.where("host is not null").groupBy("host")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.expr("CAST(base_failed OR soft_failed AS LONG)")).alias("failed")), "hosts")
    mean, strength = beta_prior(hosts)
    rates = hosts.select("host", ((F.col("failed") + mean * strength) / (F.col("n") + strength)).alias("host_rate"))
    return (judged.join(rates, "host", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "soft_failed", "host_rate",
                    (~F.col("base_failed") & ~(F.col("soft_failed") & (F.coalesce("host_rate", F.lit(0.0)) > HOST_REJECT)))
                    .alias("kept")))
