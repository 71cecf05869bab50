"""URL filter: rules first, then naive Bayes over segmented host and path words (operator 6)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm._util import ascii_lower, cut, id_type, slices, strings

#: The rules of the query: fixed values. (verdict, host/path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words whose urls train the blocked class; the other urls train the allowed class.
SEEDS = ("ads", "adult", "bet", "bets", "casino", "cheap", "crack", "dating", "escort", "gambling", "jackpot",
         "loan", "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "track", "viagra", "warez", "xxx")
BUCKETS = 1 << 18      # of hashed words: bounds the model at 2 MB
LONGEST = 20           # letters of a known word
SEED_COUNT = 50        # occurrences that a seed word has besides the counted ones
MARGIN = 0.0           # log odds above which a url is blocked
_LETTERS = re.compile(rb"[a-z]+")
#: What is not running text: scripts and styles (to the end if they are not closed), tags, entities.
_MARKUP = re.compile(rb"<(script|style)\b.*?(?:</\1|\Z)|<[^<>]*>|&[a-z]+;", re.DOTALL)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without a ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits; a rule holds for its host and all subdomains."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4096):
        counts: Counter = Counter()
        for i in range(batch.num_columns):
            for text in strings(batch.column(i)):
                counts.update(_LETTERS.findall(_MARKUP.sub(b" ", text.encode().lower())))
        counts = {w: n for w, n in counts.items() if len(w) <= LONGEST}
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                          pa.array(counts.values(), pa.int64())], ["word", "n"])


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """Most likely split of ``name`` into words; an unknown word pays for each letter."""
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    log_total = math.log(max(total, 2))
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(name[start:end])
            cost = (math.log(n) - log_total) if n else -log_total - (end - start) * math.log(10)
            if best[start] + cost > best[end]:
                best[end], back[end] = best[start] + cost, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _segmented(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name").to_pylist()
            found = [segment(name, {k["word"]: k["n"] for k in known}, total)
                     for name, known in zip(names, batch.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(found, pa.list_(pa.string()))],
                                             ["name", "words"])
    return run


def split_words(values: DataFrame, counts: DataFrame) -> DataFrame:
    """(value, words) for distinct ``values`` that hold letters a-z; ``counts`` has (word, n).

    Each distinct run of letters meets only the counts of its own substrings, by a join, so
    no vocabulary is broadcast; the substrings carry a number, not the name they come from.
    """
    parts = values.select("value", F.posexplode(F.split("value", "[^a-z]+")).alias("at", "name")).where("name <> ''")
    names = cut(parts.select("name").distinct().withColumn("id", F.monotonically_increasing_id()), "names")
    pieces = (names.select("id", "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start"))
              .select("id", F.substring("name", F.col("start"), F.lit(LONGEST)).alias("tail"))
              .select("id", F.explode(F.expr("transform(sequence(1, length(tail)), n -> left(tail, n))")).alias("word"))
              .distinct())
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = (names.join(pieces.join(counts, "word").groupBy("id")
                        .agg(F.collect_list(F.struct("word", "n")).alias("known")), "id", "left")
             .select("name", F.coalesce("known", F.expr("array()").cast("array<struct<word:string,n:bigint>>"))
                     .alias("known")))
    split = known.mapInArrow(_segmented(total), "name string, words array<string>")
    return (parts.join(split, "name").groupBy("value")
            .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))),
                                       lambda s: s["words"])).alias("words")))


def _weights(classes: np.ndarray) -> np.ndarray:
    """Log odds of each bucket from its (blocked, allowed) counts; all 0 if no url trains the blocked class.

    One count more is shared out in proportion to the classes, so a word that was seen
    nowhere weighs nothing, and a rare word the same in small and large tables.
    """
    sizes = classes.sum(axis=1) + 1
    if sizes[0] == 1:
        return np.zeros(classes.shape[1])
    smooth = sizes / sizes.sum()
    weights = np.log((classes[0] + smooth[0]) / sizes[0]) - np.log((classes[1] + smooth[1]) / sizes[1])
    weights[classes.sum(axis=0) == 0] = 0.0
    return weights


def _scored(weights: np.ndarray, start: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("buckets")
            values = weights[column.flatten().to_numpy(zero_copy_only=False)]
            sums = np.concatenate([[0.0], np.cumsum(values)])
            ends = np.cumsum([0, *(len(b) for b in column.to_pylist())])
            odds = start + sums[ends[1:]] - sums[ends[:-1]]
            names = [n for n in batch.schema.names if n != "buckets"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(odds, pa.float64())],
                                             [*names, "log_odds"])
    return run


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str | None = "html",
               rules: tuple[tuple[str, str], ...] = RULES, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """One row per input row: the id, host, path, rule, verdict, log_odds, host_words.

    Word counts for the segmentation come from the running text of all texts (tags, scripts, styles
    and entities left out) and the seeds, never from urls: a concatenated name that stands in
    urls alone is no word of its own, however often. Names in hosts and in paths are segmented. A url
    with a seed word among its host or path words trains the blocked class, any other
    the allowed one; multinomial weights of all words, smoothed in proportion to the
    classes, then score each url (without class priors, as seeds are rare). If no url
    trains the blocked class, all log odds are 0. The rule's verdict goes
    before the method's. A null url and one without ``://`` have an empty host and path,
    no words, and log odds 0, which allow. Rows may repeat; an empty table gives an empty
    result.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    seeded = pages.sparkSession.createDataFrame([(s, SEED_COUNT) for s in seeds], "word string, n long")
    found = seeded
    if text_col:
        texts = pages.select(F.col(text_col).cast("string").alias("text"))
        found = texts.mapInArrow(_counted, "word string, n long").union(seeded)
    counts = cut(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    rows = rows.withColumn("lower_path", ascii_lower(F.col("path")))
    split = cut(split_words(rows.select(F.explode(F.array("host", "lower_path")).alias("value")).distinct(), counts), "split")
    none = F.expr("array()").cast("array<string>")
    of_host, of_path = split.toDF("host", "words"), split.toDF("lower_path", "path_words")
    tokens = F.concat(F.coalesce("words", none), F.coalesce("path_words", none))
    known = F.array(*[F.lit(s) for s in seeds]) if seeds else F.expr("array()").cast("array<string>")
    judged = cut(rows.join(of_host, "host", "left").join(of_path, "lower_path", "left")
                 .withColumn("tokens", tokens)
                 .select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("rule"),
                         F.arrays_overlap("tokens", known).alias("seeded"),
                         F.coalesce("words", F.expr("array()").cast("array<string>")).alias("host_words"),
                         F.transform("tokens", lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
                         .alias("buckets")), "urls")
    found = (judged.select("seeded", F.explode("buckets").alias("bucket")).groupBy("bucket")
             .agg(F.count_if("seeded").alias("block"), F.count_if(~F.col("seeded")).alias("allow")).toArrow())
    classes = np.zeros((2, BUCKETS))
    at = found.column("bucket").to_numpy()
    classes[0][at] = found.column("block").to_numpy()
    classes[1][at] = found.column("allow").to_numpy()
    weights = _weights(classes)
    scored = judged.drop("seeded").mapInArrow(
        _scored(weights, 0.0), f"page_id {id_type(pages, id_col)}, host string, path string, rule string, "
                               "host_words array<string>, log_odds double")
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)]) if rules else None
    by_rule = verdicts[F.col("rule")] if rules else F.lit(None).cast("string")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce(by_rule, F.when(F.col("log_odds") > MARGIN, "block").otherwise("allow")).alias("verdict"),
        "log_odds", "host_words")
