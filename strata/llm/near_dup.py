"""MinHash near-duplicates with odd sketches (operator 1).

1. One pass over the texts: a key of the normalised words, the shingle count and the
   band keys of the MinHash signature. Rows with equal words fall into one class; only
   classes (nodes) go on, so copies are never expanded into pairs.
2. Nodes that share a band key with another node are candidates. Their texts are fetched
   once and get an odd sketch: more MinHash samples folded into a parity bitmap, where
   the population count of the XOR of two bitmaps estimates their similarity.
3. Star step: each node is verified against the least node of the band it shares most
   often. Verified links give first components. Merge rounds then verify one
   node of every component against one node of the largest component in one of its
   bands, which joins the parts of a large group before their members would meet.
4. Sweep: within a band key only pairs from different components are left. The largest
   component of the key stays whole; the others are its "minor" nodes. Minor blocks meet
   chunks of the key's nodes, so a key of any size is spread over bounded groups, and the
   sketches drop pairs that are surely below the threshold. What stays is verified on
   the full shingle sets. No pair between two components of a key is skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import cut, id_type, slices, utf8
from strata.llm.graph import components, merged

WIDTH = 5                 # words of a shingle
SIMILAR = (75, 100)       # linked: 100 * intersection >= 75 * union
BANDS, ROWS = 40, 5       # a pair at 0.75 shares no band with probability 2e-5
SAMPLES, BITS = 3072, 12288
DEVIATIONS = 4.0          # a pair at 0.75 is dropped by its sketches with probability 3e-5
MERGES = ((0, 1, 2), (3, 4, 5))  # rounds that join components, by a pair of each for every turn
BLOCK, CHUNK = 256, 1024  # minor nodes and nodes that meet in one group of the sweep
_WORDS = 200_000          # word hashes that a task keeps


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _WORDS:
            self.clear()
        self[word] = value
        return value


def words(text: bytes) -> list[bytes]:
    """bytes.lower() changes A-Z only; bytes.split() cuts at \\x20 and \\x09-\\x0D."""
    return text.lower().split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(tokens: list[bytes], hashes: _WordHash, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a short text is one shingle."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, n)
    size = min(n, width)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w[i:n - size + 1 + i]
    return np.unique(_mix(h))


def _hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, count, np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, count, np.uint32))


def minhash(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = family
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    step = max(16, 65536 // len(a))
    for i in range(0, len(x), step):
        block = x[i:i + step, None] * a
        block += b
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for column in signature.reshape(bands, rows).astype(np.uint64).T:
        h = _mix(h * np.uint64(0xD6E8FEB86659FD93) + column)
    return h.view(np.int64)


def odd_sketch(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap of the (position, value) samples."""
    at = _mix((np.arange(len(samples), dtype=np.uint64) << np.uint64(32)) + samples)
    odd = np.bincount((at >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def odd_limit(similarity: float, samples: int, bits: int, deviations: float) -> int:
    """Largest XOR count that a pair at ``similarity`` reaches, with a margin.

    Of the samples, (1 - similarity) differ and flip two bits each; both the number of
    differing samples and the parity of the bits vary.
    """
    flips = 2 * samples * (1 - similarity)
    mean = bits / 2 * (1 - math.exp(-2 * flips / bits))
    from_bits = bits / 4 * (1 - math.exp(-4 * flips / bits))
    from_samples = (math.exp(-2 * flips / bits) * 2) ** 2 * samples * similarity * (1 - similarity)
    return math.ceil(mean + deviations * math.sqrt(from_bits + from_samples))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(r) for r in rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(ends, pa.array(flat, pa.int64()))


def _signatures(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, family = _WordHash(), _hash_family(bands * rows, 11)
        none = np.empty(0, np.int64)
        for batch in slices(batches):
            keys, sizes, found = [], [], []
            for text in utf8(batch.column("text")):
                tokens = words(text)
                s = shingle_set(tokens, hashes, width)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(b" ".join(tokens)) if tokens else None)
                found.append(band_keys(minhash(s, family), bands, rows) if tokens else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), _lists(found)],
                ["doc_id", "text_hash", "key", "n", "bands"])
    return run


def _sketches(width: int, bands: int, rows: int, samples: int, bits: int):
    """Adds ``sketch``: the band keys and behind them the odd sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, family, finer = _WordHash(), _hash_family(bands * rows, 11), _hash_family(samples, 12)
        for batch in slices(batches):
            out = []
            for text in utf8(batch.column("text")):
                s = shingle_set(words(text), hashes, width)
                keys = band_keys(minhash(s, family), bands, rows)
                out.append(keys.tobytes() + odd_sketch(minhash(s, finer), bits).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(out, pa.binary()),
                 batch.column("text")], ["node", "n", "sketch", "text"])
    return run


def _verify(width: int, similar: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHash()
        for batch in slices(batches):
            linked, last = [], (None, None)
            for ta, tb in zip(utf8(batch.column("text_a")), utf8(batch.column("text_b"))):
                if last[0] != ta:
                    last = (ta, shingle_set(words(ta), hashes, width))
                b = shingle_set(words(tb), hashes, width)
                both = len(np.intersect1d(last[1], b, assume_unique=True))
                linked.append(similar[1] * both >= similar[0] * (len(last[1]) + len(b) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    return run


def _cross(bands: int, limit: int, similar: tuple[int, int]):
    """Pairs of a group's minor nodes with its other nodes that the sketches let pass.

    A pair that shares several band keys is compared under the least of them only.
    """
    def pairs(part: dict[str, np.ndarray]) -> list[np.ndarray]:
        minor, band = part["minor"], part["band"][0]
        node, comp, n, sketch = (part[c][~minor] for c in ("node", "comp", "n", "sketch"))
        keys, odd = sketch[:, :bands].view(np.int64), sketch[:, bands:]
        found = []
        for i in np.flatnonzero(minor):
            m, mine = part["n"][i], part["sketch"][i]
            at = np.flatnonzero((comp != part["comp"][i])
                                & (similar[1] * np.minimum(n, m) >= similar[0] * np.maximum(n, m)))
            own = mine[:bands].view(np.int64)
            at = at[~((keys[at] == own) & (own < band)).any(axis=1)]
            if len(at):
                differ = np.bitwise_count(odd[at] ^ mine[bands:]).sum(axis=1)
                other = node[at[differ <= limit]]
                mine = np.full(len(other), part["node"][i])
                found.append(np.stack([np.minimum(mine, other), np.maximum(mine, other)]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def emit(part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            found = pairs(part)
            if found:
                a, b = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = {c: batch.column(c).to_numpy(zero_copy_only=False)
                    for c in ("band", "block", "chunk", "node", "comp", "n", "minor")}
            part["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()),
                                           np.uint64).reshape(batch.num_rows, -1)
            if held is not None:
                part = {c: np.concatenate([held[c], part[c]]) for c in part}
            new = np.flatnonzero((np.diff(part["band"]) != 0) | (np.diff(part["block"]) != 0)
                                 | (np.diff(part["chunk"]) != 0)) + 1
            edges = [0, *new.tolist()]
            for lo, hi in zip(edges, edges[1:]):
                yield from emit({c: v[lo:hi] for c, v in part.items()})
            held = {c: v[edges[-1]:] for c, v in part.items()}
        if held is not None:
            yield from emit(held)
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, similar: tuple[int, int] = SIMILAR,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Only the id and the text are read, so other columns may have any name. A null or
    blank text has n_shingles 0 and is a component of its own. component_id is the least
    non-null id of the component; kept is true where the id equals it, so rows that
    repeat an id and a text are all kept, and a row without an id is kept only if its
    component has no id at all. An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    kind = id_type(docs, id_col)
    signed = cut(base.mapInArrow(
        _signatures(width, bands, rows),
        f"doc_id {kind}, text_hash long, key binary, n long, bands array<long>"), "signed")

    nodes = cut(signed.where("key is not null").groupBy("key")
                .agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("row"),
                     F.first("n").alias("n"), F.first("bands").alias("bands"))
                .withColumn("node", F.monotonically_increasing_id()), "nodes")

    keyed = nodes.select("node", F.explode("bands").alias("band"))
    shared = (keyed.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
              .where("hub < top").select("band", "hub"))
    met = cut(keyed.join(shared, "band").select("band", "node", "hub"), "met")

    wanted = (nodes.select("node", "n", F.col("row.doc_id").alias("at"),
                           F.col("row.text_hash").alias("text_hash"))
              .join(met.select("node").distinct(), "node", "left_semi"))
    texts = cut(base.join(wanted, (base.text_hash == wanted.text_hash) & base.doc_id.eqNullSafe(wanted.at))
                .groupBy("at", wanted.text_hash, "node", "n").agg(F.first("text").alias("text"))
                .select("node", "n", "text")
                .mapInArrow(_sketches(width, bands, rows, SAMPLES, BITS),
                            "node long, n long, sketch binary, text string"), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return (pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
                .mapInArrow(_verify(width, similar), "a long, b long"))

    star = (met.where("node <> hub").groupBy("node", "hub").count().groupBy("node")
            .agg(F.max_by("hub", F.struct("count", -F.col("hub"))).alias("a"))
            .select("a", F.col("node").alias("b")))
    links = cut(verified(star), "star")
    first = components(links)

    def within_bands(labels: DataFrame) -> DataFrame:
        return (met.select("band", "node").join(labels, "node", "left")
                .select("band", "node", F.coalesce("label", "node").alias("comp")))

    for turns in MERGES:
        within = within_bands(first)
        pairs = None
        for turn in turns:
            parts = (within.groupBy("band", "comp")
                     .agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("one"),
                          F.count(F.lit(1)).alias("size")))
            largest = (parts.groupBy("band").agg(F.max_by("one", F.struct("size", "comp")).alias("other"),
                                                 F.max("size").alias("most"), F.count(F.lit(1)).alias("parts"))
                       .where("parts > 1"))
            # even turns try the band of the component's largest company, odd ones any band
            rank = F.col("most") if turn % 2 == 0 else F.xxhash64("band", F.lit(turn))
            tried = (parts.join(largest, "band").where("one <> other").groupBy("comp")
                     .agg(F.max_by(F.struct("one", "other"), F.struct(rank, "band")).alias("pair"))
                     .select(F.col("pair.other").alias("a"), F.col("pair.one").alias("b")))
            pairs = tried if pairs is None else pairs.union(tried)
        joined = cut(verified(pairs.distinct()), "merge")
        first = cut(merged(first, joined), "merged")

    within = within_bands(first)
    sizes = (within.groupBy("band", "comp").count().groupBy("band")
             .agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.max("count").alias("most"),
                  F.sum("count").alias("total"), F.count(F.lit(1)).alias("comps"))
             .where("comps > 1"))
    spread = (within.join(sizes, "band")
              .withColumn("blocks", F.ceil((F.col("total") - F.col("most")) / BLOCK))
              .withColumn("chunks", F.ceil(F.col("total") / CHUNK))
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
              .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks")))
    cols = ["band", "block", "chunk", "node", "comp", "minor"]
    minor = (spread.where("comp <> major").withColumn("minor", F.lit(True))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(cols))
    every = (spread.withColumn("minor", F.lit(False))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(cols))
    limit = odd_limit(similar[0] / similar[1], SAMPLES, BITS, DEVIATIONS)
    crossed = (minor.union(every).join(texts.select("node", "n", "sketch"), "node")
               .select(*cols, "n", "sketch").repartition("band", "block", "chunk")
               .sortWithinPartitions("band", "block", "chunk")
               .mapInArrow(_cross(bands, limit, similar), "a long, b long").distinct())
    more = cut(verified(crossed), "sweep")
    last = merged(first, more)

    placed = nodes.select("key", "node", "least").join(last, "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node"))
    named = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    named = placed.select("key", "label").join(named, "label").select("key", "component_id")
    own = signed.select("doc_id", "key", "n")
    return (own.join(named, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
