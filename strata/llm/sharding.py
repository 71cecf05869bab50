"""Sharding by best-fit-decreasing bin packing of indivisible groups (operator 4)."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm._util import cut

BITS = 9             # leading bits of a group's size that its size class keeps
CHUNK_ROWS = 20_000  # rows of a numbering chunk


@dataclass
class _Node:
    key: tuple[int, int]
    rank: float
    left: _Node | None = None
    right: _Node | None = None


class CapacityTree:
    """Balanced search tree (treap) of (remaining capacity, bin)."""

    def __init__(self) -> None:
        self.root: _Node | None = None
        self._rank = random.Random(1).random

    def _split(self, node, key):
        if node is None:
            return None, None
        if node.key < key:
            node.right, high = self._split(node.right, key)
            return node, high
        low, node.left = self._split(node.left, key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low.rank > high.rank:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high

    def add(self, remaining: int, shard: int) -> None:
        low, high = self._split(self.root, (remaining, shard))
        node = _Node((remaining, shard), self._rank())
        self.root = self._merge(self._merge(low, node), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of ``size`` or more."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        first = high
        while first.left:
            first = first.left
        _, rest = self._split(high, (first.key[0], first.key[1] + 1))
        self.root = self._merge(low, rest)
        return first.key


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Pack ``sizes`` (size, count) and return runs (size, first, end, bin) and the bins.

    Groups first to end - 1 of a size go to the bin. The tightest bin that fits one group
    stays the tightest while it fits, so it takes as many as fit at a time. A group
    above the capacity gets a bin of its own.
    """
    tree, runs, bins = CapacityTree(), [], 0
    for size, count in sorted(sizes, reverse=True):
        first = 0
        while first < count:
            found = tree.take_tightest(size)
            if found is None:
                found, bins = (max(capacity, size), bins), bins + 1
            remaining, shard = found
            here = min(count - first, remaining // size)
            runs.append((size, first, first + here, shard))
            first += here
            tree.add(remaining - here * size, shard)
    return runs, bins


def into_shards(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs for a fixed number of shards: the least capacity that needs no more bins.

    A group above an equal share gets a shard of its own; the rest share the others.
    """
    left, alone = sorted(sizes, reverse=True), []
    total = sum(s * n for s, n in left)
    while left and len(alone) < shards - 1 and left[0][0] * (shards - len(alone)) > total:
        size, count = left[0]
        alone.append(size)
        total -= size
        left = ([(size, count - 1)] if count > 1 else []) + left[1:]
    free = shards - len(alone)
    low = max(1, -(-total // free))
    high = low + (left[0][0] if left else 0)
    while best_fit_decreasing(left, high)[1] > free:
        high += high - low + 1
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(left, middle)[1] <= free:
            high = middle
        else:
            low = middle + 1
    taken: dict[int, int] = {}
    runs = []
    for shard, size in enumerate(alone):
        first = taken.get(size, 0)
        taken[size] = first + 1
        runs.append((size, first, first + 1, shard))
    for size, first, end, shard in best_fit_decreasing(left, high)[0]:
        runs.append((size, first + taken.get(size, 0), end + taken.get(size, 0), shard + len(alone)))
    return runs


def _numbered(df: DataFrame, group: str, order: list[str], rows: int, name: str) -> DataFrame:
    """``df`` with ``name``: gapless from 0 in each group, by chunks of bounded size."""
    chunks = max(1, -(-rows // CHUNK_ROWS))
    chunked = df.withColumn("chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    before = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (chunked.groupBy(group, "chunk").count()
               .select(group, "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy(group, "chunk").orderBy(*order)
    return (chunked.withColumn("within", F.row_number().over(within) - 1)
            .join(offsets, [group, "chunk"])
            .withColumn(name, (F.col("offset") + F.col("within")).cast("long"))
            .drop("chunk", "offset", "within"))


def shards(docs: DataFrame, count: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Groups are equal texts (null counts as empty) and stay together; the law is `bytes`.
    Sizes are rounded up to 9 leading bits, which leaves a histogram of at most a few
    thousand classes however many groups there are; only that comes to the driver and is
    packed there. Groups of a class are told apart by their rank, and ranks and slots are
    numbered in chunks of bounded size. A group above an equal share has its shard alone.
    Rows may repeat and ids may be null; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"),
                           (F.octet_length(text).cast("long") + 1).alias("size"),
                           F.crc32(text).alias("text_crc32"),
                           F.unhex(F.sha2(text, 256)).alias("text_key")), "shard-rows")
    unit = F.expr(f"shiftleft(1L, greatest(length(bin(bytes)) - {BITS}, 0))")
    groups = (rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
              .withColumn("class", F.ceil(F.col("bytes") / unit) * unit)
              .select("text_key", "class"))
    groups = cut(groups, "shard-groups")
    sizes = [(r["class"], r["count"]) for r in groups.groupBy("class").count().collect()]
    runs = docs.sparkSession.createDataFrame(
        into_shards(sizes, count) if sizes else [], "class long, first long, end long, shard int")
    ranked = _numbered(groups, "class", ["text_key"], sum(n for _, n in sizes), "rank")
    runs = runs.withColumnRenamed("class", "of")
    placed = (ranked.join(F.broadcast(runs), (F.col("class") == F.col("of"))
                          & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
              .select("text_key", "shard"))
    dealt = rows.join(placed, "text_key").select("doc_id", "size", "text_crc32", "shard")
    return (_numbered(dealt, "shard", ["doc_id", "size", "text_crc32"], rows.count(), "slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
