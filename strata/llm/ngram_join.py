"""N-gram Jaccard self-join by T-occurrence search (operator 13).

A document of n shingles shares at least T = ceil(85 n / 100) with any partner. Put the
shingles of every document in one global order, the most frequent ones last: of its
inverted lists the first n - T + 1 are the short ones, the other L = T - 1 the long ones.

1. One pass finds shingles that repeat often within a task; Spark adds the counts up. Those of a
   fixed share of all documents, which bounds their number, go to the end of the order.
2. A second pass gives a hash of the shingle set (the node: rows with equal sets are one, so
   copies are never expanded into pairs), its size and its short lists.
3. Only the short lists are built, by one exchange and a sort that is read as a stream; those of
   common shingles, which may be very long, are aggregated in place. Two nodes link only if they
   meet in T - L short lists at least, T now the overlap that their sizes ask for and L the larger
   number of long lists. Each node first looks at the head of the lists it shares most; merge
   rounds then try one node of each component against the largest component of its lists.
4. What is left are lists with several components. Nodes outside a list's largest component meet
   its other members, in blocks and chunks so that a list of any length is spread. A node's
   partners from all its lists are heap-merged, skipping those that cannot reach T - L.
5. The long lists are probed: for each candidate a binary search tells whether it stands in the
   list of a shingle, until T is reached or out of reach.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import cut, id_type, text_slices, utf8
from strata.llm.lexical import ranges
from strata.llm.graph import components, merged
from strata.llm.near_dup import _lists

WIDTH = 4                  # words of a shingle
SIMILAR = (85, 100)        # linked: 100 * intersection >= 85 * union
HELD = 4_000_000           # shingles of a task that are counted together
REPEATS = 3                # occurrences among them that are reported
SHARE = 4096               # a common shingle is in one of so many documents at least
TURNS = ((0, 1, 2),)       # merge rounds
BLOCK, CHUNK = 256, 2048   # asking and standing nodes that meet in one group
SLOTS = 64                 # groups in which the partners of one node are merged
BANDS = 4                  # size bands in which partners are merged
PROBES = 512               # probes between two looks at what is still within reach
PAIRS = 1 << 20            # pairs of a list that are made at a time
PIECE = 1 << 21            # bytes of text that are hashed at a time
CODEC = "zstd"             # of the texts that are compared: they are shuffled for each comparison
_FACTOR = 0x9E3779B97F4A7C15


def _byte_values() -> np.ndarray:
    """A random odd value for each byte; A-Z have those of a-z."""
    values = np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


def _powers(factor: int, count: int) -> np.ndarray:
    out = np.full(count, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Shingle sets of a column of texts at once.

    The hash of a word is its bytes' values times rising powers of a factor, added up: a
    difference of running sums, moved to the start of the text by the inverse power. A
    shingle combines the hashes of its words in order.
    """

    SPACE = np.isin(np.arange(256), [32, *range(9, 14)])

    def __init__(self, width: int) -> None:
        self.width, self.values = width, _byte_values()
        self._room(PIECE)

    def _room(self, count: int) -> None:
        self.up, self.down = _powers(_FACTOR, count), _powers(pow(_FACTOR, -1, 1 << 64), count)

    def _words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts of the words of ``data``; no word goes over one of ``ends``."""
        if len(data) > len(self.up):
            self._room(len(data))
        inside = ~self.SPACE[data]
        before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
        before[ends[ends < len(data)]] = False
        after[ends[ends > 0] - 1] = False
        start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        sums = np.append(np.uint64(0), np.cumsum(self.values[data] * self.up[:len(data)]))
        return _mix((sums[stop] - sums[start]) * self.down[start]), start

    def sets(self, column: pa.Array) -> list[np.ndarray]:
        """Sorted distinct hashes of the shingles of each text; a short text is one shingle, a text
        without words (or null) has none. Words are as bytes.lower().split() gives them."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        data = (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        hashes, starts, at = [], [], 0
        while at < len(data):   # pieces end behind a space, or with the data
            stop = at + PIECE
            while stop < len(data) and not self.SPACE[data[stop - 1]]:
                found = np.flatnonzero(self.SPACE[data[stop:stop + PIECE]])
                stop = stop + int(found[0]) + 1 if len(found) else stop + PIECE
            stop = min(stop, len(data))
            cuts = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop, side="right")] - at
            h, start = self._words(data[at:stop], cuts)
            hashes.append(h)
            starts.append(start + at)
            at = stop
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        edges = np.searchsorted(np.concatenate(starts) if starts else np.empty(0, np.int64), offsets)
        whole = self._combined(h, self.width)
        out = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if hi - lo >= self.width:
                out.append(np.unique(whole[lo:hi - self.width + 1]))
            else:
                out.append(self._combined(h[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64))
        return out

    def _combined(self, h: np.ndarray, size: int) -> np.ndarray:
        out = np.full(max(0, len(h) - size + 1), size, np.uint64)
        for i in range(size):
            out = out * np.uint64(_FACTOR) + h[i:len(h) - size + 1 + i]
        return _mix(out)


def overlap(n: int, m: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Least intersection of linked sets of n and m shingles."""
    return -(-similar[0] * (n + m) // (similar[0] + similar[1]))


def long_lists(n: int, similar: tuple[int, int] = SIMILAR) -> int:
    return -(-similar[0] * n // similar[1]) - 1


def _repeated(width: int):
    """(shingle, n): shingles that some thousand documents of a task hold several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(width), [], 0

        def out() -> pa.RecordBatch:
            shingles, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= REPEATS
            return pa.RecordBatch.from_arrays([pa.array(shingles[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"])

        for batch in text_slices(batches, "text"):
            for s in shingler.sets(batch.column("text")):
                held.append(s)
                size += len(s)
                if size >= HELD:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
    return run


def ordered(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in the global order (those that are not common first, then by count; ties by hash),
    and their counts as common ones."""
    if not len(common):
        return np.sort(shingles), np.zeros(len(shingles), np.int64)
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    count = np.where(common[at] == shingles, counts[at], 0)
    order = np.lexsort((shingles, count))
    return shingles[order], count[order]


def _signed(width: int, similar: tuple[int, int], common: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, none = Shingler(width), np.empty(0, np.int64)
        for batch in text_slices(batches, "text"):
            node, sizes, short, often = [], [], [], []
            for s in shingler.sets(batch.column("text")):
                sizes.append(len(s))
                if not len(s):
                    node.append(None)
                    short.append(none)
                    often.append(none)
                    continue
                node.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                first, count = (x[:len(s) - long_lists(len(s), similar)] for x in ordered(s, common, counts))
                short.append(first[count == 0].view(np.int64))
                often.append(first[count > 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(node, pa.int64()),
                 pa.array(sizes, pa.int64()), _lists(short), _lists(often)],
                ["doc_id", "text_hash", "node", "n", "short", "often"])
    return run


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, node) sorted by both: those of lists with two nodes or more, with the list's
    least node (head). Only head and last node of the last list are held between batches."""
    last, head, before, told = None, None, None, False    # told: the last list has two nodes already
    for batch in batches:
        if not batch.num_rows:
            continue
        shingle, node = (batch.column(c).to_numpy() for c in ("shingle", "node"))
        goes_on = last is not None and shingle[0] == last
        if goes_on:
            shingle, node = np.append(last, shingle), np.append(head, node)
        first = np.append(True, np.diff(shingle) != 0)
        start = np.flatnonzero(first)
        heads = np.repeat(node[start], np.diff(np.append(start, len(node))))
        new = np.append(True, (np.diff(node) != 0) | (np.diff(shingle) != 0))
        other = new & (node != heads)
        if goes_on and node[1] == before:
            other[1] = False
        shared = np.logical_or.reduceat(other, start)
        if goes_on and told:
            shared[0] = True
        keep = np.repeat(shared, np.diff(np.append(start, len(node)))) & (first | other)
        if goes_on and told:
            keep[0] = False
        last, head, before, told = shingle[-1], heads[-1], node[-1], bool(shared[-1])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(shingle[keep]), pa.array(node[keep]), pa.array(heads[keep])],
                                             ["shingle", "node", "head"])


def _meet(similar: tuple[int, int]):
    """Rows sorted by group: pairs (hi, lo) that asking nodes, which are outside the list's largest
    component, form with nodes of other components of a size within reach."""
    def pairs(p: dict[str, np.ndarray], start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``p`` has the standing rows of each group first, then the asking ones."""
        asks = np.flatnonzero(p["asks"])
        group = np.searchsorted(start, asks, side="right") - 1
        standing = np.add.reduceat(~p["asks"], start)[group] if len(asks) else np.empty(0, np.int64)
        ends = np.cumsum(standing)
        at = 0
        while at < len(asks):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            i = np.repeat(asks[at:upto], standing[at:upto])
            j = ranges(start[group[at:upto]], standing[at:upto])
            at = upto
            n, m = p["n"][i], p["n"][j]
            near = ((p["comp"][i] != p["comp"][j]) & (~p["minor"][j] | (p["node"][j] < p["node"][i]))
                    & (similar[1] * np.minimum(n, m) >= similar[0] * np.maximum(n, m)))
            i, j = i[near], j[near]
            if len(i):
                swap = p["node"][i] < p["node"][j]
                hi, lo = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p["node"][hi]), pa.array(p["node"][lo]), pa.array(p["shingle"][i]),
                     pa.array(p["n"][hi].astype(np.int32)), pa.array(p["n"][lo].astype(np.int32))],
                    ["hi", "lo", "shingle", "n_hi", "n_lo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = {c: batch.column(c).to_numpy(zero_copy_only=False)
                    for c in ("shingle", "block", "chunk", "node", "comp", "n", "minor", "asks")}
            if held is not None:
                part = {c: np.concatenate([held[c], part[c]]) for c in part}
            new = np.zeros(len(part["node"]) - 1, bool)
            for c in ("shingle", "block", "chunk"):
                new |= np.diff(part[c]) != 0
            edges = np.append(0, np.flatnonzero(new) + 1)
            if len(edges) > 1:
                yield from pairs({c: v[:edges[-1]] for c, v in part.items()}, edges[:-1])
            held = {c: v[edges[-1]:] for c, v in part.items()}
        if held is not None:
            yield from pairs(held, np.zeros(1, np.int64))
    return run


def merge_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Members that stand in ``least`` of the sorted lists or more, with their number of lists.

    A heap holds the head of every list. If the smallest head is in too few lists, ``least`` - 1
    heads are taken off and their lists skip to the smallest head that is left.
    """
    heap = [(x[0], i, 0) for i, x in enumerate(lists) if x]
    heapq.heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= least:
        member = heap[0][0]
        taken = []
        while heap and heap[0][0] == member:
            taken.append(heapq.heappop(heap))
        if len(taken) >= least:
            found[member] = len(taken)
            goal = member + 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                break
            goal = max(heap[0][0], member + 1)
        for _, i, at in taken:
            at = bisect_left(lists[i], goal, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return found


def needed(n: int, m: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Short lists that linked sets of n and m shingles share at least."""
    return max(1, overlap(n, m, similar) - max(long_lists(n, similar), long_lists(m, similar)))


def candidates(n: int, lists: dict[int, list[tuple[int, int]]], similar: tuple[int, int] = SIMILAR) -> list[int]:
    """Partners that meet a node of size ``n`` in enough of its ``lists`` (of sorted (member, size)).

    Partners are merged in bands of similar size, each with the least number that holds in the band.
    """
    sizes = {m for x in lists.values() for _, m in x}
    if not sizes:
        return []
    edges = np.linspace(min(sizes), max(sizes) + 1, BANDS + 1).astype(int)
    found = []
    for low, high in zip(edges, edges[1:]):
        band = [m for m in sizes if low <= m < high]
        if not band:
            continue
        size = {member: m for x in lists.values() for member, m in x if low <= m < high}
        least = min(needed(n, m, similar) for m in band)
        merged_ = merge_skip([[member for member, m in x if low <= m < high] for x in lists.values()], least)
        found += [member for member, k in merged_.items() if k >= needed(n, size[member], similar)]
    return found


def _merged(similar: tuple[int, int]):
    """Rows sorted by (hi, slot, shingle, lo): candidates of each node among the partners of a slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, n, lists = None, 0, {}
        a, b = [], []

        def close() -> None:
            if me is not None:
                near = candidates(n, lists, similar)
                a.extend([me[0]] * len(near))
                b.extend(near)

        for batch in batches:
            for hi, slot, lo, shingle, n_hi, n_lo in zip(*(batch.column(c).to_pylist()
                                                           for c in ("hi", "slot", "lo", "shingle", "n_hi", "n_lo"))):
                if (hi, slot) != me:
                    close()
                    me, n, lists = (hi, slot), n_hi, {}
                lists.setdefault(shingle, []).append((lo, n_lo))
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a.clear()
                b.clear()
        close()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def probe(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether ``least`` shingles of ``a`` stand in ``b`` (both sorted), by binary search."""
    both = 0
    for i in range(0, len(a), PROBES):
        if both + len(a) - i < least:
            return False
        part = a[i:i + PROBES]
        at = np.minimum(np.searchsorted(b, part), len(b) - 1)
        both += int(np.count_nonzero(b[at] == part))
        if both >= least:
            return True
    return both >= least


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) -> (doc_id, text_hash, body, size): each text compressed by itself,
    with its size in bytes."""
    for batch in text_slices(batches, "text"):
        texts = utf8(batch.column("text"))
        body = [pa.compress(t, CODEC, asbytes=True) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(body, pa.binary()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         ["doc_id", "text_hash", "body", "size"])


def node_texts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, body, size) of ``wanted`` (row: doc_id and text_hash, node) from the rows of ``base``.

    Texts are compressed before they are shuffled, and shuffled once: the rows of a node lie
    together by the key of the join, so that those which repeat it are merged in place.
    """
    bodies = base.mapInArrow(_compressed, f"doc_id {id_type(base, 'doc_id')}, text_hash long, body binary, size long")
    return (bodies.select(F.struct("doc_id", "text_hash").alias("row"), "body", "size").join(wanted, "row")
            .groupBy("row", "node").agg(F.first("body").alias("body"), F.first("size").alias("size"))
            .select("node", "body", "size"))


def _expanded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with both texts again, in slices of bounded rows and bytes; a longer pair is a slice of its own."""
    sizes = [batch.column(c).to_pylist() for c in ("size_a", "size_b")]
    ends = np.cumsum(np.add(*sizes))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (8 << 20), side="right"))
        stop = max(start + 1, min(stop, start + 256))
        text = [pa.array([pa.decompress(body, size, CODEC, asbytes=True) for body, size in
                          zip(batch.column(c).slice(start, stop - start).to_pylist(), size_[start:stop])], pa.large_binary())
                for c, size_ in zip(("body_a", "body_b"), sizes)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(start, stop - start) for c in ("a", "b")), *text],
                                         ["a", "b", "text_a", "text_b"])
        start = stop


def _probed(width: int, similar: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for part in _expanded(batch):
                # rows come sorted by a, whose set is made once for a run of rows
                a = part.column("a").to_numpy()
                first = np.flatnonzero(np.append(True, np.diff(a) != 0))
                own = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(a))))
                left = shingler.sets(part.column("text_a").take(pa.array(first)))
                linked = []
                for i, right in zip(own.tolist(), shingler.sets(part.column("text_b"))):
                    few, many = sorted((left[i], right), key=len)
                    linked.append(probe(few, many, overlap(len(few), len(many), similar)))
                keep = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Links are exact but for collisions of 64-bit hashes (of shingles and of their sets). Only the
    id and the text are read, so other columns may have any name. A null or blank text has
    n_shingles 0 and is a component of its own. component_id is the least non-null id of the
    component; rows may repeat ids and texts. A very long text is a slice of its own in every pass.
    An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    kind = id_type(docs, id_col)
    # at most SHARE shingles for every shingle of an average document come to the driver
    least = max(REPEATS * 8, base.count() // SHARE)
    rows = (base.select("text").mapInArrow(_repeated(width), "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas())
    rows["shingle"] = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    rows = rows.sort_values("shingle")
    common, counts = rows["shingle"].to_numpy(np.uint64), rows["n"].to_numpy(np.int64)
    signed = cut(base.mapInArrow(
        _signed(width, similar, common, counts),
        f"doc_id {kind}, text_hash long, node long, n long, short array<long>, often array<long>"), "signed")
    nodes = cut(signed.where("node is not null").groupBy("node")
                .agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("row"),
                     F.first("n").alias("n")), "nodes")
    sizes = nodes.select("node", "n")
    rare = (signed.select(F.explode("short").alias("shingle"), "node").repartition("shingle")
            .sortWithinPartitions("shingle", "node").mapInArrow(_heads, "shingle long, node long, head long"))
    often = signed.select(F.explode("often").alias("shingle"), "node").distinct()
    shared = (often.groupBy("shingle").agg(F.min("node").alias("head"), F.max("node").alias("last"))
              .where("head < last").select("shingle", "head"))
    met = cut(rare.union(often.join(shared, "shingle").select("shingle", "node", "head")), "lists")

    wanted = nodes.select("row", "node").join(met.select("node").distinct(), "node", "left_semi")
    texts = cut(node_texts(base.select("doc_id", "text_hash", "text"), wanted), "texts")

    def probed(pairs: DataFrame) -> DataFrame:
        left, right = (texts.select(*[F.col(c).alias(name) for c, name in zip(texts.columns, names)])
                       for names in (("a", "body_a", "size_a"), ("b", "body_b", "size_b")))
        return (pairs.join(right, "b").join(left, "a").select("a", "b", "body_a", "size_a", "body_b", "size_b")
                .sortWithinPartitions("a").mapInArrow(_probed(width, similar), "a long, b long"))

    within_reach = F.expr(f"{similar[1]} * least(n, m) >= {similar[0]} * greatest(n, m)")
    heads = (met.where("node <> head").groupBy("node", "head").count().join(sizes, "node")
             .join(sizes.toDF("head", "m"), "head").where(within_reach))
    star = (heads.groupBy("node").agg(F.max_by("head", F.struct("count", -F.col("head"))).alias("a"))
            .select("a", F.col("node").alias("b")))
    parts = components(cut(probed(star), "star"))

    def placed(labels: DataFrame) -> DataFrame:
        return (met.select("shingle", "node").join(labels, "node", "left")
                .select("shingle", "node", F.coalesce("label", "node").alias("comp")))

    for turns in TURNS:
        # one node of each component and list for every turn, from one pass over the lists
        ones = (placed(parts).groupBy("shingle", "comp")
                .agg(F.count(F.lit(1)).alias("size"),
                     *[F.min_by("node", F.xxhash64("node", F.lit(t))).alias(f"one{t}") for t in turns]))
        largest = (ones.groupBy("shingle")
                   .agg(F.max("size").alias("most"), F.count(F.lit(1)).alias("comps"),
                        *[F.max_by(f"one{t}", F.struct("size", "comp")).alias(f"other{t}") for t in turns])
                   .where("comps > 1"))
        each = F.explode(F.array(*[
            F.struct(F.lit(t).alias("turn"), F.col(f"one{t}").alias("one"), F.col(f"other{t}").alias("other"),
                     F.xxhash64("shingle", F.lit(t)).alias("rank")) for t in turns]))
        tries = (ones.join(largest, "shingle").select("comp", "most", each.alias("try")).where("try.one <> try.other")
                 .groupBy("comp", "try.turn")
                 .agg(F.max_by(F.struct("try.one", "try.other"), F.struct("most", "try.rank")).alias("pair"))
                 .select(F.col("pair.other").alias("a"), F.col("pair.one").alias("b")))
        within_size = (tries.distinct().join(sizes.toDF("a", "n"), "a").join(sizes.toDF("b", "m"), "b")
                       .where(within_reach).select("a", "b"))
        parts = cut(merged(parts, cut(probed(within_size), "merge")), "merged")

    within = placed(parts)
    open_lists = (within.groupBy("shingle", "comp").count().groupBy("shingle")
                  .agg(F.max_by("comp", F.struct("count", "comp")).alias("major"), F.max("count").alias("most"),
                       F.sum("count").alias("total"), F.count(F.lit(1)).alias("comps"))
                  .where("comps > 1"))
    spread = (within.join(open_lists, "shingle").join(sizes, "node")
              .withColumn("minor", F.col("comp") != F.col("major"))
              .withColumn("blocks", F.ceil((F.col("total") - F.col("most")) / BLOCK))
              .withColumn("chunks", F.ceil(F.col("total") / CHUNK))
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
              .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks")))
    cols = ["shingle", "block", "chunk", "node", "comp", "n", "minor", "asks"]
    asking = (spread.where("minor").withColumn("asks", F.lit(True))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(cols))
    standing = (spread.withColumn("asks", F.lit(False))
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(cols))
    pairs = (asking.union(standing).repartition("shingle", "block", "chunk")
             .sortWithinPartitions("shingle", "block", "chunk", "asks")
             .mapInArrow(_meet(similar), "hi long, lo long, shingle long, n_hi int, n_lo int"))
    near = (pairs.withColumn("slot", F.pmod(F.xxhash64("lo"), F.lit(SLOTS)))
            .repartition("hi", "slot").sortWithinPartitions("hi", "slot", "shingle", "lo")
            .mapInArrow(_merged(similar), "a long, b long"))
    last = merged(parts, cut(probed(near), "probed"))

    named = nodes.select("node", "least").join(last, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = named.select("node", "label").join(ids, "label").select("node", "component_id")
    return (signed.select("doc_id", "node", "n").join(ids, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
