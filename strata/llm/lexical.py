"""Ranked lexical search with geometric blocks in every posting list (operator 12).

1. One pass over the texts: the length of each document and its counts of query terms.
   Spark adds up what the scores need from all documents (their number, their terms, the
   document frequency of each query term).
2. Each task cuts its documents into segments and searches them for every query. A posting
   list is cut into blocks of similar documents: their term weights are projected on a few
   random directions, some members of the list are its centres, and each member goes to the
   closest one. A block has a summary: the largest weight of every term over its documents.
3. A query walks its terms from the largest possible gain down. The summary bounds the score
   of every document of a block from above, so a block is skipped if its bound is below the
   score of the last of the best documents so far, and the walk ends once all terms that are
   left cannot lift a new document to that score. Other documents are scored in whole, so
   the result is exact. Blocks are made when a query first reads their list.
4. The best documents of the segments meet per query, cut to the best before the shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm._util import cut, text_slices, utf8

BEST = 10
SCALE = 1_000_000_000      # of the saturated term count, in thousandths below
K1, B = 1000, 75           # saturation (8 times the norm below) and length norm in hundredths
SEGMENT = 600_000          # (document, term) counts of a segment
SUMMARIES = 6_000_000      # (block, term) maxima that a segment keeps
CELLS = 2_000_000          # of the table in which the maxima of some blocks are made
QUERIES = 4096             # queries that are searched in one pass over the counts
DIRECTIONS = 32            # of the projection that tells similar documents
_APART = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters above U+007F; A-Z is lower-cased."""
    return text.translate(_APART).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _counted(vocabulary: dict[bytes, int]):
    """Adds up to each row its number of terms and its counts of query terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            lengths, ends, ids, counts = [], [0], [], []
            for text in utf8(batch.column("text")):
                words = terms(text)
                found = Counter(map(vocabulary.get, words))
                found.pop(None, None)
                lengths.append(len(words))
                ids.extend(found.keys())
                counts.extend(found.values())
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], ["doc_id", "n", "terms", "counts"])
    return run


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every (start, length) one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Segment:
    """Documents of one task: term weights by document, and posting lists in blocks."""

    def __init__(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, sizes: np.ndarray,
                 ids: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.doc_ids, self.nulls, self.weights = doc_ids, nulls, weights
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        norm = 100 - B + (B * lengths * n_docs) // max(n_terms, 1)
        self.ids, self.parts = ids, ((SCALE * counts) // (K1 * counts + 8 * norm[owner])).astype(np.int32)  # below 10^6
        order = np.argsort(ids, kind="stable")
        self.posted = owner[order]
        self.list_starts = np.searchsorted(ids[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        full = np.flatnonzero(np.diff(self.list_starts))
        self.most[full] = np.maximum.reduceat(self.parts[order], self.list_starts[full]) if len(full) else 0
        self.blocks: dict[int, tuple] = {}
        self._kept = 0
        self._near: np.ndarray | None = None

    def _directions(self) -> np.ndarray:
        """Projection of every document's weights, of length one."""
        if self._near is None:
            signs = np.random.default_rng(12).choice(np.array([-1, 1], np.float32), (len(self.weights), DIRECTIONS))
            gain = (self.weights[self.ids] * self.parts).astype(np.float32)
            near = np.zeros((len(self.sizes), DIRECTIONS), np.float32)
            full = np.flatnonzero(self.sizes)
            for i in range(0, len(full), 4096):
                rows = full[i:i + 4096]
                lo, hi = self.starts[rows[0]], self.starts[rows[-1]] + self.sizes[rows[-1]]
                near[rows] = np.add.reduceat(signs[self.ids[lo:hi]] * gain[lo:hi, None], self.starts[rows] - lo, axis=0)
            self._near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
        return self._near

    def _blocked(self, term: int) -> tuple:
        """Documents of a posting list in blocks, where blocks start, and the summaries: sorted
        (block, term) keys with the largest part of the term in the block."""
        docs = self.posted[self.list_starts[term]:self.list_starts[term + 1]]
        count = max(1, math.isqrt(len(docs)))
        if count > 1:
            near = self._directions()
            centres = near[docs[np.linspace(0, len(docs) - 1, count).astype(np.int64)]]
            home = np.concatenate([np.argmax(near[docs[i:i + 8192]] @ centres.T, axis=1) for i in range(0, len(docs), 8192)])
            order = np.argsort(home, kind="stable")
            docs, home = docs[order], np.unique(home[order], return_inverse=True)[1]
        else:
            home = np.zeros(len(docs), np.int64)
        starts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(docs))
        # maxima of a few blocks at a time, in a table of their documents' terms
        width, keys, most = len(self.weights), [], []
        step = max(1, CELLS // width)
        for first in range(0, len(starts) - 1, step):
            last = min(first + step, len(starts) - 1)
            part = docs[starts[first]:starts[last]]
            at = ranges(self.starts[part], self.sizes[part])
            key = np.repeat((home[starts[first]:starts[last]] - first) * width, self.sizes[part]) + self.ids[at]
            table = np.zeros((last - first) * width, np.int32)
            np.maximum.at(table, key, self.parts[at])
            found = np.flatnonzero(table)
            keys.append(found + first * width)
            most.append(table[found])
        return docs.astype(np.int32), starts, np.concatenate(keys), np.concatenate(most)

    def bounds(self, term: int, query: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Upper bound of the score of every block of the term's list."""
        if term not in self.blocks:
            if self._kept > SUMMARIES:
                self.blocks.clear()
                self._kept = 0
            self.blocks[term] = self._blocked(term)
            self._kept += len(self.blocks[term][2])
        _, starts, keys, most = self.blocks[term]
        wanted = np.arange(len(starts) - 1)[:, None] * len(self.weights) + query[None, :]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return (np.where(keys[at] == wanted, most[at], 0) * gains).sum(axis=1)

    def scores(self, docs: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Whole scores of documents with at least one term; gains are by term."""
        at = ranges(self.starts[docs], self.sizes[docs])
        each = gains[self.ids[at]] * self.parts[at]
        return np.add.reduceat(each, np.cumsum(self.sizes[docs]) - self.sizes[docs])

    def search(self, query: np.ndarray, times: np.ndarray, best: int = BEST) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) that may be among the best, and how many were scored. All that reach
        the score of the last of the best are kept, so ties are settled by whoever knows all."""
        gains = np.zeros(len(self.weights), np.int64)
        gains[query] = times * self.weights[query]
        listed = self.list_starts[query + 1] > self.list_starts[query]
        query = query[listed & (gains[query] > 0)]
        reach = gains[query] * self.most[query]
        order = np.argsort(-reach, kind="stable")
        query, left = query[order], np.cumsum(reach[order][::-1])[::-1]
        own = gains[query]
        seen, scored = np.zeros(len(self.sizes), bool), 0
        docs, points, least = np.empty(0, np.int64), np.empty(0, np.int64), 1

        def take(more: np.ndarray) -> None:
            nonlocal docs, points, least, scored
            more = more[~seen[more]]
            if not len(more):
                return
            seen[more] = True
            scored += len(more)
            docs, points = np.concatenate([docs, more]), np.concatenate([points, self.scores(more, gains)])
            if len(points) > best:
                least = max(1, int(np.partition(points, len(points) - best)[len(points) - best]))
                docs, points = docs[points >= least], points[points >= least]
            elif len(points) == best:
                least = max(1, int(points.min()))

        for i, term in enumerate(query):
            if left[i] < least:
                break
            bound = self.bounds(term, query, own)
            members, starts = self.blocks[term][:2]
            ranked = np.argsort(-bound, kind="stable")
            size = 1
            while len(ranked) and bound[ranked[0]] >= least:
                now, ranked = ranked[:size], ranked[size:]
                now = now[bound[now] >= least]
                take(members[ranges(starts[now], starts[now + 1] - starts[now])])
                size *= 4
        return docs[points >= least], points[points >= least], scored


def _searched(queries: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0

        def found() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, sizes = rows["terms"].combine_chunks(), rows["terms"].combine_chunks().value_lengths().to_numpy()
            doc_id = rows["doc_id"].combine_chunks()
            segment = Segment(doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False),
                              rows["n"].to_numpy(), sizes.astype(np.int64), ids.flatten().to_numpy(),
                              rows["counts"].combine_chunks().flatten().to_numpy(), weights, n_docs, n_terms)
            out = []
            for item, query, times in queries:
                docs, points, _ = segment.search(query, times, best)
                # of equal scores the least ids; rows without an id come last
                first = np.lexsort((segment.doc_ids[docs], segment.nulls[docs], -points))[:best]
                out.append((np.full(len(first), item), docs[first], points[first]))
            item, docs, points = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(segment.doc_ids[docs], pa.int64(), mask=segment.nulls[docs]),
                 pa.array(points, pa.int64())], ["item", "doc_id", "score"])

        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                held.append(part)
                entries += len(part.column("terms").flatten())
                if entries >= SEGMENT:
                    yield from found()
                    held, entries = [], 0
        if held:
            yield from found()
    return run


def _ranked(docs: DataFrame, items: list[tuple[int, Counter]], best: int) -> DataFrame:
    """(item, rank, doc_id, score) of one block of queries (item number, terms with counts)."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, query in items for t in query}))}
    counted = cut(docs.mapInArrow(_counted(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>"), "counts")
    totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs, totals.terms or 0
    weights = np.array([weight(n_docs, 0)] * len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a query term
        weights[r.term] = weight(n_docs, r["count"])
    queries = [(item, np.array([vocabulary[t] for t in query], np.int64), np.array(list(query.values()), np.int64))
               for item, query in items]
    near = counted.where(F.size("terms") > 0).mapInArrow(
        _searched(queries, weights, n_docs, n_terms, best), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", query_col: str = "text", best: int = BEST, block: int = QUERIES) -> DataFrame:
    """The best documents of each item: item_id, rank, doc_id, score.

    ``docs`` has integer ids. Items are read in blocks of ``block`` (by item id and text), so that the
    driver and the tasks hold the queries of one block only; each block is one search over all
    documents. Null or empty texts have no terms: such items have no rows, such documents are never
    found and do not count. Equal scores are ranked by ascending doc_id, null ids last; rows that repeat
    an id are documents of their own, and so are items. Only the named columns are read. Without
    documents or items the result is empty.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(query_col).alias("text")).orderBy("item_id", "text")
    kind = items.schema[item_col].dataType
    spark, out = docs.sparkSession, None
    rows, number = asked.toLocalIterator(), 0
    while part := list(islice(rows, block)):
        queries = [(number + i, Counter(terms((r.text or "").encode()))) for i, r in enumerate(part)]
        names = spark.createDataFrame([(number + i, r.item_id) for i, r in enumerate(part)],
                                      f"item long, item_id {kind.simpleString()}")
        found = _ranked(base, [q for q in queries if q[1]], best)
        found = cut(found.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        out, number = found if out is None else out.union(found), number + len(part)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out
