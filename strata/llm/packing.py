"""Hierarchical multi-length packing (operator 9).

Each task tokenizes its documents and packs them, so ids are never shuffled. Whole
windows of the longest tier are cut from long documents at once. What is left of each
document is routed to the least tier that holds it; tiers are packed from the longest
one, the gaps of a window are filled with the longest rests that fit, from shorter tiers
too, and the last gap by a cut. A window that stays open at the end of a task is cut at
powers of two, so no sequence has padding.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heapreplace
from operator import itemgetter
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import id_type, strings, text_slices

TIERS = (1024, 512, 256, 128)
STEP_TOKENS = 16 * 1024    # of a step group, all of one tier
POOL_TOKENS = 1 << 20      # rests that a task holds before it packs them
PRETOKENS = 800_000        # pieces that a Python worker keeps
_LONG = 64                 # longer pre-tokens are not cached
_RARE = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S) (?=\S)")
WORD = 4                   # bytes of an id


def _odd(text: str) -> bool:
    """Whether some space has white space, or an end of the text, beside it."""
    return ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
            or _RARE.search(text) is not None)


class Encoder:
    """Ids as little-endian bytes; a space between two words always begins a pre-token.

    So a text is cut at such spaces, and each distinct piece is tokenized once and kept, in two
    generations: when the young one is full it becomes the old one, from which pieces come
    back as they are met; both together have ``pieces`` of them (and those of one call). With ``special_tokens`` the text of an added token stands for its id, as ``tokenizers``
    has it by default; such a text is tokenized whole.
    """

    def __init__(self, path: str, special_tokens: bool = False, pieces: int | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special_tokens
        added = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._whole = re.compile("|".join(added) if special_tokens and added else r"(?!)")
        vocabulary = self._tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self._spaced[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True
        self._pieces = PRETOKENS if pieces is None else pieces
        self._kept: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[str]) -> None:
        """Tokenize pieces in one text: the first token of each begins with its space."""
        spaced = [p for p in parts if " " in p]
        self._kept.update(zip(spaced, self._ids([" " + p for p in spaced])))
        plain = [p for p in parts if " " not in p]
        if plain:
            found = self._tokenizer.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            at = [*(np.flatnonzero(self._spaced[ids]) * WORD).tolist(), len(ids) * WORD]
            ids = ids.tobytes()
            self._kept.update((p, ids[lo:hi]) for p, lo, hi in zip(plain, at, at[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [[t] if self._whole.search(t) else _CUT.split(t) if _odd(t) else t.split(" ") for t in texts]
        if len(self._kept) > self._pieces // 2:
            self._old, self._kept = self._kept, {}
        kept, old = self._kept, self._old
        heads = self._ids([parts[0] for parts in cut])
        new = {p for parts in cut for p in parts[1:]}.difference(kept)
        back = [p for p in new if p in old]
        kept.update(zip(back, map(old.__getitem__, back)))
        new = list(new.difference(back))
        if new:
            self._learn(new)
        out = [b"".join((head, *map(kept.__getitem__, parts[1:]))) for head, parts in zip(heads, cut)]
        for part in new:
            if len(part) > _LONG:
                del kept[part]
        return out


def encoder_of_worker(path: str, special_tokens: bool, pieces: int | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file; a reused Python worker keeps it between tasks.

    Task functions come pickled by value, so their module's own globals are new in each task;
    what shall last is held by a module that is entered in the worker's ``sys.modules``.
    """
    holder = sys.modules.setdefault("_strata_worker", ModuleType("_strata_worker")).__dict__
    key = ("encoder", path, special_tokens, pieces)
    if key not in holder:
        holder[key] = Encoder(path, special_tokens, pieces)
    return holder[key]


@dataclass
class Piece:
    doc: int          # row in the task's list of documents
    start: int
    ids: bytes

    @property
    def length(self) -> int:
        return len(self.ids) // WORD

    def split(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:at * WORD]),
                Piece(self.doc, self.start + at, self.ids[at * WORD:]))


def tier_of(length: int, tiers: tuple[int, ...]) -> int:
    return min(t for t in tiers if t >= length)


def pack(rests: list[Piece], tiers: tuple[int, ...], last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows from ``rests``, and what is left for later (nothing if ``last``)."""
    pool = sorted(rests, key=lambda p: p.length)
    windows: list[list[Piece]] = []
    while pool:
        window = [pool.pop()]
        gap = tier_of(window[0].length, tiers) - window[0].length
        while gap and pool:
            at = bisect_right(pool, gap, key=lambda p: p.length) - 1
            if at >= 0:
                piece = pool.pop(at)
            else:
                piece, rest = pool.pop(0).split(gap)
                insort(pool, rest, key=lambda p: p.length)
            window.append(piece)
            gap -= piece.length
        if gap and not last:
            return windows, window
        if gap:
            windows.extend(at_powers(window))
        else:
            windows.append(window)
    return windows, []


def at_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Cut an open window into sequences whose lengths are its binary digits."""
    left, windows = sum(p.length for p in pieces), []
    queue = pieces[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        window = []
        while size:
            piece = queue.pop()
            if piece.length > size:
                piece, rest = piece.split(size)
                queue.append(rest)
            window.append(piece)
            size -= piece.length
        windows.append(window)
    return windows


def step_groups(windows: list[list[Piece]], step_tokens: int, first: int) -> tuple[list[int], int]:
    """Group number of each window: equal counts of one length, balanced by attention cost."""
    by_length: dict[int, list[int]] = {}
    for i, window in enumerate(windows):
        by_length.setdefault(sum(p.length for p in window), []).append(i)
    groups = [0] * len(windows)
    for length, members in by_length.items():
        room = max(1, step_tokens // length)
        count = -(-len(members) // room)
        costs = {i: sum(p.length ** 2 for p in windows[i]) for i in members}
        heap = [(0, first + g, room) for g in range(count)]
        heapify(heap)
        for i in sorted(members, key=costs.get, reverse=True):
            cost, group, free = heap[0]
            groups[i] = group
            heapreplace(heap, (cost + costs[i] if free > 1 else float("inf"), group, free - 1))
        first += count
    return groups, first


class _Task:
    """Packing state of one task."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, base: int) -> None:
        self.tiers, self.step_tokens = tiers, step_tokens
        self.sequence = self.group = base
        self.docs: dict[int, tuple] = {}
        self.full: list[list[Piece]] = []
        self.rests: list[Piece] = []
        self.held = 0

    def add(self, row: int, doc_id, ids: bytes) -> None:
        n, longest = len(ids) // WORD, self.tiers[0]
        self.docs[row] = (doc_id, n)
        for start in range(0, n - longest + 1, longest):
            self.full.append([Piece(row, start, ids[start * WORD:(start + longest) * WORD])])
        start = n - n % longest
        if start < n:
            self.rests.append(Piece(row, start, ids[start * WORD:]))
        self.held += n

    def flush(self, last: bool) -> list[tuple]:
        packed, self.rests = pack(self.rests, self.tiers, last)
        windows = self.full + packed
        groups, self.group = step_groups(windows, self.step_tokens, self.group)
        out = []
        for window, group in zip(windows, groups):
            offset, length = 0, sum(p.length for p in window)
            for p in window:
                doc_id, n = self.docs[p.doc]
                out.append((doc_id, p.start, p.length, zlib.crc32(p.ids), n, self.sequence, offset,
                            length, group))
                offset += p.length
            self.sequence += 1
        self.full, self.held = [], sum(p.length for p in self.rests)
        self.docs = {p.doc: self.docs[p.doc] for p in self.rests}
        return out


def _packed(path: str, end_id: int, tiers: tuple[int, ...], step_tokens: int, pool_tokens: int, schema: pa.Schema,
            special_tokens: bool, pieces: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of_worker(path, special_tokens, pieces), end_id.to_bytes(WORD, "little")
        task = _Task(tiers, step_tokens, TaskContext.get().partitionId() << 40)
        row = 0

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            found = task.flush(last)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(itemgetter(i), found), f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in text_slices(batches, "text", 256):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   encoder.encode(strings(batch.column("text")))):
                task.add(row, doc_id, ids + end)
                row += 1
            if task.held >= pool_tokens:
                yield from rows(False)
        yield from rows(True)
    return run


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
                   special_tokens: bool = False, pieces: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_length, step_group.

    ``tokenizer`` is the path of a byte-level BPE tokenizer file, on every executor.
    ``tiers`` are powers of two. A null or empty text is its end id alone. Rows may repeat
    and ids may be null: each row is packed as its own document. Sequence ids are unique
    and the same when a task is run again; an empty table gives an empty result. With
    ``special_tokens`` the text of a special token gives its id, else the ids of its characters.
    ``pieces`` (default ``PRETOKENS``): pre-tokens that a Python worker keeps between its tasks; fewer take
    less memory and more time, and give the same rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    form = (f"doc_id {id_type(docs, id_col)}, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, offset long, sequence_length long, step_group long")
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], form).schema)
    return base.mapInArrow(_packed(tokenizer, end_id, tuple(sorted(tiers, reverse=True)), step_tokens,
                                   POOL_TOKENS, arrow, special_tokens, pieces), form)
