"""Viterbi over a unigram vocabulary with forward scores shared by common prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

MARK = "▁"         # a space inside pieces
UNKNOWN_PENALTY = 10.0  # below the least piece score, as SentencePiece has it
_PIECE = ""             # key of (id, score) in a vocabulary trie node


class Vocabulary:
    """Trie of the pieces of a model file, with their scores as the file states them."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[str] = []
        scores, self.bytes = [], {}
        self.root: dict = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.pieces.append(piece)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores.append(model.get_score(i))
                node = self.root
                for c in piece:
                    node = node.setdefault(c, {})
                node[_PIECE] = (i, scores[-1])
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = model.unk_id()
        self.byte_of = {i: b for b, i in self.bytes.items()}

    def spelled(self, char: str) -> list[int]:
        """Ids of a character that no piece covers: its bytes, or the unknown id."""
        return [self.bytes.get(b, self.unknown_id) for b in char.encode()] if self.bytes else [self.unknown_id]


class Walk:
    """Depth-first walk over sorted words: what a word shares with the one before it is kept.

    For each position of the current word: the forward score, the token count, the piece
    that ends there with its start, and the vocabulary nodes still open.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._vocabulary = vocabulary
        self._word = ""
        self._score, self._count = [0.0], [0]
        self._from: list[tuple[int, int]] = [(0, -1)]
        self._open: list[list[tuple[int, dict]]] = [[]]
        self.steps = 0  # characters scored, for tests

    def _move_to(self, word: str) -> None:
        shared, last = 0, self._word
        for a, b in zip(last, word):
            if a != b:
                break
            shared += 1
        for kept in (self._score, self._count, self._from, self._open):
            del kept[shared + 1:]
        vocabulary, score, root = self._vocabulary, self._score, self._vocabulary.root
        for at in range(shared, len(word)):
            c, best, origin, covered, still = word[at], -math.inf, (at, -1), False, []
            for start, node in (*self._open[at], (at, root)):
                node = node.get(c)
                if node is None:
                    continue
                still.append((start, node))
                piece = node.get(_PIECE)
                if piece is not None:
                    covered = covered or start == at
                    if score[start] + piece[1] > best:
                        best, origin = score[start] + piece[1], (start, piece[0])
            size = 1
            if not covered and score[at] + vocabulary.unknown > best:
                best, origin = score[at] + vocabulary.unknown, (at, -1)
                size = len(vocabulary.spelled(c))
            score.append(best)
            self._count.append(self._count[origin[0]] + size)
            self._from.append(origin)
            self._open.append(still)
            self.steps += 1
        self._word = word

    def counts(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """(word, tokens) in sorted order."""
        for word in sorted(words):
            self._move_to(word)
            yield word, self._count[-1]

    def ids(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) in sorted order."""
        for word in sorted(words):
            self._move_to(word)
            out, end = [], len(word)
            while end:
                start, piece = self._from[end]
                out += [piece] if piece >= 0 else self._vocabulary.spelled(word[start])[::-1]
                end = start
            yield word, out[::-1]


def marked_words(text: str) -> list[str]:
    """The words of ``text`` with spaces as marks and one mark in front, less their first mark.

    A run of marks goes with the word behind it; no piece crosses from a letter to a
    mark, so words are scored on their own.
    """
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")  # a literal mark reads as a space
    if "" not in parts:
        return parts
    out, marks = [], ""
    for part in parts:
        if part:
            out.append(marks + part)
            marks = ""
        else:
            marks += MARK
    if marks:
        out.append(marks[1:])
    return out
