import random
import zlib
from array import array
from functools import cache

import pytest

from strata.llm import pieces, token_counts
from strata.llm._util import tokenizer_path
from strata.llm.lattice import MARK, Vocabulary, Walk, marked_words

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def scores(vocabulary):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return {p: (i, model.get_score(i)) for i, p in enumerate(vocabulary.pieces)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}


def brute(text, vocabulary, scores):
    """Best segmentation of the whole marked text, without tries or words."""
    if not text:
        return []
    marked = MARK + text.replace(" ", MARK)
    longest = max(map(len, scores))

    @cache
    def best(end):
        if end == 0:
            return 0.0, ()
        top = None
        for start in range(max(0, end - longest), end):  # a longer last piece first
            known = scores.get(marked[start:end])
            if known:
                score, ids = best(start)
                if top is None or score + known[1] > top[0]:
                    top = (score + known[1], (*ids, known[0]))
        if marked[end - 1] not in scores:
            score, ids = best(end - 1)
            if top is None or score + vocabulary.unknown > top[0]:
                top = (score + vocabulary.unknown, (*ids, *vocabulary.spelled(marked[end - 1])))
        return top
    for end in range(len(marked)):
        best(end)
    return list(best(len(marked))[1])


TEXTS = ["", " ", "  a", "a  ", "a  b", "the cat sat", "x\ny\n\nz", "é中\U0001F600 ñ①", "word" * 30, f"a{MARK}b {MARK}", "\t\x00 z",
         "unbelievable internationalization"]


def random_texts(n, seed):
    rnd = random.Random(seed)
    bits = ["the", "ing", "tion", " ", " ", "  ", "a", "z", "Q", "é", "①", "\n", ".", "12", "中"]
    return ["".join(rnd.choices(bits, k=rnd.randint(0, 14))) for _ in range(n)]


def test_no_piece_goes_from_a_letter_to_a_mark(vocabulary):
    assert not any(MARK in p.lstrip(MARK) for p in vocabulary.pieces)


def test_encoding_against_whole_text_viterbi(vocabulary, scores):
    codec = pieces.Codec(PATH)
    for texts in (TEXTS, random_texts(800, 1), random_texts(800, 1)):
        for text, ids in zip(texts, codec.encode(texts)):
            assert array("I", ids).tolist() == brute(text.replace(MARK, " "), vocabulary, scores), repr(text)


def test_exact_round_trip():
    codec = pieces.Codec(PATH)
    for text, ids in zip(TEXTS + random_texts(1000, 2), codec.encode(TEXTS + random_texts(1000, 2))):
        assert codec.decode(ids) == text.replace(MARK, " ")


def test_unigram_model_of_another_library(scores):
    """The tokenizers library's unigram model over the same pieces finds as good a score."""
    from tokenizers import Tokenizer, models
    pairs = sorted(scores.items(), key=lambda kv: kv[1][0])
    other = Tokenizer(models.Unigram([("<unk>", -2e9), *((p, s) for p, (_, s) in pairs)], 0))
    value = {p: s for p, (_, s) in pairs}
    walk = Walk(Vocabulary(PATH))
    words = sorted({MARK + "".join(random.Random(i).choices(["the", "in", "er", "a", "s", "tion"], k=4)) for i in range(300)})
    names = Vocabulary(PATH).pieces
    for word, ids in walk.ids(words):
        mine = sum(value[names[i]] for i in ids)
        assert abs(mine - sum(value[t] for t in other.encode(word).tokens)) < 1e-6, word


def test_prefixes_are_scored_once(vocabulary):
    words = ["abcdef" + c for c in "uvwxyz"] + ["abc"]
    walk = Walk(vocabulary)
    list(walk.counts(words))
    assert walk.steps == len("abcdef") + 6
    fresh = [next(Walk(vocabulary).counts([w]))[1] for w in sorted(words)]
    assert [n for _, n in Walk(vocabulary).counts(words)] == fresh


def test_marked_words():
    for text in TEXTS + random_texts(300, 3):
        words = marked_words(text)
        assert "".join(MARK + w for w in words) == (MARK + text.replace(" ", MARK) if text else "")


def test_counts_and_digests_of_documents(documents, odd_rows, vocabulary, scores):
    rows = odd_rows[:10] + [(100 + i, t, "s") for i, t in enumerate(TEXTS + random_texts(100, 4))]
    want = {r[0]: brute((r[1] or "").replace(MARK, " "), vocabulary, scores) for r in rows if len(r[1] or "") < 1000}
    counts = token_counts.token_counts(documents(rows), PATH).collect()
    digests = pieces.digests(documents(rows), PATH).collect()
    assert len(counts) == len(digests) == len(rows) and all(d.round_trip for d in digests)
    text = {r[0]: r[1] or "" for r in rows}
    for c in counts:
        if c.doc_id in want and c.doc_id is not None:
            assert c.n_tokens == len(want[c.doc_id])
    for d in digests:
        if d.doc_id in want and d.doc_id is not None:
            assert (d.n_tokens, d.ids_crc32) == (len(want[d.doc_id]), zlib.crc32(array("I", want[d.doc_id]).tobytes()))
            assert d.decoded_crc32 == zlib.crc32(text[d.doc_id].replace(MARK, " ").encode())
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(documents(rows), PATH), PATH).collect()}
    assert all(back[i] == t.replace(MARK, " ") for i, t in text.items() if i not in (None,))
    for empty in (token_counts.token_counts(documents([]), PATH), pieces.digests(documents([]), PATH)):
        assert empty.count() == 0
