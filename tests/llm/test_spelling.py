"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import spelling
from tests.llm.test_small_operators import LOWER

SF = "/root/testdata/sf0.001"


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = brute_words(rows)
    wild = defaultdict(set)   # words with one letter taken out, or replaced by a mark
    for w in n:
        for i in range(len(w)):
            wild[w[:i] + w[i + 1:]].add(w)
        wild[w].add(w)
    near = {w: {v for i in range(len(w)) for v in wild[w[:i] + w[i + 1:]]} | wild[w] for w in n}
    near = {w: {v for v in found if one_apart(v, w)} for w, found in near.items()}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


@given(st.lists(st.text("abcé", min_size=1, max_size=6), max_size=40, unique=True), st.text("abcé", min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_index_finds_exactly_the_words_at_distance_one(words, word):
    index = spelling.PositionIndex(words)
    got = {words[i] for i in spelling.members(index.near(word))}
    assert got == {w for w in words if one_apart(w, word)}
    apart = {words[i] for i in spelling.members(index.near(word, apart=2))}
    assert apart == {w for w in got if len(word) < 2 or w[:2] != word[:2]}


def test_large_index_has_one_bit_a_word():
    words = [f"{i:05d}" for i in range(3000)]
    index = spelling.PositionIndex(words)
    got = {words[i] for i in spelling.members(index.near("01234"))}
    assert got == {w for w in words if one_apart(w, "01234")}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(spelling.spelling_variants(docs))
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(set(got)) and set(got) == want
    assert any(f for _, f, *_ in want)


def test_chains_ties_and_split_groups(spark, documents, monkeypatch):
    frequent = {"wordform": 300, "wordforn": 25, "wordfoon": 2, "xordform": 300, "wordforms": 2, "formword": 2, "formworx": 20,
                "formwora": 20}
    rows = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(frequent.items())]
    want = brute(rows)
    assert rows_of(spelling.spelling_variants(documents(rows))) and set(rows_of(spelling.spelling_variants(documents(rows)))) == want
    assert any(root != form and form for _, form, root, *_ in want)
    words = spark.createDataFrame([(w, c) for w, c in frequent.items()], "word string, n long")
    whole = {tuple(r) for r in spelling.near_words(words).collect()}
    assert whole == {tuple(r) for r in spelling.near_words(words, chunk=1, block=2).collect()}


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows(documents, odd_rows, empty):
    rows = [] if empty else odd_rows + [(8, "x" * 200_000, "s"), (20, "CafÉword cafÉword İstanbulx", "s"),
                                        (21, "cafÉword stanbulx", None)]
    got = rows_of(spelling.spelling_variants(documents(rows).selectExpr("*", "text AS word", "1 AS n", "2 AS form")))
    assert set(got) == brute([r[:2] for r in rows]) and len(got) == len(set(got))
