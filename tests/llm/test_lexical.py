"""Ranked search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import lexical
from tests.llm.test_small_operators import LOWER

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    counts = [(doc_id, Counter(split(text))) for doc_id, text in docs]
    N, L = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 25 + (75 * sum(c.values()) * N) // L if c else 0
            score = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in split(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:best])]
    return out


def made(count, seed=3):
    """Documents of skewed words in topics, so that blocks can tell them apart."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        topic = rng.integers(0, 8)
        common = rng.zipf(1.5, rng.integers(1, 40)) % 50
        own = rng.integers(0, 30, rng.integers(0, 25)) + 100 * (topic + 1)
        rows.append((int(i), " ".join(f"w{x}" for x in [*common, *own])))
    return rows


def answer(spark, documents, docs, items, **how):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical.ranked_search(documents(docs), asked, **how).collect()), key=repr)


def test_against_brute_force(spark, documents, monkeypatch):
    docs = made(600)
    items = [(i, docs[17 * i][1]) for i in range(25)] + [(100, "w1 w1 w2"), (101, "W105 w105, w3 absent"), (102, "absent")]
    assert answer(spark, documents, docs, items) == sorted(brute(docs, items), key=repr)
    assert answer(spark, documents, docs, items, block=7, best=3) == sorted(brute(docs, items, 3), key=repr)


def test_many_segments_give_the_same(spark, documents, monkeypatch):
    docs = made(300, 5)
    items = [(i, docs[11 * i][1]) for i in range(20)]
    monkeypatch.setattr(lexical, "SEGMENT", 200)
    assert answer(spark, documents, docs, items) == sorted(brute(docs, items), key=repr)


def test_ties_are_ranked_by_id(spark, documents):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (7, "same words here"), (90, "other")]
    got = answer(spark, documents, docs, [(1, "words"), (1, "words"), (2, "other")])
    assert got == sorted(brute(docs, [(1, "words"), (1, "words"), (2, "other")]), key=repr)
    assert sorted(d for i, _, d, _ in got if i == 1)[::2] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]


def segment(rows):
    """One segment of the rows, its vocabulary, and the brute-force search in it."""
    counts = [Counter(split(t)) for _, t in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
    df, N = Counter(t for c in counts for t in c), len(rows)
    weights = np.array([lexical.weight(N, df[t]) for t in vocabulary])
    n = np.array([sum(c.values()) for c in counts])
    s = lexical.Segment(np.arange(N), np.zeros(N, bool), n, np.array([len(c) for c in counts]),
                        np.array([vocabulary[t] for c in counts for t in c]), np.array([x for c in counts for x in c.values()]),
                        weights, N, int(n.sum()))
    return s, vocabulary


def test_summaries_bound_every_document_and_blocks_are_skipped():
    rows = made(4000, 9)
    s, vocabulary = segment(rows)
    few = 0
    for i in range(0, 400, 13):
        query = Counter(split(rows[i][1]))
        terms, times = np.array([vocabulary[t] for t in query]), np.array(list(query.values()))
        gains = np.zeros(len(vocabulary), np.int64)
        gains[terms] = times * s.weights[terms]
        for t in terms[:5]:
            bound = s.bounds(t, terms, gains[terms])
            docs, starts = s.blocks[t][:2]
            assert sorted(docs) == sorted(s.posted[s.list_starts[t]:s.list_starts[t + 1]])
            for b, top in enumerate(bound):
                assert s.scores(docs[starts[b]:starts[b + 1]], gains).max() <= top
        docs, points, scored = s.search(terms, times)
        all_points = s.scores(np.arange(4000), gains)
        last = np.sort(all_points)[-10]
        assert sorted(docs) == np.flatnonzero(all_points >= max(1, last)).tolist()
        few += scored
    assert few < 0.8 * 4000 * len(range(0, 400, 13))


def test_odd_rows(spark, documents, odd_rows):
    docs = [r[:2] for r in odd_rows] + [(30, "word x"), (31, "Ünïcode ÜNÏCODE a_b-c d.e 3,14")]
    items = [(None, "word"), (1, None), (2, ""), (3, "a b c"), (4, "Ünïcode 14 e"), (5, "x" * 200_000), (6, " \t")]
    assert sorted(answer(spark, documents, docs, items), key=repr) == sorted(brute(docs, items), key=repr)
    assert answer(spark, documents, docs, []) == [] == answer(spark, documents, [], items)
    clash = documents(docs).selectExpr("*", "1 AS n", "text AS terms", "2 AS item", "'a' AS score")
    asked = spark.createDataFrame([(3, "a b c", 1)], "item_id long, text string, doc_id long")
    assert sorted(tuple(r) for r in lexical.ranked_search(clash, asked).collect()) == brute(docs, [(3, "a b c")])
