"""The n-gram join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import ngram_join
from tests.llm.test_near_dup import corpus


def shingles(text, width=4):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def mutated(rnd, base, share, vocabulary):
    text = list(base)
    for at in rnd.sample(range(len(base)), int(share * len(base))):
        text[at] = rnd.choice(vocabulary)
    return text


@given(st.lists(st.lists(st.integers(0, 60), unique=True).map(sorted), max_size=8), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_merge_skip_counts_as_a_plain_merge(lists, least):
    want = {m: sum(m in x for x in lists) for x in lists for m in x}
    assert ngram_join.merge_skip(lists, least) == {m: k for m, k in want.items() if k >= least}


@given(st.integers(1, 400), st.data())
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_the_needed_short_lists(n, data):
    """For sets at the threshold in any order: the bound on short lists holds, and probing agrees."""
    m = data.draw(st.integers(max(1, n * 85 // 100), n * 100 // 85 + 1))
    both = min(n, m, ngram_join.overlap(n, m))
    rnd = random.Random(data.draw(st.integers(0, 1 << 30)))
    order = rnd.sample(range(1 << 20), n + m - both)
    a, b = set(order[:n]), set(order[n - both:])
    linked = 100 * both >= 85 * (n + m - both)
    short = [sorted(x)[:len(x) - ngram_join.long_lists(len(x))] for x in (a, b)]
    if linked:
        assert len(set(short[0]) & set(short[1])) >= ngram_join.needed(n, m)
    arrays = [np.array(sorted(x), np.uint64) for x in (a, b)]
    assert ngram_join.probe(*arrays, ngram_join.overlap(n, m)) == linked


def test_against_all_pairs(documents):
    for seed in (3, 4):
        rows = corpus(seed)
        assert result(ngram_join.jaccard_components(documents(rows))) == brute(rows)


def test_thresholds_of_short_texts(documents):
    rows = [(i, t) for i, t in enumerate(["a", "a", "b", "a b", "A B", "a b c d", "a b c d e", "x y z w v u t s",
                                          "x y z w v u t s r", "x y z w v u t s r q"])]
    rows += [(100 + i, " ".join(f"t{j}" for j in range(i, i + 30))) for i in range(6)]
    assert result(ngram_join.jaccard_components(documents(rows))) == brute(rows)


def test_open_lists_are_searched_in_blocks(documents, monkeypatch):
    """Without star and merge links (nothing joins before), chains of similar texts come from the lists."""
    for name, value in (("BLOCK", 3), ("CHUNK", 5), ("TURNS", ())):
        monkeypatch.setattr(ngram_join, name, value)
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for _ in range(4):
        base = rnd.choices(vocabulary, k=120)
        rows += [(len(rows) + i, " ".join(mutated(rnd, base, rnd.choice([0.01, 0.02, 0.04]), vocabulary))) for i in range(20)]
    passage = " ".join(rnd.choices(vocabulary, k=80))
    rows += [(200 + i, passage + " " + " ".join(rnd.choices(vocabulary, k=rnd.choice([4, 10, 14, 60])))) for i in range(30)]
    assert result(ngram_join.jaccard_components(documents(rows))) == brute(rows)


def test_common_shingles_change_no_result(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHARE", 1 << 40)
    monkeypatch.setattr(ngram_join, "REPEATS", 1)
    rows = corpus(6)
    assert result(ngram_join.jaccard_components(documents(rows))) == brute(rows)


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows(documents, odd_rows, empty):
    rows = [] if empty else odd_rows
    clash = documents(rows).selectExpr("*", "1 AS n", "2 AS node", "text AS key", "3 AS shingle", "4 AS text_hash")
    assert result(ngram_join.jaccard_components(clash)) == brute([r[:2] for r in rows])


def test_heads_of_sorted_lists_in_any_batches():
    import pyarrow as pa
    rnd = np.random.default_rng(2)
    rows = np.stack([rnd.integers(0, 40, 300), rnd.integers(0, 12, 300)])
    rows = rows[:, np.lexsort(rows[::-1])]
    nodes = {s: sorted(set(rows[1][rows[0] == s].tolist())) for s in rows[0].tolist()}
    want = sorted((s, n, x[0]) for s, x in nodes.items() if len(x) > 1 for n in x)
    for size in (1, 2, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i:i + size]) for c in rows], ["shingle", "node"]) for i in range(0, 300, size)]
        got = [r for b in ngram_join._heads(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted(got) == want


@given(st.lists(st.one_of(st.none(), st.text(" \t\n\x0b\x1c\x85\xa0aAbBéÉz", max_size=30)), max_size=12), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_shingler_agrees_with_plain_words(texts, width):
    import pyarrow as pa
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    ngram = ngram_join.Shingler(width)
    ngram_join_piece, ngram_join.PIECE = ngram_join.PIECE, 16
    try:
        got = ngram.sets(column)
    finally:
        ngram_join.PIECE = ngram_join_piece
    want = [shingles(t, width) for t in texts]
    assert [len(x) for x in got] == [len(x) for x in want]
    for a, x in zip(got, want):
        assert all((len(np.intersect1d(a, b)) == len(x & y)) for b, y in zip(got, want))


def test_compared_texts_are_shuffled_once_and_compressed(spark, documents):
    """One exchange a side and none for the merge of rows that repeat an id and a text; null ids match."""
    text = "one two three four five " * 40
    docs = documents([(None, text), (None, text), (1, text), (1, text), (2, "other words"), (3, "not wanted")])
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    wanted = (base.where("text <> 'not wanted' and (doc_id is null or doc_id > 1)").distinct()
              .select(F.struct("doc_id", "text_hash").alias("row"), F.xxhash64("text").alias("node")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join.node_texts(base, ngram_join.cut(wanted, "wanted"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(len(r.body) < r["size"] // 10 for r in rows) == [False, True]
    texts = [pa.decompress(bytes(r.body), r["size"], ngram_join.CODEC, asbytes=True).decode() for r in rows]
    assert sorted(texts) == sorted([text, "other words"])
