import random

import numpy as np

from strata.llm import near_dup
from strata.llm.graph import components


def brute(rows):
    """component_id and shingle count of each row, all pairs compared."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * both >= 75 * union:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def corpus(seed, families=12, copies=12):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = rnd.choices(vocabulary, k=60)
    rows = []
    for _ in range(families):
        base = rnd.choices(vocabulary, k=rnd.choice([3, 5, 40, 150, 400]))
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 20))):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            if rnd.random() < 0.2:
                text += passage
            rows.append((len(rows) * 3 + rnd.randint(0, 2), " ".join(text).upper() if rnd.random() < 0.1 else " ".join(text)))
    rnd.shuffle(rows)
    return rows


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()], key=str)


def test_against_all_pairs(documents):
    for seed in (1, 2):
        rows = corpus(seed)
        assert result(near_dup.near_duplicates(documents(rows))) == brute(rows)


def test_large_group_of_near_copies_is_joined_without_all_pairs(documents, monkeypatch):
    """Copies at 0.6 to 1 of a base: parts of the group meet in many band keys."""
    rnd = random.Random(9)
    vocabulary = [f"v{i}" for i in range(2000)]
    base = rnd.choices(vocabulary, k=150)
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rnd.randint(0, 9)):
            text[rnd.randrange(150)] = rnd.choice(vocabulary)
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "CHUNK", 32)
    assert result(near_dup.near_duplicates(documents(rows))) == brute(rows)


def test_odd_rows(documents, odd_rows):
    got = {}
    for r in near_dup.near_duplicates(documents(odd_rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert sum(map(len, got.values())) == len(odd_rows)
    assert got[1] == [(0, 1, True)] and got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)]
    assert got[4] == [(2, 4, True)] * 2 and got[5] == [(2, 4, False)] and got[6] == [(2, 4, False)]
    assert got[7] == [(1, 7, True)] and got[8] == [(1, 8, True)]
    assert sorted(got[None]) == [(0, None, True), (1, None, True)]


def test_empty_table_and_clashing_columns(spark, documents):
    assert near_dup.near_duplicates(documents([])).count() == 0
    df = spark.createDataFrame([(1, "a b", 5, True, "k", 7)], "doc_id int, text string, component_id int, "
                               "kept boolean, key string, node int")
    assert [tuple(r) for r in near_dup.near_duplicates(df).collect()] == [(1, 1, 1, True)]


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    family = near_dup._hash_family(near_dup.SAMPLES, 12)
    limit = near_dup.odd_limit(0.75, near_dup.SAMPLES, near_dup.BITS, near_dup.DEVIATIONS)

    def count(similarity, n=400):
        shared = int(round(2 * n * similarity / (1 + similarity)))
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.r_[pool[:shared], pool[n:2 * n - shared]])
        x, y = (near_dup.odd_sketch(near_dup.minhash(s, family), near_dup.BITS) for s in (a, b))
        return int(np.bitwise_count(x ^ y).sum())
    assert all(count(0.76) <= limit for _ in range(30))
    assert all(count(0.6) > limit for _ in range(30))
    assert count(1.0) == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert got[200] == got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
