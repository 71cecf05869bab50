"""Exact dedup, sharding, quality rules, licenses and urls against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import exact_dup, licenses, quality, sharding, urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- exact dedup
def test_exact_against_groups(documents, odd_rows):
    rnd = random.Random(4)
    long = "prefix " * 80  # differs only behind the hashed prefix
    rows = odd_rows + [(100 + i, rnd.choice(["Aa", "aA", "b", long + "x", long + "y", "Éa", "éa", "zz"]), "s")
                       for i in range(200)]
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    got = exact_dup.exact_duplicates(documents(rows), carry={"digest": F.sha2("lowered", 256)}).collect()
    want = []
    for doc_id, text, _ in rows:
        key = (text or "").translate(LOWER)
        keep = max((i for i in groups[key] if i is not None), default=None)
        want.append((doc_id, keep, len(groups[key]), hashlib.sha256(key.encode()).hexdigest(), doc_id == keep))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_filter_lets_chance_hits_pass(documents, monkeypatch):
    monkeypatch.setattr(exact_dup, "FILTER_BITS", 1 << 15)
    rows = [(i, f"text {i % 5000}") for i in range(6000)]
    got = exact_dup.exact_duplicates(documents(rows))
    assert got.where("kept").count() == 5000 and got.count() == 6000
    assert exact_dup.exact_duplicates(documents([])).count() == 0


# --- sharding
def naive_bfd(sizes, capacity):
    free, placed = [], defaultdict(Counter)
    for size in sorted(sizes, reverse=True):
        fits = [(room, b) for b, room in enumerate(free) if room >= size]
        if fits:
            b = min(fits)[1]
        else:
            b = len(free)
            free.append(max(capacity, size))
        free[b] -= size
        placed[size][b] += 1
    return placed, len(free)


def test_runs_equal_one_by_one_packing():
    rnd = random.Random(2)
    for _ in range(40):
        sizes = [rnd.choice([rnd.randint(1, 12), rnd.randint(1, 60)]) for _ in range(rnd.randint(1, 120))]
        capacity = rnd.randint(10, 80)
        runs, bins = sharding.best_fit_decreasing(list(Counter(sizes).items()), capacity)
        want, want_bins = naive_bfd(sizes, capacity)
        got = defaultdict(Counter)
        for size, first, end, b in runs:
            got[size][b] += end - first
        assert bins == want_bins
        assert {s: sorted(c.values()) for s, c in got.items()} == {s: sorted(c.values()) for s, c in want.items()}


def test_tree_finds_the_tightest_bin():
    rnd, tree, held = random.Random(5), sharding.CapacityTree(), set()
    for i in range(2000):
        if held and rnd.random() < 0.4:
            size = rnd.randint(0, 100)
            want = min((k for k in held if k[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            held.discard(want)
        else:
            key = (rnd.randint(0, 100), i)
            tree.add(*key)
            held.add(key)


def test_shards_hold_groups_and_are_even(documents, odd_rows):
    rnd = random.Random(8)
    rows = [(10_000 + i, "t" * rnd.randint(1, 400) + str(rnd.randint(0, 900)), "s") for i in range(3000)]
    rows += [(5000 + i, "hot text", "s") for i in range(700)] + odd_rows[:7]
    got = sharding.shards(documents(rows), 8).collect()
    text = dict((r[0], r[1]) for r in rows)
    assert len(got) == len(rows)
    where, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        if r.doc_id is not None:
            raw = (text[r.doc_id] or "").encode()
            assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
            where[raw].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in where.values())
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_oversized_group_has_its_shard_alone(documents):
    rows = [(0, "x" * 50_000)] + [(i, f"{i:05}") for i in range(1, 800)]
    got = sharding.shards(documents(rows), 4).collect()
    alone = [r.shard for r in got if r.doc_id == 0][0]
    assert [r.doc_id for r in got if r.shard == alone] == [0]
    counts = Counter(r.shard for r in got if r.shard != alone)
    assert len(counts) == 3 and max(counts.values()) - min(counts.values()) <= 2
    assert sharding.shards(documents([]), 4).count() == 0


# --- quality rules
def brute_features(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def test_features_against_brute_force():
    rnd = random.Random(6)
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b ", "c\n", "  ", "é", "\x0b", "\x1c", "\u00a0", "#", "<a b c> ", "\r\n"])
                       for _ in range(rnd.randint(0, 60)))
        assert quality.features(text)[:5] == brute_features(text)


def test_host_verdict_drops_soft_failures_only_on_bad_hosts(documents, odd_rows):
    rnd = random.Random(7)

    def prose(mark=""):
        return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randint(100, 9999)}{mark}" for _ in range(80))
    rows = [(i, prose("###"), "bad") for i in range(60)] + [(100 + i, prose(), "bad") for i in range(5)]
    rows += [(200 + i, prose(), "good") for i in range(60)] + [(300, prose("###"), "good"), (301, "short", "good")]
    rows += [(400 + i, prose(), f"h{i}") for i in range(5)] + [(500, prose("###"), None)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(documents(rows)).collect()}
    assert not any(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(5))
    assert all(kept[200 + i] for i in range(60)) and kept[300] and not kept[301]
    assert all(kept[400 + i] for i in range(5)) and kept[500]
    assert quality.quality_rules(documents(odd_rows)).where("kept").count() == 0
    assert quality.quality_rules(documents([])).count() == 0


# --- licenses
def best_in_order(doc, template):
    """Longest common subsequence of the template with any part of the document."""
    best = [0] * (len(template) + 1)
    for word in doc:
        last = 0
        for i, t in enumerate(template, 1):
            last, best[i] = best[i], max(best[i], best[i - 1], last + 1 if t == word else 0)
    return best[-1]


def test_alignment_matches_as_much_as_whole_tables():
    rnd = random.Random(3)
    for _ in range(200):
        template = [rnd.randint(1, 40) for _ in range(rnd.randint(5, 25))]
        noisy = list(template)
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(noisy))
            noisy[at:at + 1] = rnd.choice([[], [0], [noisy[at], 0]])
        doc = [0] * 10 + noisy + [0] * 10
        assert licenses.align(doc, template, 10, 4)[0] == best_in_order(doc, template)


def test_license_places(documents, odd_rows):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    changed = gpl.replace("GNU", "the GNU").upper()
    rows = [(1, f"é start. {mit} then {changed} end"), (2, "released under the sun"), (3, mit + "\n" + mit),
            (4, licenses.TEMPLATES["Apache-2.0-header"]), (5, None)]
    got = defaultdict(list)
    for r in licenses.license_matches(documents(rows)).orderBy("doc_id", "start").collect():
        got[r.doc_id].append(r)
    assert [m.license for m in got[1]] == ["MIT", "GPL-3.0"]
    assert rows[0][1][got[1][0].start:got[1][0].end] == mit[:-1]
    assert got[1][1].coverage == 100 and got[1][1].matched_words == got[1][1].license_words
    assert 2 not in got and 5 not in got and [m.start for m in got[3]] == [0, len(mit) + 1]
    assert [m.license for m in got[4]] == ["Apache-2.0-header"]
    assert licenses.license_matches(documents(odd_rows)).count() == 0
    assert licenses.license_matches(documents([])).count() == 0


def changed_notice(rnd, words, share):
    """``words`` with one run put in, one left out and some replaced, together at most a ``share`` of them."""
    words = list(words)
    budget = int(share * len(words))
    put = rnd.randint(0, budget)
    left = rnd.randint(0, budget - put)
    for at in rnd.sample(range(len(words)), budget - put - left):
        words[at] = "xx"
    at = rnd.randrange(1, len(words))
    words[at:at] = ["yy"] * put
    at = rnd.randrange(1, len(words) - left)
    del words[at:at + left]
    return words


def test_license_scan_against_alignment_over_whole_texts():
    """Places of which an alignment without a band matches 80 % are found, runs of any place put in or left out."""
    rnd = random.Random(4)
    index = licenses.Index(licenses.TEMPLATES)
    long = [t for t, words in enumerate(index.templates) if len(words) > 24]
    held = found = 0
    for _ in range(120):
        t = rnd.choice(long)
        notice = changed_notice(rnd, licenses.words_of(licenses.ascii_lowered(licenses.TEMPLATES[index.names[t]])), 0.18)
        text = " ".join(["zz"] * rnd.randint(0, 40) + notice + ["zz"] * rnd.randint(0, 40))
        ids = [index.words.get(w, 0) for w in licenses.words_of(text)]
        best = []
        for u, template in enumerate(index.templates):
            matched, first, end, _ = licenses.align(ids, template, -len(template), 0, len(ids) + len(template))
            place = set(ids[first:end])
            if (100 * matched >= licenses.COVERAGE * max(len(template), end - first)
                    and index.needed[u] <= place and place & index.terms <= index.needed[u]):
                best.append((-matched, first, index.names[u]))
        if best:
            held += 1
            got = licenses.scan(text, index)
            found += any((-matched, name) == (min(best)[0], min(best)[2]) for name, matched, *_ in got)
    assert held > 75 and found >= 0.97 * held, (found, held)


def test_a_run_put_into_a_notice():
    index = licenses.Index(licenses.TEMPLATES)
    words = licenses.TEMPLATES["MIT-permission"].replace("/", " ").split()
    for n in (3, 5, 8, 12):
        text = " ".join(words[:30] + ["inserted"] * n + words[30:])
        assert [(m[0], m[1]) for m in licenses.scan(text, index)] == [("MIT-permission", len(words))], n
    for n in (2, 3):  # copies next to each other stay places of their own
        assert [m[0] for m in licenses.scan(" ".join(words * n), index)] == ["MIT-permission"] * n


def test_license_variants_are_told_apart():
    index = licenses.Index(licenses.TEMPLATES)
    for name, template in licenses.TEMPLATES.items():
        assert [m[0] for m in licenses.scan(f"See here. {template} And so on.", index)] == [name]
    numbered = licenses.TEMPLATES["BSD-3-Clause-text"].replace("met: ", "met: 1. ").replace("Neither", "3. Neither")
    assert [m[0] for m in licenses.scan(numbered, index)] == ["BSD-3-Clause-text"]
    work = "This work is licensed under "
    for text, names in {
            "Licensed under the Apache License, Version 1.1.": [], "Licensed under the Other License, Version 2.0.": [],
            "Released under the BSD License.": [], "Licensed under CC BY-NC-SA 2.5.": [],
            work + "the GNU General Public License, version 2.": ["GPL-2.0"],
            work + "the GNU General Public License v3": ["GPL-3.0"],
            work + "the GNU Affero General Public License, version 3.": ["AGPL-3.0"],
            "Licensed under the Apache License v2": ["Apache-2.0"], "Licensed under CC BY-ND 4.0.": ["CC-BY-ND-4.0-short"],
            "Licensed under CC BY 4.0.": ["CC-BY-4.0-short"], "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
            work + "a Creative Commons Attribution-NonCommercial 4.0 International License.": ["CC-BY-NC-4.0-notice"],
            "Licensed for you under one more CC BY-NC 4.0.": []}.items():
        assert [m[0] for m in licenses.scan(text, index)] == names, text


# --- urls
def brute_rule(host, path):
    best = None
    for _, rule in urls.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = max(best or "", rule, key=len)
    return best


def test_url_parts_rules_and_words(spark):
    rows = ["http://A.Example.NET/en/1?x#y", "https://example.com/de/2", "http://notexample.com/de/", "http://x.org/fr/1",
            "http://x.org/FR/1", "http://x.net", "http://x.net?/", "http://x.net/en/", None, "no scheme", "", "a://b://c/d",
            "http://www.cheappills.example.com/a", "http://cheap-pills.example.org/b", "http://news.example.com/c",
            "http://\u00c9X.net/\n?", "http://" + "spam" * 60 + ".org/x"] + [f"http://w{i}.example.com/n" for i in range(40)]
    df = spark.createDataFrame([(i, u, 1, "v") for i, u in enumerate(rows)], "page_id long, url string, host int, verdict string")
    got = {r.page_id: r for r in urls.judge_urls(df, text_col=None).collect()}
    for i, url in enumerate(rows):
        at = (url or "").find("://")
        rest = url[at + 3:] if at >= 0 else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(LOWER)
        rule = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if rule:
            assert got[i].verdict == dict((r, v) for v, r in urls.RULES)[rule]
    assert got[12].host_words[1:3] == ["cheap", "pills"] and got[12].verdict == got[13].verdict == "block"
    assert got[14].verdict == got[8].verdict == got[9].verdict == "allow" and got[16].verdict == "block"
    assert urls.judge_urls(df.limit(0), text_col=None).count() == 0


def test_rare_clean_words_do_not_speak_for_block(spark):
    clean = ["http://zebra.com/quartz", *(f"http://news.com/{w}" for w in ("story", "garden", "river") for _ in range(200))]
    form = "page_id long, url string"
    df = spark.createDataFrame(list(enumerate([*clean, "http://casino.com/jackpot", "http://casino.com/win"])), form)
    got = {r.page_id: r for r in urls.judge_urls(df, text_col=None).collect()}
    assert all(got[i].verdict == "allow" and got[i].log_odds < 0 for i in range(len(clean)))
    assert got[len(clean)].verdict == got[len(clean) + 1].verdict == "block"
    unseeded = spark.createDataFrame(list(enumerate(clean)), form)
    assert {(r.verdict, r.log_odds) for r in urls.judge_urls(unseeded, text_col=None).collect()} == {("allow", 0.0)}


@pytest.mark.parametrize("size", [100, 5_000])
def test_names_are_split_in_hosts_and_paths_at_any_table_size(spark, size):
    """The whole name stands in many urls and in tags, the words only in texts."""
    html = "<p class='cheappills'>garden river</p><script>var cheappills = 1</script> cheap pills free casino bonus &amp;"
    rows = [(i, f"http://cheappills.com/n{i % 50}", html) for i in range(size)]
    rows += [(size, "http://news.com/freeCasinobonus?x", html), (size + 1, "http://news.com/gardenriver", html),
             (size + 2, "http://" + "river" * 400 + ".com/x", "<script>casinoriver"), (size + 3, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge_urls(df).where(f"page_id = 0 OR page_id >= {size}").collect()}
    assert got[0].host_words[:2] == ["cheap", "pills"] and got[0].verdict == "block"
    assert got[size].verdict == "block" and got[size + 1].verdict == got[size + 3].verdict == "allow"
    assert got[size + 2].host_words[:400] == ["river"] * 400


def test_weight_of_a_rare_word_does_not_grow_with_the_table():
    rare = []
    for n in (10_000, 1_000_000):
        counts = np.zeros((2, 200))
        counts[:, 1:] = np.array([[n / 20_000], [n / 100]])
        counts[:, 0] = 0, 1
        rare.append(urls._weights(counts)[0])
    assert max(rare) < 0 and abs(rare[0] - rare[1]) < 0.05


@pytest.mark.parametrize("seed", range(5))
def test_segmentation_is_the_likeliest(seed):
    rnd = random.Random(seed)
    counts = {"".join(rnd.choices("ab", k=rnd.randint(1, 4))): rnd.randint(1, 50) for _ in range(8)}
    total = sum(counts.values())
    name = "".join(rnd.choices("abc", k=9))

    def cost(words):
        import math
        return sum(math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10) for w in words)

    def splits(s):
        yield [s]
        for i in range(1, len(s)):
            for rest in splits(s[i:]):
                yield [s[:i], *rest]
    assert abs(cost(urls.segment(name, counts, total)) - max(map(cost, splits(name)))) < 1e-9


def test_one_document_rejects_no_host_and_a_bad_host_is_rejected(documents):
    def body(i, bad):
        return " ".join(f"word{i}x{j}" for j in range(60)) + (" # #" * 20 if bad else "")
    single = [(i, body(i, i % 10 == 0), f"h{i}") for i in range(200)]
    assert quality.quality_rules(documents(single)).where("NOT kept").count() == 0
    bad = [(1000 + i, body(i, True), "bad") for i in range(60)]
    got = {r.doc_id: r.kept for r in quality.quality_rules(documents(single + bad)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(60))


def test_prior_from_hosts_of_known_spread(spark):
    import numpy as np
    rnd = np.random.default_rng(4)
    rates = rnd.beta(2, 6, 3000)
    sizes = rnd.integers(1, 30, 3000)
    rows = [(int(n), int(rnd.binomial(n, p))) for n, p in zip(sizes, rates)]
    monkey, quality.PRIOR_STRENGTH = quality.PRIOR_STRENGTH, (1.0, 1e4)
    try:
        mean, strength = quality.beta_prior(spark.createDataFrame(rows, "n long, failed long"))
    finally:
        quality.PRIOR_STRENGTH = monkey
    assert abs(mean - 0.25) < 0.02 and 6 < strength < 10.5


def test_a_lineage_cut_leaves_no_shuffle_files(spark):
    from strata.llm import _util
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    set_before, files = spark.conf.get(_util.CLEANUP, None), disk.getAllFiles().size()
    rows = spark.range(5000).withColumn("k", F.col("id") % 700).repartition("k").groupBy("k").count()
    assert _util.cut(rows, "shuffled").count() == 700
    assert spark.conf.get(_util.CLEANUP, None) == set_before
    deadline = time.time() + 20
    while disk.getAllFiles().size() > files + 8 and time.time() < deadline:
        time.sleep(0.5)
    assert disk.getAllFiles().size() <= files + 8   # the count's own
