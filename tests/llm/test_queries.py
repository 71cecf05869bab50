"""The registered queries against DuckDB, and the pipeline against a brute-force version."""

import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import digest  # noqa: E402
from strata.llm import quality, queries  # noqa: E402
from strata.llm._util import tokenizer_path  # noqa: E402
from tests.llm.test_near_dup import brute as near_brute  # noqa: E402
from tests.llm.test_pii import brute as pii_brute  # noqa: E402
from tests.llm.test_small_operators import LOWER, brute_features, brute_rule  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_registers_the_operators_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(columns) == sorted(df.columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_url_query_rules_on_all_pages(spark, duck):
    got = {r.page_id: r for r in queries.QUERIES["op6_url_filter"](spark, SF).collect()}
    pages = duck.execute("SELECT page_id, url FROM pages").fetchall()
    assert len(got) == len(pages)
    for page_id, url in pages:
        rest = url.split("://", 1)[1]
        host = rest.split("/")[0].translate(LOWER)
        path = rest[len(host):].split("?")[0].split("#")[0]
        assert (got[page_id].host, got[page_id].path, got[page_id].rule) == (host, path, brute_rule(host, path))


def test_license_query_finds_the_stated_lines(spark, duck):
    from strata.llm import licenses
    got = {(r.doc_id, r.license) for r in queries.QUERIES["op2_license_scan"](spark, SF).collect()}
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        for name, template in licenses.TEMPLATES.items():
            if template.lower() in text.lower():
                assert (doc_id, name) in got or any((doc_id, n) in got for n in licenses.TEMPLATES if n.startswith(name))


def test_pipeline_against_brute_force(spark, duck):
    """Stage by stage: what stays, the redacted texts and the packed ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "redact_pii", "pack"]

    def run(name, frame):
        from strata.llm._util import cut
        out = cut(stages[name](spark, frame, SF), name)
        assert name == "pack" or out.columns == docs.columns
        return out
    kept = run("quality_rules", docs)
    ids = {r.doc_id for r in kept.collect()}
    verdicts = {r.doc_id: r.kept for r in quality.quality_rules(docs).collect()}
    for doc_id, text in rows:
        n_words, _, _, _, repeated = brute_features(text)
        if n_words < 50 or 100 * repeated > 50 * n_words:
            assert doc_id not in ids
        assert (doc_id in ids) == verdicts[doc_id]
    rows = [r for r in rows if r[0] in ids]
    exact = run("exact_dedup", kept)
    last = {}
    for doc_id, text in sorted(rows):
        last[text.translate(LOWER)] = doc_id
    assert sorted(r.doc_id for r in exact.collect()) == sorted(last.values())
    rows = [r for r in rows if r[0] in set(last.values())]
    near = run("near_dedup", exact)
    want = sorted(doc_id for doc_id, _, _, keep in near_brute(rows) if keep)
    assert sorted(r.doc_id for r in near.collect()) == want
    text = dict(r for r in rows if r[0] in set(want))
    redacted = {r.doc_id: r for r in run("redact_pii", near).collect()}
    assert set(redacted) == set(text)
    for doc_id, r in redacted.items():
        assert not [s for s in pii_brute(r.text) if s[1] != 2] and r.n_chars == len(r.text)
        if not any(c in "@0123456789" for c in text[doc_id]):
            assert r.text == text[doc_id]
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    packed = defaultdict(list)
    for r in run("pack", spark.createDataFrame(list(redacted.values()), docs.schema)).collect():
        packed[r.doc_id].append(r)
    for doc_id, r in redacted.items():
        ids = np.array(plain.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(packed[doc_id], key=lambda p: p.start)
        assert sum(p.length for p in pieces) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for p in pieces)
