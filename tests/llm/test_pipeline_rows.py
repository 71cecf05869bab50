"""Pipeline stages on odd, repeated and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm._util import cut

STAGES = dict(P.STAGES)


def texts(i, n=60):
    return " ".join(f"w{i}a{j}" for j in range(n))


def test_one_row_of_each_repeated_group_stays(spark, documents):
    rows = [(1, texts(1)), (1, texts(1)), (1, texts(1)), (None, texts(2)), (None, texts(2)), (3, texts(2).upper()),
            (None, texts(4)), (None, texts(4)), (5, texts(5)), (5, texts(6))]
    got = sorted(((r.doc_id, r.text) for r in STAGES["exact_dedup"](spark, documents(rows), "").collect()), key=str)
    assert got == sorted([(1, texts(1)), (3, texts(2).upper()), (None, texts(4)), (5, texts(5)), (5, texts(6))], key=str)


def test_stored_tables_are_not_stored_again(spark, documents, tmp_path, monkeypatch):
    """Rows of Parquet files are told apart by their place; a column called _metadata changes nothing."""
    names = []
    monkeypatch.setattr(P, "cut", lambda df, name: names.append(name) or cut(df, name))
    rows = [(1, texts(1)), (1, texts(1)), (None, texts(2)), (None, texts(2)), (3, texts(2)), (None, texts(4)), (None, texts(4)), (6, None)]
    wanted = sorted([(1, texts(1)), (3, texts(2)), (None, texts(4)), (6, None)], key=str)
    documents(rows).repartition(3).write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    for docs, copies in ((stored, []), (stored.withColumn("_metadata", F.lit(1)), ["numbered"])):
        names.clear()
        out = STAGES["exact_dedup"](spark, docs, "")
        assert out.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == wanted
        assert names == [*copies, "exact-copies"]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_odd_and_empty_tables(spark, documents, odd_rows, name):
    for rows in ([], odd_rows):
        docs = documents(rows).selectExpr("doc_id", "text", "lang", "source", "1 AS __document", "2 AS n", "3 AS host", "'x' AS `key`")
        out = STAGES[name](spark, docs, "")
        got = out.collect()
        assert name == "pack" or out.columns == docs.columns
        assert bool(got) == (bool(rows) and name != "quality_rules")
