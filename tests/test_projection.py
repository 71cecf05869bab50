from strata.operators import projection as P


def test_apply_spec_one_select_rename_cast(spark):  # P2
    df = spark.createDataFrame([(" 10 ", "2000.0", "x")], "a string, b string, c string")
    out = P.apply_spec(df, [("A", "num", "bigint"), ("b", "year", "int"), ("c", "name", "string")])
    assert out.columns == ["num", "year", "name"]
    assert tuple(out.first()) == (10, 2000, "x")
    # one Project node over the relation
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_prefix_filter_pushdown(spark, scratch):  # P4
    path = scratch("prefix")
    spark.createDataFrame([("S1",), ("CNPJ",), (None,)], "seg string").write.parquet(path)
    df = P.filter_prefix(spark.read.parquet(path), "seg", "S")
    assert [r.seg for r in df.collect()] == ["S1"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan


def test_clean_header_first_duplicate_wins(spark):  # P7
    df = spark.createDataFrame([(1, 2, 3)], ['"a"', "b", "'a'"])
    out = P.clean_header(df)
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, 2)


def test_project_and_drop(spark):  # P1, P3
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert P.project(df, ["c", "a"]).columns == ["c", "a"]
    assert P.drop_cols(df, ["b"]).columns == ["a", "c"]
