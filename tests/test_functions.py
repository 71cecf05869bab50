"""Column functions on literals: one test per raw-text trap."""

from pyspark.sql import functions as F

from strata.functions import columns as C


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_blank_numeric_is_null_not_error(spark):  # T1
    assert one(spark, lambda c: C.safe_cast(c, "bigint"), " ") is None
    assert one(spark, lambda c: C.safe_cast(c, "bigint"), "") is None
    assert one(spark, lambda c: C.safe_cast(c, "float"), " ") is None


def test_integer_written_as_float_text(spark):  # T2
    assert one(spark, lambda c: C.safe_cast(c, "int"), "2000.0") == 2000
    assert one(spark, lambda c: C.safe_cast(c, "int"), " 12 ") == 12
    assert one(spark, lambda c: C.safe_cast(c, "bigint"), "9007199254740993") == 9007199254740993
    assert one(spark, lambda c: C.safe_cast(c, "int"), "99999999999") is None  # overflow


def test_locale_decimal(spark):  # T3
    assert one(spark, C.parse_decimal_br, "54,79") == 54.79
    assert one(spark, C.parse_decimal_br, "16.699,13") == 16699.13
    assert one(spark, C.parse_decimal_br, " ") is None
    assert one(spark, lambda c: C.format_decimal_br(c, 2), 1234.5, "double") == "1.234,50"


def test_split_missing_part_is_null(spark):  # T4
    assert one(spark, lambda c: C.split_part_at(c, ", ", 2), "Recife, Brasil") == "Brasil"
    assert one(spark, lambda c: C.split_part_at(c, ", ", 2), "Recife") is None
    assert one(spark, lambda c: C.split_part_at(c, ".", 2), "a.b") == "b"  # literal separator


def test_extract_no_match_modes(spark):  # T5, T6
    pat = r"\/.+\/(.+)\..,"
    url = "/Avaliacoes/bancos/setor-bancario.9,40_IP1.htm"
    assert one(spark, lambda c: C.regex_extract(c, pat, 1), url) == "setor-bancario"
    assert one(spark, lambda c: C.regex_extract(c, pat, 1, "empty"), "none") == ""
    assert one(spark, lambda c: C.regex_extract(c, pat, 1, "keep"), "none") == "none"
    assert one(spark, lambda c: C.regex_extract(c, pat, 1, "null"), "none") is None


def test_quarter_month_and_partition(spark):  # F9, F10, T19
    assert one(spark, C.quarter_to_month, "3º") == "09"
    assert one(spark, C.quarter_to_month, "4") == "12"
    assert one(spark, C.quarter_to_month, "5º") == "00"
    df = spark.createDataFrame([("2021", "1º")], "a string, t string")
    assert df.select(C.quarter_partition("a", "t")).first()[0] == "20210301"


def test_name_cleaning(spark):  # F2-F5
    assert one(spark, lambda c: C.strip_pattern(c, " - PRUDENCIAL"), "BANCO X - PRUDENCIAL") == "BANCO X"
    assert one(spark, lambda c: C.strip_pattern(c, r" \(conglomerado\)"),
               "ITAU (conglomerado)") == "ITAU"
    assert one(spark, lambda c: C.fold_accents(c, "Ô", "O"), "BANCÔ") == "BANCO"


def test_ref_date_and_load_ts(spark):  # P5, P6, F13
    df = C.with_load_ts(C.with_ref_date(spark.range(2), "2023-08-14"))
    row = df.first()
    assert row["anomesdia"] == "20230814" and row["dat_hor_psst"] is not None
    d = spark.createDataFrame([("2023-08-14",)], "d string").select(C.date_key(F.to_date("d")))
    assert d.first()[0] == "20230814"
