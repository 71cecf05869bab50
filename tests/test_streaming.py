import pytest

from strata import sinks
from strata import streaming as ST
from tests.test_sources_sinks import write_file


def land(root, name, text):
    write_file(f"{root}/{name}", text)


def test_stream_routes_skips_empty_and_is_idempotent(spark, scratch):  # E1-E3
    root = scratch("stream")
    lz = f"{root}/landing"
    land(lz, "Bancos_1.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tA\nS2\t2\tB\n")
    land(lz, "Reclamacoes_2021.csv", "Ano;Trimestre\n2021;3º;x;y; ;NOME;1,0;1;1;1;2;3;4;5;\n")
    land(lz, "misc.txt", "hello\n")
    sinks.touch_empty(spark, f"{lz}/Empregados_empty.csv")
    args = dict(sor_root=f"{root}/sor", checkpoint=f"{root}/ckpt", ref_date="2023-08-14",
                quarantine_root=f"{root}/q")
    ST.stream_landing(spark, lz, timeout_s=300, **args)
    banks = spark.read.parquet(f"{root}/sor/bancos")
    assert banks.count() == 2
    recl = spark.read.parquet(f"{root}/sor/reclamacoes").first()
    assert str(recl.anomesdia) == "20210901" and recl["CNPJ IF"] == " "
    assert spark.read.parquet(f"{root}/q").count() == 1
    ST.stream_landing(spark, lz, timeout_s=300, **args)  # nothing new: no duplicates
    assert spark.read.parquet(f"{root}/sor/bancos").count() == 2
    land(lz, "Bancos_2.tsv", "Segmento\tCNPJ\tNome\nS3\t3\tC\n")
    ST.stream_landing(spark, lz, timeout_s=300, **args)
    assert spark.read.parquet(f"{root}/sor/bancos").count() == 3


def test_unrouted_file_raises_by_default(spark, scratch):
    root = scratch("stream_raise")
    land(f"{root}/landing", "unknown.csv", "a;b\n")
    with pytest.raises(Exception, match="match no dataset route"):
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt", timeout_s=300)


def test_route_by_path_first_match_wins(spark):
    df = spark.createDataFrame([("/landing/in/Bancos_Reclamacoes.csv",), ("x/Empregados/a",), ("z",)],
                               "p string")
    got = [r.d for r in df.select(ST.route_by_path("p").alias("d")).collect()]
    assert got == ["bancos", "empregados", None]


def test_backlog_split_into_bounded_batches(spark, scratch):
    root = scratch("stream_batches")
    for i in range(5):
        land(f"{root}/landing", f"Bancos_{i}.tsv", f"Segmento\tCNPJ\tNome\nS1\t{i}\tN{i}\n")
    ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt",
                      ref_date="2023-08-14", timeout_s=300, max_files_per_trigger=2)
    df = spark.read.parquet(f"{root}/sor/bancos")
    assert df.count() == 5
    assert df.select("batch_id").distinct().count() == 3


def test_stream_runs_raw_to_trusted_chain(spark, scratch):
    root = scratch("stream_sot")
    lz = f"{root}/landing"
    land(lz, "Bancos_1.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tA - PRUDENCIAL\nS2\t2\tB\n")
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", ref_date="2023-08-14",
                      timeout_s=300, sot_root=f"{root}/sot", dq_root=f"{root}/dq")
    sot = spark.read.parquet(f"{root}/sot/bancos")
    assert sorted(r.nom_instituicao for r in sot.collect()) == ["A", "B"]
    assert spark.read.parquet(f"{root}/dq").count() == 5
    land(lz, "Bancos_2.tsv", "Segmento\tCNPJ\tNome\nS9\t3\tC\n")  # S9 fails the segment check
    with pytest.raises(Exception, match="failed quality constraint"):
        ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", ref_date="2023-08-14",
                          timeout_s=300, sot_root=f"{root}/sot", dq_root=f"{root}/dq")
    assert spark.read.parquet(f"{root}/sot/bancos").count() == 2  # trusted table unchanged


def test_incremental_trusted_refresh(spark, scratch):
    root = scratch("stream_inc")
    lz = f"{root}/landing"
    head = ";".join(__import__("strata.schemas", fromlist=["x"]).COMPLAINT_FIELDS) + ";\n"

    def line(year, q, cnpj):
        return f"{year};{q}º;Top 10;Banco; {cnpj};NOME;1,5;1;1;1;2;3;4;5;\n"
    land(lz, "Reclamacoes_a.csv", head + line(2021, 1, 1) + line(2021, 2, 2))
    args = dict(ref_date="2023-08-14", timeout_s=300, sot_root=f"{root}/sot",
                refresh="partitions")
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    land(lz, "Reclamacoes_b.csv", head + line(2021, 2, 3))
    land(lz, "Reclamacoes_empty_body.csv", head)  # header only: nothing to refresh
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    sot = spark.read.parquet(f"{root}/sot/reclamacoes")
    got = sorted((r.num_trimestre, r.num_cnpj_instituicao) for r in sot.collect())
    assert got == [(1, 1), (2, 2), (2, 3)]  # quarter 1 kept, quarter 2 rebuilt from raw


def test_stream_reads_files_as_the_batch_reader_does(spark, scratch):
    """Blank lines, a header spelled otherwise, a data line equal to the header."""
    from strata.plans import jobs as J
    root = scratch("stream_same")
    land(f"{root}/landing", "Bancos_1.tsv", "segmento\tcnpj\tnome\nS1\t1\tA\n\nSegmento\tCNPJ\tNome\nS2\t2\tB\n")
    ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt", ref_date="2023-08-14", timeout_s=300)
    got = spark.read.parquet(f"{root}/sor/bancos").select("Segmento", "CNPJ", "Nome").collect()
    want = J.sor_frame(spark, "bancos", f"{root}/landing", "2023-08-14").select("Segmento", "CNPJ", "Nome").collect()
    assert sorted(got) == sorted(want) and len(got) == 3


def test_unrouted_file_stops_before_anything_is_written(spark, scratch):
    from strata import sources as S
    root = scratch("stream_stop")
    land(f"{root}/landing", "Bancos_1.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tA\n")
    land(f"{root}/landing", "what.csv", "x\n")
    with pytest.raises(Exception, match="match no dataset route"):
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt", timeout_s=300)
    assert S.path_length(spark, f"{root}/sor") is None


def test_partition_refresh_with_mixed_spellings_and_nulls(spark, scratch):
    root = scratch("stream_mixed")
    lz = f"{root}/landing"
    head = ";".join(__import__("strata.schemas", fromlist=["x"]).COMPLAINT_FIELDS) + ";\n"

    def line(year, quarter, cnpj):
        return f"{year};{quarter};Top 10;Banco; {cnpj};NOME;1,5;1;1;1;2;3;4;5;\n"
    args = dict(ref_date="2023-08-14", timeout_s=300, sot_root=f"{root}/sot", refresh="partitions")
    land(lz, "Reclamacoes_a.csv", head + line("2021", "2º", 1) + line("2021.0", " 2º", 2) + line("", "", 3))
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    land(lz, "Reclamacoes_b.csv", head + line("2021", " 2º", 4) + line("x", "", 5))
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    got = sorted(r.num_cnpj_instituicao for r in spark.read.parquet(f"{root}/sot/reclamacoes").collect())
    assert got == [1, 2, 3, 4, 5]


def test_failed_gate_is_made_up_for_and_metrics_stay_single(spark, scratch):
    root = scratch("stream_retry")
    lz = f"{root}/landing"
    land(lz, "Bancos_1.tsv", "Segmento\tCNPJ\tNome\nS9\t1\tA\n")
    args = dict(ref_date="2023-08-14", timeout_s=300, sot_root=f"{root}/sot", dq_root=f"{root}/dq")
    for _ in range(2):  # the second run has no new file, but the refresh is still owed
        with pytest.raises(Exception, match="failed quality constraint"):
            ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    assert spark.read.parquet(f"{root}/dq").count() == 5


def test_redelivered_contents_are_taken_once_per_dataset(spark, scratch):
    root = scratch("stream_again")
    lz = f"{root}/landing"
    body = "Segmento\tCNPJ\tNome\nS1\t1\tA\n"
    args = dict(ref_date="2023-08-14", timeout_s=300)
    land(lz, "Bancos_1.tsv", body)
    land(lz, "Bancos_copy_in_one_batch.tsv", body)
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    land(lz, "Bancos_redelivered.tsv", body)
    land(lz, "Bancos_2.tsv", body + "S2\t2\tB\n")  # another content
    ST.stream_landing(spark, lz, f"{root}/sor", f"{root}/ckpt", **args)
    got = sorted(r.CNPJ for r in spark.read.parquet(f"{root}/sor/bancos").collect())
    assert got == ["1", "1", "2"]
    ST.stream_landing(spark, lz, f"{root}/all", f"{root}/ckpt_all", redelivered="keep", **args)
    assert spark.read.parquet(f"{root}/all/bancos").count() == 5


def test_large_files_are_told_apart_by_path(spark, scratch):
    root = scratch("stream_large")
    for name in ("Bancos_1.tsv", "Bancos_2.tsv"):
        land(f"{root}/landing", name, "Segmento\tCNPJ\tNome\nS1\t1\tA\n")
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    for limit, n in ((10, 2), (1000, 1)):
        found = []
        q = (ST.arrivals(reader, f"{root}/landing", digest_limit=limit).writeStream
             .foreachBatch(lambda b, i: found.extend(b.collect())).option("checkpointLocation", f"{root}/c{limit}")
             .trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert q.exception() is None and len(found) == n


def test_batch_of_another_date_replaces_its_rows(spark, scratch):
    root = scratch("stream_dates")
    land(f"{root}/landing", "Bancos_1.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tA\n")
    files = ST.routed_files(spark.read.format("binaryFile").load(f"{root}/landing"))
    for date in ("2023-08-14", "2023-08-15"):
        ST.Landing(f"{root}/sor", date).write_batch(files, 0)
    assert [str(r.anomesdia) for r in spark.read.parquet(f"{root}/sor/bancos").collect()] == ["20230815"]


def test_refresh_reads_only_raw_rows_of_its_partitions(spark, scratch):
    """Spellings and raw dates of a quarter fall together; other quarters are pruned by folder."""
    from strata.plans import jobs as J
    root = scratch("lineage")

    def line(year, quarter, name):
        return f"{year};{quarter};x;y;1;{name};1,0;1;1;1;2;3;4;5;\n"

    land(f"{root}/landing", "Reclamacoes_1.csv", "Ano;Trimestre\n" + line("2021", "3º", "a") + line("2021.0", " 3", "b")
         + line("2021", "1º", "c") + line(" ", "?", "d"))
    ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt", ref_date="2023-08-14", timeout_s=300)
    land(f"{root}/landing", "Reclamacoes_2.csv", "Ano;Trimestre\n" + line("2021", "3", "e") + line("", "x", "f"))
    ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/ckpt", ref_date="2023-08-14", timeout_s=300)
    feeding = ST.Landing(f"{root}/sor", "2023-08-14").feeding(spark, "reclamacoes", 1)
    names = {r[0] for r in feeding.select("Instituição financeira").collect()}
    assert names == {"a", "b", "e", "d", "f"}
    plan = feeding._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("],")[0]
    assert "lin_ano" in filters and "lin_num_trimestre" in filters
    assert not any("lin_num_trimestre=1" in f for f in feeding.inputFiles() if "batch_id=1" in f)
    cleaned = J.sot_frame("reclamacoes", J.with_lineage("reclamacoes", feeding).drop("lin_ano", "lin_num_trimestre"))
    assert {(r.ano, r.num_trimestre) for r in cleaned.collect()} == {(2021, 3), (None, None)}
