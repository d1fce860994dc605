import datetime as dt

from rollcall.__main__ import main
from rollcall.sources.schemas import RESPONSES


def _land(spark, tables, base):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    spark.createDataFrame([("brasilapi", "01310-100", '{"cep":"01310100","city":"SP"}', dt.datetime(2024, 1, 1))],
                          RESPONSES).write.mode("overwrite").parquet(f"{base}/responses")


def test_cli_extract_and_report(spark, tables, tmp_path):
    base = str(tmp_path / "landing")
    _land(spark, tables, base)
    assert main(["editions", "--landing", base, "--contains", "milhas", "--out", str(tmp_path / "ed")], spark) == 0
    assert [r.globalEvent for r in spark.read.parquet(str(tmp_path / "ed")).collect()] == ["10 Milhas RJ"]
    common = ["--landing", base, "--edition", "10 Milhas RJ", "--first", "2023-12-31", "--last", "2024-01-31",
              "--as-of", "2025-06-30", "--rows-per-batch", "3"]
    assert main(["extract", *common, "--out", str(tmp_path / "x")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "x" / "forms")).count() == 4
    assert spark.read.parquet(str(tmp_path / "x" / "participants")).count() == 14
    profile = {r.metric: r["qtde (percent)"] for r in spark.read.parquet(str(tmp_path / "x" / "forms_profile")).collect()}
    assert profile["total"] == "4 (100.00%)" and profile["with_underscore"] == "3 (75.00%)"
    assert main(["report", *common, "--out", str(tmp_path / "r")], spark) == 0
    report = spark.read.parquet(str(tmp_path / "r"))
    assert report.count() == 14 and "itemID" in report.columns and "cidade" in report.columns
    assert report.filter("itemID = 1").select("cidade").distinct().collect()[0][0] == "SP"
    counters = spark.read.parquet(str(tmp_path / "r_counters")).first().asDict()
    assert counters["ok"] == 2 and counters["nok"] == 2   # participants 1 and 11 answered 01310-100
    assert counters["report_label"] == "10_Milhas_RJ" and "viacep errors" in counters
    assert spark.read.parquet(str(tmp_path / "r_unresolved")).count() == 2
    # the same report from the extract, whole and batch by batch
    extracted = ["--extract", str(tmp_path / "x")]
    assert main(["report", *common, *extracted, "--out", str(tmp_path / "whole")], spark) == 0
    batches = [r[0] for r in spark.read.parquet(str(tmp_path / "x" / "participants")).select("batch_number").distinct().collect()]
    assert len(batches) > 1
    for b in batches:
        assert main(["report", *common, *extracted, "--batch", str(b), "--out", str(tmp_path / f"b{b}")], spark) == 0
    columns = [c for c in report.columns if c not in ("run_ts", "batch")]
    rows = lambda *paths: sorted(repr(r) for p in paths for r in spark.read.parquet(str(tmp_path / p)).select(*[f"`{c}`" for c in columns]).collect())
    assert rows("r") == rows("whole") == rows(*[f"b{b}" for b in batches])
    # counters and failed rows of the batches add up as well
    sums = lambda *paths: [sum(spark.read.parquet(str(tmp_path / f"{p}_counters")).first()[c] for p in paths) for c in counters if c not in ("report_label", "run_ts", "batch")]
    assert sums("whole") == sums(*[f"b{b}" for b in batches])
    failed = lambda *paths: sorted(r.participant_id for p in paths for r in spark.read.parquet(str(tmp_path / f"{p}_unresolved")).collect())
    assert failed("whole") == failed(*[f"b{b}" for b in batches]) != []
    assert main(["pending", *common, *extracted, "--out", str(tmp_path / "p")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_cli_editions_share_an_output_and_may_be_empty(spark, tables, tmp_path):
    base = str(tmp_path / "landing")
    _land(spark, tables, base)
    common = ["--landing", base, "--as-of", "2025-06-30", "--out", str(tmp_path / "x")]
    assert main(["extract", "--edition", "10 Milhas RJ", *common], spark) == 0
    before = {r.metric: r.n for r in spark.read.parquet(str(tmp_path / "x" / "forms_profile")).collect()}
    assert main(["extract", "--edition", "none such", *common], spark) == 0
    profile = spark.read.parquet(str(tmp_path / "x" / "forms_profile"))
    assert {r.metric: r.n for r in profile.filter("edition_label = '10_Milhas_RJ'").collect()} == before
    empty = profile.filter("edition_label = 'none_such'").collect()
    assert len(empty) == len(before) and all(r.n == 0 and r.share is None for r in empty)
    assert main(["report", "--edition", "none such", *common[:-1], str(tmp_path / "r")], spark) == 0


def test_land_refuses_one_cursor_over_a_table_of_all_events():
    import pytest
    with pytest.raises(SystemExit):
        main(["land", "--url", "jdbc:mysql://db:3306/x", "--tables", "checkoutparticipant", "--out", "x"])
    with pytest.raises(SystemExit):
        main(["report", "--landing", "x", "--edition", "e", "--batch", "1", "--out", "y"], spark=object())


def test_cli_reads_month_partitioned_landing(spark, tables, tmp_path):
    from rollcall.sources.readers import PURCHASE_DATED, land_table
    base = str(tmp_path / "landing")
    _land(spark, tables, base)
    for name, col in PURCHASE_DATED.items():
        land_table(tables[name], base, name, month_of=col)
    args = ["--landing", base, "--edition", "10 Milhas RJ", "--first", "2023-12-31", "--last", "2024-01-31",
            "--as-of", "2025-06-30", "--rows-per-batch", "3", "--month-partitioned"]
    assert main(["extract", *args, "--out", str(tmp_path / "x")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "x" / "participants")).count() == 14
    assert spark.read.parquet(str(tmp_path / "x" / "forms")).count() == 4


def test_cli_pending_requests(spark, tables, tmp_path):
    base = str(tmp_path / "landing")
    _land(spark, tables, base)
    args = ["--landing", base, "--edition", "10 Milhas RJ", "--first", "2023-12-31", "--last", "2024-01-31",
            "--out", str(tmp_path / "p")]
    assert main(["pending", *args], spark) == 0
    got = sorted((r.provider, r.cep_requested) for r in spark.read.parquet(str(tmp_path / "p")).collect())
    # 01310-100 was accepted by the first provider; the other codes were never asked
    assert got == [("brasilapi", "01234-567"), ("brasilapi", "13100-000")]


def test_cli_with_unnested_option_view(spark, tables, tmp_path):
    from rollcall.operators.options import unnest_options
    base = str(tmp_path / "landing")
    _land(spark, tables, base)
    unnest_options(tables["participant_options"]).write.parquet(f"{base}/checkoutparticipant_array_vw")
    args = ["--landing", base, "--edition", "10 Milhas RJ", "--first", "2023-12-31", "--last", "2024-01-31",
            "--as-of", "2025-06-30", "--rows-per-batch", "3", "--option-view"]
    assert main(["extract", *args, "--out", str(tmp_path / "x")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "x" / "participants")).count() == 14
