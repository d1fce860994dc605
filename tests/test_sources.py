import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.functions.dates import local_date, purchased_between
from rollcall.sources.readers import jdbc_options, read_table, read_tables
from rollcall.sources.sinks import (display_participants, edition_label, preview, write_extract,
                                    write_report)


def test_jdbc_options_split_range():
    opts = jdbc_options("jdbc:mysql://db:3306/x", "checkoutparticipant", user="u", password="p",
                        partition_column="id", lower_bound=1, upper_bound=1000, num_partitions=8)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8" and opts["upperBound"] == "1000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id", lower_bound=1)


def test_csv_keeps_leading_zeros(spark, tmp_path):
    base = tmp_path / "land"
    (base / "formfieldanswer").mkdir(parents=True)
    (base / "formfieldanswer" / "a.csv").write_text("checkoutParticipantId,fieldId,answer\n1,cep,01234567\n")
    row = read_table(spark, str(base), "formfieldanswer", fmt="csv").first()
    assert row.answer == "01234567" and row.checkoutParticipantId == 1


def test_parquet_round_trip(spark, tables, tmp_path):
    base = str(tmp_path / "landed")
    for name in ("event", "eventcomplement"):
        tables[name].write.parquet(f"{base}/{name}")
    back = read_tables(spark, base, ["event", "eventcomplement"])
    assert back["event"].count() == 4 and back["eventcomplement"].schema == tables["eventcomplement"].schema


def test_local_date_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2, 59, 59),), (dt.datetime(2024, 1, 1, 3, 0),)],
                               "ts timestamp_ntz")
    assert [r.d for r in df.select(local_date("ts").alias("d")).collect()] == [dt.date(2023, 12, 31),
                                                                              dt.date(2024, 1, 1)]


def test_half_open_range_equals_closed_and_pushes_down(spark, tmp_path):
    ts = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3, 4) for h in (0, 2, 3, 23)]
    path = str(tmp_path / "ev")
    spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    got = purchased_between(df, "ts", "2024-01-01", "2024-01-02")
    want = df.filter(local_date("ts").between(dt.date(2024, 1, 1), dt.date(2024, 1, 2)))
    assert sorted(got.collect()) == sorted(want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T03:00)" in plan and "LessThan(ts,2024-01-03T03:00)" in plan


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("10 Milhas RJ", 1), ("10 Milhas RJ", 2)], "edition string, item_id long")
    assert edition_label(df).first().edition_label == "10_Milhas_RJ"
    out = write_report(df, str(tmp_path / "report"), dt.datetime(2025, 6, 30, 14, 5))
    assert spark.read.parquet(f"{out}/report_label=10_Milhas_RJ/run_ts=20250630_1405").count() == 2
    write_extract(df, str(tmp_path / "forms"), "edition")
    assert spark.read.parquet(str(tmp_path / "forms")).filter(F.col("edition_label") == "10_Milhas_RJ").count() == 2
    assert display_participants(df).columns == ["edição", "itemID"]
    assert preview(df, 1).count() == 1


def test_scale_conf_for_100_tb():
    from rollcall.session import scale_conf
    conf = scale_conf(100 << 40, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 4096)
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_csv_array_column_from_json_text(spark, tmp_path):
    base = tmp_path / "land"
    (base / "participant_options").mkdir(parents=True)
    (base / "participant_options" / "a.csv").write_text('id,questionIDs\n1,"[500, 501]"\n2,[]\n')
    rows = {r.id: r.questionIDs for r in read_table(spark, str(base), "participant_options", fmt="csv").collect()}
    assert rows == {1: [500, 501], 2: []}


def test_land_command_validates_split_options():
    from rollcall.__main__ import main
    with pytest.raises(ValueError):
        main(["land", "--url", "jdbc:mysql://db:3306/x", "--tables", "event", "--partition-column", "id",
              "--out", "/nonexistent"])


def test_month_partitions_are_pruned(spark, tables, tmp_path):
    from rollcall.sources.readers import land_table
    base = str(tmp_path / "landing")
    land_table(tables["checkoutsession"], base, "checkoutsession", month_of="createdAt")
    landed = read_table(spark, base, "checkoutsession", month_of="createdAt")
    got = purchased_between(landed, "createdAt", "2024-01-02", "2024-01-06")
    want = purchased_between(tables["checkoutsession"], "createdAt", "2024-01-02", "2024-01-06")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) == [14, 15, 16, 17, 18, 19]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(createdAt_month" in plan and "2024-01" in plan
    first_day = purchased_between(landed, "createdAt", "2023-12-31", "2023-12-31")
    assert sorted(r.id for r in first_day.collect()) == [11]   # 2024-01-01 02:00 UTC is Dec 31 local


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master):
        self.master, self._dir = master, None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, conf):
        self.sparkContext, self.conf = _Context(master), _Conf(conf)


def test_checkpoint_dir_never_invented_on_a_cluster():
    from rollcall.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn", {}))
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared/ckpt"
    assert shared.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_batch_slice_of_written_extract_skips_other_batches(spark, tmp_path):
    from rollcall.operators.batching import number_batches, select_batch
    df = spark.range(0, 20000).select(F.lit("10 Milhas").alias("edition"), F.col("id"))
    path = str(tmp_path / "extract")
    write_extract(number_batches(df, ["id"], 2500), path, "edition")
    back = select_batch(spark.read.parquet(path), 3)
    assert sorted(r.id for r in back.collect()) == list(range(5000, 7500))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(batch_number), EqualTo(batch_number,3)]" in plan


def test_report_as_csv(spark, tmp_path):
    df = spark.createDataFrame([("10 Milhas RJ", 1, "São Paulo")], "edition string, item_id long, cidade string")
    out = write_report(df, str(tmp_path / "csv"), dt.datetime(2025, 6, 30, 14, 5), fmt="csv")
    back = spark.read.option("header", "true").csv(f"{out}/report_label=10_Milhas_RJ/run_ts=20250630_1405")
    assert [tuple(r) for r in back.collect()] == [("10 Milhas RJ", "1", "São Paulo")]


@pytest.mark.parametrize("above", [None, 500])
def test_split_predicates_balance_skewed_keys(above):
    import duckdb

    from rollcall.sources.readers import histogram_query, split_predicates
    con = duckdb.connect()
    # dense old keys, a gap, and a burst of new ones; some without key
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 997 = 0 THEN NULL WHEN i < 1000 THEN i WHEN i < 9000 THEN 1000000 + i // 4 "
                "ELSE 5000000 + 1000 * i END AS id FROM range(12000) r(i)")
    histogram = con.execute(f"SELECT low, n FROM {histogram_query('t', 'id', 100, above)}").fetchall()
    con.execute("INSERT INTO t VALUES (-5), (99999999999)")               # after the histogram was taken
    parts = split_predicates(histogram, "id", 8, above)
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    total = con.execute("SELECT count(*) FROM t" + (f" WHERE id > {above}" if above else "")).fetchone()[0]
    assert len(parts) == 8 and sum(sizes) == total
    assert max(sizes) <= total / 8 + 2 * 400 + 20      # a share, a range of 100 keys four times over, the rows without key
    assert split_predicates([], "id", 8) == ["1 = 1"]
    with pytest.raises(ValueError):
        split_predicates(histogram, "id", 0)


def test_clustered_landing_skips_row_groups(spark, tmp_path):
    from rollcall.operators.sizing import key_set, restrict
    from rollcall.sources.readers import land_table
    rows = spark.range(0, 60_000).select(F.col("id").alias("sessionId"), F.concat(F.lit("Pix"), F.col("id")).alias("paymentOption")) \
        .orderBy(F.xxhash64("sessionId"))
    wanted = key_set(spark.range(20_000, 24_000).filter("id % 2 = 0"), "id", max_rows=10)      # beyond the broadcast bound
    read = {}
    for name, cluster in (("loose", None), ("clustered", "sessionId")):
        land_table(rows.withColumn("n", F.lit(1)), str(tmp_path / name), "checkoutpayment", cluster_by=cluster)
        landed = spark.read.option("mergeSchema", "false").parquet(f"{tmp_path}/{name}/checkoutpayment")
        found = restrict(landed, "sessionId", wanted)
        assert found.count() == 2000
        plan = restrict(landed, "sessionId", wanted)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(sessionId,20000)" in plan and "LessThanOrEqual(sessionId,23998)" in plan
        read[name] = _scan_rows(spark, landed.filter(F.col("sessionId").between(wanted.low, wanted.high)))
    assert read["clustered"] < 0.35 * read["loose"] and read["loose"] == 60_000


def _scan_rows(spark, df):
    """Rows that the scan read from the row groups it did not skip."""
    execution = df.select("sessionId")._jdf.queryExecution()
    execution.executedPlan().execute().count()
    leaf = execution.executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_land_command_plans_its_splits_or_takes_bounds():
    from rollcall.__main__ import main
    land = ["land", "--url", "jdbc:mysql://db:3306/x", "--tables", "event", "--out", "/nonexistent"]
    for wrong in (["--key-width", "100"], ["--above", "7"], ["--key-width", "100", "--partition-column", "id", "--partitions", "4", "--lower", "1"]):
        with pytest.raises(SystemExit):
            main([*land, *wrong])
