"""Parts of an output: replaced exactly, also by nothing, and beside each other."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.session import ensure_checkpoint_dir, materialize, run_folder
from rollcall.sources.commits import commit_part, part_folder, read_parts
from rollcall.sources.readers import read_extract
from rollcall.sources.schemas import CLEANED_FORMS, PARTICIPANTS
from rollcall.sources.sinks import write_beside_report, write_extract, write_report

ROW = "edition string, batch_number long, item_id long"


def test_emptied_edition_replaces_its_old_rows(spark, tmp_path):
    base = str(tmp_path / "x")
    people = spark.createDataFrame([], PARTICIPANTS)
    forms = spark.createDataFrame([], CLEANED_FORMS)
    three = spark.createDataFrame([(b, i, "City Run") for b, i in ((1, 1), (1, 2), (2, 3))], "batch_number long, item_id long, edition string")
    full = people.unionByName(three, allowMissingColumns=True)
    other = people.unionByName(three.withColumn("edition", F.lit("Other")), allowMissingColumns=True)
    for rows, edition in ((full, "City Run"), (other, "Other")):
        write_extract(rows, f"{base}/participants", "edition", edition=edition)
        write_extract(forms, f"{base}/forms", "edicao", edition=edition)
    assert read_extract(spark, base, "City Run")[0].count() == 3
    write_extract(full.filter("item_id = 1"), f"{base}/participants", "edition", edition="City Run")
    assert [r.item_id for r in read_extract(spark, base, "City Run")[0].collect()] == [1]
    write_extract(people, f"{base}/participants", "edition", edition="City Run")
    assert read_extract(spark, base, "City Run")[0].count() == 0
    assert read_extract(spark, base, "Other")[0].count() == 3
    assert read_extract(spark, base, "Never")[0].count() == 0
    # a plain reader of the folder sees the same
    assert spark.read.schema(PARTICIPANTS).parquet(f"{base}/participants").count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_two_batches_of_one_minute_lie_beside_each_other(spark, tmp_path, fmt):
    out, now = str(tmp_path / "r"), dt.datetime(2025, 6, 30, 14, 5)
    rows = spark.createDataFrame([("City Run", b, 10 * b) for b in (1, 2, 2)], ROW)
    for batch in (1, 2):
        mine = rows.filter(F.col("batch_number") == batch)
        write_report(mine, out, now, fmt=fmt, edition="City Run", batch=batch)
        write_beside_report(mine.agg(F.count("*").alias("ok")), f"{out}_counters", now, "City Run", batch=batch)
    read = lambda: spark.read.option("header", "true").format(fmt).load(out)
    assert read().count() == 3
    write_report(rows.limit(0), out, now, fmt=fmt, edition="City Run", batch=2)
    assert [str(r.item_id) for r in read().collect()] == ["10"]
    counters = spark.read.parquet(f"{out}_counters")
    assert sorted((r.batch, r.ok) for r in counters.collect()) == [(1, 1), (2, 2)]


def test_a_failed_write_is_never_read(spark, tmp_path):
    path, part = str(tmp_path / "t"), {"edition_label": "A/B: 100%"}
    good = spark.createDataFrame([(1,)], "v long")
    commit_part(good, path, part)
    bad = good.select((F.lit(1) / F.when(F.col("v") == 1, F.lit(0))).cast("long").alias("v"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        commit_part(bad, path, part)
    (tmp_path / "t" / part_folder(part) / "commit-left").mkdir()          # what a killed driver may leave
    assert [r.v for r in read_parts(spark, path, good.schema, part).collect()] == [1]
    levels = spark.read.parquet(path).select("edition_label").distinct().collect()
    assert [r.edition_label for r in levels] == ["A/B: 100%"]


def test_a_run_removes_its_intermediates(spark):
    import os
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    with run_folder(spark) as folder:
        kept = materialize(spark.range(5), "inside")
        assert kept.count() == 5 and os.listdir(folder.removeprefix("file:"))
    assert set(os.listdir(base)) == before
