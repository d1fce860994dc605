import datetime as dt

from rollcall.sources.schemas import RESPONSES
from rollcall.streaming.responses import land_parsed_responses


def test_stream_lands_parsed_responses(spark, tmp_path):
    src, sink, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    rows = [("brasilapi", "01310-100", '{"cep":"01310100","city":"SP"}', dt.datetime(2024, 1, 1)),
            ("viacep", "01310-100", "<html>", dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, RESPONSES).write.parquet(src + "/batch1")
    q = land_parsed_responses(spark, src + "/batch1", sink, ckpt)
    q.awaitTermination(120)
    got = {r.provider: (r.rank, r.is_object, r.accepted, r.fields.city if r.fields else None)
           for r in spark.read.parquet(sink).collect()}
    assert got == {"brasilapi": (1, True, True, "SP"), "viacep": (2, False, False, None)}


def test_postal_cleaning_runs_on_a_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    from rollcall.operators.postal import normalise_postal_codes
    src, sink, ckpt = str(tmp_path / "forms"), str(tmp_path / "clean"), str(tmp_path / "ckpt2")
    spark.createDataFrame([(1, "0131_-1__"), (2, None), (3, "01310-1009")],
                          "participant_id long, cep string").write.parquet(src)
    stream = spark.readStream.schema("participant_id long, cep string").parquet(src)
    q = (normalise_postal_codes(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.participant_id: r.parsed_ceps for r in spark.read.parquet(sink).select(
        "participant_id", F.col("parsed_ceps")).collect()}
    assert got == {1: "01310-100", 2: "00000-000", 3: "01310-100"}
