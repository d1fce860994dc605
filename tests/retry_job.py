"""Run in its own process (tests/test_retries.py): numbering while tasks fail once and are retried."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    spark = (SparkSession.builder.master("local[4,4]")          # up to 4 attempts per task
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from rollcall.operators.batching import number_batches

    @F.udf("long")
    def flaky(x):   # test-only: the first attempt of partition 1 fails in every job that evaluates it
        ctx = TaskContext.get()
        if ctx is not None and ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return x

    df = spark.range(0, 4000, numPartitions=4).select(flaky(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    got = {(r.k, r.v): r.batch_number for r in number_batches(df, ["k", "v"], 300).collect()}
    w = Window.orderBy("k", "v")
    want = {(r.k, r.v): r.b for r in spark.range(0, 4000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
            .withColumn("b", F.floor((F.row_number().over(w) - 1) / 300) + 1).collect()}
    numbering_ok = got == want

    # A whole participant extraction whose participant scan fails once per job.
    import datetime as dt
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from fixture_tables import operational_tables
    from rollcall.plans.extract import extract_participants
    tables = operational_tables(spark)
    args = ("10 Milhas RJ", "2023-12-31", "2024-01-31")
    clean = sorted(map(tuple, extract_participants(tables, *args, rows_per_batch=3, as_of=dt.date(2025, 6, 30))
                       .collect()))
    cp = tables["checkoutparticipant"]
    tables["checkoutparticipant"] = cp.repartition(4).withColumn("id", flaky(F.col("id")))
    retried = sorted(map(tuple, extract_participants(tables, *args, rows_per_batch=3, as_of=dt.date(2025, 6, 30))
                         .collect()))
    extraction_ok = clean == retried and len(clean) == 14
    print("OK" if numbering_ok and extraction_ok else "MISMATCH", len(got))


if __name__ == "__main__":
    main()
