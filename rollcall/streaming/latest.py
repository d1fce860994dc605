"""A bucketed table of landed answers, kept up by a stream and read by the lookup.

The table is bucketed by requested code.  A micro-batch is reduced to its last
answer per (provider, code), dealt to the buckets by the hash Spark buckets by
(one file a bucket) and appended; no earlier file is read or rewritten, so the
cost of a micro-batch is its own size.  Readers take the last answer per
(provider, code): a replayed micro-batch adds rows that are equal to those there
and changes nothing.  Aggregates and joins by code on the table need no shuffle.
``compact_answers`` rewrites it to one row per (provider, code) now and then.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators.lookup import latest_answers
from rollcall.session import ensure_checkpoint_dir, materialize
from rollcall.sources.schemas import RESPONSES
from rollcall.streaming.responses import read_response_stream

CODE = "cep_requested"


class AnswerTable(NamedTuple):
    """Where the answers are: a name in the session's catalog, a folder, and the number of buckets (fixed once written)."""
    name: str
    path: str
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        spark.catalog.refreshTable(self.name)      # a stream appends from a session of its own
        return spark.table(self.name)


def open_answers(spark: SparkSession, table: AnswerTable) -> AnswerTable:
    """Name the table in this session's catalog, over the files that are there (or none yet)."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESPONSES.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet "
              f"CLUSTERED BY ({CODE}) SORTED BY ({CODE}) INTO {table.buckets} BUCKETS LOCATION '{table.path}'")
    return table


def upsert_answers(answers: DataFrame, table: AnswerTable, mode: str = "append") -> None:
    """Add the last answer per (provider, code) of ``answers`` to the table."""
    rows = latest_answers(answers).select(*[f.name for f in RESPONSES.fields]).repartition(table.buckets, CODE)
    (rows.write.format("parquet").mode(mode).bucketBy(table.buckets, CODE).sortBy(CODE)
         .option("path", table.path).saveAsTable(table.name))


def stream_answers(spark: SparkSession, source: str, table: AnswerTable, checkpoint: str | None = None,
                   once: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the table up with the responses that land in ``source``.

    ``checkpoint`` must be a folder the whole cluster shares; by default it is
    ``streams/<table name>`` under the session's checkpoint folder.
    """
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{table.name}"
    writer = (read_response_stream(spark, source, max_files_per_trigger).writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: upsert_answers(batch, table)))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()


def compact_answers(spark: SparkSession, table: AnswerTable) -> None:
    """Rewrite the table to one row per (provider, code); the last answers are written aside first."""
    upsert_answers(materialize(latest_answers(table.read(spark)), "answers"), table, mode="overwrite")
