"""Parse provider responses as they land, into an append-only Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.functions.responses import address_fields, has_key, is_object
from rollcall.operators.lookup import PROVIDER_ORDER
from rollcall.session import ensure_checkpoint_dir
from rollcall.sources.schemas import RESPONSES


def read_response_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RESPONSES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parsed_responses(responses: DataFrame, providers=PROVIDER_ORDER) -> DataFrame:
    """Per response: provider rank, JSON-object flag, fallback acceptance, address fields."""
    rank = F.when(F.col("provider") == F.lit(providers[0]), F.lit(1))
    for i, name in enumerate(providers[1:], start=2):
        rank = rank.when(F.col("provider") == F.lit(name), F.lit(i))
    return responses.select(
        "provider", "cep_requested", "fetched_at", rank.alias("rank"), "body",
        is_object("body").alias("is_object"), has_key("body").alias("accepted"),
        address_fields("body").alias("fields"))


def land_parsed_responses(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None,
                          once: bool = True) -> StreamingQuery:
    """Append parsed responses from ``source`` to ``sink`` (exactly once via ``checkpoint``).

    ``checkpoint`` must be a folder the whole cluster shares; by default it is
    ``streams/parsed-responses`` under the session's checkpoint folder.
    ``once`` runs until the files present now are processed (``availableNow``).
    """
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/parsed-responses"
    stream = parsed_responses(read_response_stream(spark, source))
    writer = (stream.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
