"""Outputs replaced part by part, through a manifest of commits.

A part is what one run writes for one edition (and batch, and run time): a
folder below the output's path whose levels name it
(``edition_label=City_Run/...``).  A write lands in a new folder of its own
inside the part; then one row naming it is appended to the manifest, a small
Parquet table beside the output (``<path>_commits``); then the part's earlier
folders are removed.  So a part is replaced exactly, also by an empty result,
and never by another part that is written at the same time; a write that fails
half way is never read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.session import remove_folder

MANIFEST = "part string, folder string, committed_ns long"


def _escaped(value) -> str:
    """Folder names as Spark writes partition values: anything but letters, digits and ``-._`` of ASCII as ``%XX``."""
    return "".join(c if ord(c) > 127 or c.isalnum() or c in "-._" else f"%{ord(c):02X}" for c in str(value))


def part_folder(part: dict[str, object]) -> str:
    return "/".join(f"{name}={_escaped(value)}" for name, value in part.items())


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}_commits"


def live_folders(spark: SparkSession, path: str) -> DataFrame:
    """``part, folder`` of the last commit of every part of ``path``."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(manifest_path(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], MANIFEST)
    last = Window.partitionBy("part").orderBy(F.desc("committed_ns"), "folder")
    return rows.withColumn("place", F.row_number().over(last)).filter("place = 1").select("part", "folder")


def commit_part(df: DataFrame, path: str, part: dict[str, object], fmt: str = "parquet") -> str:
    """Replace ``part`` of the output at ``path`` by ``df`` (which does not hold the part's columns)."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = part_folder(part)
    folder = f"{name}/commit-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(f"{path}/{folder}")
    before = live_folders(spark, path).filter(F.col("part") == name).collect()
    spark.createDataFrame([(name, folder, time.time_ns())], MANIFEST).coalesce(1).write.mode("append").parquet(manifest_path(path))
    for old in before:
        remove_folder(spark, f"{path}/{old.folder}")
    return path


def read_parts(spark: SparkSession, path: str, schema: T.StructType, within: dict[str, object] | None = None) -> DataFrame:
    """Rows of the committed parts below ``within`` (its levels first), with the part's levels that ``schema`` names as columns.

    The manifest's live rows, one per part, are what reaches the driver.
    """
    path = path.rstrip("/")
    live = live_folders(spark, path)
    if within:
        name = part_folder(within)
        live = live.filter((F.col("part") == name) | F.startswith(F.col("part"), F.lit(name + "/")))
    folders = [f"{path}/{r.folder}" for r in live.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())
