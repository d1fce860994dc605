"""Readers with declared schemas: Parquet/CSV landings and the JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sources.commits import read_parts
from rollcall.sources.schemas import ALL, CLEANED_FORMS, OPERATIONAL, PARTICIPANTS


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet",
               month_of: str | None = None) -> DataFrame:
    """Read one landed table with its declared schema (never inferred).

    ``month_of`` declares the month partition column written by
    ``land_table(month_of=…)``.  CSV has no array type: an array column is
    landed as JSON text (``[500, 501]``) and parsed into the declared element
    type.
    """
    schema = ALL[name]
    if month_of:
        schema = T.StructType(schema.fields + [T.StructField(month_column(month_of), T.StringType(), True)])
    path = f"{base.rstrip('/')}/{name}"
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    arrays = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, T.ArrayType)}
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) if f.name in arrays else f
                                for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", "true").option("mode", "FAILFAST").csv(path))
    return raw.select([F.from_json(F.col(f.name), arrays[f.name]).alias(f.name) if f.name in arrays
                       else F.col(f.name) for f in schema.fields])


# Tables whose purchase date filters extractions: landed month-partitioned by it.
PURCHASE_DATED = {"checkoutparticipant": "createdAt", "checkoutsession": "createdAt"}


def read_tables(spark: SparkSession, base: str, names=None, fmt: str = "parquet",
                months: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Read landed tables; ``months`` maps a table to its month-partition source column."""
    months = months or {}
    return {name: read_table(spark, base, name, fmt, months.get(name)) for name in (names or OPERATIONAL)}


def read_extract(spark: SparkSession, base: str, edition: str) -> tuple[DataFrame, DataFrame]:
    """Participants and forms of one edition, as ``extract`` wrote them last under ``base``."""
    base, part = base.rstrip("/"), {"edition_label": edition.replace(" ", "_")}

    def one(name: str, schema: T.StructType, col: str) -> DataFrame:
        return read_parts(spark, f"{base}/{name}", schema, part).filter(F.col(col) == edition)
    return one("participants", PARTICIPANTS, "edition"), one("forms", CLEANED_FORMS, "edicao")


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000, driver: str | None = None) -> dict[str, str]:
    """Options for a parallel JDBC scan split on an integer key range.

    ``partition_column`` with bounds makes Spark issue ``num_partitions``
    range queries instead of one cursor, so a large table is read by many
    tasks.  The four partitioning options must be given together.
    """
    # datetimes without a zone stay as they are, whatever the driver's zone
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        if num_partitions <= 0 or upper_bound < lower_bound:
            raise ValueError("need num_partitions > 0 and lower_bound <= upper_bound")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, name: str, options: dict[str, str]) -> DataFrame:
    """Scan one operational table over JDBC and conform it to the declared schema."""
    return _conformed(spark.read.format("jdbc").options(**options).load(), name)


def _conformed(raw: DataFrame, name: str) -> DataFrame:
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in ALL[name].fields])


def histogram_query(table: str, column: str, width: int, above: int | None = None) -> str:
    """SQL for the database: rows per ``width`` consecutive values of an integer key, of keys after ``above``."""
    where = f" WHERE {column} > {int(above)}" if above is not None else ""
    return (f"(SELECT FLOOR({column} / {int(width)}) * {int(width)} AS low, COUNT(*) AS n FROM {table}{where} "
            f"GROUP BY FLOOR({column} / {int(width)}) * {int(width)}) key_histogram")


def split_predicates(histogram: list[tuple[int | None, int]], column: str, num_partitions: int,
                     above: int | None = None) -> list[str]:
    """One condition per scan task, of about equally many rows each, from ``(low, rows)`` of a key histogram.

    The conditions part all keys, also those that came after the histogram was
    taken and nulls; with ``above`` (the watermark of an increment), the keys
    after it.  Ranges end where the histogram's do, so a task holds at most the
    rows of an equal share and of one of its ranges.
    """
    if num_partitions <= 0:
        raise ValueError("need num_partitions > 0")
    known = sorted((int(low), int(n)) for low, n in histogram if low is not None and n > 0)
    share, bounds, before = sum(n for _, n in known) / num_partitions, [], 0
    for low, n in known:
        if before >= (len(bounds) + 1) * share:
            bounds.append(low)
        before += n
    floor = [f"{column} > {int(above)}"] if above is not None else []
    if not bounds:
        return [" AND ".join(floor) or "1 = 1"]
    first = " AND ".join([*floor, f"{column} < {bounds[0]}"])
    return [first if floor else f"({first} OR {column} IS NULL)",
            *[" AND ".join([*floor, f"{column} >= {a}", f"{column} < {b}"]) for a, b in zip(bounds, bounds[1:], strict=False)],
            " AND ".join([*floor, f"{column} >= {bounds[-1]}"])]


def read_jdbc_balanced(spark: SparkSession, name: str, options: dict[str, str], column: str, num_partitions: int,
                       width: int, above: int | None = None) -> DataFrame:
    """Scan a table over JDBC in parts of equally many rows, as the database counts them, instead of equal key ranges.

    The histogram has one row per ``width`` keys; choose it so that those are some thousands.
    """
    base = {k: v for k, v in options.items() if k not in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    asked = spark.read.format("jdbc").options(**base, dbtable=histogram_query(options["dbtable"], column, width, above)).load()
    predicates = split_predicates([tuple(r) for r in asked.select("low", "n").collect()], column, num_partitions, above)
    raw = spark.read.jdbc(base["url"], options["dbtable"], predicates=predicates,
                          properties={k: v for k, v in base.items() if k != "url"})
    return _conformed(raw, name)


def month_column(col: str) -> str:
    """Name of the month partition column derived from timestamp ``col``."""
    return f"{col}_month"


#: The column by which extractions restrict a table of all events: landed clustered by it.
RESTRICTED_BY = {"checkoutparticipant": "checkoutEventTicketBatchPriceId", "checkoutsession": "id", "checkoutpayment": "sessionId",
                 "checkoutsummary": "sessionId", "checkoutorderticketpartialcancel": "participantId",
                 "participant_options": "id", "formfieldanswer": "checkoutParticipantId", "checkouteventticketbatchprice": "eventTicketBatchPriceId"}


def land_table(df: DataFrame, base: str, name: str, partition_by=(), month_of: str | None = None,
               cluster_by: str | None = None, append: bool = False) -> str:
    """Write a scanned table as Parquet so later runs read it column-pruned.

    ``month_of`` names a timestamp column; the table is then partitioned by its
    UTC month (``<col>_month``, ``yyyy-MM``), and ``purchased_between`` on that
    column reads only the months of its range (static partition pruning).
    ``cluster_by`` sorts the rows by a column (by range over the files and inside
    each), so that ``restrict`` on it reads only the row groups in its ids'
    range.  ``append`` adds an increment.
    """
    path = f"{base.rstrip('/')}/{name}"
    if month_of:
        df = df.withColumn(month_column(month_of), F.date_format(F.col(month_of), "yyyy-MM"))
        partition_by = (*partition_by, month_column(month_of))
    if cluster_by:
        keys = [*partition_by, cluster_by]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = df.write.mode("append" if append else "overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
