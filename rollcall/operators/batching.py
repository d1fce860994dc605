"""Global batch numbers without a single-partition sort.

``batch_number = floor((row_number() over (order by keys) - 1) / N) + 1``.
A window without ``PARTITION BY`` would pull every row into one task, so the
row number is built from counts per value of the first key (the id):

1. the input is written once to the shared checkpoint folder with a per-row
   tiebreak, so the (often join-heavy) input is computed once and the tiebreak
   cannot change under a retried task.  This is the only full-width write;
2. rows are counted per id (partial aggregation: a hot id is one row a task);
3. the counts, one narrow row per id, are sorted by range and turned into
   offsets by a two-level prefix sum: running sums inside each range, and the
   totals of the ranges before it (one row per range);
4. the written rows are joined to the offset of their id and numbered within
   it: one shuffle by id, used by the join and by the window.

An id with more than ``HOT_ROWS`` rows is cut into pieces by splitters sampled
from its rows (the remaining keys and the tiebreak): the piece of a row is the
number of splitters below it, a pure function of the row, and pieces are
counted, offset and numbered like ids of their own.

A row limit becomes a threshold: the largest id whose offset is below it is
looked up in the offsets, and later ids are filtered in the scan before
anything full-width is shuffled or sorted.

Orders whose first key is not a plain column (descending, expressions) are
sorted by range and numbered by the position in the written, sorted files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.sizing import broadcast_if_small
from rollcall.session import materialize, scratch_folder

#: Rows of one id that a task numbers by itself.
HOT_ROWS = 500_000
#: Pieces of a hot id at most: every row is compared with the splitters of its id.
MOST_PIECES = 256
#: Rows sampled per piece to place the splitters.
SAMPLES_PER_PIECE = 16

_TIE, _PART, _IDX, _N, _OFF, _ROW = "__rc_tie", "__rc_part", "__rc_idx", "__rc_n", "__rc_off", "__rc_row"
_ID, _PIECE, _GROUP, _REST, _SPLIT = "__rc_id", "__rc_piece", "__rc_group", "__rc_rest", "__rc_split"


def _key(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _tagged(df: DataFrame) -> DataFrame:
    return df.withColumn(_TIE, F.monotonically_increasing_id())


def _staged(df: DataFrame, path: str, stage_input: bool) -> DataFrame:
    tagged = _tagged(df)
    if not stage_input:
        return tagged
    tagged.write.parquet(f"{path}/staged")
    return df.sparkSession.read.schema(tagged.schema).parquet(f"{path}/staged")


def _splitters(staged: DataFrame, hot: DataFrame, id_col: str, rest: Column) -> DataFrame:
    """Per hot id (``_ID``, ``_N``) its sorted splitters, ``_SPLIT``."""
    rate = F.least(F.ceil(F.col(_N) / F.lit(HOT_ROWS)), F.lit(MOST_PIECES)) * F.lit(float(SAMPLES_PER_PIECE)) / F.col(_N)
    drawn = F.pmod(F.xxhash64(F.lit(7), _TIE), F.lit(1 << 30)) < rate * F.lit(float(1 << 30))
    sample = staged.join(broadcast_if_small(hot), F.col(id_col).eqNullSafe(F.col(_ID))).filter(drawn)
    taken = sample.groupBy(_ID).agg(F.sort_array(F.collect_list(rest)).alias("s"))
    places = F.sequence(F.lit(SAMPLES_PER_PIECE), F.size("s"), F.lit(SAMPLES_PER_PIECE))
    every = F.when(F.size("s") >= SAMPLES_PER_PIECE, F.transform(places, lambda i: F.element_at("s", i)))
    return materialize(taken.select(_ID, every.alias(_SPLIT)), "splitters")


def _with_pieces(staged: DataFrame, splitters: DataFrame | None, id_col: str, rest: Column) -> DataFrame:
    """``staged`` with ``_GROUP``: the id and the piece of it (0 unless hot).  As a struct it is equal to itself where the id is null."""
    piece = F.lit(0)
    if splitters is not None:
        staged = staged.join(broadcast_if_small(splitters), F.col(id_col).eqNullSafe(F.col(_ID)), "left").drop(_ID)
        below = F.size(F.filter(_SPLIT, lambda s: s < rest))
        piece = F.when(F.col(_SPLIT).isNotNull(), below).otherwise(F.lit(0))
    group = F.struct(F.col(id_col).alias(_ID), piece.alias(_PIECE))
    out = staged.withColumn(_GROUP, group)
    return out.drop(_SPLIT) if splitters is not None else out


def prefix_offsets(counts: DataFrame) -> DataFrame:
    """``_GROUP, _OFF``: the rows of all groups before, from ``_GROUP, _N`` (one row a group)."""
    ranged = counts.repartitionByRange(_GROUP).withColumn(_PART, F.spark_partition_id())
    landed = materialize(ranged, "ranged-counts")
    totals = landed.groupBy(_PART).agg(F.sum(_N).alias("__rc_total"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)       # one row per range
    totals = totals.select(_PART, F.coalesce(F.sum("__rc_total").over(earlier), F.lit(0)).alias("__rc_start"))
    before = Window.partitionBy(_PART).orderBy(_GROUP).rowsBetween(Window.unboundedPreceding, -1)
    inside = landed.withColumn("__rc_inside", F.coalesce(F.sum(_N).over(before), F.lit(0)))
    return materialize(inside.join(F.broadcast(totals), _PART)
                       .select(_GROUP, (F.col("__rc_start") + F.col("__rc_inside")).cast("long").alias(_OFF)), "offsets")


def _up_to_limit(offsets: DataFrame, id_col: str, max_rows: int) -> Column:
    """The ids that start below the limit: a comparison with one literal, so the scan skips the others."""
    last = offsets.filter(F.col(_OFF) < F.lit(max_rows)).agg(F.max(_GROUP).alias("g")).first().g
    if last is None:
        return F.lit(False)
    if last[_ID] is None:
        return F.col(id_col).isNull()
    return F.col(id_col).isNull() | (F.col(id_col) <= F.lit(last[_ID]))


def _number_by_counts(df: DataFrame, staged: DataFrame, id_col: str, rest_cols: list[Column], row_col: str,
                      max_rows: int | None, stage_input: bool) -> DataFrame:
    rest = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(rest_cols)], F.col(_TIE).alias("tie"))
    per_id = materialize(staged.groupBy(F.col(id_col).alias(_ID)).agg(F.count("*").alias(_N)), "id-counts")
    hot = per_id.filter(F.col(_N) > HOT_ROWS)
    whole = F.struct(F.col(_ID), F.lit(0).alias(_PIECE)).alias(_GROUP)
    counts = per_id.select(whole, _N)
    splitters = None
    if not hot.isEmpty():
        splitters = _splitters(staged, hot, id_col, rest)
        pieces = _with_pieces(staged.join(broadcast_if_small(hot.select(F.col(_ID).alias("__rc_hot"))),
                                          F.col(id_col).eqNullSafe(F.col("__rc_hot")), "left_semi"), splitters, id_col, rest)
        counts = per_id.filter(F.col(_N) <= HOT_ROWS).select(whole, _N).unionByName(
            pieces.groupBy(_GROUP).agg(F.count("*").alias(_N)))
    offsets = prefix_offsets(counts)
    if max_rows is not None:
        wanted, offsets = _up_to_limit(offsets, id_col, max_rows), offsets.filter(F.col(_OFF) < F.lit(max_rows))
        if stage_input or splitters is not None:
            staged = staged.filter(wanted)
        else:       # below the tiebreak, whose order (not its values) the filter keeps, it reaches the scan
            staged = _tagged(df.filter(wanted))
    rows = _with_pieces(staged, splitters, id_col, rest).join(offsets, _GROUP)
    within = Window.partitionBy(_GROUP).orderBy(*rest_cols, F.col(_TIE))
    numbered = rows.withColumn(row_col, F.col(_OFF) + F.row_number().over(within)).drop(_TIE, _GROUP, _OFF)
    return numbered if max_rows is None else numbered.filter(F.col(row_col) <= F.lit(max_rows))


def _number_by_files(staged: DataFrame, keys: list[Column], row_col: str, path: str, max_rows: int | None) -> DataFrame:
    ranged = staged.orderBy(*keys, F.col(_TIE)).withColumn(_PART, F.spark_partition_id())
    ranged.write.option("maxRecordsPerFile", 0).parquet(f"{path}/sorted")
    landed = staged.sparkSession.read.schema(ranged.schema).parquet(f"{path}/sorted")
    counts = landed.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    numbered = (landed.select("*", F.col("_metadata.row_index").alias(_IDX))
                      .join(F.broadcast(offsets), _PART)
                      .withColumn(row_col, F.col(_OFF) + F.col(_IDX) + F.lit(1))).drop(_TIE, _PART, _IDX, _OFF)
    return numbered if max_rows is None else numbered.filter(F.col(row_col) <= F.lit(max_rows))


def number_rows(df: DataFrame, order_by, row_col: str = "row_number", workdir: str | None = None,
                stage_input: bool = True, max_rows: int | None = None) -> DataFrame:
    """Add a 1-based global ``row_col`` in the order of ``order_by``; ``max_rows`` keeps the first ones.

    ``stage_input=False`` skips step 1 for an input that is a plain file scan
    (with filters or projections): it yields the same rows in the same order
    when read again, so its tiebreak ids are stable without being written.
    Anything with a join, aggregate or shuffle should be staged.
    """
    base = workdir or scratch_folder(df.sparkSession)
    path = f"{base.rstrip('/')}/rollcall-rows-{uuid.uuid4().hex}"
    order_by = list(order_by)
    staged = _staged(df, path, stage_input)
    if isinstance(order_by[0], str) and all(isinstance(k, str) for k in order_by):
        return _number_by_counts(df, staged, order_by[0], [F.col(k) for k in order_by[1:]], row_col, max_rows, stage_input)
    return _number_by_files(staged, [_key(k) for k in order_by], row_col, path, max_rows)


def number_batches(df: DataFrame, order_by, rows_per_batch: int, max_rows: int | None = None,
                   batch_col: str = "batch_number", keep_row_number: bool = False,
                   workdir: str | None = None, stage_input: bool = True) -> DataFrame:
    """Add ``batch_col``; ``max_rows`` keeps the first rows of that order only."""
    if rows_per_batch is None or int(rows_per_batch) <= 0:
        raise ValueError("rows_per_batch must be a positive integer")
    if max_rows is not None and int(max_rows) < 0:
        raise ValueError("max_rows must not be negative")
    numbered = number_rows(df, order_by, _ROW, workdir, stage_input, None if max_rows is None else int(max_rows))
    numbered = numbered.withColumn(
        batch_col, F.expr(f"({_ROW} - 1) div {int(rows_per_batch)} + 1").cast("bigint"))
    if keep_row_number:
        return numbered.withColumnRenamed(_ROW, "row_number")
    return numbered.drop(_ROW)


def select_batch(df: DataFrame, batch: int, batch_col: str = "batch_number") -> DataFrame:
    return df.filter(F.col(batch_col) == F.lit(int(batch)))
