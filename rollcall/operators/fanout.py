"""Row multiplicity of one-to-many left joins, computed from pre-aggregated sides.

A ``LEFT JOIN x ON x.k = id`` that contributes no column only repeats each
row once per match (at least once).  Joining the raw side would shuffle all
its rows and put every match of a hot key in one task; counting matches per
key first (partial aggregation on the map side) leaves one row per key, and
the repeat is a streaming ``explode`` after a one-to-one join.

Copies are cut into chunks of at most ``CHUNK_COPIES``, and the chunks are
dealt out before they are expanded, so no task emits all copies of a
hot key.  Joining the copies again would gather them; jobs therefore attach
the number first (``attach_copies``) and repeat rows as their last step.

Sides that do contribute columns are attached by ``attach_sides``: one exchange
for all of them, and joins that can be split for the keys that are hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.sizing import broadcast_if_small
from rollcall.session import materialize

CHUNK_COPIES = 1_000
#: Rows of one key and table that may be gathered into a list.
HOT_SIDE_ROWS = 1_000
_KEY, _COPIES, _REP, _CHUNK = "__rc_fan_key", "__rc_fan_copies", "__rc_fan_rep", "__rc_fan_chunk"
_TAG, _HOT, _SIDE, _MATCHED = "__rc_fan_tag", "__rc_fan_hot", "__rc_fan_side", "__rc_fan_matched"


def repeat_rows(df: DataFrame, copies: Column) -> DataFrame:
    """Emit each row ``copies`` times; 0 (or less) drops it.

    A row is first cut into chunks of at most ``CHUNK_COPIES`` copies, which are
    dealt out in turn (Spark sorts before it deals, so a retried task deals alike).
    """
    one, step = F.lit(1).cast("long"), F.lit(CHUNK_COPIES).cast("long")
    counted = df.withColumn(_COPIES, copies.cast("long")).filter(F.col(_COPIES) > 0)
    last_chunk = F.floor((F.col(_COPIES) - one) / step).cast("long")
    # An explicit partition count: chunk rows are tiny, and AQE would otherwise
    # coalesce them back into a single partition.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (counted.withColumn(_CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
                     .repartition(parts))
    size = F.least(step, F.col(_COPIES) - F.col(_CHUNK) * step)
    out = chunks.withColumn(_REP, F.explode(F.sequence(one, size)))
    return out.drop(_REP, _CHUNK, _COPIES)


def attach_copies(df: DataFrame, id_col: str, per_key: DataFrame, copies_col: str) -> DataFrame:
    """Add ``copies_col``: the key's number in ``per_key`` (one row a key, written once), 1 where it has none."""
    per_key = materialize(per_key, "per-key")
    joined = df.join(per_key, F.col(id_col) == F.col(_KEY), "left")
    return joined.withColumn(copies_col, F.coalesce(F.col(_COPIES), F.lit(1))).drop(_KEY, _COPIES)


def _multiply(df: DataFrame, id_col: str, per_key: DataFrame) -> DataFrame:
    counted = attach_copies(df, id_col, per_key, "__rc_fan_n")
    return repeat_rows(counted, F.col("__rc_fan_n")).drop("__rc_fan_n")


def left_matches(df: DataFrame, side: DataFrame, id_col: str, key: str) -> DataFrame:
    """``df LEFT JOIN side ON key = id_col`` without ``key``, of written tables.

    A left join can only be split on its left side, so a key with many rows in
    ``side`` would be one task.  The inner join can be split on both; the rows
    without a match come from an anti-join with the distinct keys.
    """
    matched = df.join(side, F.col(id_col) == F.col(key)).drop(key)
    keys = side.select(F.col(key).alias(_MATCHED)).distinct()
    alone = df.join(keys, F.col(id_col) == F.col(_MATCHED), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def attach_sides(df: DataFrame, id_col: str, sides: list[tuple[DataFrame, str]], hot_rows: int | None = None) -> DataFrame:
    """``df LEFT JOIN side ON key = id_col`` for every ``(side, key)``, without the keys; rows multiply as the joins do.

    All sides meet ``df`` in one exchange: rows of all of them are written once
    as a union tagged with the table they come from, grouped by key into one
    list per table, and the lists are expanded.  So each input is read once,
    however many left joins there are.  Keys with more than ``hot_rows`` rows of
    one table never become lists: their rows are joined by ``left_matches``
    from the written union, where either side of a join can be split.
    """
    hot_rows = HOT_SIDE_ROWS if hot_rows is None else hot_rows
    tables = [(df, id_col, list(df.columns))] + [(side, key, [c for c in side.columns if c != key]) for side, key in sides]
    names = [f"__rc_t{i}" for i in range(len(tables))]
    payloads = [F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(1).alias("__rc_any")) for _, _, cols in tables]
    empty = [F.lit(None).cast(table.select(payload.alias("p")).schema["p"].dataType)
             for (table, _, _), payload in zip(tables, payloads, strict=True)]
    tagged = None
    for i, (table, key, _) in enumerate(tables):
        mine = table if i == 0 else table.filter(F.col(key).isNotNull())
        rows = mine.select(F.col(key).alias(_KEY), F.lit(i).alias(_TAG),
                           *[(payloads[j] if j == i else empty[j]).alias(n) for j, n in enumerate(names)])
        tagged = rows if tagged is None else tagged.unionByName(rows)
    tagged = materialize(tagged, "tagged-sides")
    columns = [c for _, _, cols in tables for c in cols]

    def expanded(lists: DataFrame) -> DataFrame:
        out = lists.filter(F.size(names[0]) > 0)
        for n in names:
            out = out.withColumn(n, F.explode_outer(n))
        return out.select(*[F.col(f"{n}.{c}").alias(c) for n, (_, _, cols) in zip(names, tables, strict=True) for c in cols])

    known = tagged.filter(F.col(_KEY).isNotNull())
    hot = materialize(known.groupBy(_KEY, _TAG).agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows)
                      .select(F.col(_KEY).alias(_HOT)).distinct(), "hot-keys")
    crowded = not hot.isEmpty()
    hot = broadcast_if_small(hot)
    calm = known.join(hot, F.col(_KEY) == F.col(_HOT), "left_anti") if crowded else known
    out = expanded(calm.groupBy(_KEY).agg(*[F.collect_list(n).alias(n) for n in names]))
    # rows without a key match nothing
    out = out.unionByName(tagged.filter(F.col(_KEY).isNull()).select(*[F.col(f"{names[0]}.{c}").alias(c) for c in tables[0][2]]),
                          allowMissingColumns=True)
    if crowded:
        rows = known.join(hot, F.col(_KEY) == F.col(_HOT), "left_semi")
        joined = rows.filter(F.col(_TAG) == 0).select(_KEY, *[F.col(f"{names[0]}.{c}").alias(c) for c in tables[0][2]])
        for i, (_, _, cols) in enumerate(tables[1:], start=1):
            side = rows.filter(F.col(_TAG) == i).select(F.col(_KEY).alias(_SIDE), *[F.col(f"{names[i]}.{c}").alias(c) for c in cols])
            joined = materialize(left_matches(joined, side, _KEY, _SIDE), "hot-matches")
        out = out.unionByName(joined.drop(_KEY), allowMissingColumns=True)
    return out.select(*columns)


def null_reason_copies(cancels: DataFrame, key: str = "participantId", reason: str = "reason") -> DataFrame:
    """Per key of ``cancels``: how many of its cancellations have a null reason."""
    return cancels.groupBy(F.col(key).alias(_KEY)).agg(F.count_if(F.col(reason).isNull()).alias(_COPIES))


def match_copies(other: DataFrame, key: str) -> DataFrame:
    """Per key of ``other``: its rows."""
    return other.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias(_COPIES))


def without_partial_cancel(df: DataFrame, cancels: DataFrame, id_col: str,
                           key: str = "participantId", reason: str = "reason") -> DataFrame:
    """Same rows as ``df LEFT JOIN cancels ON key = id_col WHERE reason IS NULL``.

    Not an anti-join: a row without cancellation stays once, a row whose
    cancellations all carry a reason goes, and a row stays once per
    cancellation with a null reason.
    """
    return _multiply(df, id_col, null_reason_copies(cancels, key, reason))


def keep_unused_fanout(df: DataFrame, other: DataFrame, id_col: str, key: str) -> DataFrame:
    """Same rows as ``df LEFT JOIN other ON other.key = id_col`` with no column of other."""
    return _multiply(df, id_col, match_copies(other, key))


def combined_copies(cancels: DataFrame, unused: tuple = (), key: str = "participantId",
                    reason: str = "reason") -> DataFrame:
    """Per key the copies left by ``without_partial_cancel`` and any number of ``keep_unused_fanout`` on it.

    ``unused`` holds ``(table, key)`` pairs.  All sides are unioned into one
    per-key aggregate (one shuffle, partial aggregation on the map side):
    copies = (null-reason cancellations if the key has any cancellation, else
    1) x max(1, matches) of every ``unused`` side.
    """
    flags = ["__rc_c", "__rc_cn"] + [f"__rc_u{i}" for i in range(len(unused))]
    zero = {f: F.lit(0) for f in flags}
    cols = {**zero, "__rc_c": F.lit(1), "__rc_cn": F.col(reason).isNull().cast("int")}
    sides = cancels.select(F.col(key).alias(_KEY), *[cols[f].cast("long").alias(f) for f in flags])
    for i, (table, table_key) in enumerate(unused):
        cols = {**zero, f"__rc_u{i}": F.lit(1)}
        sides = sides.unionByName(
            table.select(F.col(table_key).alias(_KEY), *[cols[f].cast("long").alias(f) for f in flags]))
    sums = sides.groupBy(_KEY).agg(*[F.sum(f).alias(f) for f in flags])
    copies = F.when(F.col("__rc_c") > 0, F.col("__rc_cn")).otherwise(F.lit(1))
    for i in range(len(unused)):
        copies = copies * F.greatest(F.col(f"__rc_u{i}"), F.lit(1))
    return sums.select(_KEY, copies.cast("long").alias(_COPIES))


def multiply_by_matches(df: DataFrame, id_col: str, cancels: DataFrame, unused: tuple = (),
                        key: str = "participantId", reason: str = "reason") -> DataFrame:
    """``without_partial_cancel`` and the ``keep_unused_fanout`` of ``unused`` on one key, in one pass."""
    return _multiply(df, id_col, combined_copies(cancels, unused, key, reason))
