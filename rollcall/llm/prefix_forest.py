"""Approximate nearest neighbours by a forest of sorted hash strings.

Every vector gets a long hash string per tree (signs of random orthogonal
projections of the mean-centred vector).  Rows are dealt into shards of bounded
size; a shard keeps one sorted array of strings per tree.  A query descends
in each tree to the rows with its longest common prefix, then all trees ascend
together, one bit at a time, taking in whole prefix ranges until enough
candidates are gathered.  Candidates are ranked by their exact cosine, and the
best of all shards are merged.

Every row is indexed in every tree.  A shard's rows come first in its
partition and the queries after them, so a task holds one shard and a batch of
queries, however many there are.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do rows without an id or of another
length than the most frequent one; rows that repeat an id and a vector are one,
and of an id with several vectors the best counts, for the query and the
candidate; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import materialize

TREES = 16
#: Bits of a hash string.
BITS = 48
#: Mean rows of a shard, and candidates a query gathers in each (whole ranges, so it can be more).
SHARD_ROWS = 4096
CANDIDATES = 2600
SEED = 20_24
NEIGHBOURS = 5


def projections(dimension: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """``trees x bits`` unit vectors; within a tree orthogonal as far as the dimension allows."""
    random = np.random.default_rng(SEED)
    out = []
    for _ in range(trees):
        blocks = [np.linalg.qr(random.standard_normal((dimension, dimension)))[0] for _ in range(-(-bits // dimension))]
        out.append(np.concatenate(blocks)[:bits])
    return np.stack(out)


def hash_strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One integer per tree and vector, its highest bit the first of the string."""
    weights = (1 << np.arange(planes.shape[1] - 1, -1, -1, dtype=np.int64)).astype(np.int64)
    return np.stack([((vectors @ p.T) > 0) @ weights for p in planes])


class Forest:
    """Sorted arrays of the hash strings of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centre: np.ndarray, planes: np.ndarray):
        self.ids, self.vectors, self.centre, self.planes = ids, vectors, centre, planes
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        strings = hash_strings(vectors / self.norms[:, None] - centre, planes)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the range of rows that share the first ``depth`` bits."""
        cut = self.planes.shape[1] - depth
        low = (strings >> cut) << cut
        starts = np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, low, strict=True)])
        ends = np.stack([np.searchsorted(s, x + ((1 << cut) - 1), side="right") for s, x in zip(self.sorted, low, strict=True)])
        return starts, ends

    def search(self, ids: np.ndarray, queries: np.ndarray, wanted: int, neighbours: int):
        """``(query id, candidate id, cosine)`` of the nearest candidates of each query."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        strings = hash_strings(queries / norms[:, None] - self.centre, self.planes)
        found = np.zeros((len(queries), len(self.ids)), bool)
        open_ = np.arange(len(queries))
        wanted = min(wanted, len(self.ids))
        for depth in range(self.planes.shape[1], -1, -1):
            starts, ends = self.ranges(strings[:, open_], depth)
            for column in np.flatnonzero((ends - starts).sum(axis=0)):
                hits = found[open_[column]]
                for order, a, b in zip(self.order, starts[:, column], ends[:, column], strict=True):
                    hits[order[a:b]] = True
            open_ = open_[found[open_].sum(axis=1) < wanted]
            if not len(open_):
                break
        for q, hits in enumerate(found):
            rows = np.flatnonzero(hits & (self.ids != ids[q]))
            if len(rows):
                # a sum per row, so that equal vectors have equal scores
                cosines = (self.vectors[rows] * queries[q]).sum(axis=1) / (self.norms[rows] * norms[q])
                best = np.lexsort((self.ids[rows], -cosines))
                # the best row of each id
                best = best[np.sort(np.unique(self.ids[rows[best]], return_index=True)[1])][:neighbours]
                yield ids[q], self.ids[rows[best]], cosines[best]


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (double) of the rows that take part."""
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return typed.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
                        & F.exists("embedding", lambda x: x != 0))


def search_neighbours(vectors: DataFrame, query_filter, neighbours: int = NEIGHBOURS, trees: int = TREES, bits: int = BITS,
                      shard_rows: int = SHARD_ROWS, candidates: int = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest rows of each row for which ``query_filter`` holds."""
    valid = materialize(valid_vectors(vectors).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
                        .dropDuplicates(["vec_id", "embedding"]), "vectors")
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = valid.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return empty
    dimension, rows = sizes["d"], sizes["n"]
    valid = valid.filter(F.size("embedding") == dimension)
    # the centre only places the hash planes; a mean over all rows, one number a component
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    means = valid.select(norm.alias("norm"), F.posexplode("embedding").alias("i", "x")).groupBy("i") \
        .agg(F.avg(F.col("x") / F.col("norm")).alias("m")).orderBy("i").collect()
    centre = np.nan_to_num(np.array([r["m"] for r in means], float))
    shards = max(1, math.ceil(rows / shard_rows))
    salt = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")
    entries = valid.select(salt.alias("shard"), F.lit(0).alias("kind"), "vec_id", "embedding")
    queries = valid.filter(query_filter).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                                F.lit(1).alias("kind"), "vec_id", "embedding")
    dealt = entries.unionByName(queries).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "vec_id")

    def run(batches):
        planes = projections(dimension, trees, bits)
        current, held, forest = None, [], None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            cuts = np.flatnonzero(np.diff(shard * 2 + kind)) + 1
            for part in np.split(np.arange(len(ids)), cuts):
                if not len(part):
                    continue
                if shard[part[0]] != current:
                    current, held, forest = shard[part[0]], [], None
                if kind[part[0]] == 0:
                    held.append((ids[part], values[part]))
                    continue
                if not held:
                    continue
                if forest is None:
                    forest = Forest(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), centre, planes)
                for begin in range(0, len(part), 1024):
                    block = part[begin:begin + 1024]
                    found = list(forest.search(ids[block], values[block], candidates, neighbours))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found])),
                             pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                            names=["query_id", "vec_id", "score"])
    nearest = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return nearest.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)) \
        .filter(F.col("rank") <= neighbours).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
