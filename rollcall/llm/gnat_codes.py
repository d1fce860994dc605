"""Vector code compression: product codes whose entries are searched through GNATs.

Vectors become whole numbers (``floor(SCALE * x)``) and are cut into ``PARTS``
equal parts; each part position has a codebook of up to ``ENTRIES`` entries,
which starts as that part of the smallest vec_ids and is moved ``ROUNDS`` times
to the floored means of the parts assigned to it.

A part's nearest entry is found through a geometric near-neighbour access tree
over the codebook: a node has split points, chosen far apart, each other entry
below it belongs to its nearest split point, and for every child and every
split point the node stores the range of distances from the child's entries to
that split point.  A query measures its distances to the split points; with
the nearest distance r found so far, a child is left out when for any split
point p its whole range lies beyond ``d(q, p) + r`` or short of ``d(q, p) - r``.
Only strictly: ranges are rounded outwards and query distances to the side that
keeps a child, so an entry at exactly r is always reached.  What is reached is
compared by whole squared distances, ties by the lower index.

A round is one pass: tasks add up their parts per entry, and one row per entry
reaches the driver (``PARTS * ENTRIES`` rows whatever the input).

Defined results: rows whose vector is null or holds a null or non-finite
component are left out; so are vectors that cannot be cut like that of the
smallest vec_id left (another length, or none of ``PARTS`` equal parts of one
component or more); rows that repeat a vec_id are rows of their own, ordered by
their vector where they start codebooks, rows without vec_id last; fewer rows
than entries make smaller codebooks; whole numbers beyond ``LARGEST`` in size
are set to it, so that no sum overflows; an empty table gives an empty result;
columns other than ``vec_id``, ``embedding`` and ``label`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LARGEST = 1 << 26
#: Split points of a node; nodes of at most as many entries have no children.
SPLITS = 8
#: More than the rounding of a square root and of a sum of two.
_OUT = 1 + 2.0 ** -49
_IN = 1 - 2.0 ** -49


class Node(NamedTuple):
    splits: np.ndarray          # indexes of entries
    points: np.ndarray          # the entries themselves
    children: list[Node | None]
    low: np.ndarray             # child x split point: least distance, rounded down
    high: np.ndarray            # greatest, rounded up


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, whole numbers."""
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        out += (a[:, k, None] - b[None, :, k]) ** 2
    return out


def build_tree(entries: np.ndarray, among: np.ndarray | None = None) -> Node:
    """A tree over distinct entries (of equal ones the lowest index, which wins every tie)."""
    if among is None:
        among = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    if len(among) <= SPLITS:
        none = np.zeros((len(among), len(among)))
        return Node(among, entries[among], [None] * len(among), none, none)
    chosen = [0]
    nearest = squared(entries[among], entries[among[:1]])[:, 0]
    while len(chosen) < SPLITS:                     # each as far from the others as can be
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries[among], entries[among[chosen[-1:]]])[:, 0])
    splits, rest = among[chosen], np.delete(among, chosen)
    distances = squared(entries[rest], entries[splits])
    owner = distances.argmin(axis=1)
    children, low, high = [], np.zeros((SPLITS, SPLITS)), np.zeros((SPLITS, SPLITS))
    for i in range(SPLITS):
        own = owner == i
        children.append(build_tree(entries, rest[own]) if own.any() else None)
        if own.any():
            low[i], high[i] = np.sqrt(distances[own].min(axis=0)) * _IN, np.sqrt(distances[own].max(axis=0)) * _OUT
    return Node(splits, entries[splits], children, low, high)


def _visit(node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Lower ``best`` and ``index`` of the rows to what the node holds."""
    d = squared(queries[rows], node.points)
    for k, entry in enumerate(node.splits.tolist()):
        better = (d[:, k] < best[rows]) | ((d[:, k] == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = d[better, k], entry
    if not any(node.children):
        return
    root = np.sqrt(d)
    near, far = root * _IN, root * _OUT
    own = d.argmin(axis=1)
    # the child of the nearest split point first: it makes r small for the others
    for first in (True, False):
        for i, child in enumerate(node.children):
            if child is None:
                continue
            at = np.flatnonzero((own == i) == first)
            r = np.sqrt(best[rows[at]])[:, None] * _OUT
            out = (near[at] - r > node.high[i]) | (far[at] + r < node.low[i])
            at = at[~out.any(axis=1)]
            if len(at):
                _visit(child, queries, rows[at], best, index)


def nearest_entries(tree: Node, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each query (ties: the lower one), and its squared distance."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    index = np.full(len(queries), np.iinfo(np.int64).max)
    if len(queries):
        _visit(tree, queries, np.arange(len(queries)), best, index)
    return index, best


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, width, vector`` (32-bit whole numbers) of the rows that take part, but for their width."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    kept = vectors.select("vec_id", "label", x.alias("embedding")).filter(x.isNotNull() & finite)
    # bounded before the numbers become whole, so that no cast overflows
    bounded = F.transform(x, lambda v: F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v.cast("double") * SCALE)))
    return kept.select("vec_id", "label", F.size("embedding").alias("width"),
                       F.transform(bounded, lambda v: F.floor(v).cast("int")).alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows x parts x components."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), PARTS, width // PARTS)


def _assign(trees: list[Node], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and squared distances, rows x parts."""
    found = [nearest_entries(trees[p], vectors[:, p]) for p in range(PARTS)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def first_codebooks(whole: DataFrame) -> np.ndarray | None:
    """Parts x entries x components, from the rows of the smallest vec_ids; ``None`` without rows."""
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").collect()
    if not first:
        return None
    return np.array([r.vector for r in first], np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2).copy()


def moved_codebooks(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floored mean of the parts assigned to it; unused entries stay."""
    trees, width, entries = [build_tree(b) for b in books], PARTS * books.shape[2], books.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), width)
            index, _ = _assign(trees, vectors)
            for p in range(PARTS):
                np.add.at(sums[p], index[:, p], vectors[:, p])
                counts[p] += np.bincount(index[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"])
    added = whole.select("vector").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    total = added.groupBy("part", "entry").agg(F.sum("n").alias("n"),
                                               *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(books.shape[2])])
    out = books.copy()
    for part, entry, n, *sums in total.collect():
        out[part, entry] = [s // n for s in sums]
    return out


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""
    trees, width = [build_tree(b) for b in books], PARTS * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            index, distance = _assign(trees, _matrix(batch.column("vector"), width))
            codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))],
                names=["vec_id", "label", "code", "error"])
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    return whole.select("vec_id", "label", "vector").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def train_codebooks(vectors: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """The whole-number rows that take part (written once), and the codebooks after ``ROUNDS`` rounds."""
    whole = materialize(whole_vectors(vectors), "whole-vectors")
    smallest = whole.filter(F.col("width") > 0).orderBy(F.asc_nulls_last("vec_id"), "vector").select("width").first()
    width = smallest.width if smallest else 0
    whole = whole.filter(F.col("width") == (width if width % PARTS == 0 and width else -1))
    books = first_codebooks(whole)
    for _ in range(ROUNDS if books is not None else 0):
        books = moved_codebooks(whole, books)
    return whole, books


def compress(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row that takes part."""
    whole, books = train_codebooks(vectors)
    if books is None:
        return whole.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).limit(0)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = materialize(encode(whole, books), "coded-vectors")
    sums = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("l"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
