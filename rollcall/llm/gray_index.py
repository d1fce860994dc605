"""SimHash near-duplicates through Gray-order hierarchical indexes.

A text's fingerprint has a bit for each of the 64 bits that is set in over
half the XXH64 hashes of its three-word shingles.  Two fingerprints are
linked when at most ``MAX_DIFFERENCE`` bits differ; components of links are
near-duplicates.

Of four 16-bit blocks two linked fingerprints share two, so the distinct
fingerprints are sorted six times, each time with another two blocks in
front, by the Gray rank of the permuted bits (codes that agree in front are
neighbours in that order, and neighbours differ in few bits).  A run of the
sorted order is one index: nodes of ``FANOUT`` neighbours hold the mask of the
bits that all below them share, and their pattern; upper nodes are made of
lower ones alike.  The index is joined with itself from the top: a pair of
nodes carries the differences found so far, only bits that are newly shared on
both sides are added, and the pair goes with everything below it once they are
too many.  Runs are never cut between fingerprints that agree in front.  Where
more than ``CROWD`` agree there, those are sorted again with two of the other
blocks (four of 8 bits) in front as well; then 16 bits are left, so at most
65,536 distinct fingerprints agree.

A run reports its links as stars (member, smallest member of its component
there), never as pairs; a fingerprint has at most 2,080 others within two bits.

Defined results: a null text is an empty one; a text without words has the
fingerprint 0 and is linked like any other; fewer than three words are one
shingle; repeated rows are kept, each with its component; a component is
named by its smallest doc_id, null if none of its rows has one; columns other
than ``doc_id`` and ``text`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import map_batches, materialize
from rollcall.llm.components import close_links

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_DIFFERENCE = 2
FANOUT = 4
#: Fingerprints that agree in the 32 bits in front, above which they are sorted again by further blocks.
CROWD = 4_096
#: Fingerprints of one index, unless more agree in front (65,536 at most).
RUN_ROWS = 16_384
#: Pairs of nodes looked at together.
PAIRS_AT_ONCE = 1 << 18
#: Hashes of a text unpacked into bits at a time.
HASHES_AT_ONCE = 1 << 16

_ONE = np.uint64(1)


def fingerprint(text: bytes | None) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()          # bytes: only A-Z, and only the six ASCII blanks
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    joined, size = b" ".join(words), min(SHINGLE_WORDS, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], HASH_SEED) for s, e in zip(starts, ends, strict=True)), "<u8", len(ends))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[i:i + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])
    return map_batches(narrow, run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Places of the codes in the order of the reflected binary code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _in_front(codes: np.ndarray, first: int, width: int, front: tuple[int, ...], blocks: int) -> np.ndarray:
    """Codes whose ``blocks`` blocks of ``width`` bits below bit ``64 - first`` are permuted, those of ``front`` first."""
    mask = np.uint64((1 << width) - 1)
    top = np.uint64(64 - first)
    out = codes >> top << top if first else np.zeros_like(codes)
    for place, block in enumerate([*front, *(b for b in range(blocks) if b not in front)]):
        taken = codes >> np.uint64(64 - first - (block + 1) * width) & mask
        out |= taken << np.uint64(64 - first - (place + 1) * width)
    return out


_PAIRS_OF_BLOCKS = list(combinations(range(4), 2))


def sort_keys(codes: np.ndarray, order: int, deep: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(front, rank)``: what agrees in front, and the Gray rank, of a sort order (0-5; ``deep`` adds two 8-bit blocks).

    The rank is shifted into the order of signed numbers.
    """
    permuted = _in_front(codes, 0, 16, _PAIRS_OF_BLOCKS[order], 4)
    front_bits = 32
    if deep is not None:
        permuted, front_bits = _in_front(permuted, 32, 8, _PAIRS_OF_BLOCKS[deep], 4), 48
    rank = gray_rank(permuted)
    # a prefix of the Gray rank stands for a prefix of the code
    return (rank >> np.uint64(64 - front_bits)).view(np.int64), (rank ^ (_ONE << np.uint64(63))).view(np.int64)


def _sorted_rows(fps: DataFrame) -> DataFrame:
    """``sort, front, rank, fp``: every fingerprint in each of the six orders."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = batch.column("fp").to_numpy(zero_copy_only=False)
        keys = [sort_keys(codes.view(np.uint64), order) for order in range(6)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(6, dtype=np.int32), len(codes))), pa.array(np.concatenate([k[0] for k in keys])),
             pa.array(np.concatenate([k[1] for k in keys])), pa.array(np.tile(codes, 6))], names=["sort", "front", "rank", "fp"])
    return map_batches(fps.select("fp"), run, "sort int, front long, rank long, fp long")


def _resorted(crowded: DataFrame) -> DataFrame:
    """Rows of crowded fronts, in six further orders each; ``sort`` from 6 on."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, orders = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "sort"))
        out: list[list[np.ndarray]] = [[], [], [], []]
        for order in np.unique(orders):
            own = codes[orders == order]
            for deep in range(6):
                front, rank = sort_keys(own.view(np.uint64), int(order), deep)
                for column, values in zip(out, (np.full(len(own), 6 + 6 * order + deep, np.int32), front, rank, own), strict=True):
                    column.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["sort", "front", "rank", "fp"])
    return map_batches(crowded.select("sort", "fp"), run, "sort int, front long, rank long, fp long")


def build_levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(mask, pattern)`` of each node, from the codes themselves up to at most ``FANOUT`` nodes."""
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    every, some = codes, codes
    while len(every) > FANOUT:
        starts = np.arange(0, len(every), FANOUT)
        every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
        mask = ~(every ^ some)
        levels.append((mask, every & mask))
    return levels


def linked_pairs(codes: np.ndarray, most: int = MAX_DIFFERENCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``a < b`` of all distinct sorted codes with at most ``most`` differing bits, some at a time."""
    levels = build_levels(codes)
    top = len(levels) - 1
    a, b = np.triu_indices(len(levels[top][0]))
    mask, pattern = levels[top]
    both = mask[a] & mask[b]
    found = np.bitwise_count((pattern[a] ^ pattern[b]) & both).astype(np.int64)
    near = found <= most
    todo = [(top, a[near], b[near], found[near], both[near])]
    while todo:
        level, a, b, found, both = todo.pop()
        if not len(a):
            continue
        if len(a) > PAIRS_AT_ONCE:
            todo += [(level, *(x[i:i + PAIRS_AT_ONCE] for x in (a, b, found, both))) for i in range(0, len(a), PAIRS_AT_ONCE)]
            continue
        if level == 0:
            apart = a != b
            yield a[apart], b[apart]
            continue
        mask, pattern = levels[level - 1]
        n = len(mask)
        out = []
        for i in range(FANOUT):
            for j in range(FANOUT):
                below_a, below_b = FANOUT * a + i, FANOUT * b + j
                there = (below_a < n) & (below_b < n) & (below_a <= below_b)
                below_a, below_b = below_a[there], below_b[there]
                shared = mask[below_a] & mask[below_b]
                # the bits above were counted already
                now = found[there] + np.bitwise_count((pattern[below_a] ^ pattern[below_b]) & shared & ~both[there])
                near = now <= most
                out.append((below_a[near], below_b[near], now[near], shared[near]))
        todo.append((level - 1, *(np.concatenate([x[k] for x in out]) for k in range(4))))


def star_roots(codes: np.ndarray) -> np.ndarray:
    """Of each code the place of the first code of its component."""
    roots = np.arange(len(codes))
    for a, b in linked_pairs(codes):
        while len(a):
            low, high = np.minimum(roots[a], roots[b]), np.maximum(roots[a], roots[b])
            apart = low != high
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(roots, high, low)
            while (jumped := roots[roots] != roots).any():
                roots = np.where(jumped, roots[roots], roots)
    return roots


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Codes of consecutive rows of a partition, cut where a sort order ends or a front does and there are enough."""
    kept: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        kept.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("sort", "front", "fp")))
        if sum(len(k[0]) for k in kept) <= RUN_ROWS:
            continue
        sort, front, codes = (np.concatenate([k[i] for k in kept]) for i in range(3))
        new_sort = sort[1:] != sort[:-1]
        cuts = np.flatnonzero(new_sort | (front[1:] != front[:-1])) + 1
        forced = set((np.flatnonzero(new_sort) + 1).tolist())
        start = 0
        cuts = [*cuts.tolist(), len(codes)]
        for cut, following in zip(cuts[:-1], cuts[1:], strict=True):
            if cut in forced or following - start > RUN_ROWS:
                yield codes[start:cut]
                start = cut
        kept = [(sort[start:], front[start:], codes[start:])]
    if kept:
        sort, _, codes = (np.concatenate([k[i] for k in kept]) for i in range(3))
        for part in np.split(codes, np.flatnonzero(sort[1:] != sort[:-1]) + 1):
            yield part


def star_links(rows: DataFrame) -> DataFrame:
    """``leader, node`` stars of the components inside each run of the sorted rows."""
    # fronts are whole in a range: the sort adds no key that could part them
    dealt = rows.repartitionByRange("sort", "front").sortWithinPartitions("sort", "front", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _runs(batches):
            roots = star_roots(codes.view(np.uint64))
            member = np.flatnonzero(roots != np.arange(len(codes)))
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(codes[roots[member]]), pa.array(codes[member])], names=["leader", "node"])
    return dealt.mapInArrow(run, "leader long, node long").distinct()


def link_stars(fps: DataFrame) -> DataFrame:
    """``leader, node`` links whose components are those of all links between the distinct ``fp`` of ``fps``."""
    rows = materialize(_sorted_rows(fps), "gray-rows")
    crowded = materialize(rows.groupBy("sort", "front").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD)
                          .select("sort", "front"), "gray-crowded")
    if not crowded.isEmpty():
        rest = rows.join(crowded, ["sort", "front"], "left_anti").select("sort", "front", "rank", "fp")
        rows = materialize(rest.unionByName(_resorted(rows.join(crowded, ["sort", "front"], "left_semi"))), "gray-rows")
    return materialize(star_links(rows), "gray-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``."""
    found = materialize(fingerprints(docs), "fingerprints")
    fps = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "gray-distinct")
    roots = close_links(link_stars(fps)).select(F.col("node").alias("fp"), "root")
    member = materialize(fps.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "gray-members")
    names = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(member.join(names, "root").select("fp", "component_id"), "gray-names")
    return found.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
