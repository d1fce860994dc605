"""Ranked lexical search over classes of equal bags.

Items (queries) are dealt into blocks of at most about ``BLOCK_TERMS`` terms,
and each block is answered over all documents.  A document is restricted to
the block's vocabulary: its bag is the occurrences (tf) of those terms, and
its length enters a score only as the whole number ``m``.  Documents with the
same bag and the same ``m`` score alike for every item, so they form a class:
they meet by a hash of both, are verified by comparing them, and the class is
scored once.  A class carries its ``k`` smallest doc_ids, which is all that any
item's ranking can take from it; they are expanded in ascending order.

Copies are gathered in the tasks that read them before anything is shuffled,
so a class holding a third of all rows arrives as one row a task.  Every task
keeps the ``k`` best rows of each item; those are ranked at the end.

Defined results: a term is a run of characters that are not ASCII or are ASCII
letters or digits, with A-Z lower-cased; a null text has no term; rows that
repeat a doc_id are documents of their own and may be listed as such; a row
without doc_id ranks after others of its score; rows of ``items`` with equal
ids (null too) are one item with the terms of all of them; an item without
terms, an empty table of items or of documents, or a score of 0 gives no row;
columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import map_batches, materialize

#: Distinct (item, term) pairs of the items answered together; what tasks are sent is in proportion.
BLOCK_TERMS = 500_000
#: Cells of the matrix of scores (classes x items) held at a time.
SCORE_CELLS = 1 << 21
#: Classes that a task gathers before it hands them on.
GATHERED_CLASSES = 20_000
NO_ID = (1 << 63) - 1

#: Separators become blanks, A-Z lower case; bytes of other characters stay.
_FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Block(NamedTuple):
    """Items answered together."""
    vocabulary: dict[bytes, int]   # term -> number
    item_ids: list                 # item number -> item_id
    starts: np.ndarray             # of each term its first place in ``items``, and the end
    items: np.ndarray              # numbers of the items that hold the term


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term`` (binary), distinct."""
    narrow = items.select("item_id", F.col("text").cast("string").cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, t) for i, text in enumerate(batch.column("text")) for t in dict.fromkeys(terms(text.as_py()))]
        return pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array([i for i, _ in rows], pa.int64())),
                                           pa.array([t for _, t in rows], pa.binary())], names=["item_id", "term"])
    kind = narrow.schema["item_id"].dataType.simpleString()
    return map_batches(narrow, run, f"item_id {kind}, term binary").distinct()


def item_blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks, each brought to the driver by itself."""
    pairs = materialize(item_terms(items), "item-terms")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    for block in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not rows.num_rows:
            continue
        names = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        words = rows.column("term").combine_chunks().dictionary_encode()
        term = words.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        vocabulary = {t: i for i, t in enumerate(words.dictionary.to_pylist())}
        yield Block(vocabulary, names.dictionary.to_pylist(), np.searchsorted(term[order], np.arange(len(vocabulary) + 1)),
                    names.indices.to_numpy(zero_copy_only=False)[order])


def document_bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag``: all terms of a row with repeats, and term numbers followed by their tf (32-bit, ascending terms)."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, counts, bags = sent.value.get, [], []
        for text in batch.column("text"):
            words = terms(text.as_py())
            counts.append(len(words))
            found = [t for t in map(known, words) if t is not None]
            number, tf = np.unique(np.array(found, np.uint32), return_counts=True)
            bags.append(number.tobytes() + tf.astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(bags, pa.binary())],
                                          names=["doc_id", "n", "bag"])
    return map_batches(narrow, run, "doc_id long, n long, bag binary")


def unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(bag, np.uint32)
    return both[:len(both) // 2], both[len(both) // 2:]


def document_frequencies(bags: DataFrame, terms_in_all: int) -> np.ndarray:
    """Documents that hold each term, added up per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms_in_all, np.int64)
        for batch in batches:
            for bag in batch.column("bag"):
                total[unpack(bag.as_py())[0]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])
    found = bags.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(terms_in_all, np.int64)
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return df


class Gathered:
    """Classes by hash, verified by comparing their bags and ``m``, each with its ``k`` smallest ids."""

    def __init__(self, k: int):
        self.k = k
        self.classes: dict[bytes, list[list]] = {}     # hash -> classes that differ, each [m, bag, ids]

    def add(self, key: bytes, m: int, bag: bytes, ids: list[int]) -> None:
        for known in self.classes.setdefault(key, []):
            if known[0] == m and known[1] == bag:
                if ids[0] < known[2][-1] or len(known[2]) < self.k:
                    known[2] = sorted(known[2] + ids)[:self.k]
                return
        self.classes[key].append([m, bag, ids])

    def drain(self) -> list[tuple[bytes, int, bytes, list[int]]]:
        out = [(key, *c) for key, several in self.classes.items() for c in several]
        self.classes = {}
        return out


_CLASS_SCHEMA = "key binary, m long, bag binary, ids array<long>"


def _class_batch(rows: list[tuple[bytes, int, bytes, list[int]]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "m", "bag", "ids"])


def partial_classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``key, m, bag, ids`` of the classes that a task sees; documents without a term of the vocabulary have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(k)
        for batch in batches:
            for doc_id, n, bag in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "bag")), strict=True):
                if bag:
                    m = 100 - 90 + (90 * n * n_docs) // n_terms
                    key = hashlib.blake2b(bag, digest_size=8, salt=m.to_bytes(16, "little")).digest()
                    gathered.add(key, m, bag, [NO_ID if doc_id is None else doc_id])
            if len(gathered.classes) >= GATHERED_CLASSES:
                yield _class_batch(gathered.drain())
        if gathered.classes:
            yield _class_batch(gathered.drain())
    return bags.mapInArrow(run, _CLASS_SCHEMA)


class Best:
    """The ``k`` best documents of each item: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(items)]     # (-score, id), ascending
        self.least = np.ones(items, np.int64)                                    # a score that can still enter

    def offer(self, scores: np.ndarray, ids: list[list[int]]) -> None:
        """``scores``: class x item."""
        if len(scores) > self.k:
            # only a class among the k best of its own, or tied with the last of them, can enter
            floor = np.maximum(self.least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        else:
            floor = self.least
        for item, place in zip(*(x.tolist() for x in np.nonzero((scores >= floor).T)), strict=True):
            score = int(scores[place, item])
            rows = sorted(self.rows[item] + [(-score, i) for i in ids[place]])[:self.k]
            self.rows[item] = rows
            if len(rows) == self.k:
                self.least[item] = -rows[-1][0]


def class_scores(classes: list[tuple[int, bytes]], weights: np.ndarray, block: Block) -> np.ndarray:
    """Scores of classes (``m, bag``) for the block's items."""
    scores = np.zeros((len(classes), len(block.item_ids)), np.int64)
    parts = [unpack(bag) for _, bag in classes]
    sizes = [len(p[0]) for p in parts]
    term = np.concatenate([p[0] for p in parts]).astype(np.int64)
    tf = np.concatenate([p[1] for p in parts]).astype(np.int64)
    m = np.repeat(np.array([c[0] for c in classes], np.int64), sizes)
    gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
    held = block.starts[term + 1] - block.starts[term]
    # every occurrence of a term in a class, once for each item that holds the term
    place = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(block.starts[term], held)
    row = np.repeat(np.repeat(np.arange(len(classes)), sizes), held)
    np.add.at(scores, (row, block.items[place]), np.repeat(gain, held))
    return scores


def _score_classes(partial: DataFrame, weights: np.ndarray, block: Block, k: int) -> DataFrame:
    """``item, score, doc_id``: of each task the best rows of each item (``item`` is a number)."""
    dealt = partial.repartition("key").sortWithinPartitions("key")
    sent = partial.sparkSession.sparkContext.broadcast((weights, block))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, bytes, list[int]]]:
        """Classes, complete: rows of one key follow each other."""
        gathered, last = Gathered(k), None
        for batch in batches:
            for key, m, bag, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "m", "bag", "ids")), strict=True):
                if key != last:
                    yield from gathered.drain()
                    last = key
                gathered.add(key, m, bag, ids)
        yield from gathered.drain()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, block = sent.value
        best, at_once = Best(len(block.item_ids), k), max(1, min(512, SCORE_CELLS // len(block.item_ids)))
        held: list[tuple[bytes, int, bytes, list[int]]] = []

        def score() -> None:
            best.offer(class_scores([c[1:3] for c in held], weights, block), [c[3] for c in held])
            held.clear()
        for one in whole(batches):
            held.append(one)
            if len(held) == at_once:
                score()
        if held:
            score()
        rows = [(item, -score, i) for item, own in enumerate(best.rows) for score, i in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["item", "score", "doc_id"])
    return dealt.mapInArrow(run, "item long, score long, doc_id long")


def _answer(docs: DataFrame, block: Block, item_ids: DataFrame, k: int) -> DataFrame | None:
    bags = materialize(document_bags(docs, block.vocabulary), "bags")
    n_docs, n_terms = bags.filter(F.col("n") > 0).agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = document_frequencies(bags, len(block.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    found = _score_classes(partial_classes(bags, n_docs, n_terms, k), weights, block, k)
    first = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return materialize(ranked.join(F.broadcast(item_ids), "item").select(
        "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"), "ranked")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    answers = spark.createDataFrame([], schema)
    for block in item_blocks(items):
        # as many rows as the block has items
        ids = spark.createDataFrame(list(enumerate(block.item_ids)), f"item long, item_id {kind}")
        answer = _answer(docs, block, ids, k)
        if answer is not None:
            answers = answers.unionByName(answer)
    return answers
