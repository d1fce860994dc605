"""Lexical retrieval packing of token sequences.

Documents are indexed in shards of bounded size, each a BM25 inverted index
over token ids.  A seed document starts a window; its best-matching unused
neighbours fill the window greedily, and the neighbour that no longer fits is
cut so that nothing is padded.  Text that fills whole windows by itself needs
no neighbours.  Only the last window of a shard can be short; it is cut into
pieces whose lengths are powers of two, which are not padded.

A shard is a run of the rows of one input partition, so a lost task packs the
same rows again into the same sequences.

Defined results: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; ties go to the earlier row of the shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import text_slices
from rollcall.llm.word_ids import encoder

WINDOW = 1024
END_ID = 0
#: Ids after which a shard is closed and packed (a longer document is a shard of its own).
SHARD_IDS = 3_000_000
#: Bytes of text encoded at a time: several workers share an executor's memory.
SLICE_BYTES = 2 << 20
#: Terms of a seed that are looked up, by their weight in the seed.
QUERY_TERMS = 24
K1, B = 1.2, 0.75

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


class Bm25Index:
    """Inverted index of one shard: for every term the documents that hold it and their BM25 weights."""

    def __init__(self, documents: list[np.ndarray]):
        # arrays as long as the postings are few and narrow: several workers share an executor's memory
        lengths = np.array([len(d) for d in documents], float)
        found = [np.unique(d, return_counts=True) for d in documents]
        sizes = np.array([len(t) for t, _ in found])
        ends = np.cumsum(sizes)
        terms = np.concatenate([t for t, _ in found])
        counts = np.concatenate([c.astype(np.int32) for _, c in found])
        del found
        self.size = len(documents)
        self.vocabulary, frequency = np.unique(terms, return_counts=True)
        column = np.searchsorted(self.vocabulary, terms).astype(np.int32)
        del terms
        idf = np.log1p((self.size - frequency + 0.5) / (frequency + 0.5))
        norms = K1 * (1 - B + B * lengths / lengths.mean())
        # queries: the heaviest terms of each document, ties in term order
        weight, queries = np.empty(len(column), np.float32), []
        for start, end, norm in zip(ends - sizes, ends, norms, strict=True):
            own, n = column[start:end], counts[start:end]
            weight[start:end] = idf[own] * n * (K1 + 1) / (n + norm)
            queries.append(own[np.argsort(-weight[start:end], kind="stable")[:QUERY_TERMS]])
        del counts
        self.query_terms = np.concatenate(queries)
        self.query_bounds = np.concatenate([[0], np.cumsum(np.minimum(sizes, QUERY_TERMS))])
        # the postings in term order
        order = np.argsort(column, kind="stable")
        del column
        self.weight = weight[order]
        self.owner = np.repeat(np.arange(self.size, dtype=np.int32), sizes)[order]
        self.bounds = np.concatenate([[0], np.cumsum(frequency)])

    def neighbours(self, seed: int) -> np.ndarray:
        """BM25 scores of all documents of the shard for the seed's heaviest terms."""
        terms = self.query_terms[self.query_bounds[seed]:self.query_bounds[seed + 1]]
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in terms]
        return np.bincount(np.concatenate([self.owner[s] for s in spans]),
                           np.concatenate([self.weight[s] for s in spans]), self.size)


def pack(documents: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)``; every id of every document lies in exactly one piece."""
    sequences = [[(i, s, window)] for i, d in enumerate(documents) for s in range(0, len(d) - window + 1, window)]
    start = np.array([len(d) // window * window for d in documents])
    left = np.array([len(d) for d in documents]) - start      # ids of the tail that are not placed
    if not left.any():
        return sequences
    index = Bm25Index(documents)
    for seed in np.argsort(-left, kind="stable"):
        if not left[seed]:
            continue
        current, room = [(int(seed), int(start[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        if room and left.any():
            scores = index.neighbours(seed)
            unused = np.flatnonzero(left)
            for i in unused[np.argsort(-scores[unused], kind="stable")]:
                take = min(room, int(left[i]))
                current.append((int(i), int(start[i]), take))
                start[i] += take
                left[i] -= take
                room -= take
                if not room:
                    break
        if room:      # the shard has run out: pieces of a power of two each
            sequences += _powers_of_two(current, window - room)
        else:
            sequences.append(current)
    return sequences


def _powers_of_two(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    out, pending = [], list(reversed(pieces))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        current = []
        while room:
            i, s, n = pending.pop()
            take = min(n, room)
            current.append((i, s, take))
            room -= take
            if take < n:
                pending.append((i, s + take, n - take))
        out.append(current)
    return out


def _pack_shard(ids: list, texts: list[bytes], shard_start: int) -> pa.RecordBatch:
    documents = [np.frombuffer(t, "<u4") for t in texts]
    rows = []
    for n, sequence in enumerate(pack(documents)):
        offset = 0
        for i, start, length in sequence:
            piece = texts[i][4 * start:4 * (start + length)]
            rows.append((ids[i], start, length, zlib.crc32(piece), len(documents[i]), shard_start + n, offset, piece))
            offset += length
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of all documents with their ids and places: the columns of ``PIECES``.

    ``sequence_id`` is the input partition in the high bits and a running number in the low 40.
    """
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        words = encoder(tokenizer_path, lower=False)
        base = TaskContext.get().partitionId() << 40
        ids, texts, held = [], [], 0
        for part in (part for batch in batches for part in text_slices(batch, SLICE_BYTES)):
            for doc_id, encoded in zip(part.column("doc_id").to_pylist(), words.encode_each(part.column("text")), strict=True):
                ids.append(doc_id)
                texts.append(encoded + end)
                held += len(encoded) // 4 + 1
                if held >= SHARD_IDS:
                    out = _pack_shard(ids, texts, base)
                    base += len(out)      # at least as many as sequences
                    ids, texts, held = [], [], 0
                    yield out
                    del out
            del part      # before the next batch is read
        if ids:
            yield _pack_shard(ids, texts, base)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECES)


def packing_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digest of the contract: the pieces without their ids."""
    return pack_documents(docs, tokenizer_path).drop("ids")
