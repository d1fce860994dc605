"""Token ids in directly addressable codes.

Ids are split into 8-bit chunks by level: level 0 has the low byte of every
id, level k+1 the next byte of those ids of level k that are not finished.  A
level's continuation bitmap says which go on, and a rank directory (ones before
every 512th bit) finds an id's place in the next level, so any single id is
read without decoding its block.

The file is Parquet, one row a block of whole documents: ``part`` (input range
in ascending doc_id order), ``block``, ``first`` (ids before the block within
the part), ``n_tokens``, ``doc_ids``, ``lengths`` and per level ``chunks``,
``bitmaps`` and ``ranks``.

Defined results: a null or empty text is its end id alone; null ids come
first; rows of one doc_id are ordered by their text; an empty table gives an
empty file.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.common import materialize
from rollcall.llm.word_ids import encoder

END_ID = 2
RANK_BITS = 512
#: Ids after which a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 19

BLOCKS = ("part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<long>, "
          "chunks array<binary>, bitmaps array<binary>, ranks array<binary>")


def encode_ids(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of the levels of ``ids`` (unsigned 32-bit)."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while len(rest):
        goes_on = rest >= 256
        chunks.append((rest & 255).astype(np.uint8).tobytes())
        bitmaps.append(np.packbits(goes_on, bitorder="little").tobytes())
        before = np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BITS), dtype=np.int64))
        ranks.append(np.concatenate([[0], before[:-1]]).astype("<u4").tobytes())
        rest = rest[goes_on] >> 8
    return chunks, bitmaps, ranks


def decode_ids(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a block, from the last level up."""
    higher = np.zeros(0, np.uint32)
    for chunk, bitmap in zip(reversed(chunks), reversed(bitmaps), strict=True):
        ids = np.frombuffer(chunk, np.uint8).astype(np.uint32)
        if len(higher):
            goes_on = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(ids), bitorder="little").view(bool)
            ids[goes_on] |= higher << 8
        higher = ids
    return higher


def token_at(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """The ``i``-th id of a block: a byte, a bit and one rank per level, nothing else is decoded."""
    value, shift = 0, 0
    for chunk, bitmap, rank in zip(chunks, bitmaps, ranks, strict=True):
        value |= chunk[i] << shift
        if not bitmap[i >> 3] >> (i & 7) & 1:
            break
        start = i // RANK_BITS
        ones = int.from_bytes(rank[4 * start:4 * start + 4], "little")
        bits = int.from_bytes(bitmap[start * RANK_BITS // 8:(i >> 3) + 1], "little")
        i = ones + (bits & ((1 << (i - start * RANK_BITS)) - 1)).bit_count()
        shift += 8
    return value


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Blocks of all documents in ascending ``doc_id`` order; ranges of it are encoded in parallel."""
    end = end_id.to_bytes(4, "little")
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches):
        words = encoder(tokenizer_path, lower=True)
        part = TaskContext.get().partitionId()
        block, first, doc_ids, texts, held = 0, 0, [], [], 0

        def out():
            ids = np.frombuffer(b"".join(texts), "<u4")
            levels = [pa.array([x], pa.list_(pa.binary())) for x in encode_ids(ids)]
            numbers = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                       pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                       pa.array([[len(t) // 4 for t in texts]], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(numbers + levels, names=[f.split()[0] for f in BLOCKS.split(", ")])
        for batch in batches:
            for doc_id, encoded in zip(batch.column("doc_id").to_pylist(), words.encode_all(batch.column("text")), strict=True):
                doc_ids.append(doc_id)
                texts.append(encoded + end)
                held += len(encoded) // 4 + 1
                if held >= BLOCK_IDS:
                    yield out()
                    block, first, doc_ids, texts, held = block + 1, first + held, [], [], 0
        if doc_ids:
            yield out()
    return ordered.mapInArrow(run, BLOCKS)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    encode_documents(docs, tokenizer_path).write.parquet(path)


def read_documents(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every document in a file; ``start`` counts the ids of all documents before it.

    The offset of a part is a running sum over one number a part.
    """
    totals = materialize(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("offset_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = blocks.join(F.broadcast(offsets), F.col("part") == F.col("offset_part")) \
        .select("doc_ids", "lengths", (F.col("first") + F.col("before")).alias("start"), "chunks", "bitmaps")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_ids(row["chunks"], row["bitmaps"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                pieces = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"], pa.int64()),
                     pa.array([zlib.crc32(p) for p in pieces], pa.int64()), pa.array(pieces, pa.binary())],
                    names=["doc_id", "start", "ids_crc32", "ids"])
    return placed.mapInArrow(run, "doc_id long, start long, ids_crc32 long, ids binary")


def read_tokens(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, position, token`` for the rows of ``wanted`` (``doc_id, position`` from 0), read through the ranks.

    Only a byte, a bit and a rank of each level are read per token.  Positions
    that a document does not have, and ids that are not in the file, give no
    row; a doc_id that the file has several times gives a row for each.  A
    block meets its questions in one task, before them, so a task holds one
    block at a time however many tokens of it are asked for.
    """
    place = F.posexplode("lengths").alias("i", "n")
    listed = blocks.select("part", "block", "doc_ids", "lengths", place).select(
        "part", "block", F.get("doc_ids", F.col("i")).alias("doc_id"), F.col("n").alias("length"), "i", "lengths")
    before = Window.partitionBy("part", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    listed = listed.drop("lengths").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("i")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("position").cast("long").alias("position")) \
        .join(materialize(listed, "code-places"), "doc_id").filter((F.col("position") >= 0) & (F.col("position") < F.col("length")))
    levels = ("chunks", "bitmaps", "ranks")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("doc_id", "position", "at")]
    empty = [F.lit(None).cast("array<binary>").alias(c) for c in levels]
    rows = blocks.select("part", "block", F.lit(0).alias("kind"), *nothing, *levels).unionByName(
        asked.select("part", "block", F.lit(1).alias("kind"), "doc_id", "position", (F.col("offset") + F.col("position")).alias("at"), *empty))
    dealt = rows.repartition("part", "block").sortWithinPartitions("part", "block", "kind")

    def run(batches):
        held = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    held = [row[c] for c in levels]
                else:
                    found.append((row["doc_id"], row["position"], token_at(*held, row["at"])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)],
                                                 names=["doc_id", "position", "token"])
    return dealt.mapInArrow(run, "doc_id long, position long, token long")


def code_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digest of the contract, from the file read back."""
    blocks = materialize(encode_documents(docs, tokenizer_path), "direct-codes")
    return read_documents(blocks).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids_crc32")
