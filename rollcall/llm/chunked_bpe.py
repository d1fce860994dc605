"""Byte-level BPE by overlapping chunks.

A long text is cut into overlapping chunks that are pre-tokenised and encoded
in parallel, each from its own start.  Neighbours are stitched at the first
position that is a pre-token boundary in both: the pattern looks only ahead, so
from a common boundary on both agree.  Where an overlap has no common boundary
the text is pre-tokenised on from the last sure one.  Decoding concatenates
the tokens' raw bytes.

Defined results: a null text is an empty one (no ids); repeated rows are
encoded as often as they occur.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk, and of its overlap with the next one.
CHUNK_CHARS = 32 * 1024
OVERLAP_CHARS = 1024
#: Characters after a position that can decide whether a boundary is there (the longest contraction).
LOOKAHEAD_CHARS = 4
CACHE_ENTRIES = 500_000

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceEncoder(dict):
    """Maps a pre-token to its ids; the merges are tiktoken's."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        raw = [b""] * size
        for token, rank in ranks.items():
            raw[rank] = token
        self.raw = pa.array(raw, pa.binary())

    def __missing__(self, piece: str) -> tuple[bytes, bytes]:
        ids = self.encoding.encode_ordinary(piece)
        found = np.array(ids, "<u4").tobytes(), ",".join(map(str, ids)).encode()
        if len(self) < CACHE_ENTRIES:
            self[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def decode(self, ids: bytes) -> bytes:
        """Raw bytes of little-endian unsigned 32-bit ids."""
        if not ids:
            return b""
        tokens = self.raw.take(pa.array(np.frombuffer(ids, "<u4").astype(np.int64)))
        return tokens.buffers()[2].to_pybytes()[:np.frombuffer(tokens.buffers()[1], np.int32)[len(tokens)]]


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def piece_encoder(path: str, pattern: str) -> PieceEncoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = PieceEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def _digest(encoder: PieceEncoder, found: list[tuple[bytes, bytes]]) -> tuple[int, str, str]:
    ids = b"".join([f[0] for f in found])
    return (len(ids) // 4, hashlib.sha256(b",".join([f[1] for f in found])).hexdigest(),
            hashlib.sha256(encoder.decode(ids)).hexdigest())


def stitch(chunks: list[tuple[int, list[str], bool]], text_from, pieces_of) -> list[str]:
    """Pre-tokens of a text from those of its chunks ``(start, pre-tokens, is last)``, in order.

    ``text_from(position)`` gives the text from a position on, ``pieces_of`` pre-tokenises it; they
    are only used where no common boundary is found.
    """
    kept: list[str] = []
    # of the accepted pre-tokens so far: those of the current chunk from `begin` (index) on
    start, pieces, last = chunks[0]
    begin = 0
    bounds = np.cumsum([start] + [len(p) for p in pieces])
    for following, next_pieces, next_last in chunks[1:]:
        next_bounds = np.cumsum([following] + [len(p) for p in next_pieces])
        # near its end a chunk has not seen what a pre-token goes on with: boundaries before that are sure
        sure = bounds[begin:-1]
        sure = sure[(sure <= bounds[-1] - LOOKAHEAD_CHARS) | (sure == bounds[begin])]
        common = np.intersect1d(sure[sure >= following], next_bounds[:-1], assume_unique=False)
        if not len(common):
            return kept + pieces[begin:begin + len(sure) - 1] + pieces_of(text_from(int(sure[-1])))
        here = int(np.searchsorted(bounds, common[0]))
        kept += pieces[begin:here]
        begin = int(np.searchsorted(next_bounds, common[0]))
        pieces, bounds, last = next_pieces, next_bounds, next_last
    assert last
    return kept + pieces[begin:]


def encode_documents(docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS,
                     overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Digest of the contract: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = [f.split()[0] for f in RESULT.split(", ")]

    def whole(batches):
        encoder = piece_encoder(path, pattern)
        for batch in batches:
            rows = [_digest(encoder, [encoder[p] for p in encoder.pieces(t)]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], names=names)

    def lengths(batches):
        """Pre-tokenises and encodes each chunk: lengths and ids of all its pre-tokens."""
        encoder = piece_encoder(path, pattern)
        for batch in batches:
            texts = [encoder.pieces(t) for t in batch.column("chunk").to_pylist()]
            found = [[encoder[p][0] for p in t] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([np.array([len(p) for p in t], "<i4").tobytes() for t in texts], pa.binary()),
                 pa.array([np.array([len(f) for f in x], "<i4").tobytes() for x in found], pa.binary()),
                 pa.array([b"".join(x) for x in found], pa.binary())],
                names=[*batch.schema.names, "lengths", "id_bytes", "ids"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        """The chunks of one document: its pre-tokens stitched, each with the ids its chunk found."""
        encoder = piece_encoder(path, pattern)
        group = group.sort_values("part")
        known: dict[str, bytes] = {}
        chunks = []
        for row in group.itertuples():
            ends = np.cumsum(np.frombuffer(row.lengths, "<i4"))
            pieces = [row.chunk[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            id_ends = np.cumsum(np.frombuffer(row.id_bytes, "<i4"))
            known.update((p, row.ids[a:b]) for p, a, b in zip(pieces, [0, *id_ends[:-1]], id_ends, strict=True))
            chunks.append((row.part * chunk_chars, pieces, row.part == len(group) - 1))

        def text_from(position: int) -> str:
            part = min(position // chunk_chars, len(group) - 1)
            texts = group["chunk"].tolist()
            return texts[part][position - part * chunk_chars:][:max(0, (part + 1) * chunk_chars - position)] + "".join(
                t[:chunk_chars] for t in texts[part + 1:])
        found = []
        for p in stitch(chunks, text_from, encoder.pieces):
            ids = known.get(p)
            ids = encoder[p][0] if ids is None else ids
            found.append((ids, ",".join(map(str, np.frombuffer(ids, "<u4").tolist())).encode()))
        return pd.DataFrame([(group["doc_id"].iloc[0], *_digest(encoder, found))], columns=names)

    long_text = F.length("text") > chunk_chars
    parts = F.floor((F.length("text") - 1) / F.lit(chunk_chars)).cast("int")
    cut = narrow.filter(long_text).withColumn("row", F.monotonically_increasing_id()) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts))) \
        .select("row", "doc_id", "part",
                F.col("text").substr(F.col("part") * chunk_chars + 1, F.lit(chunk_chars + overlap_chars)).alias("chunk"))
    encoded = cut.repartition("row", "part").mapInArrow(
        lengths, "row long, doc_id long, part int, chunk string, lengths binary, id_bytes binary, ids binary")
    stitched = encoded.groupBy("row").applyInPandas(join, RESULT)
    return narrow.filter(~long_text).mapInArrow(whole, RESULT).unionByName(stitched)
