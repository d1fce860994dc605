"""Language identification by compression.

Each language gets a raw-content zstandard dictionary of training text.  A
text is encoded with every dictionary, in blocks so that the dictionary stays
in reach over the whole of a long text, and the language with the smallest
total wins.  A narrow margin between the two best is a rejection.

Defined results: a text that is null or has no letter is ``und`` with score 0
and not accepted; without any training language every text is ``und``; equal
sizes go to the language with more training rows and are never accepted.
"""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import fold, with_fields

UNDETERMINED = "und"
#: Bytes of training text in one language's dictionary, and of one row's share of it.
DICTIONARY_BYTES = 64 * 1024
SNIPPET_CHARS = 1200
#: Bytes of text encoded at a time; the dictionary precedes each block.
BLOCK_BYTES = 8 * 1024
LEVEL = 6
#: Margin of the best over the second best, as a share of the best, below which a prediction is rejected.
MIN_MARGIN = 0.002


def learn_dictionaries(training: DataFrame, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw dictionary per ``lang`` from ``text``, the rows picked by hash order; the commonest language first.

    The fit reads a bounded sample: of the distinct texts of a language, by
    hash, those whose snippets from the middle make about four times ``size``.
    """
    rows = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("t"))
    middle = F.greatest(F.lit(1), ((F.length("text") - SNIPPET_CHARS) / 2).cast("int") + 1)
    snippet = F.col("text").substr(middle, F.lit(SNIPPET_CHARS))
    # copies of a text are one
    distinct = rows.groupBy("lang", "t").agg(F.count("*").alias("n"), F.max(F.octet_length(snippet)).alias("size"))
    counts, sizes = {}, {}
    for r in distinct.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect():
        counts[r["lang"]], sizes[r["lang"]] = r["n"], r["size"]
    if not counts:
        return {}
    limit = F.create_map(*[x for k, n in sizes.items()
                           for x in (F.lit(k), F.lit(int(1_000_000_007 * min(1.0, 4 * size / n)) + 1))])[F.col("lang")]
    place = F.abs(F.col("t") % 1_000_000_007)
    picked = rows.filter(place < limit).select("lang", place.alias("h"), snippet.alias("snippet"))
    snippets: dict[str, set] = {}
    for r in picked.dropDuplicates(["lang", "snippet"]).collect():
        snippets.setdefault(r["lang"], set()).add((r["h"], r["snippet"]))
    ordered = sorted(snippets, key=lambda lang: (-counts[lang], lang))
    return {lang: "\n".join(s for _, s in sorted(snippets[lang])).lower().encode()[:size] for lang in ordered}


def _compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang in dictionaries:
        data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False)))
    return out


def classify(text: str | None, compressors: list) -> tuple[str, float, float]:
    """Language, score (0 to 1) and margin of one text."""
    if not compressors or not text or not any(c.isalpha() for c in text):
        return UNDETERMINED, 0.0, 0.0
    raw = text.lower().encode()
    blocks = [raw[i:i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in compressors]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1:]
    margin = (min(others) - sizes[best]) / sizes[best] if others else 1.0
    # posterior when a language's code length is the text's bits, tempered because blocks repeat content
    weight = sum(math.exp(-min(50.0, (s - sizes[best]) * math.log(2))) for s in sizes)
    return compressors[best][0], 1.0 / weight, margin


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Prediction of every row of ``docs`` from its text alone: ``lang_pred``, ``score``, ``margin``, ``accepted``.

    All columns of ``docs`` but those four are returned as they came.
    """
    dictionaries = learn_dictionaries(training)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "margin", "accepted")]
    docs = docs.select(*keep)

    def run(batches):
        compressors = _compressors(dictionaries)
        for batch in batches:
            rows = [classify(t, compressors) for t in batch.column("text").to_pylist()]
            accepted = [r[0] != UNDETERMINED and r[2] >= MIN_MARGIN for r in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.float64()),
                 pa.array(accepted, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "margin", "accepted"])
    return docs.mapInArrow(run, with_fields(docs, "lang_pred string, score double, margin double, accepted boolean"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows a model may learn from: fold ``crc32(doc_id) mod 4`` is not 2."""
    return docs.filter(fold(F.col("doc_id"), 4) != 2).select("lang", "text")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Digest of the contract: one row per document with ``held_out``, ``lang_pred`` and ``score``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = identify(narrow, training_rows(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
                        "margin", "accepted")
