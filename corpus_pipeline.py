"""Corpus pipeline: toxicity, language ID, line dedup, near-dedup, packing.

Each stage takes the documents its predecessor kept, as written and read
again, and works on all of them.

Defined results of every stage: an empty table gives an empty one; columns
beyond those of documents are ignored; a row without doc_id is a document like
any other, and so is each of several rows that repeat an id.  A null text is
scored as an empty one by the toxicity stage; it has no language, as has an
empty text or one without letters, so the language stage rejects it; line dedup
leaves it null, and a copy of an earlier document empty; texts left empty are
copies of each other; packing gives each document at least its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import fair_toxicity, order_minhash, retrieval_packing, winnow_lines, zstd_langid
from rollcall.llm.common import DOCUMENT_COLUMNS, materialize, read_table
from rollcall.llm.queries import tokenizer_file


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENT_COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = fair_toxicity.train(fair_toxicity.training_rows(docs), read_table(spark, sf_dir, "labels"))
    return _documents(fair_toxicity.score(_documents(docs), model).filter(F.col("toxicity") < 0.5))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified by a clear margin; ``lang`` stays as it came."""
    found = zstd_langid.identify(_documents(docs), zstd_langid.training_rows(docs))
    return _documents(found.filter("accepted"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later places of repeated runs of lines; ``n_chars`` follows the text."""
    out = winnow_lines.dedup_lines(_documents(docs))
    return _documents(out.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long"))
                                     .otherwise(F.col("n_chars"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return order_minhash.keep_representatives(_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of all kept documents."""
    return retrieval_packing.packing_digest(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("language_id", keep_identified), ("line_dedup", drop_repeated_lines),
          ("near_dedup", drop_near_duplicates), ("packing", pack)]

#: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
