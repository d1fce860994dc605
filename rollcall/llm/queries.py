"""The operators of this package over the driver's tables, one query each.

Every query reads its whole table; the digest columns are derived from what
the operator returns.  ``ORACLES`` has the SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (bag_search, chunked_bpe, context_mixing, direct_codes, fair_toxicity, gnat_codes, gray_index,
                          host_rules, order_minhash, prefix_forest, retrieval_packing, winnow_lines, zstd_langid)
from rollcall.llm.common import read_table


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.duplicate_digest(read_table(spark, sf_dir, "documents"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(read_table(spark, sf_dir, "documents"))


def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_documents(read_table(spark, sf_dir, "documents"))


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.packing_digest(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op5_zstd_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_langid.predict_languages(read_table(spark, sf_dir, "documents"))


def op6_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.search_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_winnow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow_lines.dedup_digest(read_table(spark, sf_dir, "documents"))


def op8_fair_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct_codes.code_digest(spark, read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return chunked_bpe.encode_documents(read_table(spark, sf_dir, "documents"),
                                        tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gray_index.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat_codes.compress(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_host_rules": op2_host_rules,
    "op3_context_mixing": op3_context_mixing,
    "op4_retrieval_packing": op4_retrieval_packing,
    "op5_zstd_langid": op5_zstd_langid,
    "op6_prefix_forest": op6_prefix_forest,
    "op7_winnow_lines": op7_winnow_lines,
    "op8_fair_toxicity": op8_fair_toxicity,
    "op9_direct_codes": op9_direct_codes,
    "op10_chunked_bpe": op10_chunked_bpe,
    "op11_gray_index": op11_gray_index,
    "op12_bag_search": op12_bag_search,
    "op13_gnat_codes": op13_gnat_codes,
}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    """Terms of a text column, in DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"unnest(regexp_extract_all(translate({column}, '{upper}', '{upper.lower()}'), '{_TERM}'))"


def search_sql(k: int = 10) -> str:
    """The ranking of every document for every item, the plain way."""
    return f"""
WITH words AS (SELECT d.doc_id, t.term FROM documents d, LATERAL (SELECT {_terms('d.text')} AS term) t),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS l FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tfs, totals GROUP BY term, docs),
asked AS (SELECT DISTINCT b.item_id, t.term FROM benchmark b, LATERAL (SELECT {_terms('b.text')} AS term) t),
scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l))))::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), totals
           GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= {k}"""


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Product codes with whole-number codebooks, by comparing every part with every entry."""
    def assigned(name: str, books: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT vec_id, label, part, min_by(entry, d * {entries} + entry) AS entry, min(d) AS d FROM (
    SELECT v.vec_id, v.label, v.part, b.entry,
           list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) * (v.x[i] - b.x[i])))::BIGINT AS d
    FROM cut v JOIN {books} b USING (part)) GROUP BY vec_id, label, part)"""

    def moved(name: str, assignment: str, books: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS x FROM (
      SELECT v.part, a.entry, i, floor(sum(v.x[i])::DOUBLE / count(*))::BIGINT AS mean
      FROM cut v JOIN {assignment} a USING (vec_id, part), range(1, (SELECT max(len(x)) FROM cut) + 1) AS r(i)
      GROUP BY v.part, a.entry, i) GROUP BY part, entry) m USING (part, entry))"""
    steps = []
    for i in range(rounds):
        steps += [assigned(f"a{i}", f"b{i}"), moved(f"b{i + 1}", f"a{i}", f"b{i}")]
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (SELECT vec_id, label, p.part, x[p.part * len(x) // {parts} + 1:(p.part + 1) * len(x) // {parts}] AS x
                     FROM kept, range(0, {parts}) AS p(part)),
b0 AS MATERIALIZED (SELECT c.part, s.entry, c.x FROM cut c JOIN (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}) s USING (vec_id)),
{", ".join(steps)},
{assigned("final", f"b{rounds}")},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
          FROM final GROUP BY vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"""


ORACLES: dict[str, str] = {
    "op12_bag_search": search_sql(),
    "op13_gnat_codes": codes_sql(),
}
