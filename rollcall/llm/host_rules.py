"""Quality rules judged per host.

Each document is measured once; rule failures are aggregated by host
(``source``), every host's failure rates are shrunk towards an empirical beta
prior, and the host verdicts are joined back to the documents.

Defined results: a null text has no words and fails the base rules; a null
host is a host of its own; repeated rows are measured and counted as often as
they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_checked, map_batches, materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: A host whose shrunk base-failure or soft-failure rate exceeds this loses all its documents.
HOST_REJECT_RATE = 0.6
#: Prior strength used when the hosts do not differ by more than chance.
MAX_PRIOR_STRENGTH = 1000.0

_MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # a window is (pair number, word): exact, and within 64 bits whatever the vocabulary
    _, pair = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)
    _, window, count = np.unique(pair[:n] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + n] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()          # bytes.split() separates at exactly \x20 and \x09-\x0D
    blanks = sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), len(lines),
            len(lines) - len(set(lines)), repeated_words(words))


def measure_documents(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``source`` and the base measures of its whole text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        names = [f.split()[0] for f in _MEASURES.split(", ")]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), *columns],
                                          names=["doc_id", "source", *names])
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         F.col("text").cast("string").alias("text"))
    return map_batches(narrow, run, f"doc_id long, source string, {_MEASURES}")


def rules() -> dict[str, Column]:
    """Document-level rules; a true value is a failure.  Integer arithmetic only, so that ties are exact."""
    n = F.col("n_words")
    return {
        "base": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
    }


def beta_prior(hosts: DataFrame, failures: str) -> tuple[float, float]:
    """Empirical beta prior of a failure rate over hosts, by the method of moments.

    The mean is pooled over all documents; the spread between hosts is the
    observed variance of host rates less their binomial noise.  One row of
    sums reaches the driver.
    """
    rate = F.col(failures) / F.col("n")
    row = hosts.agg(F.sum(failures).alias("f"), F.sum("n").alias("n"), F.count("*").alias("hosts"),
                    F.sum(F.col("n") * rate * rate).alias("second"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not row["n"]:
        return 1.0, 1.0
    mean = (row["f"] + 0.5) / (row["n"] + 1.0)
    observed = max(0.0, row["second"] / row["n"] - (row["f"] / row["n"]) ** 2)
    noise = mean * (1 - mean) * row["hosts"] / row["n"]
    between = max(0.0, observed - noise)
    strength = MAX_PRIOR_STRENGTH if between <= 0 else mean * (1 - mean) / between - 1
    strength = min(max(strength, 2.0), MAX_PRIOR_STRENGTH)
    return mean * strength, (1 - mean) * strength


def host_verdicts(measured: DataFrame) -> DataFrame:
    """One row per host: document count, failures, shrunk rates and the verdicts."""
    failed = rules()
    soft = failed["symbols"] | failed["dup_lines"] | failed["word_length"]
    hosts = materialize(measured.groupBy(F.col("source").alias("host")).agg(
        F.count("*").alias("n"), F.sum(failed["base"].cast("long")).alias("base_failures"),
        F.sum(soft.cast("long")).alias("soft_failures")), "hosts")
    out = hosts
    for kind in ("base", "soft"):
        a, b = beta_prior(hosts, f"{kind}_failures")
        out = out.withColumn(f"host_{kind}_rate",
                             (F.col(f"{kind}_failures") + F.lit(a)) / (F.col("n") + F.lit(a + b)))
        out = out.withColumn(f"prior_{kind}_rate", F.lit(a / (a + b)))
    reject = (F.col("host_base_rate") > HOST_REJECT_RATE) | (F.col("host_soft_rate") > HOST_REJECT_RATE)
    # soft failures a document may have: one on hosts at or below the prior's rate, none elsewhere
    return out.select("host", "n", "base_failures", "soft_failures", "host_base_rate", "host_soft_rate",
                      reject.alias("host_rejected"),
                      (F.col("host_soft_rate") <= F.col("prior_soft_rate")).cast("int").alias("host_allowance"))


def judge(docs: DataFrame) -> DataFrame:
    """Measures, base verdict, host rates and the final ``kept`` of every document."""
    measured = materialize(measure_documents(docs), "measures")
    hosts = broadcast_checked(materialize(host_verdicts(measured), "host-verdicts"))
    failed = rules()
    n_soft = sum((failed[k].cast("int") for k in ("symbols", "dup_lines", "word_length")), F.lit(0))
    joined = measured.join(hosts.drop("n"), F.col("source").eqNullSafe(F.col("host")))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed["base"].alias("base_failed"), "host_base_rate", "host_soft_rate", "host_rejected",
        (~failed["base"] & ~F.col("host_rejected") & (n_soft <= F.col("host_allowance"))).alias("kept"))
