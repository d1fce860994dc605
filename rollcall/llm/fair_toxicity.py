"""Toxicity by a counterfactual-regularised classifier.

A logistic model over word presence.  The words come from document
frequencies by label over *all* labelled training rows; the weights are fitted
on a bounded sample of them.  In every labelled sentence of the sample that
names a group, the identity term is swapped for another one (or a neutral
word) and the squared change of the score is added to the loss, so a group's
mention alone does not move a score.

Defined results: a null text is scored as an empty one; without labels, or
with one class only, every text gets the smoothed base rate; repeated labels
of a document count as toxic if any of them says so; null labels are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_checked, fold, materialize, with_fields

#: Labelled rows the weights are fitted on (document frequencies use all of them).
FIT_ROWS = 20_000
#: Words of the model, and the significance a word needs.
MAX_FEATURES = 2048
MIN_Z = 6.0
MIN_DOCUMENTS = 5
#: Weight of the squared score change under an identity swap, and of the ridge.
SWAP_PENALTY = 10.0
RIDGE = 1.0
STEPS = 400
#: Partial counts kept in a task before they are handed to the shuffle.
_FLUSH = 200_000

WORDS = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")
#: Terms that name a group, interchangeable within a row; the last of each row is neutral.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "children"),
    ("woman", "man", "girl", "boy", "person"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "religious"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "believers"),
    ("black", "white", "asian", "latino", "african", "european", "local"),
    ("gay", "lesbian", "straight", "transgender", "queer", "married"),
    ("immigrants", "refugees", "foreigners", "natives", "residents"),
    ("disabled", "blind", "deaf", "elderly", "young"),
)


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def _label_table(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return docs.join(broadcast_checked(labels), F.col("doc_id") == F.col("label_id")).select("text", "toxic")


def document_frequencies(labelled: DataFrame) -> DataFrame:
    """``word, toxic_docs, clean_docs`` over all rows of ``text, toxic``; the empty word counts the rows."""
    def run(batches):
        counts: Counter = Counter()
        def out():
            keys = list(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([counts[k] for k in keys], pa.int64())], names=["word", "toxic", "n"])
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                flag = int(toxic > 0)
                counts.update((w, flag) for w in words_of(text))
                counts[("", flag)] += 1
                if len(counts) > _FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()
    partial = labelled.mapInArrow(run, "word string, toxic int, n long")
    return partial.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic_docs"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean_docs"))


def select_features(frequencies: DataFrame, toxic: int, clean: int) -> list[str]:
    """The words whose share differs most significantly between the classes, and all identity terms."""
    terms = sorted({t for row in IDENTITY_TERMS for t in row})
    if not toxic or not clean:
        return terms
    both = F.col("toxic_docs") + F.col("clean_docs")
    share = both / F.lit(toxic + clean)
    z = (F.col("toxic_docs") / F.lit(toxic) - F.col("clean_docs") / F.lit(clean)) / F.sqrt(
        share * (1 - share) * F.lit(1 / toxic + 1 / clean) + F.lit(1e-12))
    top = frequencies.filter((F.col("word") != "") & (both >= MIN_DOCUMENTS)).select("word", F.abs(z).alias("z")) \
        .filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_FEATURES)
    found = [r["word"] for r in top.collect()]
    return found + [t for t in terms if t not in set(found)]


def swapped_mentions(text: str | None) -> list[tuple[str, str]]:
    """For each sentence that names a group: the term and what it is swapped for, every other term of its row."""
    found = []
    lowered = text.lower() if text else ""
    if not any(t in lowered for row in IDENTITY_TERMS for t in row):
        return found
    for sentence in SENTENCE_END.split(lowered):
        present = words_of(sentence)
        found += [(t, u) for row in IDENTITY_TERMS for t in row if t in present for u in row if u != t]
    return found


def fit_weights(rows: list[tuple[list[int], int]], swaps: Counter, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression with ridge and swap penalties, by full-batch Adam steps.

    A swap in a sentence changes the score by the difference of two weights,
    so the penalty is the weighted sum of squared differences over all swaps.
    """
    y = np.array([label for _, label in rows], float)
    row_of = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    columns = np.array([c for f, _ in rows for c in f], np.int64)
    pairs = np.array(list(swaps), np.int64).reshape(-1, 2)
    times = np.array([swaps[k] for k in swaps], float) / max(1, sum(swaps.values()))
    base = (y.sum() + 0.5) / (len(y) + 1.0)
    weights, bias = np.zeros(size), math.log(base / (1 - base))
    moments = [np.zeros(size + 1), np.zeros(size + 1)]
    for step in range(1, STEPS + 1):
        logits = np.bincount(row_of, weights[columns], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y
        gradient = np.append(np.bincount(columns, error[row_of], size) + RIDGE * weights, error.sum())
        if len(pairs):
            change = 2 * SWAP_PENALTY * len(rows) * times * (weights[pairs[:, 0]] - weights[pairs[:, 1]])
            gradient[:size] += np.bincount(pairs[:, 0], change, size) - np.bincount(pairs[:, 1], change, size)
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient ** 2
        move = 0.05 * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-9)
        weights, bias = weights - move[:size], bias - move[size]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """Word weights and bias learned from ``docs`` joined to ``labels`` (already without held-out rows)."""
    known = materialize(_label_table(labels), "labels")
    frequencies = materialize(document_frequencies(_labelled(docs, known)), "frequencies")
    totals = frequencies.filter(F.col("word") == "").first()
    toxic, clean = (totals["toxic_docs"], totals["clean_docs"]) if totals else (0, 0)
    features = select_features(frequencies, toxic, clean)
    if not toxic or not clean:
        base = (toxic + 0.5) / (toxic + clean + 1.0)
        return {}, math.log(base / (1 - base))
    place = {w: i for i, w in enumerate(features)}
    # of labels of these documents only; ids alone are ordered, the texts of the chosen rows stay in the executors
    here = known.join(docs.select(F.col("doc_id").alias("label_id")), "label_id", "left_semi")
    sample = materialize(here.orderBy(F.xxhash64("label_id"), "label_id").limit(FIT_ROWS), "fit-rows")

    def featurise(batches):
        for batch in batches:
            found, swaps = [], []
            for text in batch.column("text").to_pylist():
                found.append(sorted(place[w] for w in words_of(text) if w in place))
                swaps.append([x for t, u in swapped_mentions(text) for x in (place[t], place[u])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.int32()))],
                names=["toxic", "features", "swaps"])
    rows = _labelled(docs, sample).mapInArrow(featurise, "toxic int, features array<int>, swaps array<int>").collect()
    swaps: Counter = Counter()
    for r in rows:
        swaps.update(zip(r["swaps"][::2], r["swaps"][1::2], strict=True))
    fitted = sorted((list(r["features"]), int(r["toxic"] > 0)) for r in rows)
    if not fitted:
        return {}, math.log((toxic + 0.5) / (clean + 0.5))
    weights, bias = fit_weights(fitted, swaps, len(features))
    return {w: float(weights[i]) for w, i in place.items() if weights[i]}, bias


def score_text(text: str | None, weights: dict[str, float], bias: float) -> float:
    total = bias + math.fsum(weights.get(w, 0.0) for w in words_of(text))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))


def score(docs: DataFrame, model: tuple[dict[str, float], float]) -> DataFrame:
    """All columns of ``docs`` with ``toxicity``, from the whole text alone."""
    weights, bias = model
    docs = docs.select(*[c for c in docs.columns if c != "toxicity"])

    def run(batches):
        for batch in batches:
            scores = [score_text(t, weights, bias) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "toxicity"])
    return docs.mapInArrow(run, with_fields(docs, "toxicity double"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows a model may learn from: fold ``crc32(doc_id) mod 5`` is not 0."""
    return docs.filter(fold(F.col("doc_id"), 5) != 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest of the contract: ``doc_id, held_out, score, predicted`` of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(narrow, train(training_rows(docs), labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
                         F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
