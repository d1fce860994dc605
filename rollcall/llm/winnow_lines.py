"""Line dedup by winnowing over line hashes; DataFrame functions only.

A document is a sequence of line hashes.  Its fingerprints are

* pairs of consecutive lines: of every window of two neighbouring pairs the
  smaller hash is selected, so any run of three or more lines that two places
  share has a selected pair in common, and selected pairs leave no gap;
* every line of at least ``MIN_WORDS`` words.

Each fingerprint is also emitted with the line before it and with the line
after it.  All of them are joined with the first position that has the same
one (positions are ordered by doc_id, then line); a later position marks the
lines it covers.  The extended ones carry a match over both ends of a run.
Marked lines that follow each other form a run, and a run of at least
``MIN_WORDS`` words is deleted.  So every repeated passage of two or more times
``MIN_WORDS`` words, and every repeated run of three or more lines from
``MIN_WORDS`` words on, keeps its first place only.

A hot fingerprint is reduced to its first position before the join (partial
minima, no list), and the written minima are joined by key, where skewed keys
can be split.  There are no pairs of positions.

Defined results: a null text stays null and an empty one empty; rows with the
same doc_id and text are one document and are treated alike; rows that share
only the doc_id are ordered by the hash of their text; null ids come first.
Blank lines belong to the line before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize

#: Words of a run that is deleted, and of a line that is a fingerprint by itself.
MIN_WORDS = 25
_WORD = r"[^\x20\x09-\x0D]+"
_LINES = r"(?<=\n)(?=[^\n])"
_NO_ID = -(1 << 63)


def _lines(text: Column) -> Column:
    """Lines with the line ends that follow them."""
    return F.split(text, _LINES)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"),
                       F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``key`` at ``(did, th, line)`` and the word counts ``words`` of the lines it covers from ``line`` on."""
    hashed = _identified(docs).filter(F.length("text") > 0).select("did", "th", F.transform(
        _lines(F.col("text")), lambda x: F.struct(F.xxhash64(F.rtrim(F.regexp_replace(x, r"\n+$", ""))).alias("h"),
                                                  F.regexp_count(x, F.lit(_WORD)).alias("n"))).alias("ls"))
    pairs = F.when(F.size("ls") > 1, F.transform(F.sequence(F.lit(1), F.size("ls") - 1), lambda i: F.xxhash64(
        F.element_at("ls", i)["h"], F.element_at("ls", i + 1)["h"]))).otherwise(F.array().cast("array<long>"))
    paired = hashed.withColumn("ps", pairs).withColumn("last", F.size("ls") - 1)

    def row(kind: str, first: Column, size: int) -> Column:
        """Fingerprint of ``size`` lines from index ``first`` (0-based), null where it leaves the document."""
        covered = [F.get("ls", first + k) for k in range(size)]
        return F.when((first >= 0) & (first + (size - 1) <= F.col("last")), F.struct(
            F.xxhash64(F.lit(kind), *[c["h"] for c in covered]).alias("key"), first.alias("line"),
            F.array(*[c["n"] for c in covered]).alias("words")))

    def of_line(i: Column) -> Column:
        pair = F.get("ps", i)
        selected = pair.isNotNull() & ((pair < F.get("ps", i + 1)) | (pair <= F.get("ps", i - 1)) | (F.size("ps") == 1))
        long_line = F.get("ls", i)["n"] >= MIN_WORDS
        empty = F.array().cast("array<struct<key:bigint,line:int,words:array<int>>>")
        return F.concat(
            F.when(selected, F.array(row("pair", i, 2), row("before", i - 1, 3), row("after", i, 3))).otherwise(empty),
            F.when(long_line, F.array(row("line", i, 1), row("line before", i - 1, 2), row("line after", i, 2)))
            .otherwise(empty))
    every = F.flatten(F.transform(F.sequence(F.lit(0), F.col("last")), of_line))
    return paired.select("did", "th", F.explode(F.filter(every, lambda x: x.isNotNull())).alias("f")).select(
        F.col("f.key").alias("key"), "did", "th", F.col("f.line").alias("line"), F.col("f.words").alias("words"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``did, th, out, n_out``: per document with a repeated run whether each line goes (up to the last that does), and how many do.

    Every step is linear in the document's lines.
    """
    places = materialize(fingerprints(docs), "fingerprints")
    position = F.struct("did", "th", "line")
    first = materialize(places.groupBy("key").agg(F.min(position).alias("first"), F.max(position).alias("latest"))
                        .filter(F.col("first") < F.col("latest")).select(F.col("key").alias("first_key"), "first"),
                        "first-places")
    # both joins are planned alike at every size: sorted by key, so a skewed key can be split
    later = places.join(first.hint("merge"), F.col("key") == F.col("first_key")).filter(position > F.col("first"))
    marked = later.select("did", "th", "line", F.posexplode("words").alias("step", "n")) \
        .select("did", "th", (F.col("line") + F.col("step")).alias("line"), "n")
    # a document's marked lines meet in one row: at most its own lines
    per_doc = marked.groupBy("did", "th").agg(F.array_sort(F.collect_set(F.struct("line", "n"))).alias("ms"))
    sized = per_doc.withColumn("size", F.size("ms"))
    # places (from 1) at which a run of marked lines starts
    begins = F.filter(F.sequence(F.lit(1), F.col("size")), lambda i: (i == 1) | (
        F.get("ms", i - 1)["line"] != F.get("ms", i - 2)["line"] + 1))
    started = materialize(sized.withColumn("begins", begins), "marked-lines")

    def run_of(begin: Column, k: Column) -> Column:
        end = F.coalesce(F.get("begins", k + 1), F.col("size") + 1)
        own = F.slice("ms", begin, end - begin)
        return F.struct(F.get(own, F.lit(0))["line"].alias("first"), (F.get(own, F.lit(0))["line"] + end - begin).alias("after"),
                        F.aggregate(own, F.lit(0), lambda n, m: n + m["n"]).alias("words"))
    runs = F.filter(F.transform("begins", run_of), lambda r: r["words"] >= MIN_WORDS)
    closed = materialize(started.select("did", "th", runs.alias("runs")).filter(F.size("runs") > 0), "line-runs")

    def flags(r: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("runs", k - 1)["after"]).otherwise(0)
        return F.concat(F.array_repeat(F.lit(False), r["first"] - before), F.array_repeat(F.lit(True), r["after"] - r["first"]))
    n_out = F.aggregate("runs", F.lit(0), lambda n, r: n + r["after"] - r["first"])
    return closed.select("did", "th", F.flatten(F.transform("runs", flags)).alias("out"), n_out.alias("n_out"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, ``text`` without repeated runs, and ``n_lines``, ``n_removed_lines``, ``n_removed_words``."""
    added = ("n_lines", "n_removed_lines", "n_removed_words")
    kept = [c for c in docs.columns if c not in added]
    removed = materialize(repeated_lines(docs), "repeated-lines")
    text = F.col("d.text").cast("string")
    joined = docs.select(*kept).alias("d").join(
        removed.hint("merge").alias("r"), (F.coalesce(F.col("d.doc_id").cast("long"), F.lit(_NO_ID)) == F.col("r.did"))
        & (F.xxhash64(text) == F.col("r.th")), "left")
    lines = F.transform(_lines(text), lambda x, i: F.struct(x.alias("x"), F.coalesce(F.get(F.col("r.out"), i), F.lit(False)).alias("out")))
    stays = F.rtrim(F.array_join(F.transform(F.filter(lines, lambda x: ~x["out"]), lambda x: x["x"]), ""), F.lit("\n"))
    words = F.aggregate(F.filter(lines, lambda x: x["out"]), F.lit(0),
                        lambda n, x: n + F.regexp_count(x["x"], F.lit(_WORD)))
    cut = F.col("r.did").isNotNull()
    return joined.select(
        *[F.when(cut, stays).otherwise(text).alias(c) if c == "text" else F.col(f"d.`{c}`").alias(c) for c in kept],
        F.when(F.length(text) > 0, F.size(_lines(text))).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce("r.n_out", F.lit(0)).cast("long").alias("n_removed_lines"),
        F.when(cut, words).otherwise(0).cast("long").alias("n_removed_words"))


def dedup_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its id, the line and word counts of what went, and a hash of what stays."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed_lines", "n_removed_words",
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))
