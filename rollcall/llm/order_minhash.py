"""Near-duplicates by Order MinHash, verified by banded alignment.

Texts become sequences of words (letters and digits, lower case).  Their
k-mers of words are labelled with the number of their occurrence; each of a
scheme's hash functions picks the ``retained`` smallest labelled k-mers and
keeps them in the order of the text, so an equal vector needs equal k-mers in
equal order.  Texts that share a vector meet in a bucket.  Two texts do with
a probability of about 1 - (1 - J^retained)^functions, where J is the
resemblance of their k-mers; edits scattered word by word leave
J = s^k / (2 - s^k) at a similarity s.  ``SCHEMES`` adds vectors of shorter
k-mers for short texts, of which an edit takes a larger share of the k-mers.

Members of a bucket are compared with its leader, first in some buckets, then
in all; links are closed into classes, and buckets whose members are in one
class are done.  The others are dealt again, led by the member with the most
links, as long as that finds links.  What is left is compared pair by pair, so of texts that share a vector every two are compared or in one
class.  Before two texts are compared, the parities of their words (a bit
for each of ``SIGNATURE_BITS`` groups of words) must differ in no more bits than
the similarity leaves words unmatched: every unmatched word changes one bit, so
no link is lost, and texts that share a passage but not more never make a pair.

A comparison aligns the two word sequences within the band that an alignment
of ``MIN_SIMILARITY`` can reach (an LCS over bit vectors); the similarity is
twice the aligned words over all words.

Defined results: equal texts are one node whatever their number; a null text
is an empty one; texts without words are copies of each other only when equal;
texts of fewer words than a k-mer have one k-mer; a class is named by its
smallest doc_id (null if none of its rows has one); columns other than
``doc_id`` and ``text`` are ignored, or returned as they are by
``keep_representatives``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_checked, materialize
from rollcall.llm.components import close_links

MIN_SIMILARITY = 0.8


class Scheme(NamedTuple):
    kmer_words: int
    functions: int
    first: int           # how many functions' buckets are compared first
    most_words: int      # for texts of at most so many words; 0: all
    retained: int = 3


#: Measured misses at a similarity of 0.8 are in the README.
SCHEMES = (Scheme(3, 96, 12, 0), Scheme(2, 48, 6, 72), Scheme(1, 48, 6, 24))
#: Texts of at most so many words also meet by every two of their words in order.
PAIR_WORDS = 3
SIGNATURE_BITS = 2048
#: Rounds of leaders go on while they find a link for every so many open places in buckets.
LEAST_LINKED = 10
#: Hash values of a text held at a time, unless one function has more.
SKETCH_VALUES = 1 << 15
#: Rows of a batch whose words are unpacked together.
SLICE_ROWS = 64
#: Bytes of a text hashed at a time, unless a word is longer.
CHUNK_BYTES = 1 << 16
#: Bytes of a word's hash that are compared.
WORD_BYTES = 5

_WORDS = re.compile(r"[^\W_]+")
#: A character beyond ASCII that is neither letter nor digit.
_FOREIGN = re.compile(r"[^\w\x00-\x7f]")
_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_EVEN = np.random.default_rng(61).integers(1, 1 << 62, 8, dtype=np.uint64) | np.uint64(1)
_ODD = np.random.default_rng(62).integers(1, 1 << 32, 256, dtype=np.uint32) | np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


_BASE = 0x5851F42D4C957F2D
_FORWARD, _BACK = _powers(_BASE, CHUNK_BYTES), _powers(pow(_BASE, -1, 1 << 64), CHUNK_BYTES)


def _hash_words(raw: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes between blanks: polynomials in their bytes, free of where they start."""
    n = len(raw)
    forward, back = (_FORWARD, _BACK) if n <= CHUNK_BYTES else (_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
    gap = np.ones(n + 2, bool)
    gap[1:-1] = raw == 32
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * forward[:n], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _EVEN[-5])


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, runs of letters and digits in lower case."""
    text = text.lower() if text else ""
    if _FOREIGN.search(text):
        text = " ".join(_WORDS.findall(text))
    raw = np.frombuffer(text.encode().translate(_APART), np.uint8)       # what is left beyond ASCII belongs to words
    if len(raw) <= CHUNK_BYTES:
        return _hash_words(raw)
    out, start = [], 0
    while start < len(raw):
        # a long text in parts that end at a blank
        stop = min(start + CHUNK_BYTES, len(raw))
        blanks = np.flatnonzero(raw[start:stop] == 32) if stop < len(raw) else [stop - start]
        if len(blanks):
            stop = start + int(blanks[-1])
        else:
            stop = next((i + CHUNK_BYTES * k + start for k in range(1, len(raw) // CHUNK_BYTES + 2)
                         for i in np.flatnonzero(raw[start + CHUNK_BYTES * k:start + CHUNK_BYTES * (k + 1)] == 32)[:1].tolist()), len(raw))
        out.append(_hash_words(raw[start:stop]))
        start = stop + 1
    return np.concatenate(out)


def labelled_kmers(words: np.ndarray, kmer_words: int) -> np.ndarray:
    """Hashes of the k-mers, each with the number of its occurrence so far."""
    n = max(1, len(words) - kmer_words + 1)
    kmers = np.zeros(n, np.uint64)
    for k in range(min(kmer_words, len(words))):
        kmers = kmers * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n]
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.arange(n)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return _mix(kmers + occurrence * _EVEN[-1])


def _smallest(values: np.ndarray, retained: int) -> np.ndarray:
    """Places of the ``retained`` smallest values of each row, in ascending order of place; overwrites them."""
    rows, places = np.arange(len(values)), []
    for _ in range(retained):
        places.append(values.argmin(axis=1))
        values[rows, places[-1]] = np.iinfo(np.uint32).max
    return np.sort(np.stack(places, axis=1), axis=1)


def sketch(words: np.ndarray, scheme: Scheme = SCHEMES[0]) -> np.ndarray:
    """One hash per hash function of the retained k-mers in text order; empty for a text without words."""
    if not len(words):
        return np.zeros(0, np.uint64)
    kmers, n = labelled_kmers(words, scheme.kmer_words), scheme.functions
    if len(kmers) > scheme.retained:
        # a long text takes its hash functions a few at a time
        at_once, chosen = max(1, SKETCH_VALUES // len(kmers)), []
        short = (kmers >> np.uint64(32)).astype(np.uint32)
        for r in range(0, n, at_once):
            own = slice(r, min(r + at_once, n))
            values = short[None, :] * _ODD[:n][own, None]
            values += _ODD[n:2 * n][own, None]
            values ^= values >> np.uint32(15)
            values *= np.uint32(0x2C1B3C6D)
            chosen.append(_smallest(values, scheme.retained))
        places = np.concatenate(chosen)
    else:
        places = np.tile(np.arange(len(kmers)), (n, 1))
    vector = np.full(n, scheme.kmer_words, np.uint64)
    for k in range(places.shape[1]):
        vector = _mix(vector * _EVEN[-2] + kmers[places[:, k]])
    return vector


def buckets(words: np.ndarray) -> np.ndarray:
    """The buckets of a text, as signed longs; those compared first are odd."""
    out = []
    for number, scheme in enumerate(SCHEMES):
        if len(words) and (not scheme.most_words or len(words) <= scheme.most_words):
            found = sketch(words, scheme)
            order = np.arange(len(found), dtype=np.uint64)
            found = _mix(found + (order + np.uint64(1000 * number)) * _EVEN[-3])
            out.append(found & ~np.uint64(1) | (order < scheme.first))
    if 1 < len(words) <= PAIR_WORDS:
        a, b = np.triu_indices(len(words), 1)
        out.append(_mix(words[a] * _EVEN[-4] + words[b]) | np.uint64(1))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def signature(words: np.ndarray) -> np.ndarray:
    """Whether each group of words has an odd number of words, as signed longs."""
    odd = np.bincount((words >> np.uint64(20)).astype(np.int64) % SIGNATURE_BITS, minlength=SIGNATURE_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def aligned_similarity(a: list[int], b: list[int], least: float = MIN_SIMILARITY) -> float:
    """Twice the words of the best alignment within the band, over all words; 0 where ``least`` is out of reach.

    The band holds every alignment that leaves at most ``(1 - least)`` of the words unmatched.
    """
    if len(a) < len(b):
        a, b = b, a
    total = len(a) + len(b)
    most_unmatched = int((1 - least) * total + 1e-9)
    if not b or len(a) - len(b) > most_unmatched:
        return 0.0
    # equal words at both ends are aligned whatever lies between
    head = 0
    while head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not b:
        return 2 * (head + tail) / total
    in_b = set(b)
    if sum(w not in in_b for w in a) > most_unmatched:
        return 0.0
    width = most_unmatched
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    band = (1 << (2 * width + 1)) - 1
    row = full
    for j, w in enumerate(b):
        match = places.get(w)
        if match:
            match &= band << (j - width) if j >= width else band >> (width - j)
            found = row & match
            row = ((row + found) | (row - found)) & full
    return 2 * (head + tail + len(a) - row.bit_count()) / total


def slices(batches):
    """Runs of a few rows, so that long texts are not all unpacked at once; the allocator gives back what is free."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)
        pa.default_memory_pool().release_unused()


def text_key(text: Column) -> Column:
    """Equal texts have equal keys."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _known_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), *more)


def sketch_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n_words, buckets, signature`` of the row with each node's ``first_id``."""
    texts = _keyed(docs, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, signatures = [], [], []
            for text in batch.column("text"):
                words = word_hashes(text.as_py())
                counts.append(len(words))
                found.append(buckets(words))
                signatures.append(signature(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64())),
                 pa.array(signatures, pa.list_(pa.int64()))], names=["doc_id", "key", "n_words", "buckets", "signature"])
    sketched = texts.mapInArrow(run, "doc_id long, key binary, n_words long, buckets array<long>, signature array<long>")
    # by key and id, so that the copies of one text do not meet
    sketched = sketched.withColumn("first_id", _known_id(F.col("doc_id")))
    return sketched.join(nodes.select("key", "first_id", "node").hint("merge"), ["key", "first_id"]) \
        .select("node", "n_words", "buckets", "signature")


def bucket_members(sketched: DataFrame) -> DataFrame:
    """``bucket, node, leader`` of the buckets with two members or more.

    A task pairs the members that it reads itself; only one of a bucket's members per batch is shuffled.
    """
    def entries(heads: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("buckets")
                bucket = lists.flatten().to_numpy(zero_copy_only=False)
                node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))
                order = np.lexsort((node, bucket))
                bucket, node = bucket[order], node[order]
                new = np.ones(len(bucket), bool)
                new[1:] = bucket[1:] != bucket[:-1]
                start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                follows = node != node[start]
                if heads:
                    busy = np.zeros(len(bucket), bool)
                    busy[start[follows]] = True
                    columns = [bucket[new], node[new], busy[new]]
                else:
                    columns = [bucket[follows], node[follows], node[start][follows]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "node", "busy" if heads else "leader"])
        return sketched.select("node", "buckets").mapInArrow(run, f"bucket long, node long, {'busy boolean' if heads else 'leader long'}")

    run = Window.partitionBy("bucket").orderBy("node")
    heads = entries(True).select("bucket", "node", "busy", F.lag("node").over(run).alias("before"), F.lead("node").over(run).alias("after"),
                                 F.first("node").over(run.rowsBetween(Window.unboundedPreceding, 0)).alias("leader"))
    shared = heads.filter(F.col("busy") | F.col("before").isNotNull() | F.col("after").isNotNull())
    return shared.select("bucket", "node", "leader").unionByName(entries(False))


def _within_reach(a: str, b: str) -> Column:
    """Whether two texts' numbers of words and signatures (columns prefixed ``a`` and ``b``) leave the similarity possible."""
    total = F.col(f"{a}n_words") + F.col(f"{b}n_words")
    apart = sum(F.bit_count(F.col(f"{a}signature")[i].bitwiseXOR(F.col(f"{b}signature")[i])) for i in range(SIGNATURE_BITS // 64))
    lengths = 2 * F.least(F.col(f"{a}n_words"), F.col(f"{b}n_words")) >= F.lit(MIN_SIMILARITY) * total
    return lengths & (apart <= F.lit(1 - MIN_SIMILARITY) * total + F.lit(1e-9))


def _prefixed(facts: DataFrame, prefix: str) -> DataFrame:
    return facts.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("node", "n_words", "signature")])


def _word_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, words`` once per node of ``wanted`` (``node, key, first_id``), from the row with its ``first_id``."""
    rows = _keyed(docs, F.col("text").cast("string").alias("text")).withColumn("first_id", _known_id(F.col("doc_id")))
    texts = rows.join(broadcast_checked(wanted), ["key", "first_id"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [word_hashes(t.as_py()).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(words, pa.binary())], names=["node", "words"])
    return texts.mapInArrow(run, "node long, words binary")


def unpack_words(words: bytes) -> list[int]:
    out = np.zeros((len(words) // WORD_BYTES, 8), np.uint8)
    out[:, :WORD_BYTES] = np.frombuffer(words, np.uint8).reshape(-1, WORD_BYTES)
    return out.view("<u8")[:, 0].tolist()


def _verify(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The ``leader, node`` pairs whose alignment reaches the similarity."""
    both = pairs.join(words.select(F.col("node").alias("leader"), F.col("words").alias("a")), "leader") \
        .join(words.select("node", F.col("words").alias("b")), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            linked = [aligned_similarity(unpack_words(a.as_py()), unpack_words(b.as_py())) >= MIN_SIMILARITY
                      for a, b in zip(batch.column("a"), batch.column("b"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("leader"), batch.column("node")], names=["leader", "node"]) \
                .filter(pa.array(linked, pa.bool_()))
    return both.select("leader", "node", "a", "b").mapInArrow(run, "leader long, node long")


class Linker:
    """Links found so far (``leader, node``), the pairs compared, and ``node, root`` of the linked nodes."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, facts: DataFrame):
        self.docs, self.nodes, self.facts = docs, nodes, facts
        spark = docs.sparkSession
        self.links = self.compared = spark.createDataFrame([], "leader long, node long")
        self.roots = spark.createDataFrame([], "node long, root long")
        self.words: DataFrame | None = None

    def compare(self, pairs: DataFrame, checked: bool = False) -> int:
        """Verify the ``leader, node`` pairs that are new (and within reach, unless ``checked``), and add their links; how many."""
        pairs = pairs.select(F.least("leader", "node").alias("leader"), F.greatest("leader", "node").alias("node")).distinct()
        pairs = pairs.join(self.compared, ["leader", "node"], "left_anti")
        if not checked:
            known = pairs.join(_prefixed(self.facts, "a_"), F.col("leader") == F.col("a_node")) \
                .join(_prefixed(self.facts, "b_"), F.col("node") == F.col("b_node"))
            pairs = known.filter(_within_reach("a_", "b_")).select("leader", "node")
        # a row that repeats an id and a text has its facts and words twice
        pairs = materialize(pairs.distinct(), "near-pairs")
        if pairs.isEmpty():
            return 0
        self.compared = self.compared.unionByName(pairs)
        self._read_words(pairs)
        found = materialize(_verify(pairs, self.words).distinct(), "links")
        n = found.count()
        if n:
            self.links = self.links.unionByName(found)
            self._merge(found)
        return n

    def _read_words(self, pairs: DataFrame) -> None:
        wanted = pairs.select(F.col("leader").alias("node")).distinct().unionByName(pairs.select("node").distinct()).distinct()
        if self.words is not None:
            wanted = wanted.join(self.words.select("node"), "node", "left_anti")
        wanted = materialize(wanted.join(self.nodes, "node").select("node", "key", "first_id"), "wanted")
        if self.words is None or not wanted.isEmpty():
            more = materialize(_word_table(self.docs, wanted), "words")
            self.words = more if self.words is None else self.words.unionByName(more)

    def _merge(self, found: DataFrame) -> None:
        edges = found
        for side in ("leader", "node"):
            edges = edges.join(self.roots.select(F.col("node").alias(side), F.col("root").alias("r")), side, "left") \
                .withColumn(side, F.coalesce("r", side)).drop("r")
        moved = materialize(close_links(materialize(edges.filter(F.col("leader") != F.col("node")).distinct(), "root-edges")), "moved")
        now = moved.select(F.col("node").alias("root"), F.col("root").alias("r"))
        self.roots = materialize(self.roots.join(now, "root", "left").select("node", F.coalesce("r", "root").alias("root"))
                                 .unionByName(moved.select("node", "root")), "roots")

    def rooted(self, members: DataFrame, side: str = "node") -> DataFrame:
        """``members`` with the class of ``side`` as ``<side>_root``."""
        roots = self.roots.select(F.col("node").alias("n"), F.col("root").alias("r"))
        return members.join(roots, F.col(side) == F.col("n"), "left").withColumn(f"{side}_root", F.coalesce("r", side)).drop("n", "r")

    def open_members(self, members: DataFrame) -> DataFrame:
        """``bucket, node, node_root`` of the buckets that still hold two classes."""
        known = materialize(self.rooted(members.select("bucket", "node")), "rooted-members")
        split = known.groupBy("bucket").agg(F.min("node_root").alias("a"), F.max("node_root").alias("b")) \
            .filter(F.col("a") != F.col("b")).select("bucket")
        return materialize(known.join(split, "bucket", "left_semi"), "open-members")


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("leader", "node")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))


def _left_pairs(left: DataFrame, facts: DataFrame) -> DataFrame:
    """``leader, node`` of the members of ``left`` that share a bucket, are of two classes and within reach, in the least bucket they share."""
    # each node's facts meet its buckets in one row
    own = left.groupBy("node").agg(F.min("node_root").alias("node_root"), F.collect_set("bucket").alias("buckets"))
    own = own.join(facts, "node").withColumn("bucket", F.explode("buckets"))
    members = materialize(own, "left-members")
    a, b = (members.select("bucket", *[F.col(c).alias(f"{p}{c}") for c in ("node", "node_root", "n_words", "signature", "buckets")])
            for p in ("a_", "b_"))
    near = (F.col("a_node") < F.col("b_node")) & (F.col("a_node_root") != F.col("b_node_root")) & _within_reach("a_", "b_")
    least = F.array_min(F.array_intersect("a_buckets", "b_buckets")) == F.col("bucket")
    return a.join(b, "bucket").filter(near & least).select(F.col("a_node").alias("leader"), F.col("b_node").alias("node"))


def find_links(docs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified ``leader, node`` links between different texts, and ``node, root`` of the linked ones."""
    sketched = materialize(sketch_nodes(docs, nodes), "sketches")
    members = materialize(bucket_members(sketched), "members")
    linker = Linker(docs, nodes, sketched.select("node", "n_words", "signature"))
    led = members.filter(F.col("leader") != F.col("node"))
    linker.compare(led.filter(F.col("bucket").bitwiseAND(F.lit(1)) == 1))
    linker.compare(linker.rooted(linker.rooted(led), "leader").filter(F.col("node_root") != F.col("leader_root")))
    left = linker.open_members(members)
    while count := left.count():
        # led by the member with the most links
        order = F.struct((-F.coalesce("n_links", F.lit(0))).alias("l"), F.xxhash64("bucket", "node").alias("o"),
                         F.col("node").alias("leader"), F.col("node_root").alias("leader_root"))
        leaders = materialize(left.join(_degrees(linker.links), "node", "left").groupBy("bucket").agg(F.min(order).alias("f"))
                              .select("bucket", "f.leader", "f.leader_root"), "leaders")
        led = left.join(leaders, "bucket").filter(F.col("node_root") != F.col("leader_root")).select("leader", "node")
        if LEAST_LINKED * linker.compare(led) < count:
            break          # the classes that `left` knows are a few links old, which costs no more than their comparison
        left = linker.open_members(left)
    if count:
        linker.compare(_left_pairs(left, linker.facts), checked=True)
    return linker.links, linker.roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size, n_links, key, class_node`` of every row of ``docs``.

    ``class_size`` counts rows, ``n_links`` the verified links of the row's text to other texts.
    """
    rows = materialize(_keyed(docs), "rows")
    nodes = materialize(rows.groupBy("key").agg(F.min(_known_id(F.col("doc_id"))).alias("first_id"), F.min("doc_id").alias("least_id"),
                                                F.count("*").alias("n_rows"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    links, roots = find_links(docs, nodes)
    known = nodes.join(roots, "node", "left").join(_degrees(links), "node", "left").select(
        "node", "key", "least_id", "n_rows", F.coalesce("root", "node").alias("class_node"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    known = materialize(known, "known-nodes")
    classes = materialize(known.groupBy("class_node").agg(F.min("least_id").alias("class_id"), F.sum("n_rows").alias("class_size")), "classes")
    named = materialize(known.join(classes, "class_node").select("key", "class_id", "class_size", "n_links", "class_node"), "named-nodes")
    return rows.join(named, "key").select("doc_id", "class_id", "class_size", "n_links", "key", "class_node")


def duplicate_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).drop("key", "class_node")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``; of every class one row, that of its smallest doc_id.

    Where several texts of a class have that id, the one with the smallest key stays.
    """
    found = materialize(near_duplicates(docs.select("doc_id", "text")).filter(F.col("class_size") > 1), "copies")
    kept = materialize(found.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(F.col("class_node").alias("c"))
                       .agg(F.min("key").alias("kept_key")), "kept")
    joined = found.join(kept, F.col("class_node") == F.col("c"))
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("kept_key"))
    ids = (_known_id(F.col("doc_id")).alias("__id"), F.col("key").alias("__key"))
    dropped = materialize(joined.filter(~stays).select(*ids).distinct(), "dropped")
    repeated = materialize(joined.filter(stays).groupBy(*ids).count().filter("count > 1").select("__id", "__key"), "repeated")
    tagged = docs.withColumn("__id", _known_id(docs["doc_id"])).withColumn("__key", text_key(docs["text"]))
    rows = tagged.join(broadcast_checked(dropped), ["__id", "__key"], "left_anti")
    if not repeated.isEmpty():
        # rows that repeat an id and a text
        again = broadcast_checked(repeated)
        rows = rows.join(again, ["__id", "__key"], "left_anti").unionByName(
            rows.join(again, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]))
    return rows.drop("__id", "__key")
