"""Language-model scoring by logistic mixing of hashed-context bit predictors.

A text is its lower-cased words, a space after each, and an end symbol.  Every
byte is coded by binary decisions along the Huffman code of the bytes that
follow the one before it.  Five predictors hold counts of ones per (context,
decision): the last one, two, four and six bytes, and the word so far, hashed
into tables whose size follows the training bytes.  Their stretched probabilities are mixed with weights that
are chosen by each predictor's confidence and scaled by the decision's depth,
and an adaptive probability map per depth refines the sum.

A symbol and what the predictors see before it - six bytes and the word so far - make an event.  The
equal events of a run of texts are brought together by sorting and counted, learned from or scored once.

Training.  The counts are sums over all training rows but a hash fold of
them (``MIX_FOLD``); on that fold, whose counts the tables have not seen, the
weights are learned online in mini-batches, in each partition, and averaged by
the events behind each weight, and the maps are counted.  All training rows
are used once.  The model is then fixed, so a score does not depend on the
order of the rows, and its bits add up to a true probability of the text.

The unigram base score needs each token's training count.  Words that make up
at least 1 in ``HEAVY_SHARE`` tokens - so at most that many - are broadcast;
the rest are joined by word.

Defined results: a null text is an empty one (the end alone); without training
rows the counts are zero and the predictors neutral; rows that repeat are
scored, and learned from, as often as they occur; a null id is never held out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import fold, materialize, text_slices

HELD_OUT_FOLDS, HELD_OUT = 5, 1
#: Of the training rows, one in so many (by hash) trains the mixing instead of the counts.
MIX_FOLD = 16
#: Bytes of context of the predictors (the first is one), before that of the word so far.
ORDERS = (1, 2, 4, 6)
PREDICTORS = len(ORDERS) + 1
#: Bits of the largest table at most: a worker holds four bytes a slot, twice, while it counts, and each task writes its counts.
MOST_TABLE_BITS = 22
BLOCK = 1 << 16
CONFIDENCES = 8
HEAVY_SHARE = 1 << 20
#: Bytes of text that Arrow cuts into words at a time.
SLICE_BYTES = 4 << 20
#: Distinct words of a task's counts that are held before they are handed on.
WORDS_HELD = 300_000
#: Bytes counted, scored and learned from at a time.
COUNT_POSITIONS, SCORE_POSITIONS, LEARN_POSITIONS = 1 << 19, 1 << 19, 1 << 15
#: Distinct events of them that are taken through a depth of the code at a time when counting and scoring.
SPAN = 1 << 17
END = "\n"

_PAD = b"\n" * 8
_DEPTHS = 64
#: Cells of a probability map over the mixed logit, from -8 to 8.
_MAP_CELLS = 257
#: When scoring, steps of a logit, and what a predictor adds at most: five of them fit in 16 bits, doubled.
_STEPS, _MOST = 128, 1600
_ODD = np.uint32(0x9E3779B1)
_WORD_BASE = 0x5851F42D4C957F2D
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def normal(text: str | None) -> bytes:
    """The text as the stream codes it: words with A-Z lowered, a space after each, the end symbol."""
    return b" ".join([*text.encode().lower().split(), END.encode()]) if text else END.encode()


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For every word of a batch its number and its row, and the distinct words by number."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    numbered = cut.flatten().dictionary_encode()
    number = numbered.indices.to_numpy(zero_copy_only=False)
    words = numbered.dictionary.cast(pa.binary())
    empty = pc.equal(words, b"").to_numpy(zero_copy_only=False)
    if empty.any():      # before or after white space at a text's ends
        keep = ~empty[number]
        number, owner = number[keep], owner[keep]
    return number, owner, words


def table_bits(training_bytes: int) -> tuple[int, ...]:
    """Bits of the predictors' tables: slots in proportion to the training bytes, up to ``MOST_TABLE_BITS``."""
    large = max(16, min(MOST_TABLE_BITS, round(math.log2(max(1, training_bytes))) - 2))
    return 16, min(18, large), max(16, large - 1), large, large


class Code:
    """For each byte the Huffman code of the bytes after it; a step holds the inner node and the bit.

    ``bits`` are those of the predictors' tables.
    """

    def __init__(self, histogram: np.ndarray, bits: tuple[int, ...] | None = None):
        self.bits = bits or table_bits(int(histogram.sum()))
        paths = [path for row in histogram.reshape(256, 256) for path in self._paths(row)]
        self.length = np.array([len(p) for p in paths], np.uint8)
        #: Place of each pair among all, longer codes first.
        self.rank = np.argsort(np.argsort(np.uint8(255) - self.length, kind="stable")).astype(np.uint16)
        self.steps = np.zeros((int(self.length.max()), 1 << 16), np.uint16)
        for pair, path in enumerate(paths):
            self.steps[:len(path), pair] = path

    @staticmethod
    def _paths(counts: np.ndarray) -> list[list[int]]:
        """Per symbol ``2 * node + bit`` from the root on; the length stays below ``_DEPTHS``."""
        heap = [(int(n) + 1, symbol) for symbol, n in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        for node in range(256, 511):
            (m, a), (n, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b] = (node, 0), (node, 1)
            heapq.heappush(heap, (m + n, node))
        paths = []
        for symbol in range(256):
            path, at = [], symbol
            while at in parent:
                at, bit = parent[at]
                path.append(2 * (at - 256) + bit)
            paths.append(path[::-1])
        return paths


class Stream:
    """The distinct events of a run of documents, ordered so that longer codes come first.

    An event is a symbol with all that the predictors see of what is before it - six bytes and the word so far -, so
    that one that occurs often in a run is counted, or costed, once.  ``weights`` tell how often each occurs.
    """

    def __init__(self, code: Code, texts: list[bytes], predictors: range = range(PREDICTORS)):
        raw = np.frombuffer(b"".join([_PAD + t for t in texts]), np.uint8)
        self._sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(self._sizes + len(_PAD)) - self._sizes
        inside = np.ones(len(raw), bool)
        for k in range(len(_PAD)):
            inside[starts - 1 - k] = False
        # a number whose lowest byte is the symbol, the next six those before it
        seen = np.ndarray(len(raw) - 7, ">u8", raw, strides=(1,))[inside[7:]].astype(np.uint64) & np.uint64((1 << 56) - 1)
        word = self._words(raw)[:-1][inside]
        # by code length, then pair, then a hash of the rest
        key = ((seen ^ word * np.uint64(_WORD_BASE)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)
        order = np.argsort(key, kind="stable")
        ranks = code.rank.take(seen.astype(np.uint16), mode="clip").take(order, mode="clip")
        order = order.take(np.argsort(ranks, kind="stable"), mode="clip")
        seen, word = seen.take(order, mode="clip"), word.take(order, mode="clip")
        new = np.ones(len(order), bool)
        np.not_equal(seen[1:], seen[:-1], out=new[1:])
        new[1:] |= word[1:] != word[:-1]
        begin = np.flatnonzero(new)
        seen, word = seen.take(begin, mode="clip"), word.take(begin, mode="clip")
        self.code, self.predictors, self._order = code, predictors, order
        self.pairs, self.weights = seen.astype(np.uint16), np.diff(begin, append=len(order))
        counts = np.bincount(code.length.take(self.pairs, mode="clip"), minlength=256)
        self.active = len(begin) - np.cumsum(counts)[:code.steps.shape[0]]      # events with more than d decisions
        self.hashes = [(self.pairs & np.uint16(0xFF00)).astype(np.uint32)]
        before = seen.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        mixed = before[:, 1].astype(np.uint32)
        for back in range(2, max(ORDERS) + 1):
            # a hash of the `back` bytes before the symbol
            mixed = mixed * np.uint32(0x85EBCA6B) + (before[:, back] + np.uint32(1)) * np.uint32(pow(0x2C1B3C6D, back, 1 << 32))
            if back in ORDERS:
                self.hashes.append(mixed ^ mixed >> np.uint32(15))
        self.hashes.append(word)

    def by_document(self, each: np.ndarray) -> np.ndarray:
        """The sum over each document of a number an event."""
        out = np.empty(len(self._order))
        out[self._order] = np.repeat(each, self.weights)
        return np.add.reduceat(out, np.cumsum(self._sizes) - self._sizes)      # no document is without a symbol

    def decisions(self, span: int | None = None):
        """Per code depth, in spans: the depth, the events that take part, their bits, and the slot in each table.

        The slots are made one by one, each in the place of the one before.
        """
        most = min(span or len(self.pairs), int(self.active[0]) if len(self.active) else 0)
        place, mixed, salts = np.empty(most, np.intp), np.empty(most, np.uint32), np.empty(most, np.uint32)
        for d, active in enumerate(self.active.tolist()):
            for begin in range(0, active, span or max(1, active)):
                part = slice(begin, min(active, begin + (span or active)))
                step = self.code.steps[d].take(self.pairs[part], mode="clip")
                n = len(step)
                np.right_shift(step, np.uint16(1), out=mixed[:n])
                np.multiply(mixed[:n], np.uint32(0x27D4EB2F), out=salts[:n])
                yield d, part, step & np.uint16(1), self._slots(part, step, place[:n], mixed[:n], salts[:n])

    def _slots(self, part: slice, step: np.ndarray, slot: np.ndarray, mixed: np.ndarray, salt: np.ndarray):
        for c in self.predictors:
            if c == 0:
                np.bitwise_or(self.hashes[0][part], step >> np.uint16(1), out=slot)
            else:
                np.bitwise_xor(self.hashes[c][part], salt, out=mixed)
                np.multiply(mixed, _ODD, out=mixed)
                np.right_shift(mixed, np.uint32(32 - self.code.bits[c]), out=slot)
            yield slot

    @staticmethod
    def _words(raw: np.ndarray) -> np.ndarray:
        """Hash of the word so far: a polynomial in its bytes, free of where the word starts."""
        n = len(raw)
        if len(_POWERS[0]) <= n:
            for k, base in enumerate((_WORD_BASE, pow(_WORD_BASE, -1, 1 << 64))):
                _POWERS[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, base, np.uint64))])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS[0][:n], out=sums[1:])
        starts = np.concatenate([[0], np.flatnonzero((raw == 32) | (raw == 10)) + 1])
        lengths = np.diff(starts, append=n + 1)      # a word starts after each gap
        sums -= np.repeat(sums[starts], lengths)
        sums *= np.repeat(_POWERS[1][starts] * np.uint64(0xD6E8FEB86659FD93), lengths)
        return (sums >> np.uint64(32)).astype(np.uint32)


def runs(texts: list[bytes], size: int):
    """Slices of the texts of about so many bytes; a longer text is a slice of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


# Counts as sums of partial tables: 16 bits a slot, larger numbers listed apart.

def _pack(counts: np.ndarray) -> bytes:
    large = np.flatnonzero(counts >= 65535)
    return zstandard.compress(np.minimum(counts, 65535).astype("<u2").tobytes() + large.astype("<i8").tobytes()
                              + counts[large].astype("<i8").tobytes(), level=1)


def _unpack(packed: bytes, size: int = 2 * BLOCK) -> np.ndarray:
    packed = zstandard.decompress(packed)
    counts = np.frombuffer(packed, "<u2", size).astype(np.int64)
    rest = np.frombuffer(packed, "<i8", offset=2 * size)
    counts[rest[:len(rest) // 2]] = rest[len(rest) // 2:]
    return counts


def count_bits(tables: list[np.ndarray], stream: Stream) -> None:
    """Adds a run's zeros and ones per slot to the tables."""
    weights = stream.weights.astype(np.int32)
    for _, part, bit, slots in stream.decisions(SPAN):
        bit = bit.astype(np.intp)
        for table, slot in zip(tables, slots, strict=True):
            slot += slot
            slot += bit
            np.add.at(table, slot, weights[part])


_PARTIAL = "word binary, n long, block int, salt int, counts binary"


def _partial_counts(training: DataFrame, code: Code) -> DataFrame:
    """Word counts, and tables of bit counts in blocks, of each partition's rows."""
    names = [f.split()[0] for f in _PARTIAL.split(", ")]

    def added_up(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def words_out(counts: pa.Table) -> pa.RecordBatch:
        none = [pa.nulls(len(counts), kind) for kind in (pa.int32(), pa.int32(), pa.binary())]
        return pa.RecordBatch.from_arrays([*(counts.column(c).combine_chunks() for c in ("word", "n")), *none], names=names)

    def run(batches):
        tables = [np.zeros(2 << b, np.int32) for b in code.bits]
        any_rows, ends, held = False, 0, []
        for batch in (part for whole in batches for part in text_slices(whole, SLICE_BYTES)):
            number, _, words = numbered_words(batch.column("text"))
            held.append(pa.table([words, np.bincount(number, minlength=len(words))], names=["word", "n"]))
            if sum(len(h) for h in held) > 2 * WORDS_HELD:
                held = [added_up(held)]
                if len(held[0]) > WORDS_HELD:
                    yield words_out(held.pop())
            ends += batch.num_rows
            counted = [normal(t) for t in batch.filter(pc.invert(batch.column("mixing"))).column("text").to_pylist()]
            any_rows |= bool(counted)
            for a, b in runs(counted, COUNT_POSITIONS):
                count_bits(tables, Stream(code, counted[a:b]))
        held.append(pa.table([pa.array([END.encode()], pa.binary()), np.array([ends])], names=["word", "n"]))
        yield words_out(added_up(held))
        if any_rows:
            salt = TaskContext.get().partitionId() % 64
            parts = (t[at:at + 2 * BLOCK] for t in tables for at in range(0, len(t), 2 * BLOCK))
            for block, part in enumerate(parts):
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None], pa.binary()), pa.array([None], pa.int64()), pa.array([block], pa.int32()),
                         pa.array([salt], pa.int32()), pa.array([_pack(part)], pa.binary())], names=names)
    return training.select("text", "mixing").mapInArrow(run, _PARTIAL)


def _sum_blocks(blocks: DataFrame, *keys: str, finish: Callable[[np.ndarray], bytes] = _pack) -> DataFrame:
    """Blocks added up by key, as ``finish`` writes a sum; a task holds one running sum."""
    def run(batches):
        key, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                now = tuple(row[k] for k in keys)
                if now != key:
                    if key is not None:
                        yield out(key, total)
                    key, total = now, np.zeros(2 * BLOCK, np.int64)
                total += _unpack(row["counts"])
        if key is not None:
            yield out(key, total)

    def out(key, total):
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int32()) for k in key], pa.array([finish(total)], pa.binary())],
                                          names=[*keys, "counts"])
    return blocks.select(*keys, "counts").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", counts binary")


# The model.

_STRETCH = np.tile((np.arange(256, dtype=np.float32) - 128) / 16, CONFIDENCES)


def _states(counts: np.ndarray) -> np.ndarray:
    """Per slot the predictor's confidence (3 bits) and stretched probability (8 bits)."""
    zeros, ones = counts[0::2], counts[1::2]
    total = zeros + ones
    stretched = np.log((ones + 0.3) / (zeros + 0.3))
    level = np.clip(np.rint(stretched * 16), -128, 127).astype(np.int64) + 128
    confidence = np.searchsorted([1, 2, 4, 10, 40, 200, 2000], total, side="right")
    return (confidence * 256 + level).astype(np.uint16)


class Model:
    """Fixed tables, weights and probability maps; picklable for a broadcast.

    A predictor's weight is chosen by its confidence; the scale of the sum and the map by the decision's depth.
    """

    def __init__(self, code: Code, tables: list[np.ndarray]):
        self.code, self.tables = code, tables
        self.weights = np.tile([0.0, 0.1, 0.2, 0.25, 0.3, 0.35, 0.35, 0.35], (PREDICTORS, 1))
        self.scales = np.ones(_DEPTHS)
        self.maps = np.tile(self._centres(), (_DEPTHS, 1))

    @staticmethod
    def _centres() -> np.ndarray:
        return 1 / (1 + np.exp(-np.linspace(-8, 8, _MAP_CELLS)))

    def adopt(self, sums: dict[int, tuple[float, float]]) -> None:
        """Weights, scales and maps from the sums of all partitions; what no event touched stays."""
        values, maps = np.append(self.weights, self.scales), self.maps.ravel().copy()
        for i, (a, b) in sums.items():
            if i < len(values):
                values[i] = a / b
            else:
                maps[i - len(values)] = (a + 20 * maps[i - len(values)]) / (b + 20)
        self.weights, self.scales = values[:self.weights.size].reshape(self.weights.shape), values[self.weights.size:]
        self.maps = maps.reshape(self.maps.shape)

    def inputs(self) -> np.ndarray:
        """Weighted stretched probability by predictor and state."""
        return (np.repeat(self.weights, 256, axis=1) * _STRETCH).astype(np.float32)

    def mix(self, slots: Iterable[np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The weighted sum of the predictors, and their states."""
        states = [t.take(s, mode="clip") for t, s in zip(self.tables, slots, strict=True)]
        total = inputs[0].take(states[0], mode="clip")
        for given, state in zip(inputs[1:], states[1:], strict=True):
            total += given.take(state, mode="clip")
        return total, states

    @staticmethod
    def cells(total: np.ndarray, scale: float) -> np.ndarray:
        return (np.clip(total * np.float32(scale * 16), -128, 128) + np.float32(128.5)).astype(np.int32)

    def frozen(self) -> Scorer:
        """The fixed model: a slot holds what its predictor adds to the logit, doubled, a depth's table the cost of each sum."""
        inputs = 2 * np.clip(np.rint(self.inputs() * _STEPS), -_MOST, _MOST).astype(np.int16)
        levels = [given.take(t, mode="clip") for given, t in zip(inputs, self.tables, strict=True)]
        sums = np.arange(-PREDICTORS * _MOST, PREDICTORS * _MOST + 1, dtype=np.float32) / np.float32(_STEPS)
        p = 0.5 * (self._centres() + np.clip(self.maps, 1e-6, 1 - 1e-6))
        costs = np.log10(np.stack([1 - p, p], axis=2)).astype(np.float32)
        depths = [costs[d].take(self.cells(sums, self.scales[d]), axis=0).ravel() for d in range(self.code.steps.shape[0])]
        return Scorer(self.code, levels, depths)

    def learn(self, documents: list[bytes], seen: np.ndarray, hits: np.ndarray) -> None:
        """Online steps over the documents; counts events per weight and scale in ``seen``, per map cell in ``hits``."""
        size = self.weights.size
        for a, b in runs(documents, LEARN_POSITIONS):
            stream = Stream(self.code, documents[a:b])
            for d, part, bit, slots in stream.decisions():
                events, inputs = stream.weights[part].astype(np.float64), self.inputs()
                total, states = self.mix(slots, inputs)
                cell, own = self.cells(total, self.scales[d]), slice(d * _MAP_CELLS, (d + 1) * _MAP_CELLS)
                hits[0, own] += np.bincount(cell, events, _MAP_CELLS)
                hits[1, own] += np.bincount(cell, events * bit, _MAP_CELLS)
                p = 1 / (1 + np.exp(-np.clip(total * self.scales[d], -8, 8)))
                error, curvature = events * (bit - p), events * (p * (1 - p) + 1e-4)
                x = _STRETCH * self.scales[d]
                for c, state in enumerate(states):
                    state = state.astype(np.intp)
                    sums = [np.bincount(state, events, len(x)), x * np.bincount(state, error, len(x)),
                            x * x * np.bincount(state, curvature, len(x))]
                    self._step(self.weights[c], *(s.reshape(CONFIDENCES, -1).sum(axis=1) for s in sums), seen[c * CONFIDENCES:][:CONFIDENCES])
                self._step(self.scales[d:d + 1], events.sum(), (error * total).sum(), (curvature * total * total).sum(), seen[size + d:][:1])

    @staticmethod
    def _step(values, events, gradient, curvature, seen) -> None:
        seen += events
        rate = 0.25 / (1 + seen / 100_000) ** 0.5
        values += rate * gradient / (curvature + 20)


class Scorer:
    """A fixed model; picklable for a broadcast."""

    def __init__(self, code: Code, levels: list[np.ndarray], costs: list[np.ndarray]):
        self.code, self.levels, self.costs = code, levels, costs

    def __setstate__(self, state: dict) -> None:
        # arrays of numpy's own lie in large pages of memory, what a pickle holds does not
        self.__dict__.update(state, levels=[level.copy() for level in state["levels"]])

    @cached_property
    def first(self) -> np.ndarray:
        """Per depth and pair what the first predictor adds, doubled, from the least sum on, and the bit."""
        slots = (np.arange(1 << 16) & 0xFF00) | (self.code.steps >> np.uint16(1))
        return self.levels[0].take(slots, mode="clip") + np.int16(2 * PREDICTORS * _MOST) + (self.code.steps & np.uint16(1)).astype(np.int16)

    def score(self, documents: list[bytes]) -> np.ndarray:
        """log10 probability of each document: a bit's is the mean of its cell's mixed and refined one."""
        out = np.zeros(len(documents))
        sums, given = np.empty((2, SPAN), np.int16)
        for a, b in runs(documents, SCORE_POSITIONS):
            stream = Stream(self.code, documents[a:b], range(1, PREDICTORS))
            cost = np.zeros(len(stream.pairs))
            for d, part, bit, slots in stream.decisions(SPAN):
                n = len(bit)
                total = self.first[d].take(stream.pairs[part], out=sums[:n], mode="clip")
                for level, slot in zip(self.levels[1:], slots, strict=True):
                    total += level.take(slot, out=given[:n], mode="clip")
                cost[part] += self.costs[d].take(total, mode="clip")
            out[a:b] = stream.by_document(cost)
        return out


def _mix_statistics(mixing: DataFrame, model) -> DataFrame:
    """Sums over partitions of the learned weights by their events, and of the maps' counts: ``i, a, b``."""
    def run(batches):
        own = Model(model.value.code, model.value.tables)
        seen, hits = np.zeros(own.weights.size + _DEPTHS), np.zeros((2, own.maps.size))
        for batch in batches:
            own.learn([normal(t) for t in batch.column("text").to_pylist()], seen, hits)
        a = np.concatenate([np.append(own.weights, own.scales) * seen, hits[1]])
        b = np.concatenate([seen, hits[0]])
        keep = np.flatnonzero(b)
        yield pa.RecordBatch.from_arrays([pa.array(keep), pa.array(a[keep]), pa.array(b[keep])], names=["i", "a", "b"])
    return mixing.select("text").mapInArrow(run, "i long, a double, b double").groupBy("i").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))


#: Bytes as the stream has them: A-Z lowered, white space a space.
_FOLDED = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _histogram(training: DataFrame) -> np.ndarray:
    """Counts of byte pairs in the training text; 65,536 numbers at most reach the driver."""
    def run(batches):
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part in text_slices(batch, SLICE_BYTES):
                # texts meet at two spaces, a pair that is not counted
                raw = np.frombuffer("  ".join(["", *(t or "" for t in part.column("text").to_pylist()), ""]).encode().translate(_FOLDED),
                                    np.uint8).astype(np.uint16)
                counts += np.bincount(raw[:-1] << np.uint16(8) | raw[1:], minlength=1 << 16)
            counts[32 * 256 + 10] += batch.num_rows
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["pair", "n"])
    counts = np.zeros(1 << 16, np.int64)
    for r in training.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] = r["n"]
    counts[32 * 256 + 32] = 0      # spaces in a row are one in the stream
    return counts


def train(training: DataFrame):
    """Model, word counts (``word, c``) and totals (tokens, distinct) of ``text, mixing``."""
    code = Code(_histogram(training))
    partial = materialize(_partial_counts(training, code), "lm-partial")
    words = materialize(partial.filter(F.col("n") > 0).groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    sums = _sum_blocks(partial.filter(F.col("block").isNotNull()), "block", "salt")
    states = _sum_blocks(sums, "block", finish=lambda total: _states(total).tobytes())
    flat = np.full(sum(1 << b for b in code.bits), 128, np.uint16)
    for row in states.collect():      # two bytes a slot of the tables
        flat[BLOCK * row["block"]:BLOCK * (row["block"] + 1)] = np.frombuffer(row["counts"], np.uint16)
    model = Model(code, np.split(flat, np.cumsum([1 << b for b in code.bits])[:-1]))
    sent = training.sparkSession.sparkContext.broadcast(model)
    learned = _mix_statistics(training.filter("mixing"), sent).collect()      # one row a weight or map cell
    model.adopt({r["i"]: (r["a"], r["b"]) for r in learned})
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    return model.frozen(), words, total["n"], total["v"]


_SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, n_bytes long, "
           "rare array<binary>")


def score_documents(docs: DataFrame) -> DataFrame:
    """Digest of the contract, one row per row of ``docs``, and the model's ``bits_per_byte`` of the stream."""
    folds = HELD_OUT_FOLDS * MIX_FOLD
    at = fold(F.col("doc_id"), folds)
    # a null id has no fold: it is trained on, and not held out
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (at % HELD_OUT_FOLDS == HELD_OUT).alias("held_out"), (F.floor(at / HELD_OUT_FOLDS) == 0).alias("mixing"))
    model, words, total, distinct = train(rows.filter(~F.col("held_out")).select("text", "mixing"))
    sc = docs.sparkSession.sparkContext
    denominator = math.log10(total + 0.5 * (distinct + 1)) if total else math.log10(0.5)
    frequent = words.filter(F.col("c") * HEAVY_SHARE >= total).collect()      # at most HEAVY_SHARE words
    sent = sc.broadcast((model, {bytes(r["word"]): (math.log10(r["c"] + 0.5) - denominator) for r in frequent}))
    names = [f.split()[0] for f in _SCORED.split(", ")[:8]] + ["rare"]

    def run(batches):
        own, known = sent.value
        end = known.get(END.encode(), math.log10(0.5) - denominator)
        for batch in (part for whole in batches for part in text_slices(whole, SLICE_BYTES)):
            rows = batch.num_rows
            number, owner, words = numbered_words(batch.column("text"))
            log = np.array([known.get(w, math.nan) for w in words.to_pylist()])
            found = log[number] if len(number) else np.zeros(0)
            is_rare = np.isnan(found)
            rare = words.take(pa.array(number[is_rare]))
            streams = [normal(t) for t in batch.column("text").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(owner[is_rare], minlength=rows))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(np.bincount(owner, minlength=rows) + 1),
                 pa.array(np.bincount(owner[~is_rare], minlength=rows) + int(END.encode() in known)),
                 pa.array(np.bincount(owner, np.nan_to_num(found), rows) + end),
                 pa.array(own.score(streams)), pa.array([len(t) for t in streams], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rare)], names=names)
    scored = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
                         .mapInArrow(run, _SCORED), "lm-scored")
    rest = scored.select("row", F.explode("rare").alias("word"))
    # a rare word has less than 1 in HEAVY_SHARE of the tokens, so no key is hot
    joined = rest.join(words.filter(F.col("c") * HEAVY_SHARE < total).hint("shuffle_hash"), "word", "left")
    count = F.coalesce("c", F.lit(0))
    tails = joined.groupBy("row").agg(
        F.sum(F.log10(count + 0.5) - F.lit(denominator)).alias("tail"), F.sum((count > 0).cast("long")).alias("tail_known"))
    return scored.drop("rare").join(tails.hint("merge"), "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"),
        "score", (F.col("score") * F.lit(-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
