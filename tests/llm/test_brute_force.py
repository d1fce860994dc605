"""Choices of the learned operators, worked out again the plain way."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import zstandard

from rollcall.llm import fair_toxicity, host_rules, retrieval_packing, zstd_langid


def prose(seed, words, parts="the ing ion and re er tion"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(parts.split()) for _ in range(r.randint(1, 4))) for _ in range(words))


OTHER = "der sch ung ein ich keit"


def test_language_is_the_smallest_encoding(spark):
    rows = [(lang, prose(i, 60, p)) for lang, p in (("en", "the ing ion and re er tion"), ("de", OTHER)) for i in range(80)]
    learned = zstd_langid.learn_dictionaries(spark.createDataFrame(rows, "lang string, text string"), size=4096)
    compressors = zstd_langid._compressors(learned)
    for i in range(40):
        text = prose(1000 + i, 1 + 9 * i, OTHER if i % 2 else "the ing ion and re er tion") + ("" if i % 3 else " mixed " + prose(i, 20, OTHER))
        sizes = {}
        for lang, data in learned.items():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=zstd_langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                         write_dict_id=False)
            raw = text.lower().encode()
            sizes[lang] = sum(len(c.compress(raw[k:k + zstd_langid.BLOCK_BYTES])) for k in range(0, len(raw), zstd_langid.BLOCK_BYTES))
        found, score, margin = zstd_langid.classify(text, compressors)
        assert sizes[found] == min(sizes.values())
        assert margin == pytest.approx((max(sizes.values()) - min(sizes.values())) / min(sizes.values()))
        assert score == pytest.approx(1 / sum(2.0 ** -(s - min(sizes.values())) for s in sizes.values()), rel=1e-6)


def test_document_frequencies_by_label(spark, monkeypatch):
    monkeypatch.setattr(fair_toxicity, "_FLUSH", 50)
    rows = [(prose(i, 30) if i % 11 else None, i % 2) for i in range(300)]
    found = fair_toxicity.document_frequencies(spark.createDataFrame(rows, "text string, toxic int").repartition(4)).collect()
    want = {flag: Counter(w for text, toxic in rows if toxic == flag for w in {*fair_toxicity.words_of(text), ""}) for flag in (0, 1)}
    assert {r.word: (r.toxic_docs, r.clean_docs) for r in found} == {w: (want[1][w], want[0][w]) for w in {*want[0], *want[1]}}


def loss(weights, bias, rows, swaps):
    """The fitted objective, term by term."""
    total = 0.5 * fair_toxicity.RIDGE * sum(w * w for w in weights)
    for features, label in rows:
        p = 1 / (1 + math.exp(-(bias + sum(weights[f] for f in features))))
        total -= math.log(p if label else 1 - p)
    n = sum(swaps.values())
    return total + fair_toxicity.SWAP_PENALTY * len(rows) * sum(k / n * (weights[a] - weights[b]) ** 2 for (a, b), k in swaps.items())


def test_fitted_weights_are_at_the_least_penalised_loss():
    r = random.Random(2)
    rows = [(sorted({r.randrange(6) for _ in range(3)}), 0) for _ in range(200)]
    rows = [(f, int(0 in f and r.random() < 0.9 or r.random() < 0.05)) for f, _ in rows]
    swaps = Counter({(1, 2): 30, (3, 2): 5})
    weights, bias = fair_toxicity.fit_weights(rows, swaps, 6)
    best = loss(weights, bias, rows, swaps)
    for i in range(6):
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[i] += step
            assert loss(moved, bias, rows, swaps) > best
    assert min(loss(weights, bias + step, rows, swaps) for step in (-0.05, 0.05)) > best
    assert abs(weights[1] - weights[2]) < 0.02 < weights[0]


def test_text_score_is_the_logistic_of_its_words():
    weights = {"bad": 2.0, "good": -1.0}
    assert fair_toxicity.score_text("Bad, bad good", weights, 0.5) == pytest.approx(1 / (1 + math.exp(-1.5)))
    assert fair_toxicity.score_text(None, weights, 0.5) == pytest.approx(1 / (1 + math.exp(-0.5)))


def test_hosts_are_shrunk_and_documents_judged_by_hand(spark):
    r = random.Random(7)
    rows = []
    for host, share in (("a", 0.0), ("b", 0.2), ("c", 0.95), (None, 0.5)):
        for k in range({"a": 60, "b": 40, "c": 30, None: 5}[host]):
            bad = r.random() < share
            text = "too short" if bad else prose(len(rows), 60) + (" # # # # # # # #" if r.random() < 0.3 else "")
            rows.append((len(rows), text, host))
    out = {x.doc_id: x for x in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    base = {i: out[i].base_failed for i, *_ in rows}
    hosts = Counter(h for *_, h in rows)
    fails = Counter(h for i, _, h in rows if base[i])
    n, f = len(rows), sum(fails.values())
    mean = (f + 0.5) / (n + 1)
    observed = sum(hosts[h] * (fails[h] / hosts[h]) ** 2 for h in hosts) / n - (f / n) ** 2
    between = max(0.0, observed - mean * (1 - mean) * len(hosts) / n)
    strength = min(max(mean * (1 - mean) / between - 1, 2.0), host_rules.MAX_PRIOR_STRENGTH)
    for i, _, h in rows:
        assert out[i].host_base_rate == pytest.approx((fails[h] + mean * strength) / (hosts[h] + strength))
        assert out[i].host_rejected == (out[i].host_base_rate > host_rules.HOST_REJECT_RATE or out[i].host_soft_rate > host_rules.HOST_REJECT_RATE)
        assert not (out[i].kept and (base[i] or out[i].host_rejected))
    clean = [i for i, t, h in rows if h == "a" and "#" not in t]
    assert all(out[i].kept for i in clean) and not any(out[i].kept for i, _, h in rows if h == "c")


def test_neighbours_are_ranked_by_bm25():
    r = random.Random(3)
    documents = [np.array([r.randrange(60) for _ in range(r.randint(5, 40))] + [0], "<u4") for _ in range(40)]
    index = retrieval_packing.Bm25Index(documents)
    mean = sum(map(len, documents)) / len(documents)
    df = Counter(t for d in documents for t in set(d.tolist()))

    def weight(t, d):
        c = d.tolist().count(t)
        idf = math.log1p((len(documents) - df[t] + 0.5) / (df[t] + 0.5))
        k1, b = retrieval_packing.K1, retrieval_packing.B
        return idf * c * (k1 + 1) / (c + k1 * (1 - b + b * len(d) / mean))
    for seed in range(0, 40, 7):
        terms = sorted(set(documents[seed].tolist()), key=lambda t: (-np.float32(weight(t, documents[seed])), t))[:retrieval_packing.QUERY_TERMS]
        want = [sum(weight(t, d) for t in terms if t in d) for d in documents]
        assert index.neighbours(seed) == pytest.approx(want, rel=1e-4)


def test_packing_follows_the_ranking_until_the_window_is_full():
    r = random.Random(8)
    documents = [np.array([r.randrange(50) for _ in range(r.randint(20, 90))] + [0], "<u4") for _ in range(30)]
    sequences = retrieval_packing.pack(documents, window=256)
    index = retrieval_packing.Bm25Index(documents)
    left = [len(d) for d in documents]
    for sequence in sequences:
        seed = sequence[0][0]
        if sum(n for *_, n in sequence) < 256:
            break
        assert left[seed] == max(left)
        left[seed] = 0
        ranked = sorted((i for i in range(30) if left[i]), key=lambda i: (-index.neighbours(seed)[i], i))
        assert [i for i, *_ in sequence[1:]] == ranked[:len(sequence) - 1]
        for i, _, n in sequence[1:]:
            left[i] -= n
