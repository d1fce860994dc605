"""The training-data operators against brute force, and their edge cases."""

import base64
import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from rollcall.llm import (chunked_bpe, context_mixing, direct_codes, fair_toxicity, host_rules, order_minhash,
                          prefix_forest, retrieval_packing, winnow_lines, zstd_langid)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, did string, row string, key int"
SYLLABLES = {"en": "the ing ion and re er tion", "de": "der sch ung ein ich keit", "fr": "eau oi que eux ment ai"}


def prose(seed, words, lang="en"):
    r = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


def corpus():
    rows = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        text = "\n".join(prose(100 * i + k, 12 + k, lang) for k in range(6))
        if i % 10 == 0:
            text += " you idiot"
        rows.append([i, text, lang, f"src{i % 4}"])
    near = rows[3][1].split(" ")
    near[5], near[40] = "changed", "words"
    passage = "\n".join(prose(7000 + k, 20) for k in range(4))
    rows += [[60, " ".join(near), "en", "src0"], [61, rows[4][1], "de", "src1"], [62, rows[4][1], "de", None],
             [63, prose(1, 30) + "\n" + passage + "\n" + prose(2, 30), "en", "src1"],
             [64, prose(3, 40) + "\n" + passage, "en", "src2"], [65, None, None, None], [66, "", "en", "src3"],
             [67, "   \n\n ", None, "src3"], [68, "word", "en", "src3"], [69, "\n".join(prose(9000 + k, 50) for k in range(200)), "en", "src0"],
             [None, "no id at all " * 20, "en", "src0"], [70, "twice " * 60, "en", "src0"], [70, "twice " * 60, "en", "src0"],
             [71, "tab\tand  spaces\r\nI'll don't 123 <|endoftext|> é́ x y ", "en", "src0"]]
    return [(*r, len(r[1] or ""), "clash", "clash", 1) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3, "text").persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, int(i % 10 == 0)) for i in range(60)] + [(5, 1, 0), (None, 1, 1), (7, None, None), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts():
    return [(r[0], r[1]) for r in corpus()]


def test_host_measures_match_brute_force(docs, empty):
    found = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
             for r in host_rules.judge(docs).collect()}
    for doc_id, text in texts():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
                len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert want in found
    assert host_rules.judge(docs).count() == docs.count()
    assert host_rules.judge(empty).count() == 0


def test_host_rates_are_shrunk_and_bad_hosts_rejected(spark):
    rows = [(i, "short", None, "bad") for i in range(400)] + [(1000 + i, prose(i, 80), None, "good") for i in range(400)]
    rows += [(5000, prose(1, 90), None, "bad"), (5001, "short", None, "tiny")]
    out = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not out[5000].kept and out[5000].host_rejected and out[1000].kept
    assert 0 < out[5001].host_base_rate < 1


def test_beta_prior_without_hosts(spark):
    assert host_rules.beta_prior(spark.createDataFrame([], "n long, f long"), "f") == (1.0, 1.0)


def test_language_is_predicted_from_text(docs, empty):
    rows = zstd_langid.predict_languages(docs).collect()
    assert len(rows) == docs.count()
    truth = {r[0]: r[2] for r in corpus() if r[0] is not None and r[0] < 60}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (65, 66, 67):
            assert (r.lang_pred, r.accepted) == ("und", False)
    assert zstd_langid.predict_languages(empty).count() == 0
    unlabelled = zstd_langid.identify(docs.select("doc_id", "text"), empty.select("lang", "text"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_copies_do_not_shrink_a_dictionary(spark):
    rows = [(lang, prose(i, 80, lang)) for lang in ("en", "de") for i in range(300)] + [("de", prose(1, 80, "de"))] * 20_000
    rows += [("fr", prose(i, 3, "fr")) for i in range(6000)]      # short texts: as many as fill it
    learned = zstd_langid.learn_dictionaries(spark.createDataFrame(rows, "lang string, text string"))
    assert list(learned) == ["de", "fr", "en"]
    assert {len(d) for d in learned.values()} == {zstd_langid.DICTIONARY_BYTES}


def test_toxicity_scores(docs, labels, empty, spark):
    out = fair_toxicity.score_documents(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.predicted == (r.doc_id % 10 == 0) for r in rows if r.doc_id is not None and r.doc_id < 60)
    assert fair_toxicity.score_documents(empty, labels).count() == 0
    neutral = fair_toxicity.score_documents(docs, labels.limit(0)).collect()
    assert len({r.score for r in neutral}) == 1


def test_labels_of_other_documents_do_not_crowd_out_the_fit(spark, monkeypatch):
    monkeypatch.setattr(fair_toxicity, "FIT_ROWS", 400)
    rows = [(i, prose(i, 30) + (" you idiot fool" if i % 5 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = [(i, 1, int(i % 5 == 0)) for i in range(600)]
    foreign = spark.range(0, 60_000).selectExpr("id + 1000000", "1", "cast(id % 2 as int)")
    few = spark.createDataFrame(own, "doc_id long, quality int, toxic int")
    found = [sorted(map(tuple, fair_toxicity.score_documents(docs, labels).collect())) for labels in (few, few.union(foreign))]
    assert found[0] == found[1]
    assert sum(r[3] == int(r[0] % 5 == 0) for r in found[0]) >= 590


def test_identity_swaps_make_group_weights_equal():
    assert ("muslim", "christian") in fair_toxicity.swapped_mentions("One muslim spoke. Nothing here.")
    rows = [([0], 1), ([0, 2], 1), ([1], 0), ([], 0), ([2], 1)] * 40
    free, _ = fair_toxicity.fit_weights(rows, Counter(), 3)
    tied, _ = fair_toxicity.fit_weights(rows, Counter({(0, 1): 80, (1, 0): 80}), 3)
    assert abs(free[0] - free[1]) > 2 and abs(tied[0] - tied[1]) < 0.3


def test_lines_match_brute_force(docs, empty):
    out = {}
    for r in winnow_lines.dedup_lines(docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert out[65][0].text is None and out[66][0].text == "" and out[70][0].text == out[70][1].text
    passage = prose(7000, 20)
    assert passage in out[63][0].text and passage not in out[64][0].text and out[64][0].n_removed_lines == 4
    assert out[61][0].text == out[62][0].text == ""      # copies of 4
    assert out[4][0].n_removed_lines == 0
    assert out[69][0].n_lines == 200 and out[69][0].n_removed_lines == 0
    assert winnow_lines.dedup_digest(empty).count() == 0
    assert winnow_lines.dedup_lines(docs).columns[:8] == docs.columns


def test_long_documents_take_time_in_proportion(spark):
    import time
    took = {}
    for n in (1000, 20_000, 40_000):
        text = "\n".join(f"line {k} of a long text with some words" for k in range(n))
        docs = spark.createDataFrame([(1, text), (2, text), (3, text + "\nand an end")], "doc_id long, text string")
        began = time.time()
        rows = {r.doc_id: r for r in winnow_lines.dedup_lines(docs).collect()}
        took[n] = time.time() - began
        assert [rows[i].n_removed_lines for i in (1, 2, 3)] == [0, n, n] and rows[3].text == "and an end" and rows[1].text == text
    assert took[40_000] < 3 * took[20_000] + 2


def test_every_repeated_run_is_found(spark):
    r = random.Random(5)
    lines = [prose(k, r.randint(1, 30)) for k in range(40)]
    rows = [(i, "\n".join(r.choice(lines) if r.random() < 0.4 else prose(1000 * i + k, r.randint(1, 30)) for k in range(12)))
            for i in range(40)]
    rows[20] = (20, rows[20][1] + "\n" + "\n".join(rows[3][1].split("\n")[2:8]))
    out = {x.doc_id: x.n_removed_lines for x in winnow_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for d, t in rows:
        ls = t.split("\n")
        for k in (1, 2, 3):
            for i in range(len(ls) - k + 1):
                first.setdefault(tuple(ls[i:i + k]), (d, i))
    for d, t in rows:
        ls, must, may = t.split("\n"), set(), set()
        for i in range(len(ls)):
            for k in (1, 2, 3):
                if i + k <= len(ls) and first[tuple(ls[i:i + k])] < (d, i):
                    long = any(len(x.split()) >= winnow_lines.MIN_WORDS for x in ls[i:i + k])
                    must |= set(range(i, i + k)) if k == 3 or long else set()
                    may |= set(range(i, i + k)) if k > 1 or long else set()
        sizes = []
        for marked in (must, may):
            runs, total = [], 0
            for i in sorted(marked):
                if runs and i == runs[-1][-1] + 1:
                    runs[-1].append(i)
                else:
                    runs.append([i])
            sizes.append(sum(len(x) for x in runs if sum(len(ls[i].split()) for i in x) >= winnow_lines.MIN_WORDS))
        assert sizes[0] <= out[d] <= sizes[1]


def test_near_duplicates_match_all_pairs(spark):
    """Every class of texts whose alignment reaches the similarity, comparing all pairs."""
    r = random.Random(9)
    rows = []
    for i in range(25):
        base = prose(500 + i, r.choice([3, 5, 9, 20, 60, 150])).split()
        rows.append(base)
        for _ in range(r.randint(0, 4)):
            rows.append(reworded(base, r.choice([0.0, 0.05, 0.1, 0.18, 0.3]), r.randrange(10**9)))
    passage = prose(9, 60).split()
    rows += [prose(800 + i, 90).split() + passage for i in range(60)]       # a passage of two fifths
    words = [[w.lower() for w in x] for x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(words):
        for j in range(i):
            table = [0] * (len(a) + 1)
            for y in words[j]:
                before = 0
                for k, x in enumerate(a):
                    now = table[k + 1]
                    table[k + 1] = before + 1 if x == y else max(now, table[k])
                    before = now
            if 2 * table[-1] >= 0.8 * (len(a) + len(words[j])):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    out = order_minhash.near_duplicates(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(rows)], "doc_id long, text string"))
    found = {x.doc_id: x.class_id for x in out.collect()}
    wrong = [i for i in range(len(rows)) if found[i] != find(i)]
    assert len(wrong) <= 0.02 * len(rows), wrong


@pytest.mark.parametrize("n", [2, 3, 5, 12, 25, 40, 73, 200])
def test_pairs_at_the_similarity_meet(n):
    missed = 0
    for i in range(100):
        base = prose(7000 + i, n).split()
        pair = [order_minhash.buckets(order_minhash.word_hashes(" ".join(w))) for w in (base, reworded(base, math.floor(0.2 * n + 1e-9) / n, i))]
        missed += not np.intersect1d(*pair).size
    assert missed <= 8


def test_signatures_never_hide_a_link():
    r = random.Random(4)
    for _ in range(300):
        a = [r.getrandbits(64) for _ in range(r.randint(1, 300))]
        b = [x if r.random() > 0.15 else r.getrandbits(64) for x in a] + [r.getrandbits(64) for _ in range(r.randint(0, 9))]
        x, y = (order_minhash.signature(np.array(w, np.uint64)) for w in (a, b))
        apart = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert apart <= (1 - order_minhash.aligned_similarity(a, b, 0.0)) * (len(a) + len(b)) + 1e-9


def test_repeated_rows_and_clashing_columns_of_near_duplicates(spark):
    base = prose(3, 80)
    near = base.replace(" ", " x ", 1)
    rows = [(2, base, "k", 1), (1, near, "k", 1), (1, near, "k", 1), (2, base, "k", 1), (None, base, "k", 1), (1, base, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, node int").repartition(3)
    out = order_minhash.duplicate_digest(docs).collect()
    assert {(r.class_id, r.class_size) for r in out} == {(1, 6)} and {r.n_links for r in out} == {1}
    kept = order_minhash.keep_representatives(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    alone = spark.createDataFrame([(9, "a b c", "k", 1), (9, "a b c", "k", 1)], docs.schema)
    assert order_minhash.keep_representatives(alone).count() == 1


def test_near_duplicates(docs, empty):
    rows = order_minhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    cls = {r.doc_id: r.class_id for r in rows}
    assert cls[60] == cls[3] == 3 and cls[61] == cls[62] == cls[4] == 4
    assert cls[66] == cls[65] == 65 and cls[None] is None and cls[68] == 68
    assert sum(v == k for k, v in cls.items()) == len(cls) - 4
    assert order_minhash.duplicate_digest(empty).count() == 0
    kept = order_minhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {3, 4, 65, 70} <= set(ids) and not {60, 61, 62, 66} & set(ids)


def test_alignment_is_the_longest_common_subsequence():
    r = random.Random(3)
    for _ in range(200):
        a = [r.randint(0, 9) for _ in range(r.randint(1, 30))]
        b = [x for x in a if r.random() > 0.1] + [r.randint(0, 9) for _ in range(r.randint(0, 3))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        want = 2 * table[-1, -1] / (len(a) + len(b))
        got = order_minhash.aligned_similarity(a, b)
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8


def test_order_matters_to_a_sketch():
    words = order_minhash.word_hashes(prose(1, 300))
    same = (order_minhash.sketch(words) == order_minhash.sketch(words.copy())).mean()
    halves = (order_minhash.sketch(words) == order_minhash.sketch(np.concatenate([words[150:], words[:150]]))).mean()
    assert same == 1 and halves < 0.9


def test_large_group_of_near_copies_is_one_class(spark):
    base = prose(77, 120).split()
    rows = [(i, " ".join(base[:i % 100] + [f"edit{i}"] + base[i % 100 + 1:])) for i in range(300)]
    out = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in out} == {0} and {r.class_size for r in out} == {300}


def reworded(words, share, seed):
    """The words with a share of them, all over the text, replaced by new ones."""
    places = set(random.Random(seed).sample(range(len(words)), round(share * len(words))))
    return [f"new{seed}x{i}" if i in places else w for i, w in enumerate(words)]


def test_variants_of_one_text_are_one_class_though_not_close_to_each_other(spark):
    base = prose(78, 300).split()
    rows = [(i, base if i == 500 else reworded(base, 0.15, i)) for i in range(1001)]
    out = order_minhash.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    sketches = {i: order_minhash.sketch(order_minhash.word_hashes(" ".join(w))) for i, w in rows}
    met = {i for i in sketches if (sketches[i] == sketches[500]).any()}
    cls = {r.doc_id: r.class_id for r in out}
    assert len(met) > 800 and {cls[i] for i in met} == {min(met)}


def test_a_pair_with_scattered_edits_shares_a_vector():
    missed = 0
    for i in range(200):
        base = prose(5000 + i, 300).split()
        pair = [order_minhash.sketch(order_minhash.word_hashes(" ".join(w))) for w in (base, reworded(base, 0.18, i))]
        missed += not (pair[0] == pair[1]).any()
    assert missed <= 10


def test_model_scores_and_base(docs, empty):
    rows = context_mixing.score_documents(docs).collect()
    tokens = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in texts()]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in tokens]
    counts = Counter(w for (d, ws), h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter((d, h, len(ws), sum(counts[w] > 0 for w in ws), n,
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6))
                   for (d, ws), h in zip(tokens, held, strict=True))
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    sizes = Counter(len(context_mixing.normal(t)) for _, t in texts())
    assert Counter(round(-r.score * math.log2(10) / r.bits_per_byte) for r in rows) == sizes
    assert context_mixing.score_documents(empty).count() == 0


def test_model_is_a_probability():
    documents = [context_mixing.normal(prose(i, 40)) for i in range(30)]
    raw = np.frombuffer(b" ".join(documents), np.uint8).astype(int)
    code = context_mixing.Code(np.bincount(raw[:-1] * 256 + raw[1:], minlength=1 << 16))
    assert np.allclose((0.5 ** code.length.reshape(256, 256).astype(float)).sum(axis=1), 1)
    tables = [np.zeros(2 << b, np.int32) for b in code.bits]
    context_mixing.count_bits(tables, context_mixing.Stream(code, documents))
    model = context_mixing.Model(code, [context_mixing._states(t) for t in tables])
    seen, hits = np.zeros(model.weights.size + context_mixing._DEPTHS), np.zeros((2, model.maps.size))
    before = model.frozen().score(documents[:5]).sum()
    model.learn(documents, seen, hits)
    model = model.frozen()
    assert model.score(documents[:5]).sum() > before
    # the probabilities of all next bytes after a prefix add up to one
    prefix = model.score([b"the"])[0]
    total = sum(10 ** (model.score([b"the" + bytes([c])])[0] - prefix) for c in range(256))
    assert total == pytest.approx(1, abs=1e-4)


def test_tables_grow_with_the_training_bytes():
    sizes = [context_mixing.table_bits(1 << b) for b in (10, 20, 24, 26)]
    assert [s[-1] for s in sizes] == [16, 18, 22, 22] and all(len(s) == context_mixing.PREDICTORS for s in sizes)


def test_repeated_events_count_and_score_like_single_ones():
    # the same six bytes in words that began differently, empty texts, copies, and words at a text's start
    texts = ["xabcdefgh yabcdefgh", "yabcdefghi", "", None, " a ", "a", "xabcdefgh", "ÄÖ äö\x00 ß", "the cat the cat the cat"] * 3
    documents = [context_mixing.normal(t) for t in texts]
    raw = np.frombuffer(b"".join(b"\n" + t for t in documents), np.uint8).astype(int)
    code = context_mixing.Code(np.bincount(raw[:-1] * 256 + raw[1:], minlength=1 << 16), (16, 16, 16, 16, 16))
    tables = [np.zeros(2 << b, np.int32) for b in code.bits]
    context_mixing.count_bits(tables, context_mixing.Stream(code, documents))

    # one symbol after the other, by the definition of the contexts
    want = [np.zeros(2 << b, np.int32) for b in code.bits]
    mask, longer = (1 << 32) - 1, lambda b: pow(0x2C1B3C6D, b, 1 << 32)
    for text in documents:
        padded = b"\n" * 8 + text
        for i in range(8, len(padded)):
            pair = padded[i - 1] << 8 | padded[i]
            hashes, mixed = [], padded[i - 1]
            for back in range(2, 7):
                mixed = (mixed * 0x85EBCA6B + (padded[i - back] + 1) * longer(back)) & mask
                hashes += [mixed ^ mixed >> 15] if back in context_mixing.ORDERS else []
            word, h = padded[8:i].replace(b"\n", b" ").split(b" ")[-1], 0
            for k, c in enumerate(word):
                h += (c + 1) * pow(0x5851F42D4C957F2D, k, 1 << 64)
            hashes.append((h * 0xD6E8FEB86659FD93 & (1 << 64) - 1) >> 32)
            for step in code.steps[:code.length[pair], pair].tolist():
                node, bit = step >> 1, step & 1
                want[0][2 * (padded[i - 1] << 8 | node) + bit] += 1
                for table, h in zip(want[1:], hashes, strict=True):
                    table[2 * (((h ^ node * 0x27D4EB2F & mask) * 0x9E3779B1 & mask) >> 16) + bit] += 1
    assert all((a == b).all() for a, b in zip(tables, want, strict=True))
    scorer = context_mixing.Model(code, [context_mixing._states(t) for t in tables]).frozen()
    together = pickle.loads(pickle.dumps(scorer)).score(documents)
    assert together.tolist() == pytest.approx([scorer.score([t])[0] for t in documents], rel=1e-12)


def test_model_sees_the_sixth_byte_back():
    documents = [b"a bcd x \n", b"q bcd y \n"] * 200
    raw = np.frombuffer(b"".join(documents), np.uint8).astype(int)
    code = context_mixing.Code(np.bincount(raw[:-1] * 256 + raw[1:], minlength=1 << 16))
    tables = [np.zeros(2 << b, np.int32) for b in code.bits]
    context_mixing.count_bits(tables, context_mixing.Stream(code, documents))
    model = context_mixing.Model(code, [context_mixing._states(t) for t in tables])
    model = model.frozen()
    right, wrong, other = model.score([b"a bcd x", b"a bcd y", b"q bcd y"])
    assert right - wrong > 0.3 and other - model.score([b"q bcd x"])[0] > 0.3


def test_packed_counts_round_trip():
    counts = np.zeros(2 * context_mixing.BLOCK, np.int64)
    counts[[0, 7, 9]] = 65534, 65535, 1 << 40
    assert (context_mixing._unpack(context_mixing._pack(counts)) == counts).all()


def test_packing_places_every_id_once(docs, empty):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = retrieval_packing.packing_digest(docs, path).collect()
    want = Counter()
    for d, t in texts():
        want[d] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert want == got
    one = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for d, t in texts() if d != 70}
    for r in rows:
        if r.doc_id != 70:
            assert r.ids_crc32 == zlib.crc32(one[r.doc_id][r.start:r.start + r.length].tobytes())
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in ends.values())
    assert retrieval_packing.packing_digest(empty, path).count() == 0


def test_packing_prefers_lexical_neighbours():
    r = np.random.default_rng(1)
    topics = [r.integers(1000 * t, 1000 * t + 60, 300) for t in (1, 2, 1, 2, 1, 2)]
    first = retrieval_packing.pack([t.astype(np.uint32) for t in topics], 900)[0]
    assert len({i % 2 for i, _, _ in first}) == 1 and len(first) == 3


def test_direct_codes(docs, empty, spark):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = sorted(direct_codes.code_digest(spark, docs, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in texts()), key=lambda d: (d is not None, d))
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for d, t in texts()}
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
        start += r.n_tokens
    assert direct_codes.code_digest(spark, empty, path).count() == 0
    # random access to the written file
    blocks = direct_codes.materialize(direct_codes.encode_documents(docs, path), "codes")
    asked = [(d, p) for d, _ in texts() if d is not None for p in (-1, 0, 5, len(ids[d]) - 1, len(ids[d]))] + [(12345, 0)]
    found = direct_codes.read_tokens(blocks, spark.createDataFrame(asked, "doc_id long, position long")).collect()
    assert {(r.doc_id, r.position, r.token) for r in found} == {(d, p, int(ids[d][p])) for d, p in asked if d in ids and 0 <= p < len(ids[d])}
    assert direct_codes.read_tokens(blocks, spark.createDataFrame([], "doc_id long, position long")).count() == 0


def test_random_access_and_round_trip():
    ids = np.random.default_rng(2).choice([0, 5, 255, 256, 70000, 1 << 25, (1 << 32) - 1], 5000).astype(np.uint32)
    levels = direct_codes.encode_ids(ids)
    assert (direct_codes.decode_ids(*levels[:2]) == ids).all()
    assert all(direct_codes.token_at(*levels, i) == ids[i] for i in range(0, 5000, 7))
    assert len(direct_codes.decode_ids([], [])) == 0


@pytest.mark.parametrize("chunk", [40, 97, 32768])
def test_chunked_bpe(docs, empty, chunk):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, t in texts():
        ids = whole.encode_ordinary(t or "")
        want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    rows = chunked_bpe.encode_documents(docs, path, P.PATTERN, chunk, 24).collect()
    assert Counter(tuple(r) for r in rows) == want
    assert chunked_bpe.encode_documents(empty, path, P.PATTERN).count() == 0


def test_forest_recall_and_edge_cases(spark):
    r = np.random.default_rng(4)
    vectors = r.standard_normal((600, 16))
    vectors[500:560] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(9000, None), (9050, [0.0] * 16), (9100, [float("nan")] * 16), (9150, [None] * 16), (None, [1.0] * 16), (9200, [1.0])]
    frame = spark.createDataFrame([(*x, "clash") for x in rows + odd], "vec_id long, embedding array<double>, shard string")
    out = prefix_forest.search_neighbours(frame, F.col("vec_id") % 50 == 0, shard_rows=200, candidates=120).collect()
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    hits = 0
    for q in range(0, 600, 50):
        cosines = (vectors * vectors[q]).sum(axis=1) / (norms * norms[q])
        cosines[q] = -9
        best = np.lexsort((np.arange(600), -cosines))[:5].tolist()
        found = [x.vec_id for x in sorted((x for x in out if x.query_id == q), key=lambda x: x.rank)]
        hits += len(set(found) & set(best))
        assert len(found) == 5
        if q == 100 or 500 <= q < 560:
            assert found == best
    assert hits >= 0.9 * 60 and {x.query_id for x in out} == set(range(0, 600, 50))
    assert prefix_forest.search_neighbours(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_rows_do_not_push_out_neighbours(spark):
    vectors = np.random.default_rng(6).standard_normal((60, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    # an id with several vectors counts by its best one
    rows += [(60, [float(x) for x in vectors[0] * k + np.eye(16)[k]]) for k in range(1, 8)]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    five = spark.createDataFrame(rows * 5, "vec_id long, embedding array<double>").repartition(7)
    found = [sorted(tuple(r) for r in prefix_forest.search_neighbours(f, F.col("vec_id") % 20 == 0).collect()) for f in (once, five)]
    assert found[0] == found[1] and len(found[0]) == 4 * 5
    for q in (0, 20, 40):
        best = {}
        for i, v in rows:
            if i != q:
                v = np.array(v)
                best[i] = max(best.get(i, -9), float(v @ vectors[q] / np.sqrt((v @ v) * (vectors[q] @ vectors[q]))))
        assert [r[2] for r in found[0] if r[0] == q] == sorted(best, key=lambda i: -best[i])[:5]
