"""SimHash index, lexical search and vector codes against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from rollcall.llm import bag_search, components, gnat_codes, gray_index

DOCS = "doc_id long, text string, fp string, n string, rank int"


def words(seed, n, vocabulary=300):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def fingerprint(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return 0
    shingles = [" ".join(parts[i:i + 3]) for i in range(max(1, len(parts) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(codes, most=2):
    """Index of the first member of each code's component, comparing all pairs."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(codes))]


def simhash_rows():
    rows = []
    for i in range(60):
        text = words(i, 30 + 7 * i)
        rows.append((i, " ".join(text)))
        for k in range(3):                       # a few words changed: fingerprints a few bits apart
            edited = list(text)
            for p in random.Random(31 * i + k).sample(range(len(edited)), 1 + k):
                edited[p] = f"x{k}"
            rows.append((1000 + 10 * i + k, " ".join(edited)))
    rows += [(5000 + i, rows[4][1]) for i in range(40)]
    rows += [(3, "A Straße\tÉ x"), (3, "a straße É  X"), (6001, None), (6000, ""), (6002, "\n \t"), (6003, "one"), (6004, "one two"),
             (None, "no id " * 9), (None, rows[0][1]), (6005, " ".join(words(77, 120_000))), (6005, " ".join(words(77, 120_000)))]
    return [(*r, "clash", "clash", 1) for r in rows]


@pytest.mark.parametrize("crowd,run_rows", [(4096, 16384), (3, 20)])
def test_simhash_components_match_all_pairs(spark, monkeypatch, crowd, run_rows):
    monkeypatch.setattr(gray_index, "CROWD", crowd)
    monkeypatch.setattr(gray_index, "RUN_ROWS", run_rows)
    rows = simhash_rows()
    codes = [fingerprint(r[1]) for r in rows]
    smallest = {}
    roots = components_of(codes)
    for (doc_id, *_), root in zip(rows, roots, strict=True):
        if doc_id is not None:
            smallest[root] = min(doc_id, smallest.get(root, doc_id))
    want = Counter((r[0], f"{c:016x}", smallest.get(root)) for r, c, root in zip(rows, codes, roots, strict=True))
    found = gray_index.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(4))
    assert Counter(map(tuple, found.collect())) == want
    assert len(set(roots)) < len(set(codes)) < len(rows)       # different fingerprints are linked
    assert found.columns == ["doc_id", "fingerprint", "component_id"]


def test_simhash_of_an_empty_table(spark):
    assert gray_index.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def clustered_codes(seed, n, centres, flips):
    r = np.random.default_rng(seed)
    codes = r.integers(0, 1 << 63, centres, dtype=np.uint64)[r.integers(0, centres, n)]
    for _ in range(flips):
        codes = codes ^ (np.uint64(1) << r.integers(0, 64, n, dtype=np.uint64))
    return np.unique(codes)


@pytest.mark.parametrize("codes", [clustered_codes(1, 900, 900, 0), clustered_codes(2, 900, 6, 3), clustered_codes(3, 1500, 1, 2),
                                   np.arange(700, dtype=np.uint64), np.array([5], np.uint64)])
def test_gray_index_finds_every_pair(codes):
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 2}
    found = [(i, j) for a, b in gray_index.linked_pairs(codes) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == want


def test_gray_rank_is_the_place_in_the_reflected_code():
    codes = np.array([i ^ i >> 1 for i in range(256)], np.uint64)
    assert gray_index.gray_rank(codes).tolist() == list(range(256))


def test_linked_fingerprints_agree_in_front_of_some_order():
    r = random.Random(5)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a ^ 1 << r.randrange(64) ^ 0
        b ^= 1 << r.randrange(64)
        both = np.array([a, b], np.uint64)
        assert any(np.unique(gray_index.sort_keys(both, o)[0]).size == 1 for o in range(6))
        assert any(np.unique(gray_index.sort_keys(both, o, d)[0]).size == 1 for o in range(6) for d in range(6))


def test_close_links(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)] + [(200, 201 + i) for i in range(300)]
    links = spark.createDataFrame(chain, "leader long, node long")
    found = {r.node: r.root for r in components.close_links(links).collect()}
    want = {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, **{201 + i: 200 for i in range(300)}}
    assert found == want
    assert components.close_links(links.limit(0)).count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, k=10):
    bags = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(bool(b) for b in bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        rows = []
        for (doc_id, _), bag in zip(docs, bags, strict=True):
            n = sum(bag.values())
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * (10 + 90 * n * n_docs // total)))
                        for t in wanted if t in bag)
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if none else doc_id, -score) for rank, (score, none, doc_id) in enumerate(sorted(rows)[:k], start=1)]
    return Counter(out)


def search_tables():
    docs = [(i, " ".join(words(i, 5 + i % 40, 60)).replace("w1 ", "W1, ")) for i in range(400)]
    docs += [(900 - i, docs[7][1]) for i in range(30)] + [(2000 + i, docs[9][1] + "  !") for i in range(30)]
    docs += [(11, docs[11][1]), (None, docs[7][1]), (None, None), (3000, None), (3001, ""), (3002, "...\n"), (3003, "É w1 é_w2"),
             (3004, " ".join(words(4, 50_000, 2000)))]
    items = [(i, " ".join(words(1000 + i, 12, 70))) for i in range(25)]
    items += [(3, "w2 W2 É"), (None, "w5 w6"), (None, "w7"), (50, None), (51, " ,"), (52, "unknownterm"), (53, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"BLOCK_TERMS": 40, "GATHERED_CLASSES": 5, "SCORE_CELLS": 60}])
def test_search_matches_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(bag_search, name, value)
    docs, items = search_tables()
    table = spark.createDataFrame([(*d, 1, "clash", 2) for d in docs], "doc_id long, text string, item_id int, m string, score int")
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id int")
    found = bag_search.search(table.repartition(5), asked)
    assert Counter(map(tuple, found.collect())) == ranking(docs, items)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_search_of_empty_tables(spark):
    docs, items = search_tables()
    full = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert bag_search.search(none[0], full[1]).count() == bag_search.search(full[0], none[1]).count() == 0


def test_classes_that_share_a_hash_are_kept_apart():
    gathered = bag_search.Gathered(2)
    for m, bag, ids in ((1, b"a", [5]), (1, b"b", [4]), (2, b"a", [3]), (1, b"a", [9]), (1, b"a", [1])):
        gathered.add(b"same hash", m, bag, ids)
    assert sorted(gathered.drain()) == [(b"same hash", 1, b"a", [1, 5]), (b"same hash", 1, b"b", [4]), (b"same hash", 2, b"a", [3])]


def compressed(rows, parts=16, entries=64, rounds=2):
    """Rows of codes by comparing everything, in Python's integers."""
    whole = [(v, l, [math.floor(256 * x) for x in e]) for v, e, l in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    width = len(first[0][2]) // parts
    cut = lambda x, p: x[p * width:(p + 1) * width]
    books = [[cut(r[2], p) for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for r in whole:
                held.setdefault(nearest(cut(r[2], p), books[p])[1], []).append(cut(r[2], p))
            books[p] = [[sum(c) // len(held[i]) for c in zip(*held[i], strict=True)] if i in held else e for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, per_label = [], Counter()
    for vec_id, label, x in whole:
        found = [nearest(cut(x, p), books[p]) for p in range(parts)]
        out.append((vec_id, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
        per_label[label] += out[-1][2]
    return Counter((v, c, e, per_label[label], digest) for v, c, e, label in out)


def vector_rows(n, width=32, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.4, (12, width))
    rows = [(i, (centres[i % 12] + r.normal(0, 0.1, width)).astype(np.float32).tolist(), i % 5 if i % 7 else None) for i in range(n)]
    rows += [(n, rows[0][1], 1), (n, rows[0][1], 1), (0, rows[5][1], 2), (None, rows[6][1], 2), (n + 1, None, 1), (n + 2, [None] * width, 1),
             (n + 3, [float("nan")] * width, 1), (n + 4, [float("inf")] * width, 1), (n + 5, [0.0] * width, 9), (n + 6, [-100.25] * width, 9)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, code int, error string"


@pytest.mark.parametrize("n", [30, 400])
def test_codes_match_brute_force(spark, n):
    rows = vector_rows(n)
    table = spark.createDataFrame([(*r, 1, "clash") for r in rows], VECTORS).repartition(4)
    found = gnat_codes.compress(table)
    assert Counter(map(tuple, found.collect())) == compressed(rows)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_vectors_that_cannot_be_cut_take_no_part(spark):
    rows = vector_rows(40)
    extra = [(1000, [1.0] * 16, 1), (1001, [], 1), (1002, [1.0] * 33, 1)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows + extra], VECTORS)
    assert Counter(map(tuple, gnat_codes.compress(table).collect())) == compressed(rows)
    assert gnat_codes.compress(table.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 5, 1, 1, "x")], VECTORS)
    assert gnat_codes.compress(odd).count() == 0


def test_huge_components_are_bounded(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 16, 1, 1, "x") for i in range(4)]
    assert {r.error for r in gnat_codes.compress(spark.createDataFrame(rows, VECTORS)).collect()} == {0}


@pytest.mark.parametrize("spread", [2, 30, 5000, 1 << 26])
def test_tree_gives_the_lowest_nearest_entry(spread):
    r = np.random.default_rng(spread)
    for size in (1, 5, 9, 64, 300):
        entries, queries = r.integers(-spread, spread + 1, (size, 4)), r.integers(-spread, spread + 1, (500, 4))
        index, distance = gnat_codes.nearest_entries(gnat_codes.build_tree(entries), queries)
        every = gnat_codes.squared(queries, entries)
        assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_tree_leaves_subtrees_out(monkeypatch):
    r = np.random.default_rng(1)
    centres = r.integers(-4000, 4000, (8, 4))
    entries = centres[np.arange(64) % 8] + r.integers(-40, 41, (64, 4))
    queries = centres[r.integers(0, 8, 1000)] + r.integers(-40, 41, (1000, 4))
    visited = []
    visit = gnat_codes._visit
    monkeypatch.setattr(gnat_codes, "_visit", lambda node, q, rows, *a: (visited.append(len(rows) * len(node.splits)), visit(node, q, rows, *a)))
    gnat_codes.nearest_entries(gnat_codes.build_tree(entries), queries)
    assert sum(visited) < 0.4 * 64 * 1000
