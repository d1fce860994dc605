"""The pipeline's stages on a small corpus, each against what it should do to the rows it gets."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm.common import DOCUMENT_COLUMNS, materialize

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "the ing ion and re er tion", "de": "der sch ung ein ich keit"}


def prose(seed, words, lang="en"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang].split()) for _ in range(r.randint(1, 4))) for _ in range(words))


def corpus():
    rows = []
    for i in range(240):
        lang = ("en", "de")[i % 2]
        rows.append((i, "\n".join(prose(100 * i + k, 12 + k, lang) for k in range(6)) + (" you idiot" if i % 8 == 0 else ""), lang, f"s{i % 3}"))
    passage = "\n".join(prose(7000 + k, 20) for k in range(4))
    near = rows[3][1].split(" ")
    near[5], near[40] = "changed", "words"
    rows += [(1000, " ".join(near), "de", "s0"), (1001, rows[5][1], "de", "s1"), (1002, None, None, None), (1003, "", "en", "s1"),
             (1004, "123 456", "en", "s1"), (1005, prose(1, 90) + "\n" + passage, "en", None), (1006, prose(2, 90) + "\n" + passage, "en", "s1"),
             (None, prose(4, 50), "en", "s1"), (1007, prose(5, 60), "en", "s1"), (1007, prose(5, 60), "en", "s1"),
             (1008, " ".join(prose(90 + k, 1000) for k in range(30)), "en", "s2")]
    return [(*r, len(r[1]) if r[1] else None) for r in rows]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipeline"))
    extra = spark.createDataFrame(corpus(), DOCS).withColumn("root", F.lit("clash"))
    extra.repartition(3).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, int(i % 8 == 0)) for i in range(240)] + [(None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before and after each stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d or 0))


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "line_dedup", "near_dedup", "packing"]
    for name in ("toxicity", "language_id", "line_dedup", "near_dedup"):
        assert all(set(r) == set(DOCUMENT_COLUMNS) for r in stages[name][1])


def test_toxic_documents_go_and_only_they(stages):
    before, after = stages["toxicity"]
    assert set(ids(before)) - set(ids(after)) == {i for i in range(240) if i % 8 == 0}
    assert len(after) == len(before) - 30


def test_documents_without_a_language_go(stages):
    before, after = stages["language_id"]
    gone = set(ids(before)) - set(ids(after))
    assert {1002, 1003, 1004} <= gone and len(gone) <= 5
    assert {r["doc_id"]: r["lang"] for r in after}.get(1005) == "en"


def test_shared_passage_keeps_its_first_place(stages):
    before, after = ({r["doc_id"]: r for r in rows} for rows in stages["line_dedup"])
    assert set(before) == set(after)
    passage = prose(7000, 20)
    assert passage in after[1005]["text"] and passage not in after[1006]["text"]
    assert after[1006]["n_chars"] == len(after[1006]["text"]) and after[1005]["n_chars"] == before[1005]["n_chars"]


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    kept = ids(after)
    assert len(kept) == len(set(kept)) and 3 in kept and 1000 not in kept and 1007 in kept and None in kept
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(r["text"] == texts[r["doc_id"]] for r in after)
    # those that went are near a kept one; a document whose every line went before is empty
    assert set(ids(before)) - set(kept) <= {1000, 1001} | {d for d, t in texts.items() if not t}


def test_every_kept_document_is_packed_once(stages):
    before, pieces = stages["packing"]
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before}
    for doc_id, n in want.items():
        own = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == doc_id)
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:], strict=False)) and sum(b for _, b in own) == n
    per = {}
    for p in pieces:
        per.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    sizes = [sum(n for _, n in v) for v in per.values()]
    assert max(sizes) <= 1024 and all(n == 1024 or n & (n - 1) == 0 for n in sizes)


def test_run_is_the_stages_in_turn(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda p: (p["doc_id"] or -1, p["start"])
    assert sum(p["length"] for p in stages["packing"][1]) == sum(p.length for p in got)
    assert sorted({key(p.asDict())[0] for p in got}) == sorted({key(p)[0] for p in stages["packing"][1]})


def test_stages_of_an_empty_table(spark, sf_dir):
    none = spark.createDataFrame([], DOCS + ", root string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name


def test_sequence_of_ids_is_the_documents(stages):
    pieces = stages["packing"][1]
    by = {}
    for p in pieces:
        by.setdefault((p["sequence_id"]), []).append((p["offset"], p["length"]))
    for own in by.values():
        own = np.array(sorted(own))
        assert own[0, 0] == 0 and (own[1:, 0] == np.cumsum(own[:, 1])[:-1]).all()
