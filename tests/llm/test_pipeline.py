"""Stages of the corpus pipeline one after the other, against brute force."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.test_llm_operators import BASE, ITEM, NEAR, SECRET, brute_classes, brute_secrets, prose
from tunecrate.llm import quality_rules

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages(spark, tmp_path):
    texts = [(1, BASE), (2, NEAR), (3, BASE), (4, prose(150, 50) + " " + ITEM), (5, prose(100, 51) + " " + SECRET), (6, "too short"), (7, None),
             (8, ("again and again\n") * 50), (9, prose(3000, 52)), (10, prose(60, 53)), (None, prose(70, 54))]
    random.Random(2).shuffle(texts)
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = docs
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert [(f.name, f.dataType.simpleString()) for f in seen[name].schema] == [tuple(c.split()) for c in COLUMNS.split(", ")]
    ids = {n: sorted((r["doc_id"] for r in d.collect()), key=repr) for n, d in seen.items()}
    good = [1, 2, 3, 4, 5, 9, 10, None]
    assert ids["quality_rules"] == sorted(good, key=repr)
    assert brute_classes([(1, BASE), (2, NEAR)]) == [1, 1]
    assert ids["near_dedup"] == sorted([1, 4, 5, 9, 10, None], key=repr)
    assert ids["decontamination"] == sorted([1, 5, 9, 10, None], key=repr)
    masked = {r["doc_id"]: r for r in seen["secret_scan"].collect()}
    assert "[secret]" in masked[5]["text"] and not brute_secrets(masked[5]["text"]) and masked[9]["text"] == dict(texts)[9]
    assert all(r["n_chars"] == len(r["text"]) for r in masked.values())
    placed = seen["best_fit_packing"].collect()
    assert {r["doc_id"] for r in placed} == set(masked)
    assert Counter(r["doc_id"] for r in placed)[9] > 1
    whole = corpus_pipeline.run(spark, str(tmp_path))
    order = lambda d: sorted((tuple(r)[:5] for r in d), key=repr)
    assert order(whole.collect()) == order(placed)
    assert quality_rules.Limits().min_words == 10


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
