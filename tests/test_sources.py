"""Text contracts, sinks and model files."""

import gzip
import os
import random

import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tunecrate.operators import click_models
from tunecrate.sources import readers, sinks


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_triples_drop_bad_rows(spark, tmp_path):
    path = put(tmp_path, "t", "u1|a|2.5\nu1|b|x\nu2|a\nu3|c|1|9\nu2|c|7\n")
    assert sorted(tuple(r) for r in readers.triples(spark, path).collect()) == [("u1", "a", 2.5), ("u2", "c", 7.0)]


def test_lists_pairs_pools(spark, tmp_path):
    got = readers.user_lists(spark, put(tmp_path, "l", "u=1,2\nbroken\nv=3\n")).collect()
    assert {r["user_id"]: r["items"] for r in got} == {"u": ["1", "2"], "v": ["3"]}
    singers = readers.pairs(spark, put(tmp_path, "s", "1|x\n2|a|b\n"), ("item_id", "singer"))
    assert [tuple(r) for r in singers.collect()] == [("1", "x")]
    pool = readers.pool(spark, put(tmp_path, "p", "a|b|9.1E-4|3\na|c|0.5|x\n"))
    assert [tuple(r) for r in pool.collect()] == [("a", "b", 9.1e-4, 3)]
    idf = readers.scalar_dictionary(spark, put(tmp_path, "i", "a|1.5\nb|\n"))
    assert [tuple(r) for r in idf.collect()] == [("a", 1.5)]
    assert [r[0] for r in readers.id_list(spark, put(tmp_path, "d", "7\n\n 8 \n")).collect()] == ["7", "8"]


def test_vectors_in_three_forms(spark, tmp_path):
    a = readers.feature_vectors(spark, put(tmp_path, "a", "x|1=2.5\ny|1=z\n"))
    assert [tuple(r) for r in a.collect()] == [("x", [1.0, 2.5])]
    b = readers.feature_vectors(spark, put(tmp_path, "b", "x=1|2\n"), "=", "|")
    assert b.first()["features"] == [1.0, 2.0]
    c = readers.feature_vectors(spark, put(tmp_path, "c", "x=5.0=3|4\n"), "=", "|", norm=True)
    assert tuple(c.first()) == ("x", 5.0, [3.0, 4.0])
    d = readers.labelled_samples(spark, put(tmp_path, "e", "1|0.5=2\nq|1=1\n"))
    assert [tuple(r) for r in d.collect()] == [(1.0, [0.5, 2.0])]


def test_other_contracts(spark, tmp_path):
    s = readers.sentences(spark, put(tmp_path, "s", "k!1,2,3\n\n")).collect()
    assert [tuple(r) for r in s] == [("k", ["1", "2", "3"])]
    t = readers.timelines(spark, put(tmp_path, "t", "u|10,20,x\n")).select(F.unix_timestamp("ts").alias("t"))
    assert sorted(r["t"] for r in t.collect()) == [10, 20]
    k = readers.click_samples(spark, put(tmp_path, "k", "s|p|a,b|b|1|2.5\ns|p|a|b\n")).first()
    assert (k["clicked"], k["shown"], k["features"]) == (["a", "b"], "b", [1.0, 2.5])
    x = readers.playlist_texts(spark, put(tmp_path, "x", "9|name|intro|t1@BI_ROW_SPLIT@t2\n")).first()
    assert (x["doc_id"], x["name"], x["blocks"]) == ("9", "intro", ["t1", "t2"])
    e = readers.edges(spark, put(tmp_path, "e", "a|A|2\nA|a|2\nb|A|1\n"))
    assert sorted(tuple(r) for r in e.collect()) == [("A", "a", 2.0), ("A", "b", 1.0), ("a", "A", 2.0), ("b", "A", 1.0)]
    v = readers.libsvm(spark, put(tmp_path, "v", "1 1:0.5 3:2\n0 2:1\n"), 3)
    assert [r["features"] for r in v.orderBy("label").collect()] == [[0.0, 1.0, 0.0], [0.5, 0.0, 2.0]]


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 0.5), ("c", "d", 1.0)], "x string, y string, s double")
    out = str(tmp_path / "out")
    sinks.write_text(sinks.lines(df, "|", "x", "y", "s"), out, gzip=True, files=3)
    parts = [f for f in os.listdir(out) if f.endswith(".txt.gz")]
    text = "".join(gzip.open(os.path.join(out, f), "rt").read() for f in parts)
    assert sorted(text.split()) == ["a|b|0.5", "c|d|1.0"]
    sinks.write_text(sinks.lines(df.limit(1), "|", "x"), out)
    assert spark.read.text(out).count() == 1
    sinks.append_metric(spark, str(tmp_path / "log"), "areaUnderROC", 0.75)
    sinks.append_metric(spark, str(tmp_path / "log"), "areaUnderROC", 0.5)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert len(lines) == 2 and all(x[19:].startswith(" | areaUnderROC = 0.") for x in lines)


def test_sharded_sink(spark, tmp_path):
    sinks.write_sharded(spark.range(100), str(tmp_path / "s"), "id")
    assert sorted(d for d in os.listdir(tmp_path / "s") if d.startswith("shard")) == [f"shard={i}" for i in range(10)]
    assert spark.read.parquet(str(tmp_path / "s")).where("shard = 3").count() == 10


@pytest.mark.parametrize("sep", [None, "|"])
def test_day_partitions(spark, tmp_path, sep):
    name = "day_table_text" if sep else "day_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        sinks.create_day_table(spark, name, "songid STRING, channel STRING", sep=sep)
        row = lambda v: spark.createDataFrame([(v, "c")], "songid string, channel string")
        for day, v in (("2019-08-01", "a"), ("2019-08-02", "b"), ("2019-08-03", "c"), ("2019-08-02", "z")):
            sinks.overwrite_day(row(v), name, day)
        assert sorted(r["songid"] for r in spark.table(name).collect()) == ["a", "c", "z"]
        one = readers.table_days(spark, name, "2019-08-02")
        assert [r["songid"] for r in one.collect()] == ["z"]
        assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()
        sinks.overwrite_days(spark.createDataFrame([("2019-08-02", "p", "q"), ("2019-08-04", "r", "s")], "dt string, songid string, channel string"), name)
        assert sorted((r["songid"], r["dt"]) for r in spark.table(name).collect()) == [
            ("a", "2019-08-01"), ("c", "2019-08-03"), ("p", "2019-08-02"), ("r", "2019-08-04")
        ]
        sinks.overwrite_day(row("z"), name, "2019-08-02")
        assert sorted(r["songid"] for r in readers.last_days(spark, name, "2019-08-03", 2).collect()) == ["c", "z"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_neighbour_lines(spark):
    pool = spark.createDataFrame([("a", "x", 0.25), ("a", "y", 0.5)], "src string, dst string, sim double")
    assert sinks.neighbour_lines(pool, 2).first()["neighbours"] == "y:0.500000,x:0.250000"


def test_models_save_and_score(spark, tmp_path):
    rows = [(float(i % 2), [float(i % 2) + (i % 5) / 50, float(i % 7)]) for i in range(120)]
    samples = spark.createDataFrame(rows, "label double, features array<double>")
    model = click_models.gbdt_train(samples, "5_3_0.1")
    path = str(tmp_path / "m")
    sinks.save_model(model, path)
    again = sinks.load_model(GBTClassificationModel, path)
    scored = click_models.gbdt_score(samples, again).select("features", "margin", "prob", "label").collect()
    for r in scored[:10]:
        tree_sum = sum(w * t.predict(Vectors.dense(r["features"])) for w, t in zip(again.treeWeights, again.trees))
        assert r["margin"] == pytest.approx(tree_sum)
    assert all((r["prob"] > 0.5) == (r["label"] == 1.0) for r in scored)


def test_rank_serve_keeps_users_without_features(spark):
    rows = [(float(i % 2), [float(i % 2), 1.0, float(i % 3)]) for i in range(60)]
    model = click_models.gbdt_train(spark.createDataFrame(rows, "label double, features array<double>"), "3_2_0.1")
    lists = spark.createDataFrame([("u", f"i{j}") for j in range(4)] + [("new", "i1"), ("new", "i2")], "user_id string, item_id string")
    users = spark.createDataFrame([("u", [1.0, 1.0])], "user_id string, features array<double>")
    items = spark.createDataFrame([(f"i{j}", [float(j % 3)]) for j in range(4)], "item_id string, features array<double>")
    got = click_models.rank_serve(lists, users, items, model, 2).collect()
    assert sum(r["user_id"] == "u" for r in got) == 2
    assert sorted(r["item_id"] for r in got if r["user_id"] == "new") == ["i1", "i2"]


@pytest.mark.parametrize("kind", ["boosted", "forest", "serve", "split"])
def test_samples_and_lists_are_made_once(spark, kind):
    made = spark.sparkContext.accumulator(0)

    def counted(df):
        def each(batches):
            for batch in batches:
                made.add(len(batch))
                yield batch

        return df.mapInPandas(each, df.schema)

    rows = [(float(i % 2), [float(i % 2), 1.0, float(i % 3)]) for i in range(60)]
    samples = spark.createDataFrame(rows, "label double, features array<double>")
    if kind in ("boosted", "forest"):
        train = {"boosted": lambda s: click_models.gbdt_train(s, "3_2_0.1"), "forest": lambda s: click_models.rf_train(s, 3, 2)}[kind]
        train(counted(samples))
        assert made.value == 60
        return
    lists = spark.createDataFrame([(u, i) for u in range(10) for i in range(4)], "user_id long, item_id long")
    users = spark.createDataFrame([(u, [1.0, 1.0]) for u in range(5)], "user_id long, features array<double>")
    items = spark.createDataFrame([(i, [float(i % 3)]) for i in range(4)], "item_id long, features array<double>")
    if kind == "serve":
        got = click_models.rank_serve(counted(lists), users, items, click_models.gbdt_train(samples, "3_2_0.1"), 2).collect()
    else:
        scored, plain = click_models.rf_score_split(counted(lists), users, items, click_models.rf_train(samples, 3, 2))
        got = scored.drop("prob").unionByName(plain).collect()
    assert len(got) == (30 if kind == "serve" else 40) and made.value == 40


def test_bucketed_pool_is_joined_where_it_lies(spark, tmp_path):
    from tunecrate.operators import recall

    r = random.Random(9)
    pool = [(s, (s + k) % 50, round(1 / k + s / 1000, 6), k) for s in range(50) for k in range(1, 8)]
    plays = [(u, r.randrange(60) if u % 3 else 7) for u in range(300) for _ in range(3)] + [(1, None), (None, 4)]
    pool = spark.createDataFrame(pool, "src long, dst long, sim double, rank int")
    plays = spark.createDataFrame(plays, "user_id long, item_id long")
    stored = sinks.write_bucketed(pool, "bucketed_pool", "src", f"{tmp_path}/pool", "rank")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        expected = sorted(map(tuple, recall.pool_recall(plays, pool, 6, 9).collect()), key=repr)
        for share in (1.0, 0.05):  # no hot item; item 7, with a third of the rows, is hot
            found = recall.bucketed_pool_recall(plays, stored, 6, 9, share)
            assert sorted(map(tuple, found.collect()), key=repr) == expected
            plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
            joins = [i for i, x in enumerate(plan) if "SortMergeJoin" in x]
            scan = next(i for i, x in enumerate(plan) if "FileScan" in x and i > joins[-1])
            depth = lambda i: len(plan[i]) - len(plan[i].lstrip(" :+-"))
            side, above = [], depth(scan)
            for i in range(scan - 1, joins[-1], -1):
                if depth(i) < above:
                    side, above = [*side, plan[i]], depth(i)
            assert side and not any("Exchange" in x for x in side) and "Bucketed: true" in plan[scan]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
