"""Operators on small hand-made frames, against plain Python."""

import math
import os
import random
import re
import time
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunecrate import session
from tunecrate.functions import ids, measures, vectors
from tunecrate.operators import boosting, cells, embeddings, evaluation, factors, features, filters, lists, nearest, pair_similarity, recall, sessions, walk
from tunecrate.operators import ranking_windows as rw


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_lists(df):
    out = defaultdict(list)
    for r in df.orderBy("user_id", "pos").collect():
        out[r["user_id"]].append(r["item_id"])
    return dict(out)


# --- windows ---------------------------------------------------------------------------


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n_with_a_hot_key(spark, n):
    rows = [("hot", i, (i * 37) % 1000) for i in range(4000)] + [("cold", i, i) for i in range(5)]
    df = frame(spark, rows, "k string, i int, s int")
    got = rw.top_n(df, ["k"], [F.desc("s"), F.col("i")], n).where("k = 'hot'").orderBy("rank").collect()
    want = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[2], r[1]))[:n]
    assert [(r["i"], r["rank"]) for r in got] == [(w[1], j + 1) for j, w in enumerate(want)]


def test_running_total_over_buckets(spark):
    rows = [("a", i, float(i % 7)) for i in range(500)] + [("b", i, 1.0) for i in range(3)]
    df = frame(spark, rows, "k string, i int, v double").withColumn("b", F.floor(F.col("i") / 50))
    got = {(r["k"], r["i"]): r["t"] for r in rw.running_total(df, ["k"], "b", [F.col("i")], F.col("v"), "t").collect()}
    for k in ("a", "b"):
        total = 0.0
        for _, i, v in [r for r in rows if r[0] == k]:
            total += v
            assert got[k, i] == pytest.approx(total)


def test_dense_ids_are_dense(spark):
    df = frame(spark, [(f"k{i % 321}",) for i in range(2000)], "k string")
    got = sorted(r["n"] for r in rw.dense_ids(df, "k", "n").collect())
    assert got == list(range(321))


def test_capped_top_n_equals_the_walk(spark):
    rnd = random.Random(3)
    rows = [(u, i, round(rnd.random(), 3), rnd.choice(["x", "y", None])) for u in range(4) for i in range(30)]
    df = frame(spark, rows, "user_id int, item_id int, s double, g string")
    got = rw.capped_top_n(df, ["user_id"], "g", [F.desc("s"), F.col("item_id")], 3, 12).orderBy("user_id", "rank").collect()
    want = []
    for u in range(4):
        seen, taken = defaultdict(int), 0
        for _, i, s, g in sorted((r for r in rows if r[0] == u), key=lambda r: (-r[2], r[1])):
            if taken < 12 and (g is None or seen[g] < 3):
                seen[g] += 1
                taken += 1
                want.append((u, i, taken))
    assert [(r["user_id"], r["item_id"], r["rank"]) for r in got] == want


def test_rank_cutoff_keeps_ties(spark):
    df = frame(spark, [(1, 5.0), (2, 5.0), (3, 4.0), (4, 4.0), (5, 1.0)], "i int, s double")
    assert sorted(r["i"] for r in rw.rank_cutoff(df, "i", "s", 3).collect()) == [1, 2, 3, 4]
    assert rw.rank_cutoff(df, "i", "s", 50).count() == 5


def test_nth_largest_is_exact(spark, monkeypatch):
    rnd = random.Random(3)
    values = [rnd.choice([0.5, 0.5, 2.0**-1070, -7.25, rnd.random(), rnd.random() * 1e300, -rnd.random() * 1e-300]) for _ in range(900)]
    values += [float("inf"), float("inf"), float("-inf"), float("nan"), 1.7976931348623157e308]
    order = sorted(values, key=lambda x: (x != x, x if x == x else 0.0), reverse=True)
    df = frame(spark, [(x,) for x in values] + [(None,)], "s double")
    for parts, places in ((1000, (1, 3, 4, 17, 450, len(values))), (40, (333,))):
        monkeypatch.setattr(rw, "PARTS", parts)
        for n in places:
            got = rw.nth_largest(df, "s", n)
            assert got == order[n - 1] or (got != got and order[n - 1] != order[n - 1]), n
    big = frame(spark, [(2**60 + i,) for i in range(300)], "s long")
    assert rw.nth_largest(big, "s", 7) == 2**60 + 293
    assert rw.nth_largest(df, "s", len(values) + 1) is None and rw.nth_largest(df.where("s < 0 AND s > 0"), "s", 1) is None
    many = spark.range(200_000).selectExpr("id", "id % 70000 AS s")
    cut = sorted((i % 70000 for i in range(200_000)), reverse=True)[49_999]
    assert rw.nth_largest(many, "s", 50_000) == cut
    kept = rw.rank_cutoff(many, "id", "s", 50_000)
    assert kept.count() == sum(i % 70000 >= cut for i in range(200_000))
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()


def test_hot_items_of_falling_norm_end_early(spark, monkeypatch):
    monkeypatch.setattr(factors, "FIRST_ITEMS", 16)
    rnd = np.random.default_rng(9)
    users, items = rnd.normal(size=(40, 8)), rnd.normal(size=(900, 8)) * rnd.pareto(2.0, size=(900, 1))
    vec = lambda m: [(k, [float(x) for x in m[k]]) for k in range(len(m))]
    args = (
        frame(spark, vec(users), "user_id int, factor array<double>"), frame(spark, vec(items), "item_id int, factor array<double>"),
        frame(spark, [(u, 3 * u) for u in range(40)], "user_id int, item_id int"), frame(spark, [(i, f"s{i % 90}") for i in range(800)], "item_id int, singer string"),
    )
    want = None
    for block in (1000, 100):
        monkeypatch.setattr(factors, "HOT_BLOCK", block)
        made = spark.sparkContext.accumulator(0)
        lists_ = factors._hot_lists(*args, 2, 12, made)
        best = rw.capped_top_n(lists_, ["user_id"], "singer", [F.desc("score"), F.col("item_id")], 2, 12).collect()
        got = {(r["user_id"], r["rank"]): r["item_id"] for r in best}
        if want is None:
            want = {}
            for u in range(40):
                seen, rank = defaultdict(int), 0
                for i in sorted(range(900), key=lambda i: (-round(float(users[u] @ items[i]), 9), i)):
                    name = f"s{i % 90}" if i < 800 else "Unknown"
                    if i != 3 * u and seen[name] < 2 and rank < 12:
                        seen[name], rank = seen[name] + 1, rank + 1
                        want[u, rank] = i
        assert got == want
        assert 0 < made.value < 40 * 900 * 0.6


# --- functions and filters ---------------------------------------------------------------


def test_traffic_specs(spark):
    df = frame(spark, [("1234",), ("18",), ("x28",), ("118",), ("9968",)], "u string")
    keep = lambda spec, m=5: sorted(r["u"] for r in filters.traffic_bucket(df, "u", spec, m).collect())
    assert keep("all") == ["118", "1234", "18", "9968", "x28"]
    assert keep("8") == ["118", "18", "9968", "x28"]
    assert keep("8-1") == ["118", "9968"]  # 11 % 5 and 96 % 5
    assert keep("8-6", 10) == ["9968"]


def test_vector_format(spark):
    df = frame(spark, [([1.0, 0.999999, 0.25, 0.123456, -0.000001, -2.5, 0.0],)], "v array<double>")
    line = df.select(vectors.format_vector(F.col("v")).alias("t")).first()["t"]
    assert line == "1=1=0.25=0.12346=0=-2.50=0"


def test_canonical_collection_and_modules(spark):
    df = frame(spark, [("collection_2_77_12_9",), ("4711",), ("collection_1_5_3",)], "p string")
    got = [r[0] for r in df.select(ids.canonical_collection(F.col("p"))).collect()]
    assert got == ["collection_2_77_12_0", "4711", "collection_1_5_3"]
    paths = {
        "搜索/手动输入": "搜索-主动", "首页/搜索/热门搜索": "搜索-其他", "搜索": "搜索-其他", "搜索/a手动输入": "搜索-其他",
        "/播放页/关联推荐/相似歌曲": "播放页-相似歌曲", "/播放页/x": "播放页", "/歌单/推荐": "歌单",
        "收藏/私人FM": "猜你喜欢", "/首页/个性化推荐/新歌": "首页推荐-新歌", "nothing": "本地模块",
    }
    df = frame(spark, [(p,) for p in paths], "p string")
    assert {r["p"]: r["m"] for r in df.select("p", measures.path_module(F.col("p")).alias("m")).collect()} == paths


def test_effective_seconds(spark):
    rows = [(7800, 9000, 1, 10000), (7900, 1, 4000, 10000), (7900, 1, 900000, 10000), (7900, 1, -5, 10000)]
    df = frame(spark, rows, "v int, s int, l int, n int")
    got = [r[0] for r in df.select(measures.effective_seconds(*[F.col(c) for c in "vsln"])).collect()]
    assert got == [9.0, 4.0, 10.0, 0.0]


def test_id_mapping_reads_both_ids(spark):
    dim = frame(spark, [("1", "g1"), ("2", "g2"), (None, "g3")], "l string, g string")
    got = sorted((r["any_id"], r["global_id"]) for r in filters.id_mapping(dim, "l", "g").collect())
    assert got == [("1", "g1"), ("2", "g2"), ("g1", "g1"), ("g2", "g2"), ("g3", "g3")]


def test_split_is_complementary(spark):
    df = spark.range(2000)
    a, b = filters.split_by_key(df, 0.8, 7, "id")
    assert a.count() + b.count() == 2000 and a.join(b, "id").count() == 0
    assert 1500 < a.count() < 1700


# --- recall ----------------------------------------------------------------------------


def test_decayed_recall_is_the_fold(spark):
    rnd = random.Random(5)
    sources = [("u", f"s{r}", r) for r in range(1, 7)]
    pool = [(f"s{r}", f"d{rnd.randrange(4)}x{j}", round(rnd.random(), 3)) for r in range(1, 7) for j in range(2)]
    pool = list({(a, b): (a, b, s) for a, b, s in pool}.values())
    excluded = frame(spark, [("u", "d0x0")], "user_id string, item_id string")
    got = recall.decayed_recall(
        frame(spark, sources, "user_id string, item_id string, rank int"),
        frame(spark, pool, "src string, dst string, score double"), excluded, 50,
    ).collect()
    score = {}
    for _, src, rank in sources:
        for a, b, s in sorted(pool):
            if a == src and b != "d0x0":
                c = (1 - 0.3 * (rank - 1)) * s
                score[b] = c if b not in score else 0.6 * (score[b] + c)
    assert {r["item_id"]: r["score"] for r in got} == {k: pytest.approx(x, abs=1e-8) for k, x in score.items()}


def test_decayed_recall_weighs_rank_four_by_a_tenth(spark):
    got = recall.decayed_recall(
        frame(spark, [("u", "s", 4)], "user_id string, item_id string, rank int"), frame(spark, [("s", "d", 1e7)], "src string, dst string, score double"),
        frame(spark, [("u", None), ("u", "x")], "user_id string, item_id string"),
    )
    assert got.first()["score"] == 1e6  # 1000000.0000000009 with 1 - 0.3 * 3


def test_favourite_and_dislike_recall(spark):
    plays = frame(spark, [(1, 10, 9.0), (1, 11, 3.0), (1, 12, 0.2), (2, 10, 1.0)], "user_id int, item_id int, dur double")
    near = frame(spark, [(10, 20, 1), (10, 21, 2), (11, 20, 1), (11, 22, 2), (12, 23, 1)], "src int, dst int, nb_rank int")
    assert as_lists(recall.favourite_recall(plays, near)) == {1: [20, 21, 22]}
    assert [(r[0], r[1]) for r in recall.dislike_expand(plays, near).collect()] == [(1, 23)]


def test_singer_candidates_need_no_neighbours(spark):
    plays = frame(spark, [(1, 10, 9.0)], "user_id int, item_id int, dur double")
    singer = frame(spark, [(10, 30 + i, i) for i in range(1, 9)], "src int, dst int, rank int")
    near = frame(spark, [], "src int, dst int, nb_rank int")
    assert as_lists(recall.singer_recall(plays, singer, near)) == {1: [31, 32, 33, 34]}


def test_pool_recall_sorts_numbers(spark):
    src = frame(spark, [(1, 10)], "user_id int, item_id int")
    pool = frame(spark, [(10, 20, 9.1e-4, 1), (10, 21, 0.9, 2), (10, 22, 0.5, 120)], "src int, dst int, sim double, rank int")
    assert as_lists(recall.pool_recall(src, pool, 100, 80)) == {1: [21, 20]}
    gone = frame(spark, [(1, 21)], "user_id int, item_id int")
    assert as_lists(recall.pool_recall_filtered(src, pool, gone, 100, 80, 1)) == {1: [20]}


def test_favourites_meet_as_lists(spark):
    plays = frame(spark, [(u, i, 2.0 + i) for u in range(5) for i in range(40)], "user_id int, item_id int, dur double")
    liked = rw.top_n(plays, ["user_id"], [F.desc("dur"), F.col("item_id")], 30, "fav_rank")
    near = [(i, (i * 7 + j * j) % 500, j) for i in range(40) for j in range(1, 60)]
    assert recall._expand(liked, frame(spark, near, "src int, dst int, nb_rank int")).count() == 5  # was a row per neighbour
    want = list(dict.fromkeys(d for i in range(39, 9, -1) for s, d, _ in near if s == i))
    assert as_lists(recall.favourite_recall(plays, frame(spark, near, "src int, dst int, nb_rank int"))) == {u: want for u in range(5)}


@pytest.mark.parametrize("keep", [1, 7, 80, 5000])
def test_pool_recall_hands_on_few_hits(spark, monkeypatch, keep):
    rnd = random.Random(4)
    plays = [(u, i) for u in range(4) for i in range(u * 20, u * 20 + 45)]
    near = [(i, 1000 + rnd.randrange(300), rnd.choice([0.1, 0.2, 0.3, round(rnd.random(), 4)])) for i in range(120) for _ in range(60)]
    near = sorted(set(near), key=lambda r: (r[0], -r[2], r[1]))
    pool = frame(spark, [(*r, 1 + sum(x[0] == r[0] for x in near[:j])) for j, r in enumerate(near)], "src int, dst int, sim double, rank int")
    handed, best = [], recall._best_hits
    monkeypatch.setattr(recall, "_best_hits", lambda hits, n: (handed.append(hits.count()), best(hits, n))[1])
    got = as_lists(recall.pool_recall(frame(spark, plays, "user_id int, item_id int"), pool, None, keep))
    for u in range(4):
        hits = sorted((-s, d, i) for i, d, s in near if (u, i) in plays)[:keep]
        assert got[u] == list(dict.fromkeys(d for _, d, _ in hits))
    if keep == 80:
        assert handed[0] < 4 * 3 * keep  # of some 10,000


def test_hot_explore(spark):
    hot = frame(spark, [(i,) for i in range(100)], "item_id int")
    users = frame(spark, [(u,) for u in range(20)], "user_id int")
    gone = frame(spark, [(u, i) for u in range(20) for i in range(50)], "user_id int, item_id int")
    got = as_lists(recall.hot_explore(users, hot, gone))
    assert all(len(set(x)) == len(x) and min(x) >= 50 for x in got.values())
    full = as_lists(recall.hot_explore(users, hot, gone.limit(0)))
    assert all(len(set(x)) == 30 for x in full.values()) and len(set(map(tuple, full.values()))) > 10


def test_tag_fill_fills_the_deficit(spark):
    ranked = frame(spark, [("u", "a", 0.9, 1), ("u", "t1", 0.8, 2)], "user_id string, item_id string, score double, rank bigint")
    tags = frame(spark, [("u", [0.1, 0.7, 0.7]), ("v", [1.0, 0.0, 0.0])], "user_id string, weights array<double>")
    tagged = frame(spark, [(1, f"t{i}") for i in range(5)] + [(0, "z")], "tag bigint, item_id string")
    got = recall.tag_fill(ranked, tags, tagged, 5).collect()
    u = {r["item_id"]: r["rank"] for r in got if r["user_id"] == "u"}
    assert len(u) == 5 and sorted(u.values()) == [1, 2, 3, 4, 5] and set(u) <= {"a", "t0", "t1", "t2", "t3", "t4"}
    assert [r["item_id"] for r in got if r["user_id"] == "v"] == ["z"]


def test_tag_fill_takes_any_number_of_tags(spark):
    ranked = frame(spark, [("u", "a", 0.9, 1)], "user_id string, item_id string, score double, rank bigint")
    tags = frame(spark, [("u", f"tag{i}", 1.0 + (i == 6) + (i == 8)) for i in range(9)], "user_id string, tag string, weight double")
    tagged = frame(spark, [(f"tag{i}", f"t{i}") for i in range(9)], "tag string, item_id string")
    got = recall.tag_fill(ranked, tags, tagged, 5).orderBy("rank").collect()
    assert [r["item_id"] for r in got] == ["a", "t6"]


def test_author_cap_leaves_unknown_authors(spark):
    ranked = frame(spark, [("u", i, 1.0 - i / 100) for i in range(8)], "user_id string, item_id int, score double")
    authors = frame(spark, [(i, "x") for i in range(4)], "item_id int, author string")
    got = [r["item_id"] for r in recall.author_cap(ranked, authors, 2, 5).orderBy("rank").collect()]
    assert got == [0, 1, 4, 5, 6]


# --- lists -----------------------------------------------------------------------------


def lst(spark, rows):
    return frame(spark, [(u, i, p) for u, items in rows.items() for p, i in enumerate(items, 1)], "user_id string, item_id string, pos bigint")


def test_pool_merge_fill_interleave(spark):
    a, b = lst(spark, {"u": ["1", "2", "3"]}), lst(spark, {"u": ["3", "4", "1"], "w": ["9"]})
    gone = frame(spark, [("u", "2")], "user_id string, item_id string")
    assert as_lists(lists.pool_merge([a, b], gone)) == {"u": ["1", "3", "4"], "w": ["9"]}
    assert as_lists(lists.fill_to_n(a, b, 5)) == {"u": ["1", "2", "3", "3", "4"], "w": ["9"]}
    assert as_lists(lists.fill_to_n(a, b, None))["u"] == ["1", "2", "3", "3", "4", "1"]
    longer = lst(spark, {"u": ["a", "b", "c", "d"]})
    assert as_lists(lists.interleave(a, longer)) == {"u": ["1", "a", "2", "b", "3", "c"]}
    assert as_lists(lists.interleave(a, b, distinct=True)) == {"u": ["1", "3", "2", "4"]}


def test_group_list_filter(spark):
    group = lst(spark, {"u": ["1", "2", "3", "4"], "w": ["1"]})
    pairs = lambda *x: frame(spark, list(x), "user_id string, item_id string")
    got = lists.group_list_filter(group, pairs(("u", "2")), pairs(("u", "3")), pairs(("u", "9")))
    assert as_lists(got) == {"u": ["1", "4"]}


def test_exclusions_travel_once_and_match_as_in_joins(spark):
    named = "user_id string, item_id string"
    base = spark.createDataFrame([("u", "1", 1), ("u", "2", 2), ("u", None, 3), ("v", "1", 1)], f"{named}, pos bigint")
    gone = spark.createDataFrame([("u", "2"), ("u", "2"), ("u", None), (None, "1")], named)
    ctr = spark.createDataFrame([("u", "9"), ("u", None)], named)
    merged = lists.pool_merge([base], gone)
    served = lists.group_list_filter(base, gone, gone, ctr)
    for df in (merged, served):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange hashpartitioning(") == 1
    assert sorted(map(tuple, merged.collect()), key=repr) == [("u", "1", 1), ("u", None, 2), ("v", "1", 1)]
    assert sorted(map(tuple, served.collect()), key=repr) == [("u", "1", 1), ("u", None, 2)]


def test_tail_replace(spark):
    base = lst(spark, {"u": ["1", "2", "3", "4"], "w": ["5", "6"]})
    picks = frame(spark, [("u", "8", 1), ("u", "9", 2), ("w", "5", 1)], "user_id string, item_id string, pick bigint")
    assert as_lists(lists.tail_replace(base, picks)) == {"u": ["1", "2", "9", "8"], "w": ["5", "6"]}


def test_fresh_picks_respect_all_filters(spark):
    pairs = lambda *x: frame(spark, list(x), "user_id string, item_id string")
    cand = pairs(*[("u", str(i)) for i in range(6)])
    invalid = frame(spark, [("0",), ("1",)], "item_id string")
    got = lists.fresh_picks(cand, invalid, pairs(("u", "2"), ("u", "3")), 5).collect()
    assert sorted(r["item_id"] for r in got) == ["4", "5"]


def test_random_mix_rounds(spark):
    base = lst(spark, {"u": [f"b{i}" for i in range(10)]})
    extra = lst(spark, {"u": ["e0", "e1", "e2"]})
    got = as_lists(lists.random_mix(base, extra))["u"]
    assert len(got) == len(set(got)) and set(got) == {f"b{i}" for i in range(10)} | {"e0", "e1", "e2"}
    assert got.index("e0") < got.index("e1") < got.index("e2")
    assert as_lists(lists.random_mix(base, extra)) == {"u": got}


def test_random_mix_does_not_broadcast_its_rounds(spark):
    base = frame(spark, [(u, i, i) for u in range(300) for i in range(1, 90)], "user_id int, item_id int, pos int")
    extra = frame(spark, [(u, 100 + i, i) for u in range(300) for i in range(1, 4)], "user_id int, item_id int, pos int")
    mixed = lists.random_mix(base, extra)
    mixed.count()
    plan = mixed._jdf.queryExecution().executedPlan()
    mixed.collect()
    joined = [line for line in plan.toString().splitlines() if "Join" in line and "pos" in line.split("Inner")[0]]
    assert joined and not any("Broadcast" in line for line in joined)


def test_cosine_blocks_are_large_and_cut_in_slices(monkeypatch):
    assert nearest._blocks(120_000, nearest.BLOCK_ROWS, 3) <= 4  # was 30: each target travels so often
    rnd = np.random.default_rng(2)
    a, b = rnd.normal(size=(40, 4)), rnd.normal(size=(60, 4)).round(0) + 0.5
    b[30:50] = b[0]  # copies: the smaller ids win
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    b[59] = np.nan
    as_frame = lambda x, **kw: pd.DataFrame({"id": np.arange(len(x)), "v": list(x), **kw})
    monkeypatch.setattr(nearest, "CELLS", 300)
    got = nearest.best_of_blocks(5, True)(as_frame(a), as_frame(b[::-1], part="x").assign(id=np.arange(60)[::-1]))
    cos = np.round(a @ b.T, 9)
    for i in range(40):
        want = [j for j in sorted(range(59), key=lambda j: (-cos[i, j], j)) if j != i][:5]
        assert list(got[got["a"] == i]["b"]) == want


def test_format_and_explode(spark):
    base = lst(spark, {"u": ["c", "a", "b"]})
    text = lists.format_list(base)
    assert text.first()["items"] == "c,a,b"
    back = lists.explode_list(text.select("user_id", F.split("items", ",").alias("items")))
    assert as_lists(back) == {"u": ["c", "a", "b"]}


# --- factors ---------------------------------------------------------------------------


def test_fold_in_solves_the_system(spark, monkeypatch):
    monkeypatch.setattr(factors, "ROWS_PER_PART", 5)  # spread the busy user over parts
    rnd = np.random.default_rng(1)
    y = rnd.normal(size=(40, 4))
    items = frame(spark, [(i, [float(x) for x in y[i]]) for i in range(40)], "item_id int, factor array<double>")
    idf = frame(spark, [(i, 0.5 + i / 40) for i in range(40)], "item_id int, idf double")
    plays = [("busy", i, float(1 + i)) for i in range(40)] + [("calm", 3, 2.0), ("calm", 5, 99.0)]
    got = factors.als_fold_in(frame(spark, plays, "user_id string, item_id int, dur double"), items, idf, 40.0, 0.1)
    got = {r["user_id"]: np.array(r["factor"]) for r in got.collect()}
    for user in ("busy", "calm"):
        mine = [(i, min(d, 30.0)) for u, i, d in plays if u == user]
        lhs, rhs = y.T @ y + 0.1 * len(mine) * np.eye(4), np.zeros(4)
        for i, d in mine:
            c = 1 + 40 * np.log10(d / 0.01 + 1) * (0.5 + i / 40)
            lhs += (c - 1) * np.outer(y[i], y[i])
            rhs += c * y[i]
        assert np.allclose(got[user], np.linalg.solve(lhs, rhs))


def test_partial_sums_merge_in_levels(spark, monkeypatch):
    monkeypatch.setattr(factors, "ROWS_PER_PART", 4)
    monkeypatch.setattr(factors, "MERGE", 3)
    rnd = np.random.default_rng(8)
    y = rnd.normal(size=(150, 3))
    ratings = [(u, i, 0.5 + (u * i) % 7) for u, n in ((1, 150), (2, 3), (3, 40)) for i in range(n)]
    items = frame(spark, [(i, [float(x) for x in y[i]]) for i in range(150)], "item_id int, factor array<double>")
    got = factors.solve_factors(frame(spark, ratings, "user_id int, item_id int, rating double"), items, 10.0, 0.1).collect()
    assert len(got) == 3
    for r in got:
        own = [(i, c) for u, i, c in ratings if u == r["user_id"]]
        lhs = y.T @ y + sum(10 * c * np.outer(y[i], y[i]) for i, c in own) + 0.1 * len(own) * np.eye(3)
        assert np.allclose(r["factor"], np.linalg.solve(lhs, sum((1 + 10 * c) * y[i] for i, c in own)))


def test_implicit_als_lowers_the_loss(spark):
    rnd = random.Random(2)
    plays = frame(spark, [(f"u{u}", f"i{i}", 1 + rnd.random() * 9) for u in range(30) for i in range(20) if (u + i) % 3 == 0],
                  "user_id string, item_id string, dur double")
    idf = factors.item_idf(plays)
    ratings = factors.idf_rating(plays, idf)
    known = {(r["user_id"], r["item_id"]): r["rating"] for r in ratings.collect()}

    def loss(iterations):
        params = factors.FactorParams(10.0, 0.01, 4, iterations)
        items = {r["item_id"]: np.array(r["factor"]) for r in factors.implicit_als(plays, idf, params).collect()}
        frame_items = frame(spark, [(k, [float(x) for x in f]) for k, f in items.items()], "item_id string, factor array<double>")
        users = {r["user_id"]: np.array(r["factor"]) for r in factors.solve_factors(ratings, frame_items, 10.0, 0.01).collect()}
        return sum((1 + 10 * known.get((u, i), 0)) * ((1.0 if (u, i) in known else 0.0) - users[u] @ items[i]) ** 2
                   for u in users for i in items)

    assert loss(5) < loss(1)


def test_trainer_blocks_are_ranges_of_equal_ratings(spark):
    r = np.random.default_rng(9)
    # three groups that share nothing, their ids shifted; the later users have more ratings
    rows = sorted({(1000 * g + int(u), 1000 * g + int(i)) for g in range(3) for u, i in zip(r.integers(0, 40, 300) ** 2 // 40, r.integers(0, 60, 300))})
    ratings = frame(spark, [(u, i, 1.0) for u, i in rows], "user_id long, item_id long, rating double")
    place = {}
    for key in ("user_id", "item_id"):
        ids = {x[key]: x["n"] for x in factors._block_ids(ratings, key, "n", 6, len(rows)).collect()}
        assert len(set(ids.values())) == len(ids) == ratings.select(key).distinct().count() and min(ids.values()) >= 0
        block = [ids[k] % 6 for k in sorted(ids)]
        assert block == sorted(block)
        place[key] = {k: n % 6 for k, n in ids.items()}
        held = np.bincount([place[key][x[0 if key == "user_id" else 1]] for x in rows], minlength=6)
        most = max(sum(1 for x in rows if x[0 if key == "user_id" else 1] == k) for k in ids)
        assert held.max() <= len(rows) / 6 + most
    sent = {(u, place["item_id"][i]) for u, i in rows}
    assert len(sent) < 3.5 * len(place["user_id"])  # of six blocks; without locality nearly all


@pytest.mark.parametrize("users_at_once", [2, 1024])
def test_candidates_meet_item_factors_once_per_block(spark, monkeypatch, users_at_once):
    monkeypatch.setattr(factors, "LISTED_USERS", users_at_once)
    rnd = np.random.default_rng(8)
    uf, itf = rnd.normal(size=(7, 3)), rnd.normal(size=(40, 3))
    singer = [(i, f"s{i % 4}") for i in range(30)] + [(3, "s0"), (3, "other")]  # some have two singers, some none
    cand = {u: [int(x) for x in rnd.choice(45, size=25)] for u in range(8)}  # repeated and unknown items, a user without a factor
    gone = {u: {int(x) for x in rnd.choice(45, size=5)} for u in range(4)}
    vec = lambda m: [(k, [float(x) for x in m[k]]) for k in range(len(m))]
    pairs = lambda d: frame(spark, [(u, i) for u in d for i in d[u]], "user_id int, item_id int")
    got = factors._candidate_lists(
        frame(spark, vec(uf), "user_id int, factor array<double>"), pairs(cand), frame(spark, vec(itf), "item_id int, factor array<double>"),
        pairs(gone), frame(spark, singer, "item_id int, singer string"), 12, 2, 6,
    )
    found = defaultdict(list)
    for r in got.collect():
        found[r["user_id"]].append((-r["score"], r["item_id"], r["singer"]))
    want = {}
    for u in range(7):
        usable = {i for i in cand[u] if i < 40 and i not in gone.get(u, ())}
        if len(usable) > 12:
            rows, seen = [], defaultdict(int)
            names = {i: [n for x, n in singer if x == i] or ["Unknown"] for i in usable}
            for score, i, n in sorted((-round(float(itf[i] @ uf[u]), 9), i, n) for i in usable for n in names[i]):
                if seen[n] < 2 and len(rows) < 6:
                    seen[n] += 1
                    rows.append((score, i, n))
            want[u] = rows
    assert want and {u: sorted(x) for u, x in found.items()} == want


@pytest.mark.parametrize("block", [20000, 9])
def test_cf_recommend_equals_the_greedy_walk(spark, monkeypatch, block):
    monkeypatch.setattr(factors, "HOT_BLOCK", block)
    rnd = np.random.default_rng(4)
    uf, itf = rnd.normal(size=(6, 3)), rnd.normal(size=(50, 3))
    singer = {i: f"s{i % 5}" for i in range(40)}
    cand = {u: [int(x) for x in rnd.choice(50, size=30 if u % 2 else 5, replace=False)] for u in range(6)}
    gone = {u: {int(x) for x in rnd.choice(50, size=8, replace=False)} for u in range(6)}
    bad, hot_n = {7, 8}, 25
    vec = lambda m: [(k, [float(x) for x in m[k]]) for k in range(len(m))]
    pairs = lambda d: frame(spark, [(u, i) for u in d for i in d[u]], "user_id int, item_id int")
    got = factors.cf_recommend(
        frame(spark, vec(uf), "user_id int, factor array<double>"), pairs(cand), frame(spark, vec(itf), "item_id int, factor array<double>"),
        frame(spark, [(i,) for i in range(50)], "item_id int"), frame(spark, [(i,) for i in bad], "item_id int"), pairs(gone),
        frame(spark, list(singer.items()), "item_id int, singer string"), frame(spark, [(0,), (1,)], "user_id int"),
        min_candidates=10, length=6, extra=4, per_singer=2, hot_n=hot_n,
    )
    lists_ = defaultdict(list)
    for r in got.orderBy("user_id", "rank").collect():
        lists_[r["user_id"]].append((r["item_id"], r["tag"]))
    usable = [i for i in range(50) if i not in bad]
    hot = sorted(usable, key=lambda i: -(itf[i] @ itf[i]))[:hot_n]
    for u in range(6):
        pool = [i for i in set(cand[u]) if i not in bad and i not in gone[u]]
        pool = pool if len(pool) > 10 else hot
        want, seen, limit = [], defaultdict(int), 10 if u < 2 else 6
        for i in sorted(pool, key=lambda i: (-round(float(itf[i] @ uf[u]), 9), i)):
            name = singer.get(i, "Unknown")
            if i not in gone[u] and seen[name] < 2 and len(want) < limit:
                seen[name] += 1
                want.append((i, 1 if u < 2 else 0))
        assert lists_[u] == want


@pytest.mark.parametrize("plan", [{}, {"local_edges": 3, "node_block": 2}, {"local_nodes": 2, "node_block": 3, "checkpoint_every": 2}])
def test_walk_equals_matrix_power(spark, plan):
    rows = [("A", "a", 2.0), ("A", "b", 1.0), ("B", "b", 3.0), ("B", "c", 1.0), ("C", "c", 1.0), ("C", "d", 2.0), ("A", "d", 0.5)]
    both = rows + [(b, a, w) for a, b, w in rows]
    names = sorted({x for a, b, _ in both for x in (a, b)})
    m = np.zeros((len(names),) * 2)
    for a, b, w in both:
        m[names.index(b), names.index(a)] += w
    m /= m.sum(axis=0)
    got = walk.personal_walk(
        frame(spark, both, "src string, dst string, w double"), frame(spark, [("a",), ("c",)], "root string"),
        frame(spark, [(x,) for x in "abcd"], "item_id string"), rounds=12, **plan,
    ).collect()
    for root in ("a", "c"):
        r = np.zeros(len(names))
        r[names.index(root)] = 0.15
        p = r.copy()
        for _ in range(11):
            p = 0.85 * m @ p + r
        mine = {x["item_id"]: x["score"] for x in got if x["root"] == root}
        assert mine == {x: pytest.approx(p[names.index(x)], abs=1e-8) for x in "abcd" if x != root}


@pytest.mark.parametrize("rounds, most", [(12, 12), (90, 60)])
def test_walk_of_separate_components_needs_no_tiles(spark, monkeypatch, rounds, most):
    r = np.random.default_rng(3)
    rows = sorted({(f"{c}u{u}", f"{c}i{i}") for c in range(4) for u, i in zip(r.integers(0, 5, 25), r.integers(0, 9, 25))})
    rows = [(a, b, float(w)) for (a, b), w in zip(rows, r.integers(1, 9, len(rows)))]
    rows += [(f"p{n}", f"p{n + 1}", 1.0) for n in range(20)]  # a path
    both = rows + [(b, a, w) for a, b, w in rows]
    names = sorted({x for a, b, _ in both for x in (a, b)})
    m = np.zeros((len(names),) * 2)
    for a, b, w in both:
        m[names.index(b), names.index(a)] += w
    m /= m.sum(axis=0)
    mass = 0.15 * np.eye(len(names))
    for _ in range(rounds - 1):
        mass = 0.85 * m @ mass + 0.15 * np.eye(len(names))
    items = [x for x in names if "i" in x or x[0] == "p"]

    def no_tiles(*_):
        raise AssertionError("every component is within the limits")

    made = spark.sparkContext.accumulator(0)
    times = walk._ByDegree.times
    monkeypatch.setattr(walk, "_tiled_walk", no_tiles)
    asked = frame(spark, [(x,) for x in items], "root string")
    edges = frame(spark, both, "src string, dst string, w double")
    got = walk.personal_walk(edges, asked, asked.toDF("item_id"), rounds=rounds, local_nodes=22, local_edges=60)
    found = {(x["root"], x["item_id"]): x["score"] for x in got.collect()}
    expected = {(a, b): mass[names.index(b), names.index(a)] for a in items for b in items if a != b}
    assert found == {k: pytest.approx(p, abs=1e-9) for k, p in expected.items() if round(p, 9) > 0 or k in found}
    # all steps of one component: the later ones follow from the last two
    own = [n for n, x in enumerate(names) if x[0] == "0"]
    part = m[np.ix_(own, own)]
    u, v = np.nonzero(part.T)
    order = np.lexsort((u, v))
    monkeypatch.setattr(walk._ByDegree, "times", lambda self, state: made.add(1) or times(self, state))
    state = walk._all_steps(u[order], v[order], 0.85 * part.T[u, v][order], np.arange(len(own)), len(own), 0.85, rounds, [])
    assert np.abs(state - mass[np.ix_(own, own)]).max() < 1e-10 and made.value < most


def test_walk_of_all_items_starts_from_each(spark, tmp_path):
    from tunecrate.plans.vector_queries import walk_all
    from tunecrate.plans.views import View

    r = np.random.default_rng(5)
    bought = sorted({(int(u), int(x)) for u, x in zip(r.integers(1, 8, 60), r.integers(1, 24, 60))})
    lines = [(n, x, float(r.integers(1, 50))) for n, (_, x) in enumerate(bought)]
    frame(spark, lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    frame(spark, [(n, u, None) for n, (u, _) in enumerate(bought)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    names = sorted({f"u{u}" for u, _ in bought} | {f"i{x}" for _, x in bought})
    m = np.zeros((len(names),) * 2)
    for (u, x), (_, _, w) in zip(bought, lines):
        a, b = names.index(f"u{u}"), names.index(f"i{x}")
        m[a, b] = m[b, a] = w
    m /= m.sum(axis=0)
    mass = 0.15 * np.eye(len(names))
    for _ in range(100):
        mass = 0.85 * m @ mass + 0.15 * np.eye(len(names))
    items = [x for x in names if x[0] == "i"]
    found = {(x["root"], x["item_id"]): x["score"] for x in walk_all(View(spark, str(tmp_path))).collect()}
    expected = {(a, b): mass[names.index(b), names.index(a)] for a in items for b in items if a != b}
    expected = {k: p for k, p in expected.items() if p > 0}
    assert len(items) > 16 and found == {k: pytest.approx(p, abs=1e-8) for k, p in expected.items()}


# --- similarity ------------------------------------------------------------------------


def brute_cosine(a, b, n, self_=True):
    out = {}
    for i, x in a.items():
        scored = [(-round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 9), j) for j, y in b.items() if not (self_ and i == j)]
        out[i] = [j for _, j in sorted(scored)[:n]]
    return out


@pytest.mark.parametrize("shape", ["spread", "clusters", "copies"])
def test_cosine_topn_is_exact(spark, monkeypatch, shape):
    monkeypatch.setattr(nearest, "LEAST_ROWS", 40)
    rnd = np.random.default_rng(9)
    m = rnd.normal(size=(240, 5))
    if shape == "clusters":
        m = rnd.normal(size=(8, 5))[rnd.integers(0, 8, 240)] * 5 + rnd.normal(size=(240, 5)) * 0.2
    if shape == "copies":
        m[:90] = m[0]  # one vector holds more than a third of the rows
    vecs = {i: m[i] for i in range(240)}
    df = frame(spark, [(i, [float(x) for x in v]) for i, v in vecs.items()], "id int, features array<double>")
    got = defaultdict(list)
    for r in nearest.cosine_topn(df, df, 7, block_rows=50).orderBy("a", "rank").collect():
        got[r["a"]].append(r["b"])
    assert dict(got) == brute_cosine(vecs, vecs, 7)


def test_cosine_topn_by_part_and_two_sides(spark):
    rnd = np.random.default_rng(10)
    a, b = {i: rnd.normal(size=4) for i in range(20)}, {i: rnd.normal(size=4) for i in range(60)}
    mk = lambda d: frame(spark, [(i, [float(x) for x in v]) for i, v in d.items()], "id int, features array<double>")
    got = nearest.cosine_topn(mk(a), mk(b).withColumn("shard", F.col("id") % 3), 2, part="shard", exclude_self=False)
    rows = defaultdict(list)
    for r in got.orderBy("a", "shard", "rank").collect():
        rows[r["a"], r["shard"]].append(r["b"])
    for s in range(3):
        want = brute_cosine(a, {i: v for i, v in b.items() if i % 3 == s}, 2, False)
        assert all(rows[i, str(s)] == want[i] for i in a)


def brute_tags(sets, t):
    reps = {}
    for d in sorted(sets):
        reps.setdefault(frozenset(sets[d]), d)
    first = sorted(reps.values())
    out = {(reps[frozenset(sets[d])], d): 1.0 for d in sets if reps[frozenset(sets[d])] != d}
    for i, a in enumerate(first):
        for b in first[i + 1:]:
            cos = len(sets[a] & sets[b]) / (len(sets[a]) * len(sets[b])) ** 0.5
            if cos > t:
                out[a, b] = pytest.approx(cos)
    return out


@pytest.mark.parametrize("t", [0.0, 0.3, 0.6, 0.9])
def test_tag_cosine(spark, t):
    rnd = random.Random(11)
    sets = {d: {"hot"} | {f"t{int(rnd.paretovariate(1)) % 40}" for _ in range(rnd.randrange(1, 9))} for d in range(80)}
    sets.update({d: {"x", "y"} for d in range(80, 110)})  # copies
    rows = [(d, x) for d, s in sets.items() for x in s]
    got = pair_similarity.tag_cosine(frame(spark, rows, "doc_id int, tag string"), t)
    assert {(r["a"], r["b"]): r["cos"] for r in got.collect()} == brute_tags(sets, t)


@pytest.mark.parametrize("longest", [0, 3, 64])
def test_tag_cosine_of_short_and_long_sets(spark, monkeypatch, longest):
    monkeypatch.setattr(pair_similarity, "SHORT_SET", longest)
    rnd = random.Random(3)
    sets = {d: {f"t{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 12))} for d in range(70)}
    tags = frame(spark, [(d, x) for d, s in sets.items() for x in s], "doc_id int, tag string")
    got = pair_similarity.tag_cosine(tags, 0.3).collect()
    assert {(r["a"], r["b"]): r["cos"] for r in got} == brute_tags(sets, 0.3) and len(got) == len(brute_tags(sets, 0.3))


def test_short_sets_are_compared_where_they_meet(spark):
    rows = [(d, (d * 7 + k * k) % 50) for d in range(200) for k in range(4)]
    pairs = pair_similarity.tag_cosine(frame(spark, rows, "doc_id int, tag int"), 0.3)
    assert "array_intersect" in pairs._jdf.queryExecution().executedPlan().toString()


def test_copies_are_written_out_on_demand(spark):
    sets = {1: "abc", 2: "abc", 3: "abd", 4: "abd", 5: "xyz", 6: "xyz", 7: "q"}
    tags = frame(spark, [(d, x) for d, v in sets.items() for x in v], "doc_id int, tag string")
    pairs, groups = pair_similarity.tag_cosine(tags, 0.5), pair_similarity.copy_groups(tags, "doc_id", "tag")
    got = sorted(tuple(r) for r in pair_similarity.similar_to(frame(spark, [(2,), (5,), (7,)], "doc_id int"), pairs, groups).collect())
    assert got == [(2, 1, 1.0), (2, 3, pytest.approx(2 / 3)), (2, 4, pytest.approx(2 / 3)), (5, 6, 1.0)]


@pytest.mark.parametrize("t, work, block", [(0.1, 1 << 21, 1 << 20), (0.5, 1 << 21, 1 << 20), (0.1, 40, 90), (0.5, 7, 200), (0.0, 300, 400)])
def test_tfidf_cosine(spark, monkeypatch, t, work, block):
    monkeypatch.setattr(pair_similarity, "WORK", work)
    rnd = random.Random(12)
    docs = {d: [f"w{int(rnd.paretovariate(0.7)) % 60}" for _ in range(rnd.randrange(3, 40))] for d in range(60)}
    for d in range(60, 90):
        docs[d] = docs[0][::-1]
    terms = frame(spark, [(d, w) for d, ws in docs.items() for w in ws], "doc_id int, term string")
    got = {(r["a"], r["b"]): r["cos"] for r in pair_similarity.tfidf_cosine(terms, t, block).collect()}
    count = {d: {w: ws.count(w) for w in ws} for d, ws in docs.items()}
    df = defaultdict(int)
    for c in count.values():
        for w in c:
            df[w] += 1
    vec = {d: {w: n / len(c) * np.log(len(docs) / df[w]) for w, n in c.items() if df[w] > 1} for d, c in count.items()}
    norm = {d: sum(x * x for x in v.values()) ** 0.5 for d, v in vec.items()}
    want = {(0, d): 1.0 for d in range(60, 90)}
    for a in range(60):
        for b in range(a + 1, 60):
            if norm[a] and norm[b]:
                cos = sum(x * vec[b].get(w, 0.0) for w, x in vec[a].items()) / norm[a] / norm[b]
                if cos > t:
                    want[a, b] = pytest.approx(cos)
    assert got == want


@pytest.mark.parametrize("rows, near", [(3, 500_000), (1024, 0)])
def test_all_pairs_of_copies(spark, monkeypatch, rows, near):
    monkeypatch.setattr(pair_similarity, "COPIES", rows)
    monkeypatch.setattr(pair_similarity, "BROADCAST_COPIES", near)
    kinds = ["abc", "abd", "xyz", "abce", "q"]
    sets = {d: set(kinds[d * d % 7 % 5]) for d in range(40)}
    tags = frame(spark, [(d, x) for d, v in sets.items() for x in v], "doc_id int, tag string")
    cosines = {(a, b): len(sets[a] & sets[b]) / (len(sets[a]) * len(sets[b])) ** 0.5 for a in sets for b in sets if a < b}
    got = pair_similarity.tag_cosine(tags, 0.5, whole=True).collect()
    want = {p: pytest.approx(c) for p, c in cosines.items() if c > 0.5}
    assert {(r["a"], r["b"]): r["cos"] for r in got} == want and len(got) == len(want)
    texts = frame(spark, [(d, x) for d, v in sets.items() for x in v], "doc_id int, term string")
    linked = pair_similarity.tfidf_cosine(texts, 0.1).collect()
    first = {d: min(e for e in sets if sets[e] == sets[d]) for d in sets}
    known = {(r["a"], r["b"]): r["cos"] for r in linked if first[r["a"]] != first[r["b"]]}
    want = {(a, b): pytest.approx(1.0 if first[a] == first[b] else known[tuple(sorted((first[a], first[b])))])
            for a, b in cosines if first[a] == first[b] or tuple(sorted((first[a], first[b]))) in known}
    got = pair_similarity.tfidf_cosine(texts, 0.1, whole=True).collect()
    assert {(r["a"], r["b"]): r["cos"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("step", [session.cut_lineage, lambda df: session.written(df, "step")])
def test_a_finished_step_leaves_no_shuffle_files(spark, step):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    df, before = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), files()
    kept = step(df)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and kept.agg(F.sum("count")).first()[0] == df.agg(F.sum("count")).first()[0] == 1000


def test_blocks_of_texts_meet_without_a_shuffle(spark):
    rows = [(d, f"w{(d * 7 + k * k) % 50}") for d in range(200) for k in range(4)]
    plan = pair_similarity.tfidf_cosine(frame(spark, rows, "doc_id int, term string"), 0.3, 100)._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_documents_and_stop_words(spark):
    rows = [("1", "n", ["a"]), ("2", "n", ["a", "b"]), ("3", "n", ["a", "b", "c"]), ("x", "n", ["a"]), ("-4", "n", ["a"])]
    docs = pair_similarity.build_documents(frame(spark, rows, "doc_id string, name string, blocks array<string>"))
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == {"1": "n,a", "2": "n", "3": "n,c"}
    text = frame(spark, [(1, "Été gt the <br> été, x2")], "doc_id int, text string")
    kept = pair_similarity.remove_stop_words(pair_similarity.tokens(text), frame(spark, [("the",)], "term string"))
    assert sorted(r["term"] for r in kept.collect()) == ["x", "été", "été"]


# --- features, evaluation, sessions ------------------------------------------------------


def test_profiles(spark):
    vec = frame(spark, [("a", [1.0, 0.0, 4.0]), ("b", [0.0, 2.0, 0.0])], "item_id string, features array<double>")
    scores = frame(spark, [("u", "a", 3.0), ("u", "b", 1.0), ("u", "zz", 9.0), ("z", "a", 0.0)], "user_id string, item_id string, score double")
    got = {r["user_id"]: r["profile"] for r in features.user_profile_vector(scores, vec, 3, sliced=2, at_least=0.75).collect()}
    assert got == {"u": pytest.approx([0.75, 0.5, 1.0, 0.0, 3.0]), "z": [0.0] * 5}
    members = frame(spark, [("p", "a"), ("p", "b"), ("p", "b"), ("q", "zz")], "playlist_id string, item_id string")
    means = {r["playlist_id"]: r["features"] for r in features.playlist_vector(members, vec).collect()}
    assert means == {"p": pytest.approx([0.5, 1.0, 2.0])}


def test_width_check_and_click_label(spark):
    df = frame(spark, [([1.0, 2.0],), ([1.0],)], "features array<double>")
    assert features.feature_width_check(df, 2).first().asDict() == {"rows": 2, "bad_width": 1, "ok": False}
    assert features.feature_width_check(df.limit(0), 2).first()["ok"] is False
    clicks = frame(spark, [(["a", "b"], "b"), (["a"], "b")], "clicked array<string>, shown string")
    assert [r["label"] for r in features.click_label(clicks).collect()] == [1.0, 0.0]


def test_auc_with_ties(spark):
    rnd = random.Random(13)
    rows = [(rnd.randrange(12) / 10, rnd.randrange(2)) for _ in range(300)]
    got = evaluation.auc(frame(spark, rows, "score double, label int")).first()["auc"]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got == pytest.approx(wins / len(pos) / len(neg))


def test_hit_at_1(spark):
    rows = [("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.9, 0), ("b", 0.2, 1), ("c", 0.9, 1)]
    got = evaluation.hit_at_1(frame(spark, rows, "user_id string, pred double, label int")).first()
    assert (got["users"], got["hits"]) == (2, 2)


def test_focus_sessions_across_buckets(spark):
    times = {"u": [86390, 86395, 86405, 90000, 90010], "w": [5], "x": [0, 100, 200]}
    rows = [(u, t) for u, ts in times.items() for t in ts]
    df = frame(spark, rows, "user_id string, s long").select("user_id", F.timestamp_seconds("s").alias("ts"))
    got = sorted((r["user_id"], r["session_end"], r["seconds"], r["events"]) for r in sessions.focus_sessions(df, 100).collect())
    assert got == [("u", 86405.0, 15.0, 3), ("u", 90010.0, 10.0, 2), ("w", 5.0, 0.0, 1), ("x", 0.0, 0.0, 1), ("x", 100.0, 0.0, 1), ("x", 200.0, 0.0, 1)]


def test_interval_overlap_counts_each_pair_once(spark):
    fg = frame(spark, [("u", 0.0, 10000.0), ("u", 0.0, 10000.0), ("u", 20000.0, 20001.0)], "user_id string, start double, end double")
    li = frame(spark, [("u", 3000.0, 12000.0, "m"), ("u", 30000.0, 30010.0, "m"), ("w", 0.0, 5.0, "m")], "user_id string, start double, end double, module string")
    got = sessions.interval_overlap(fg, li).collect()
    assert [(r["module"], r["seconds"], r["users"]) for r in got] == [("m", 14000.0, 1)]


def brute_boost(rows, rounds, depth, l2, least=1.0):
    """Margins of exact second-order trees on rows (label, values); null goes left."""
    y = np.array([r[0] for r in rows])
    x = np.array([[-np.inf if v is None else v for v in r[1]] for r in rows])
    m = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = p - y, p * (1 - p)
        score = lambda own: g[own].sum() ** 2 / (h[own].sum() + l2)
        nodes = [np.ones(len(y), bool)]
        for _ in range(depth):
            below = []
            for own in nodes:
                best = (1e-6, None)
                for f in range(x.shape[1]):
                    for cut in np.unique(x[own, f])[1:]:
                        left, right = own & (x[:, f] < cut), own & (x[:, f] >= cut)
                        gain = (score(left) + score(right) - score(own)) / 2
                        if h[left].sum() >= least and h[right].sum() >= least and gain > best[0] + 1e-10:
                            best = (gain, (left, right))
                below += [own] if best[1] is None else best[1]
            nodes = below
        for own in nodes:
            m[own] -= g[own].sum() / (h[own].sum() + l2)
    return m


@pytest.mark.parametrize("l2", [0.0, 2.5, 40.0])
def test_boosting_against_brute_force(spark, l2):
    rnd = random.Random(21)
    rows = []
    for _ in range(400):
        values = [float(rnd.randrange(9)), rnd.choice([None, 0.25, -1.5, 3.0]), float(rnd.randrange(5))]
        rows.append((float(rnd.random() < (values[0] + (values[1] or 0) * values[2]) / 16), values))
    samples = frame(spark, [(i, *r) for i, r in enumerate(rows)], "id int, label double, features array<double>")
    noise = frame(spark, [(-1, None, [1.0, 1.0, 1.0]), (-2, 1.0, None)], "id int, label double, features array<double>")
    trees = boosting.boost(samples.union(noise), rounds=4, depth=3, l2=l2, every=2)
    got = {r["id"]: r["margin"] for r in boosting.boosted_margin(samples.union(noise), trees).collect()}
    expected = brute_boost(rows, 4, 3, l2)
    assert [got[i] for i in range(len(rows))] == pytest.approx(list(expected), abs=1e-8)
    assert got[-2] is None and len(got) == len(rows) + 2


def test_boosting_without_rows_or_cuts(spark):
    schema = "label double, features array<double>"
    none = frame(spark, [], schema)
    assert boosting.boost(none) == [] and boosting.boosted_margin(none, []).count() == 0
    flat = frame(spark, [(1.0, [2.0])] * 30 + [(0.0, [2.0])] * 10, schema)
    trees = boosting.boost(flat, rounds=1)
    assert trees[0].splits == {} and trees[0].leaves[1] == pytest.approx(10 / (10 + 2.5))
    ends = frame(spark, [(1.0, [float("inf")])] * 30 + [(0.0, [float("-inf")])] * 30 + [(1.0, [float("nan")])] * 10, schema)
    scored = boosting.boosted_margin(ends, boosting.boost(ends, rounds=2, least_hessian=0.5))
    assert {(r["label"], r["margin"] > 0) for r in scored.collect()} == {(1.0, True), (0.0, False)}


def test_boosting_with_many_values_learns(spark):
    rnd = random.Random(4)
    rows = [(i, float(a + b > 1), [a, b, c]) for i, (a, b, c) in enumerate([(rnd.random(), rnd.random(), rnd.random()) for _ in range(3000)])]
    samples = frame(spark, rows, "id int, label double, features array<double>")
    trees = boosting.boost(samples, rounds=6, depth=4, bins=32)
    scored = boosting.boosted_margin(samples, trees)
    assert evaluation.auc(scored, score="margin").first()["auc"] > 0.98
    assert all(2 <= n < 32 for t in trees for n in t.leaves)


def test_cells_answer_every_query_with_bounded_slices(spark):
    rnd = np.random.default_rng(12)
    middle = rnd.normal(size=(30, 8))
    points = [middle[rnd.integers(30) if i % 3 else 0] + 0.3 * rnd.normal(size=8) for i in range(2400)]  # one cell holds a third
    points += [points[5]] * 40 + [np.zeros(8)]
    df = frame(spark, [(i, [float(x) for x in p], "x") for i, p in enumerate(points)], "id long, features array<double>, v string").drop("v")
    exact = {(r["a"], r["b"]): r["cos"] for r in nearest.cosine_topn(df, df, 10).collect()}
    found = cells.cosine_topn_cells(df, df, 10, tried_queries=300, block_rows=100).collect()
    counts = defaultdict(int)
    for r in found:
        counts[r["a"]] += 1
    assert counts == {i: 10 for i in range(2440)}
    assert sum((r["a"], r["b"]) in exact for r in found) >= 0.9 * len(exact)
    assert all(exact.get((r["a"], r["b"]), r["cos"]) == r["cos"] for r in found)


def test_cells_on_small_and_empty_sides(spark):
    schema = "id long, features array<double>"
    few = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, None)], schema)
    assert cells.cosine_topn_cells(few, few, 10).count() == 6  # all others, though more were asked for
    none = frame(spark, [], schema)
    assert cells.cosine_topn_cells(none, few, 3).count() == cells.cosine_topn_cells(few, none, 3).count() == 0


def test_documents_travel_few_times():
    """60 million vector entries, dealt to 12 tasks, were 86 GB on their way."""
    entries = 60_000_000
    copies = pair_similarity.n_blocks(entries, pair_similarity.BLOCK_TERMS, 12)
    assert copies * entries * pair_similarity.ENTRY_BYTES < 15e9


# --- embeddings ------------------------------------------------------------------------


def test_item2vec_in_parts(spark):
    """Words of one theme come out near each other from many small parts; nothing of the vocabulary reaches the driver."""
    rng = random.Random(5)
    rows = [(i, [f"{t}{rng.randrange(8)}" for _ in range(12)]) for i in range(900) for t in [rng.choice("abc")]] + [(900, ["rare", "a0"])]
    seqs = frame(spark, rows, "playlist int, seq array<string>")
    vecs = embeddings.item2vec(seqs, size=16, min_count=5, partitions=2, iterations=8, part_words=2000)
    got = {r["id"]: np.array(r["features"]) for r in vecs.collect()}
    assert set(got) == {f"{t}{i}" for t in "abc" for i in range(8)}  # not the rare word
    again = {r["id"]: np.array(r["features"]) for r in embeddings.item2vec(seqs, 16, 5, 2, 8, part_words=2000).collect()}
    assert all(np.array_equal(got[w], again[w]) for w in got)
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    for w in unit:
        nearest_ = sorted((o for o in unit if o != w), key=lambda o: -unit[w] @ unit[o])[:7]
        assert all(o[0] == w[0] for o in nearest_), (w, nearest_)


def test_item2vec_of_words_without_context(spark):
    seqs = frame(spark, [(i, ["alone"]) for i in range(5)] + [(9, []), (10, ["few"])], "playlist int, seq array<string>")
    (row,) = embeddings.item2vec(seqs, size=4, min_count=5, partitions=3, iterations=2).collect()
    assert row["id"] == "alone" and 0 < np.linalg.norm(row["features"]) < 1
    assert embeddings.item2vec(seqs, size=4, min_count=50, partitions=3, iterations=1).count() == 0


def test_tfidf_cuts_texts_once_and_deals_no_occurrences(spark):
    docs = spark.createDataFrame([(1, "the a b b"), (2, "a c"), (3, "a b")], "doc_id bigint, text string")
    stop = spark.createDataFrame([("the",)], "term string")
    kept = pair_similarity.remove_stop_words(pair_similarity.tokens(docs), stop)
    assert "Exchange hashpartitioning(term" not in kept._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    weights = pair_similarity.tfidf(pair_similarity.term_counts(kept))
    assert "regexp_extract_all" not in weights._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["doc_id"], r["term"]): (r["df"], round(r["weight"], 9)) for r in weights.collect()}
    assert got == {
        (1, "a"): (3, 0.0), (2, "a"): (3, 0.0), (3, "a"): (3, 0.0), (1, "b"): (2, round(math.log(1.5), 9)), (3, "b"): (2, round(math.log(1.5) / 2, 9)),
    }


def test_channel_hits_travel_once(spark):
    channels = spark.createDataFrame([("c", 1), ("c", 2), ("d", 1)], "channel string, item_id bigint")
    pool = spark.createDataFrame([(1, 9, 0.5, 1), (2, 9, 0.25, 1), (2, 8, 0.1, 2)], "src bigint, dst bigint, sim double, rank bigint")
    df = recall.channel_recall(channels, pool)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(item_id") == 1 and not re.search(r"hashpartitioning\((dst|item_id)#\w+, channel", plan)
    low = recall.channel_recall(channels, pool, min_sim=0.2)
    assert sorted(tuple(r) for r in low.collect()) == [(9, "c", 0.75, 1), (9, "d", 0.5, 2)]
