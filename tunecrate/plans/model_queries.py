"""Factor, embedding, clustering and click-model queries.

A trained factor, centre or embedding has no SQL form; its query returns whether it has the
property that defines it (it solves its system, is nearest, matches the cost), and SQL gives
the rows that must have it. Tree models are also run on separable samples, where SQL can
follow them value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.functions import measures, vectors
from tunecrate.operators import boosting, click_models, clustering, embeddings, evaluation, factors, recall
from tunecrate.plans.recall_queries import _draw_int
from tunecrate.plans.registry import query
from tunecrate.plans.views import View, with_views
from tunecrate.session import cut_lineage

ALS_PARAMS = factors.FactorParams.parse("40_0.01_16_5")


def _samples(v: View) -> DataFrame:
    """Vectors with a binary label."""
    return v.vec.select("id", (F.col("label") < 5).cast("double").alias("label"), "features")


def _click_samples(v: View) -> DataFrame:
    """(a, b, label, features) per user and content key: label 1 when the user clicked the key."""
    rows = v.events
    hour = F.pmod(F.floor(F.col("t") / 3600), F.lit(24))
    return rows.groupBy(F.col("user_id").alias("a"), F.col("k").alias("b")).agg(
        F.max((F.col("event_type") == "click").cast("double")).alias("label"),
        F.array(
            F.count("*").cast("double"), F.avg("value"), F.max("value"), F.avg(hour),
            F.sum((F.col("event_type") == "view").cast("double")),
        ).alias("features"),
    )


@query("implicit_als", with_views(["plays", "idf"], "SELECT item_id, 16 AS dims, true AS optimal FROM plays JOIN idf USING (item_id) "
       "WHERE idf > 0 GROUP BY 1"))
def implicit_als(v: View) -> DataFrame:
    """Item factors as ``factors.implicit_als`` trains them (items in the user's place), with their optimality."""
    ratings = factors.idf_rating(v.plays, v.idf).where(F.col("rating") > 0)
    flipped = cut_lineage(ratings.select(F.col("item_id").alias("user_id"), F.col("user_id").alias("item_id"), "rating"))
    items, users = (cut_lineage(x) for x in factors.train_als(flipped, ALS_PARAMS))
    gap = factors.optimality_gap(flipped, users, items, ALS_PARAMS.alpha, ALS_PARAMS.reg)
    out = items.join(gap, "user_id")
    return out.select(F.col("user_id").alias("item_id"), F.size("factor").alias("dims"), (F.col("gap") < 1e-3).alias("optimal"))


_SAMPLED = f"SELECT * FROM plays WHERE {_draw_int(1, 'user_id', 'item_id')} < {int(0.8 * 2**32)}"


@query("als_factors_norm", with_views(["plays"], "SELECT DISTINCT 'user' AS kind, user_id AS id, 16 AS dims, true AS positive FROM sampled "
       "UNION ALL SELECT DISTINCT 'item', item_id, 16, true FROM sampled", [("sampled", _SAMPLED)]))
def als_factors_norm(v: View) -> DataFrame:
    ratings = v.plays.withColumnRenamed("dur", "rating")
    return factors.als_factors_norm(ratings, rank=16, iterations=8, fraction=0.8).select(
        "kind", "id", F.size("factor").alias("dims"), (F.col("norm") > 0).alias("positive")
    )


@query("als_fold_in", with_views(["recent_plays", "idf", "item_vec"], "SELECT DISTINCT user_id, 64 AS dims, true AS optimal "
       "FROM recent_plays JOIN idf USING (item_id) JOIN item_vec USING (item_id)"))
def als_fold_in(v: View) -> DataFrame:
    """Users of the recent period folded into fixed item vectors; each must solve its system."""
    items = v.item_vec.withColumnRenamed("features", "factor")
    out = cut_lineage(factors.als_fold_in(v.recent_plays, items, v.idf, ALS_PARAMS.alpha, ALS_PARAMS.reg))
    clamped = v.recent_plays.withColumn("dur", measures.clamp(F.col("dur"), 30.0))
    gap = factors.optimality_gap(factors.idf_rating(clamped, v.idf), items, out, ALS_PARAMS.alpha, ALS_PARAMS.reg)
    return out.join(gap, "user_id").select("user_id", F.size("factor").alias("dims"), (F.col("gap") < 1e-6).alias("optimal"))


@query("als_recommend")
def als_recommend(v: View) -> DataFrame:
    """The whole chain: train item factors, fold users in, rank their candidates."""
    items = cut_lineage(factors.implicit_als(v.plays, v.idf, ALS_PARAMS))
    users = factors.als_fold_in(v.recent_plays, items, v.idf, ALS_PARAMS.alpha, ALS_PARAMS.reg)
    candidates = recall.favourite_recall(v.recent_plays, recall.neighbour_table(v.pool, v.plays, numbered=True))
    profiles = v.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    everything = v.item_singer.select("item_id")
    nothing = everything.limit(0)
    return factors.cf_recommend(
        cut_lineage(users), candidates, items, everything, nothing, v.history, v.item_singer, profiles, hot_n=5000
    )


def _item2vec(v: View, size: int = 32, partitions: int = 4, iterations: int = 2) -> DataFrame:
    members = v.playlist_item.withColumn("_b", F.pmod("item_id", F.lit(16)))
    seqs = embeddings.sequences(members, "playlist_id", "item_id", "_b")
    return embeddings.item2vec(cut_lineage(seqs), size=size, min_count=5, partitions=partitions, iterations=iterations)


_VOCABULARY = ("words", "SELECT CAST(item_id AS VARCHAR) AS id FROM playlist_item GROUP BY item_id HAVING COUNT(*) >= 5")


@query("item2vec", with_views(["playlist_item"], "SELECT id, 32 AS dims, true AS usable FROM words", [_VOCABULARY]))
def item2vec(v: View) -> DataFrame:
    vecs = _item2vec(v)
    length = vectors.norm(F.col("features"))
    return vecs.select("id", F.size("features").alias("dims"), ((length > 0) & (length < float("inf"))).alias("usable"))


@query("item2vec_neighbours", with_views(["playlist_item"], "SELECT id AS a, LEAST(50, (SELECT COUNT(*) FROM words) - 1) AS n, true AS ordered "
       "FROM words WHERE (SELECT COUNT(*) FROM words) > 1", [_VOCABULARY]))
def item2vec_neighbours(v: View) -> DataFrame:
    """Trained at the surveyed job's size, parts and iterations; words from 5 occurrences on, where it takes 200."""
    near = embeddings.item2vec_neighbours(cut_lineage(_item2vec(v, 200, 20, 10)), 50)
    steps = near.withColumn("_last", F.lag("cos").over(Window.partitionBy("a").orderBy("rank")))
    return steps.groupBy("a").agg(
        F.count("*").alias("n"), F.min((F.coalesce("_last", F.lit(1.0)) >= F.col("cos")) & (F.col("a") != F.col("b"))).alias("ordered")
    )


def _cost(v: View, centres: list) -> float:
    """Sum of squared distances to the nearest centre, from the vectors themselves."""
    nearest = F.array_min(F.transform(vectors.literal_matrix(centres), lambda c: vectors.sq_distance(F.col("features"), c)))
    return v.vec.agg(F.sum(nearest)).first()[0]


@query("kmeans_fit", "SELECT UNNEST(range(5))::INT AS cluster, 64 AS dims, true AS cost_matches")
def kmeans_fit(v: View) -> DataFrame:
    found = cut_lineage(clustering.kmeans_centres(v.vec, 5, 30))
    cost = _cost(v, [r["centre"] for r in found.orderBy("cluster").collect()])
    return found.select("cluster", F.size("centre").alias("dims"), (F.abs(F.col("wssse") / cost - 1) < 1e-9).alias("cost_matches"))


@query("kmeans_assign", with_views(["vec"], "SELECT id, true AS nearest FROM vec"))
def kmeans_assign(v: View) -> DataFrame:
    model, _ = clustering.kmeans_fit(v.vec, 5, 30)
    distances = F.transform(vectors.literal_matrix([c.tolist() for c in model.clusterCenters()]), lambda c: vectors.sq_distance(F.col("features"), c))
    own = F.element_at(distances, F.col("cluster") + 1)
    return clustering.kmeans_assign(v.vec, model).select("id", (own <= F.array_min(distances) + 1e-9).alias("nearest"))


@query("kmeans_sweep", "SELECT UNNEST([2, 5, 8, 9])::INT AS k, true AS cost_matches")
def kmeans_sweep(v: View) -> DataFrame:
    found = clustering.kmeans_sweep(v.vec, (2, 5, 8, 9), 10)
    costs = {k: _cost(v, [c.tolist() for c in clustering.kmeans_fit(v.vec, k, 10)[0].clusterCenters()]) for k in (2, 5, 8, 9)}
    expected = F.element_at(F.create_map(*[F.lit(x) for pair in costs.items() for x in pair]), F.col("k"))
    # the trainer reports the cost before its last step, which can only have lowered it
    return found.select("k", ((F.col("wssse") / expected).between(1 - 1e-9, 1.1)).alias("cost_matches"))


@query("gbdt_train")
def gbdt_train(v: View) -> DataFrame:
    """AUC of the hold-out part, on margins."""
    _, held = click_models.train_and_hold_out(_samples(v), "10_4_0.1", "id")
    return evaluation.auc(held, score="margin")


@query("gbdt_score")
def gbdt_score(v: View) -> DataFrame:
    model, _ = click_models.train_and_hold_out(_samples(v), "10_4_0.1", "id")
    return click_models.gbdt_score(_samples(v), model).select("id", "margin", "prob")


@query("boosted_rounds")
def boosted_rounds(v: View) -> DataFrame:
    model = click_models.boosted_rounds(_samples(v))
    return click_models.gbdt_score(_samples(v), model).select("id", "prob")


def _pair_samples(v: View) -> DataFrame:
    """User and item vectors of plays, labelled by long listening."""
    u = v.user_vec.select("user_id", F.col("features").alias("_u"))
    i = v.item_vec.select("item_id", F.col("features").alias("_i"))
    return v.plays.join(u, "user_id").join(i, "item_id").select(
        "user_id", "item_id", (F.col("dur") >= 3.0).cast("double").alias("label"),
        vectors.joined(F.col("_u"), F.col("_i")).alias("features"),
    )


@query("rank_serve")
def rank_serve(v: View) -> DataFrame:
    model = click_models.gbdt_train(_pair_samples(v).select("label", "features"), "5_3_0.1")
    lists = recall.pool_recall(v.recent_plays, v.pool, 100, 80)
    return click_models.rank_serve(lists, v.user_vec, v.item_vec, model, 10)


@query("rf_train")
def rf_train(v: View) -> DataFrame:
    samples = _samples(v)
    model = click_models.rf_train(samples.select("label", "features"), trees=20, depth=5, impurity="gini", categories=16)
    return click_models.rf_score(samples, model, ["id"])


@query("rf_score_split")
def rf_score_split(v: View) -> DataFrame:
    model = click_models.rf_train(_pair_samples(v).select("label", "features"), trees=10, depth=5)
    pairs = recall.pool_recall(v.recent_plays, v.pool, 100, 20).select("user_id", "item_id")
    scored, plain = click_models.rf_score_split(pairs, v.user_vec, v.item_vec, model)
    return scored.unionByName(plain.withColumn("prob", F.lit(None).cast("double")))


@query("rf_pair_rank")
def rf_pair_rank(v: View) -> DataFrame:
    samples = _click_samples(v)
    return click_models.rf_pair_rank(samples, samples.select("a", "b", "features"), 18, trees=20, depth=5)


@query("rf_test_error")
def rf_test_error(v: View) -> DataFrame:
    _, error = click_models.rf_test_error(_samples(v), "id", trees=20, depth=10)
    return v.vec.agg(F.count("*").alias("samples")).withColumn("error", F.lit(error))


@query("rf_grid_cv")
def rf_grid_cv(v: View) -> DataFrame:
    return click_models.rf_grid_cv(_samples(v).select("label", "features"), "5,10=3=gini,entropy", 2)


def _separable(v: View) -> DataFrame:
    """One integer feature; the label is whether it is 12 or more."""
    level = F.floor(F.col("p_size") % 30 / 12) * 12
    return v.table("part").select(
        F.col("p_partkey").alias("id"), (level >= 12).cast("double").alias("label"), F.array(level.cast("double")).alias("features")
    )


_LEVELS = "SELECT p_partkey AS id, CASE WHEN p_size % 30 >= 12 THEN 1 ELSE -1 END AS y FROM part"


def _margins(rounds: int, rate: float) -> str:
    """Margins of boosted trees that separate the labels: the first tree gives y, each further one a step along the gradient."""
    return (
        "WITH RECURSIVE f(n, m) AS (SELECT 1, 1.0::DOUBLE UNION ALL "
        f"SELECT n + 1, m + {rate} * 4 / (1 + exp(2 * m)) FROM f WHERE n < {rounds}), levels AS ({_LEVELS}), "
        f"scored AS (SELECT id, y * m AS margin FROM levels, f WHERE n = {rounds}) "
    )


@query("gbdt_separable", _margins(10, 0.1) + "SELECT id, ROUND(margin, 6) AS margin, ROUND(1 / (1 + exp(-margin)), 6) AS prob FROM scored")
def gbdt_separable(v: View) -> DataFrame:
    model = click_models.gbdt_train(_separable(v).select("label", "features"), "10_4_0.1", subsample=1.0)
    scored = click_models.gbdt_score(_separable(v), model)
    return scored.select("id", F.round("margin", 6).alias("margin"), F.round("prob", 6).alias("prob"))


@query("boosted_rounds_separable", _margins(15, 1.0) + "SELECT id, ROUND(1 / (1 + exp(-margin)), 6) AS prob FROM scored")
def boosted_rounds_separable(v: View) -> DataFrame:
    model = click_models.boosted_rounds(_separable(v).select("label", "features"))
    return click_models.gbdt_score(_separable(v), model).select("id", F.round("prob", 6).alias("prob"))


@query("gbdt_hold_out_separable", f"SELECT COUNT(*) FILTER (y > 0) AS positives, COUNT(*) FILTER (y < 0) AS negatives, 1.0::DOUBLE AS auc "
       f"FROM ({_LEVELS}) WHERE {_draw_int(12345, 'id')} >= {int(0.8 * 2**32)}")
def gbdt_hold_out_separable(v: View) -> DataFrame:
    _, held = click_models.train_and_hold_out(_separable(v), "10_4_0.1", "id")
    return evaluation.auc(held, score="margin")


@query("rf_separable", f"SELECT id, CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prob FROM ({_LEVELS})")
def rf_separable(v: View) -> DataFrame:
    """The forest at its default 100 trees of depth 10."""
    return click_models.rf_score(_separable(v), click_models.rf_train(_separable(v).select("label", "features")), ["id"])


@query("rf_error_separable", "SELECT COUNT(*) AS samples, 0.0::DOUBLE AS error FROM part")
def rf_error_separable(v: View) -> DataFrame:
    _, error = click_models.rf_test_error(_separable(v), "id")
    return v.table("part").agg(F.count("*").alias("samples")).withColumn("error", F.lit(error))


@query("rf_grid_separable", "SELECT UNNEST([5, 5, 10, 10])::INT AS trees, 3 AS depth, UNNEST(['gini', 'entropy', 'gini', 'entropy']) AS impurity, 1.0::DOUBLE AS auc")
def rf_grid_separable(v: View) -> DataFrame:
    return click_models.rf_grid_cv(_separable(v).select("label", "features"), "5,10=3=gini,entropy", 2)


_MIXED = (
    "SELECT p_partkey AS id, p_size % 30 AS f0, p_partkey % 7 AS f1, "
    "CASE WHEN (p_partkey * 37 + p_size * 11) % 30 < p_size % 30 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM part"
)


def _mixed(v: View) -> DataFrame:
    """Two integer features and a label that they do not determine."""
    size, key = F.col("p_size") % 30, F.col("p_partkey")
    return v.table("part").select(
        key.alias("id"), ((key * 37 + F.col("p_size") * 11) % 30 < size).cast("double").alias("label"),
        F.array(size.cast("double"), (key % 7).cast("double")).alias("features"),
    )


def _boosted_sql(rounds: int, depth: int, l2: float) -> str:
    """Rounds of second-order trees as a chain of tables: histograms, best cuts, children, margins."""
    steps = [("samples", _MIXED), ("m0", "SELECT *, 0.0::DOUBLE AS m FROM samples")]
    for r in range(rounds):
        steps.append((f"n{r}_0", f"SELECT *, 1 AS node, p - y AS g, p * (1 - p) AS h FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{r})"))
        for d in range(depth):
            sides = " UNION ALL ".join(f"SELECT node, {f} AS f, f{f} AS v, g, h FROM n{r}_{d} WHERE node >= {2**d}" for f in (0, 1))
            steps.append((f"h{r}_{d}", f"SELECT node, f, v, SUM(g) AS g, SUM(h) AS h FROM ({sides}) GROUP BY 1, 2, 3"))
            steps.append((f"c{r}_{d}", "SELECT node, f, v, SUM(g) OVER w AS gl, SUM(h) OVER w AS hl, SUM(g) OVER e AS g, SUM(h) OVER e AS h "
                          f"FROM h{r}_{d} WINDOW e AS (PARTITION BY node, f), w AS (PARTITION BY node, f ORDER BY v)"))
            gain = f"(gl * gl / (hl + {l2}) + (g - gl) * (g - gl) / (h - hl + {l2}) - g * g / (h + {l2})) / 2"
            steps.append((f"b{r}_{d}", f"SELECT node, f, v FROM (SELECT *, {gain} AS gain FROM c{r}_{d}) WHERE hl >= 1 AND h - hl >= 1 AND gain > 1e-6 "
                          "QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY ROUND(gain, 9) DESC, f, v) = 1"))
            child = "CASE WHEN b.node IS NULL THEN n.node WHEN CASE b.f WHEN 0 THEN f0 ELSE f1 END <= b.v THEN 2 * n.node ELSE 2 * n.node + 1 END"
            steps.append((f"n{r}_{d + 1}", f"SELECT n.* REPLACE ({child} AS node) FROM n{r}_{d} n LEFT JOIN b{r}_{d} b ON n.node = b.node"))
        steps.append((f"m{r + 1}", f"SELECT id, f0, f1, y, m - SUM(g) OVER w / (SUM(h) OVER w + {l2}) AS m FROM n{r}_{depth} WINDOW w AS (PARTITION BY node)"))
    chain = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in steps)
    return f"WITH {chain} SELECT id, ROUND(m, 6) AS margin, ROUND(1 / (1 + exp(-m)), 6) AS prob FROM m{rounds}"


@query("boosted_l2", _boosted_sql(4, 3, 2.5))
def boosted_l2(v: View) -> DataFrame:
    """Leaf penalty 2.5 on labels that no tree separates; SQL follows every cut."""
    samples = _mixed(v)
    scored = boosting.boosted_margin(samples, boosting.boost(samples, rounds=4, depth=3, l2=2.5, every=2))
    return scored.select("id", F.round("margin", 6).alias("margin"), F.round("prob", 6).alias("prob"))


def _profiles(v: View) -> tuple[DataFrame, DataFrame]:
    """Vectors of one market segment's users (their nation) and of all items (their level)."""
    users = v.table("customer").where(F.col("c_mktsegment") == "BUILDING")
    users = users.select(F.col("c_custkey").alias("user_id"), F.array(F.col("c_nationkey").cast("double")).alias("features"))
    return users, _separable(v).select(F.col("id").alias("item_id"), "features")


def _separable_pairs(v: View) -> DataFrame:
    """(label, features) of plays: user and item vector, of which the item's settles the label."""
    users, items = _profiles(v)
    pairs = v.plays.join(users.withColumnRenamed("features", "_u"), "user_id").join(items.withColumnRenamed("features", "_i"), "item_id")
    return pairs.select((F.element_at("_i", 1) >= 12).cast("double").alias("label"), vectors.joined(F.col("_u"), F.col("_i")).alias("features"))


_SCORED = (
    "SELECT user_id, item_id, y, c_custkey IS NOT NULL AS known FROM recent_plays "
    f"JOIN ({_LEVELS}) ON item_id = id LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = user_id"
)


@query("rank_serve_separable", with_views(["recent_plays"], "SELECT user_id, item_id FROM scored WHERE NOT known UNION ALL "
       "(SELECT user_id, item_id FROM scored WHERE known QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY y DESC, item_id) <= 10)",
       [("scored", _SCORED)]))
def rank_serve_separable(v: View) -> DataFrame:
    """Lists of users with a profile cut to ten by the model, the others' left whole."""
    users, items = _profiles(v)
    model = click_models.gbdt_train(_separable_pairs(v), "10_4_0.1", subsample=1.0)
    return click_models.rank_serve(v.recent_plays.select("user_id", "item_id"), users, items, model, 10)


@query("rf_score_split_separable", with_views(["recent_plays"], "SELECT user_id, item_id, CASE WHEN NOT known THEN NULL WHEN y > 0 THEN 1.0 ELSE 0.0 END::DOUBLE "
       "AS prob FROM scored", [("scored", _SCORED)]))
def rf_score_split_separable(v: View) -> DataFrame:
    users, items = _profiles(v)
    model = click_models.rf_train(_separable_pairs(v), trees=10, depth=5)
    scored, plain = click_models.rf_score_split(v.recent_plays.select("user_id", "item_id"), users, items, model)
    return scored.unionByName(plain.withColumn("prob", F.lit(None).cast("double")))


@query("rf_pair_rank_separable", with_views(["ev"], "SELECT user_id AS a, k AS b, (clicks > 0)::INT::DOUBLE AS prob, "
       "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY clicks > 0 DESC, k) AS rank FROM "
       "(SELECT user_id, k, COUNT(*) FILTER (event_type = 'click') AS clicks FROM ev GROUP BY 1, 2) QUALIFY rank <= 18"))
def rf_pair_rank_separable(v: View) -> DataFrame:
    """Pairs ranked by a forest that sees their clicks, which are the label."""
    clicks = F.sum((F.col("event_type") == "click").cast("double"))
    pairs = v.events.groupBy(F.col("user_id").alias("a"), F.col("k").alias("b")).agg(
        (clicks > 0).cast("double").alias("label"), F.array(clicks, F.count("*").cast("double")).alias("features")
    )
    return click_models.rf_pair_rank(pairs, pairs.select("a", "b", "features"), 18, trees=10, depth=5)
