"""Similarity, feature and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import measures, vectors
from tunecrate.operators import cells, clustering, evaluation, factors, features, nearest, pair_similarity, recall
from tunecrate.operators.walk import personal_walk
from tunecrate.plans.recall_queries import _neighbours, _pool_recall
from tunecrate.plans.registry import query
from tunecrate.plans.views import View, with_views
from tunecrate.session import cut_lineage

WIDTH = 64


def _text(column: str) -> str:
    """A DOUBLE[] rendered with five decimals, as SQL."""
    return f"array_to_string(list_transform({column}, lambda x: printf('%.5f', x)), '=')"


def _plain(vec) -> F.Column:
    return F.array_join(F.transform(vec, lambda x: F.format_string("%.5f", x)), "=")


def _mean_by(key: str, rows: str, weight: str) -> str:
    """SQL: weighted mean vector per key over rows(key..., features, weight)."""
    return (
        f"SELECT {key}, list(m ORDER BY dim) AS features FROM (SELECT {key}, dim, SUM({weight} * features[dim]) / SUM({weight}) AS m "
        f"FROM {rows}, (SELECT UNNEST(range(1, {WIDTH + 1})) AS dim) GROUP BY {key}, dim) GROUP BY {key}"
    )


# --- norms and cosine ------------------------------------------------------------------


@query(
    "hot_by_norm",
    with_views(["item_vec"], "SELECT item_id, sq_norm FROM (SELECT item_id, ROUND(list_dot_product(features, features), 9) AS sq_norm, "
    "RANK() OVER (ORDER BY ROUND(list_dot_product(features, features), 9) DESC) AS r FROM item_vec) WHERE r <= 100"),
)
def hot_by_norm(v: View) -> DataFrame:
    hot = factors.hot_by_norm(v.item_vec.withColumnRenamed("features", "factor"), 100)
    return hot.select("item_id", "sq_norm")


_COS = "ROUND(list_dot_product(a.features, b.features) / SQRT(list_dot_product(a.features, a.features)) / SQRT(list_dot_product(b.features, b.features)), 9)"


@query(
    "cosine_topn",
    with_views(["vec"], "SELECT a, b, cos, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a ORDER BY cos DESC, b) AS rank FROM "
    f"(SELECT a.id AS a, b.id AS b, {_COS} AS cos FROM vec a JOIN vec b ON a.id <> b.id)) WHERE rank <= 20"),
)
def cosine_topn(v: View) -> DataFrame:
    return nearest.cosine_topn(v.vec, v.vec, 20)


@query(
    "cosine_topn_cells",
    with_views(["vec"], "SELECT id AS a, LEAST(20, (SELECT COUNT(*) FROM vec) - 1) AS n, 0::BIGINT AS wrong, true AS recall_reached FROM vec"),
)
def cosine_topn_cells(v: View) -> DataFrame:
    """Every vector's rows from the cells, held against the exact top 20: recall of all together 0.9 or more, no wrong cosine."""
    found = cut_lineage(cells.cosine_topn_cells(v.vec, v.vec, 20))
    exact = nearest.cosine_topn(v.vec, v.vec, 20).select("a", F.col("b").alias("_b"), F.col("cos").alias("_cos"), "rank")
    true_pairs = exact.select("a", F.col("_b").alias("b"), F.lit(1).alias("hit"))
    at_rank = exact.select("a", "rank", "_cos")
    judged = found.join(true_pairs, ["a", "b"], "left").join(at_rank, ["a", "rank"])
    rows = judged.groupBy("a").agg(
        F.count("*").alias("n"), F.count("hit").alias("hits"), F.count_if(F.col("cos") > F.col("_cos") + 1e-9).alias("wrong")
    )
    rows = cut_lineage(rows)
    share = rows.agg(F.sum("hits") / F.sum("n")).first()[0]
    return rows.select("a", "n", "wrong", F.lit(share is not None and share >= 0.9).alias("recall_reached"))


@query(
    "cosine_topn_sharded",
    with_views(["vec"], "SELECT a, b, cos, rank, shard FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, shard ORDER BY cos DESC, b) AS rank FROM "
    f"(SELECT a.id AS a, b.id AS b, right(CAST(b.id AS VARCHAR), 1) AS shard, {_COS} AS cos FROM vec a JOIN vec b ON a.id <> b.id)) WHERE rank <= 5"),
)
def cosine_topn_sharded(v: View) -> DataFrame:
    targets = v.vec.withColumn("shard", F.substring(F.col("id").cast("string"), -1, 1))
    return nearest.cosine_topn(v.vec, targets, 5, part="shard")


_PLAYLIST_VEC = ("playlist_vec", _mean_by("playlist_id", "(SELECT * FROM playlist_item JOIN item_vec USING (item_id))", "1"))


def _playlist_vec(v: View) -> DataFrame:
    return features.playlist_vector(v.playlist_item, v.item_vec)


@query(
    "playlist_vector",
    with_views(["playlist_item", "item_vec"], f"SELECT playlist_id, {_text('features')} AS features FROM playlist_vec", [_PLAYLIST_VEC]),
)
def playlist_vector(v: View) -> DataFrame:
    return _playlist_vec(v).select("playlist_id", _plain("features").alias("features"))


@query(
    "item_playlist_topn",
    with_views(["playlist_item", "item_vec"], "SELECT a, b, cos, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a ORDER BY cos DESC, b) AS rank FROM "
    f"(SELECT a.item_id AS a, b.playlist_id AS b, {_COS} AS cos FROM item_vec a, playlist_vec b)) WHERE rank <= 10", [_PLAYLIST_VEC]),
)
def item_playlist_topn(v: View) -> DataFrame:
    items = v.item_vec.withColumnRenamed("item_id", "id")
    lists = _playlist_vec(v).withColumnRenamed("playlist_id", "id")
    return nearest.item_playlist_topn(items, lists, 10)


@query(
    "gram_matrix",
    with_views(["item_vec"], "SELECT CAST(i - 1 AS INT) AS i, CAST(j - 1 AS INT) AS j, ROUND(SUM(features[i] * features[j]), 6) + 0.0 AS value FROM item_vec, "
    "(SELECT UNNEST(range(1, 65)) AS i), (SELECT UNNEST(range(1, 65)) AS j) GROUP BY 1, 2"),
)
def gram_matrix(v: View) -> DataFrame:
    gram = factors.gram_matrix(v.item_vec.withColumnRenamed("features", "factor"))
    return gram.withColumn("value", F.round("value", 6) + 0.0)


_CENTRES = [[0.1] * WIDTH, [0.1 if i % 2 else -0.1 for i in range(WIDTH)], [i / 640 for i in range(WIDTH)]]
_CENTRE_SQL = [f"[{', '.join(f'{x!r}::DOUBLE' for x in c)}]" for c in _CENTRES]


@query(
    "centroid_distances",
    with_views(["vec"], "SELECT id, " + " || ';' || ".join(
        f"'{i}:' || printf('%.6f', list_sum(list_transform(range(1, 65), lambda d: pow(features[d] - ({c})[d], 2))))" for i, c in enumerate(_CENTRE_SQL)
    ) + " AS distances FROM vec"),
)
def centroid_distances(v: View) -> DataFrame:
    return clustering.centroid_distances(v.vec, _CENTRES)


# --- feature vectors -------------------------------------------------------------------

_FORMAT = (
    "array_to_string(list_transform({v}, lambda x: CASE WHEN printf('%.5f', x) IN ('-0.00000', '0.00000') THEN '0' "
    "WHEN printf('%.5f', x) LIKE '%.00000' THEN replace(printf('%.5f', x), '.00000', '') "
    "WHEN printf('%.5f', x) LIKE '%000' THEN left(printf('%.5f', x), length(printf('%.5f', x)) - 3) ELSE printf('%.5f', x) END), '=')"
)


@query("vector_format", with_views(["vec"], f"SELECT id, {_FORMAT.format(v='features')} AS line FROM vec"))
def vector_format(v: View) -> DataFrame:
    return v.vec.select("id", vectors.format_vector(F.col("features")).alias("line"))


_PROFILE = ("profile", _mean_by("user_id", "(SELECT * FROM plays JOIN item_vec USING (item_id))", "dur"))


@query(
    "user_profile_vector",
    with_views(["plays", "item_vec"], "SELECT user_id, " + _FORMAT.format(
        v="list_concat(list_concat(features[1:40], list_transform(features[1:40], lambda x: CASE WHEN x >= 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), features[41:64])"
    ) + " AS profile FROM profile", [_PROFILE]),
)
def user_profile_vector(v: View) -> DataFrame:
    scores = v.plays.withColumnRenamed("dur", "score")
    out = features.user_profile_vector(scores, v.item_vec, WIDTH, sliced=40, at_least=0.05)
    return out.select("user_id", vectors.format_vector(F.col("profile")).alias("profile"))


_CNT_PLAYS = ("cnt_plays", "SELECT p.*, songcnt FROM plays p JOIN (SELECT user_id, COUNT(*) AS songcnt FROM plays GROUP BY 1) c ON c.user_id = p.user_id")


def _song_counts(v: View) -> DataFrame:
    return v.plays.groupBy("user_id").agg(F.count("*").alias("songcnt"))


@query(
    "user_profile_vector_n",
    with_views(["plays", "item_vec"], "SELECT user_id, songcnt, " + _text("features[1:32]") + " AS profile FROM wide",
    [_CNT_PLAYS, ("wide", _mean_by("user_id, songcnt", "(SELECT * FROM cnt_plays JOIN item_vec USING (item_id))", "dur"))]),
)
def user_profile_vector_n(v: View) -> DataFrame:
    out = features.user_profile_vector_n(v.plays.join(_song_counts(v), "user_id"), v.item_vec, 32)
    return out.select("user_id", "songcnt", _plain("profile").alias("profile"))


@query(
    "feature_slice",
    with_views(["vec"], "SELECT id, " + _text("list_concat(list_concat(features[1:20], features[41:56]), "
    "CASE WHEN label < 5 THEN features[1:8] ELSE list_transform(range(0, 8), lambda x: 0.0::DOUBLE) END)") + " AS features FROM vec"),
)
def feature_slice(v: View) -> DataFrame:
    special = F.when(F.col("label") < 5, vectors.head(F.col("features"), 8))
    cut = features.feature_slice(F.col("features"), special, (0, 20), (40, 56), 8)
    return v.vec.select("id", _plain(cut).alias("features"))


@query(
    "feature_export",
    with_views(["plays", "user_vec", "vec"], "SELECT u.user_id, " + _text("list_concat(list_concat(w[1:20], w[41:56]), "
    "CASE WHEN s.id IS NOT NULL THEN s.features[1:8] ELSE list_transform(range(0, 8), lambda x: 0.0::DOUBLE) END)") + " AS features FROM "
    "(SELECT c.user_id, list_prepend(CAST(n AS DOUBLE), features) AS w FROM (SELECT user_id, COUNT(*) AS n FROM plays GROUP BY 1) c "
    "JOIN user_vec USING (user_id)) u LEFT JOIN (SELECT * FROM vec WHERE label < 5) s ON s.id = u.user_id"),
)
def feature_export(v: View) -> DataFrame:
    special = v.vec.where(F.col("label") < 5).select(
        F.col("id").alias("user_id"), vectors.head(F.col("features"), 8).alias("features")
    )
    out = features.feature_export(_song_counts(v), v.user_vec, special, (0, 20), (40, 56), 8)
    return out.select("user_id", _plain("features").alias("features"))


@query(
    "feature_width_check",
    with_views(["vec"], "SELECT COUNT(*) AS rows, COUNT(*) FILTER (len(features) <> 64) AS bad_width, "
    "COUNT(*) > 0 AND COUNT(*) FILTER (len(features) <> 64) = 0 AS ok FROM vec"),
)
def feature_width_check(v: View) -> DataFrame:
    return features.feature_width_check(v.vec, WIDTH)


@query(
    "click_label",
    with_views(["ev"], "SELECT s.event_id, s.user_id, s.k AS shown, CASE WHEN EXISTS (SELECT 1 FROM ev c WHERE c.event_type = 'click' "
    "AND c.user_id = s.user_id AND c.k = s.k) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM ev s WHERE s.event_type = 'view' "
    "AND s.user_id IN (SELECT user_id FROM ev WHERE event_type = 'click')"),
)
def click_label(v: View) -> DataFrame:
    clicked = v.events.where(F.col("event_type") == "click").select("user_id", F.col("k").alias("shown"))
    shown = v.events.where(F.col("event_type") == "view").select("event_id", "user_id", F.col("k").alias("shown"))
    return features.click_label_pairs(shown, clicked)


# --- sets and texts --------------------------------------------------------------------


@query(
    "tag_cosine",
    with_views(["playlist_item"], "SELECT LEAST(g.playlist_id, h.playlist_id) AS a, GREATEST(g.playlist_id, h.playlist_id) AS b, ROUND(cos, 9) AS cos "
    "FROM (SELECT x.playlist_id AS a, y.playlist_id AS b, COUNT(*) / SQRT(ANY_VALUE(x.n) * ANY_VALUE(y.n)) AS cos "
    "FROM rep x JOIN rep y ON x.item_id = y.item_id AND x.playlist_id < y.playlist_id GROUP BY 1, 2) "
    "JOIN groups g ON g.first_id = a JOIN groups h ON h.first_id = b WHERE cos > 0.3 "
    "UNION ALL SELECT g.playlist_id, h.playlist_id, 1.0::DOUBLE FROM groups g JOIN groups h ON g.first_id = h.first_id AND g.playlist_id < h.playlist_id",
    [("sets", "SELECT playlist_id, COUNT(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS body FROM playlist_item GROUP BY 1"),
     ("groups", "SELECT playlist_id, n, MIN(playlist_id) OVER (PARTITION BY body) AS first_id FROM sets"),
     ("rep", "SELECT p.*, g.n FROM playlist_item p JOIN groups g ON g.playlist_id = p.playlist_id WHERE g.playlist_id = first_id")]),
)
def tag_cosine(v: View) -> DataFrame:
    """Items in the role of tags; the threshold keeps frequent tags out of the candidate index."""
    tags = v.playlist_item.select(F.col("playlist_id").alias("doc_id"), F.col("item_id").alias("tag"))
    return pair_similarity.tag_cosine(tags, 0.3, whole=True).withColumn("cos", F.round("cos", 9))


@query(
    "doc_build",
    "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM (SELECT doc_id, CASE WHEN len(blocks) = 2 THEN name "
    "ELSE name || ',' || blocks[len(blocks)] END AS text FROM (SELECT doc_id, lang || ' ' || source AS name, "
    "string_split(text, chr(10)) AS blocks FROM documents WHERE doc_id > 0))",
)
def doc_build(v: View) -> DataFrame:
    playlists = v.table("documents").select(
        "doc_id", F.concat_ws(" ", "lang", "source").alias("name"), F.split("text", "\n").alias("blocks")
    )
    return pair_similarity.build_documents(playlists).select(
        "doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("chars")
    )


_TERMS = [
    ("counts", "SELECT doc_id, term, COUNT(*) AS cnt FROM (SELECT doc_id, UNNEST(regexp_extract_all(lower(text), '[\\p{L}]+')) AS term FROM documents) "
     "WHERE term NOT IN ('gt', 'lt', 'br', 'que', 'the') GROUP BY 1, 2"),
    ("df", "SELECT term, COUNT(*) AS df FROM counts GROUP BY 1 HAVING COUNT(*) > 1"),
    ("words", "SELECT doc_id, COUNT(*) AS words FROM counts GROUP BY 1"),
    ("weighted", "SELECT c.doc_id, c.term, df, cnt / words * LN((SELECT COUNT(*) FROM words) / df) AS weight FROM counts c JOIN df ON df.term = c.term JOIN words w ON w.doc_id = c.doc_id"),
]


def _terms(v: View, docs: DataFrame | None = None) -> DataFrame:
    stop = v.spark.createDataFrame([("que",), ("the",)], "term string")
    return pair_similarity.remove_stop_words(pair_similarity.tokens(v.docs if docs is None else docs), stop)


@query("tfidf", with_views([], "SELECT doc_id, term, df, ROUND(weight, 6) AS weight FROM weighted", _TERMS))
def tfidf(v: View) -> DataFrame:
    whole = v.docs.repartition("doc_id")  # a text travels once; its words are counted where it is
    return pair_similarity.tfidf(pair_similarity.term_counts(_terms(v, whole))).withColumn("weight", F.round("weight", 6))


def _tfidf_cosine_sql(t: float, whole: bool) -> str:
    """Pairs of first copies, with links to the others or, with ``whole``, with all pairs of the others."""
    pairs = (
        "(SELECT x.doc_id AS a, y.doc_id AS b, SUM(x.w * y.w) AS cos FROM unit x JOIN unit y "
        "ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY 1, 2)"
    )
    linked = (
        f"SELECT a, b, ROUND(cos, 9) AS cos FROM {pairs} WHERE cos > {t} "
        "UNION ALL SELECT first_id, doc_id, 1.0::DOUBLE FROM groups WHERE doc_id <> first_id"
    )
    every = (
        f"SELECT LEAST(g.doc_id, h.doc_id) AS a, GREATEST(g.doc_id, h.doc_id) AS b, ROUND(cos, 9) AS cos FROM {pairs} "
        f"JOIN groups g ON g.first_id = a JOIN groups h ON h.first_id = b WHERE cos > {t} "
        "UNION ALL SELECT g.doc_id, h.doc_id, 1.0::DOUBLE FROM groups g JOIN groups h ON g.first_id = h.first_id AND g.doc_id < h.doc_id"
    )
    return with_views(
        [], every if whole else linked,
        [*_TERMS, ("bags", "SELECT doc_id, string_agg(term || ':' || cnt, ',' ORDER BY term) AS body FROM counts GROUP BY 1"),
         ("groups", "SELECT doc_id, MIN(doc_id) OVER (PARTITION BY body) AS first_id FROM bags"),
         ("unit", "SELECT doc_id, term, weight / SQRT(SUM(weight * weight) OVER (PARTITION BY doc_id)) AS w FROM weighted "
          "WHERE weight > 0 AND doc_id IN (SELECT doc_id FROM groups WHERE doc_id = first_id)")],
    )


@query("tfidf_cosine", _tfidf_cosine_sql(0.5, True))
def tfidf_cosine(v: View) -> DataFrame:
    return pair_similarity.tfidf_cosine(_terms(v), 0.5, whole=True).withColumn("cos", F.round("cos", 9))


@query("tfidf_cosine_low", _tfidf_cosine_sql(0.1, False))
def tfidf_cosine_low(v: View) -> DataFrame:
    """At the surveyed job's own threshold."""
    return pair_similarity.tfidf_cosine(_terms(v), 0.1).withColumn("cos", F.round("cos", 9))


# --- evaluation ------------------------------------------------------------------------


@query(
    "auc",
    "SELECT COUNT(*) FILTER (y = 1) AS positives, COUNT(*) FILTER (y = 0) AS negatives, "
    "ROUND((SUM(r) FILTER (y = 1) - COUNT(*) FILTER (y = 1) * (COUNT(*) FILTER (y = 1) + 1) / 2) / (COUNT(*) FILTER (y = 1) * COUNT(*) FILTER (y = 0)), 9) AS auc "
    "FROM (SELECT y, RANK() OVER (ORDER BY value) + (COUNT(*) OVER (PARTITION BY value) - 1) / 2 AS r FROM "
    "(SELECT value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events))",
)
def auc(v: View) -> DataFrame:
    scored = v.events.select(F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label"))
    return evaluation.auc(scored).withColumn("auc", F.round("auc", 9))


@query(
    "roc_curve",
    "SELECT bin, ROUND(SUM(neg) OVER (ORDER BY bin DESC) / SUM(neg) OVER (), 9) AS fpr, ROUND(SUM(pos) OVER (ORDER BY bin DESC) / SUM(pos) OVER (), 9) AS tpr FROM "
    "(SELECT LEAST(CAST(FLOOR(value / (value + 50) * 100) AS INT), 99) AS bin, COUNT(*) FILTER (event_type = 'purchase') AS pos, "
    "COUNT(*) FILTER (event_type <> 'purchase') AS neg FROM events GROUP BY 1)",
)
def roc_curve(v: View) -> DataFrame:
    scored = v.events.select(
        (F.col("value") / (F.col("value") + 50)).alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label")
    )
    out = evaluation.roc_curve(scored)
    return out.select("bin", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "hit_at_1",
    with_views(["ev"], "SELECT users, hits, ROUND(hits / users, 9) AS ratio FROM (SELECT COUNT(*) FILTER (r = 2) AS users, COUNT(*) FILTER (r = 1 AND label = 1) AS hits "
    "FROM (SELECT label, RANK() OVER (PARTITION BY user_id ORDER BY value DESC) + (COUNT(*) OVER (PARTITION BY user_id, value) - 1) / 2 AS r FROM "
    "(SELECT user_id, value, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label FROM ev WHERE event_type IN ('view', 'click'))))"),
)
def hit_at_1(v: View) -> DataFrame:
    scored = v.events.where(F.col("event_type").isin("view", "click")).select(
        "user_id", F.col("value").alias("pred"), (F.col("event_type") == "click").cast("int").alias("label")
    )
    return evaluation.hit_at_1(scored).withColumn("ratio", F.round("ratio", 9))


@query(
    "vector_resort",
    with_views(["pool", "recent_plays", "user_vec", "item_vec"], "SELECT user_id, item_id, cos, ROW_NUMBER() OVER (PARTITION BY user_id "
    "ORDER BY cos DESC NULLS LAST, pos, item_id) AS rank FROM (SELECT l.user_id, l.item_id, pos, "
    + _COS + " AS cos FROM listed l LEFT JOIN user_vec a ON a.user_id = l.user_id LEFT JOIN item_vec b ON b.item_id = l.item_id)",
    [("listed", _pool_recall("recent_plays", "pool", 100, 30))]),
)
def vector_resort(v: View) -> DataFrame:
    listed = recall.pool_recall(v.recent_plays, v.pool, 100, 30)
    return factors.vector_resort(listed, v.user_vec, v.item_vec)


# --- factor-based lists ----------------------------------------------------------------


def _capped(scored: str) -> str:
    return (
        "SELECT user_id, item_id, score, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (SELECT *, "
        f"ROW_NUMBER() OVER (PARTITION BY user_id, singer ORDER BY score DESC, item_id) AS g FROM ({scored})) WHERE g <= 3"
    )


_SCORE = "ROUND(list_dot_product(u.features, i.features), 9) AS score"
_SINGERS = "LEFT JOIN singers s ON s.item_id = i.item_id"
_NOT_EXCLUDED = "NOT EXISTS (SELECT 1 FROM history h WHERE h.user_id = {u} AND h.item_id = {i})"


@query(
    "cf_recommend",
    with_views(["pool", "recent_plays", "user_vec", "item_vec", "history"], "SELECT f.user_id, f.item_id, score, rank, CASE WHEN c.c_custkey IS NULL THEN 0 ELSE 1 END AS tag FROM "
    "(SELECT * FROM by_cand UNION ALL SELECT * FROM by_hot) f LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c "
    "ON c.c_custkey = f.user_id WHERE rank <= CASE WHEN c.c_custkey IS NULL THEN 20 ELSE 30 END",
    [("singers", "SELECT p_partkey AS item_id, p_brand AS singer FROM part WHERE p_size <= 40"),
     ("items", "SELECT * FROM item_vec WHERE item_id IN (SELECT p_partkey FROM part WHERE p_size <= 45) AND item_id NOT IN (SELECT p_partkey FROM part WHERE p_type = 'LARGE')"),
     ("hot", "SELECT item_id, features FROM (SELECT *, RANK() OVER (ORDER BY ROUND(list_dot_product(features, features), 9) DESC) AS r FROM items) WHERE r <= 200"),
     ("cand", "SELECT user_id, item_id FROM recs"), ("recs", _pool_recall("recent_plays", "pool", 100, 300)),
     ("usable", f"SELECT user_id, item_id FROM recs c WHERE item_id IN (SELECT item_id FROM items) AND {_NOT_EXCLUDED.format(u='c.user_id', i='c.item_id')}"),
     ("rich", "SELECT user_id FROM usable GROUP BY 1 HAVING COUNT(*) > 25"),
     ("by_cand", _capped(f"SELECT u.user_id, i.item_id, {_SCORE}, COALESCE(singer, 'Unknown') AS singer FROM usable c JOIN rich r ON r.user_id = c.user_id "
      f"JOIN user_vec u ON u.user_id = c.user_id JOIN items i ON i.item_id = c.item_id {_SINGERS}")),
     ("by_hot", _capped(f"SELECT u.user_id, i.item_id, {_SCORE}, COALESCE(singer, 'Unknown') AS singer FROM user_vec u CROSS JOIN hot i {_SINGERS} "
      f"WHERE u.user_id NOT IN (SELECT user_id FROM rich) AND {_NOT_EXCLUDED.format(u='u.user_id', i='i.item_id')}"))]),
)
def cf_recommend(v: View) -> DataFrame:
    part = v.table("part").withColumnRenamed("p_partkey", "item_id")
    users = v.user_vec.withColumnRenamed("features", "factor")
    items = v.item_vec.withColumnRenamed("features", "factor")
    profiles = v.table("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    singers = part.where(F.col("p_size") <= 40).select("item_id", F.col("p_brand").alias("singer"))
    out = factors.cf_recommend(
        users, recall.pool_recall(v.recent_plays, v.pool, 100, 300), items,
        part.where(F.col("p_size") <= 45), part.where(F.col("p_type") == "LARGE"), v.history, singers, profiles,
        min_candidates=25, length=20, extra=10, hot_n=200,
    )
    return out.select("user_id", "item_id", "score", "rank", "tag")


def _dense(rows: str, value: str) -> str:
    """SQL: one list per row index of ``value`` over all column indexes."""
    return f"SELECT i, list({value} ORDER BY j) AS r FROM {rows} GROUP BY i"


def _walk_sql(rounds: int) -> str:
    """Scores of every (root, item) pair after ``rounds`` steps, as dense symmetric matrices over items.

    Item to item takes two steps, so p = 0.15 (I + A + A^2 + ..) with A = 0.85^2 W / W(i) W' / W(u), scaled by the
    square roots of the item weights to a symmetric B. S(m), the sum of m powers, is built by the bits of the
    number of terms: S(m+1) = I + B S(m), B^m = I + B S(m) - S(m), S(2m) = S(m) + B^m S(m).
    """
    ctes = [
        ("of_item", "SELECT item_id, SUM(dur) AS t, ROW_NUMBER() OVER (ORDER BY item_id) AS i FROM plays GROUP BY 1"),
        ("of_user", "SELECT user_id, SUM(dur) AS t FROM plays GROUP BY 1"),
        ("met", "SELECT x.i, y.i AS j, 0.85::DOUBLE * 0.85 * SUM(a.dur * b.dur / u.t) / SQRT(ANY_VALUE(x.t) * ANY_VALUE(y.t)) AS b FROM plays a "
         "JOIN plays b USING (user_id) JOIN of_user u USING (user_id) JOIN of_item x ON x.item_id = a.item_id JOIN of_item y ON y.item_id = b.item_id GROUP BY 1, 2"),
        ("b", _dense("(SELECT x.i, y.i AS j, COALESCE(b, 0) AS b FROM of_item x CROSS JOIN of_item y LEFT JOIN met ON met.i = x.i AND met.j = y.i)", "b")),
        ("s0", _dense("(SELECT x.i, y.i AS j FROM of_item x CROSS JOIN of_item y)", "CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0 END")),
    ]
    at = "s0"

    def product(name: str, x: str, y: str, value: str) -> None:
        # slices of the left rows: branches of a union run at the same time
        rows = f"SELECT x.i AS i, list({value} ORDER BY y.i) AS r FROM {x} CROSS JOIN {y} y WHERE x.i % 8 = "
        ctes.append((name, " UNION ALL ".join(f"{rows}{k} GROUP BY x.i" for k in range(8))))

    one = "CASE WHEN x.i = y.i THEN 1.0::DOUBLE ELSE 0 END"
    for n, bit in enumerate(bin((rounds - 1) // 2 + 1)[3:], 1):
        product(f"t{n}", "b x", at, "list_dot_product(x.r, y.r)")
        power = "list_transform(range(1, len(x.r) + 1), lambda k: t.r[k] - x.r[k] + (k = x.i)::INT)"
        ctes.append((f"p{n}", f"SELECT x.i AS i, {power} AS r FROM {at} x JOIN t{n} t ON t.i = x.i"))
        product(f"d{n}", f"p{n} x JOIN {at} s ON s.i = x.i", at, "s.r[y.i] + list_dot_product(x.r, y.r)")
        at = f"d{n}"
        if bit == "1":
            product(f"s{n}", "b x", at, f"{one} + list_dot_product(x.r, y.r)")
            at = f"s{n}"
    final = (
        "SELECT root, item_id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY root ORDER BY score DESC, item_id) AS rank FROM "
        "(SELECT 'i' || x.item_id AS root, 'i' || y.item_id AS item_id, ROUND(0.15 * s.r[y.i] * SQRT(y.t / x.t), 9) AS score "
        f"FROM {at} s JOIN of_item x ON x.i = s.i CROSS JOIN of_item y WHERE x.i <> y.i AND s.r[y.i] > 0)) WHERE rank <= 100"
    )
    return with_views(["plays"], final, ctes, keep=True)


WALK_ROUNDS = 101


@query("personal_walk", _walk_sql(11))
def walk(v: View) -> DataFrame:
    """Ten steps from every played item."""
    return _walk(v, 11)


@query("personal_walk_all", _walk_sql(WALK_ROUNDS))
def walk_all(v: View) -> DataFrame:
    """The whole job: every played item is a root, a hundred steps."""
    return _walk(v, WALK_ROUNDS)


def _walk(v: View, rounds: int) -> DataFrame:
    u, i = F.concat(F.lit("u"), F.col("user_id").cast("string")), F.concat(F.lit("i"), F.col("item_id").cast("string"))
    edges = v.plays.select(u.alias("src"), i.alias("dst"), F.col("dur").alias("w")).unionByName(
        v.plays.select(i.alias("src"), u.alias("dst"), F.col("dur").alias("w"))
    )
    items = v.plays.select(i.alias("item_id")).distinct()
    return personal_walk(edges, items.select(F.col("item_id").alias("root")), items, rounds=rounds).select("root", "item_id", "score")
