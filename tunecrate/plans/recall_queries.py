"""Recall, merge and list queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.functions import ids
from tunecrate.operators import filters, lists, recall
from tunecrate.operators.factors import idf_rating
from tunecrate.operators.ranking_windows import top_n
from tunecrate.plans.registry import query
from tunecrate.plans.views import HISTORY_END, RECS_END, View, with_views

# --- shared SQL steps ------------------------------------------------------------------


def _draw(seed: int, *cols: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}))"


def _draw_int(seed: int, *cols: str) -> str:
    return f"CAST('0x' || substr({_draw(seed, *cols)}, 1, 8) AS BIGINT)"


def _pool_recall(source: str, pool: str, max_rank: int | None, keep: int) -> str:
    near = "" if max_rank is None else f" WHERE p.rank < {max_rank}"
    return (
        "SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY hit) AS pos FROM ("
        "SELECT user_id, item_id, MIN(hit) AS hit FROM ("
        "SELECT s.user_id, p.dst AS item_id, ROW_NUMBER() OVER (PARTITION BY s.user_id "
        "ORDER BY p.sim DESC, p.dst, p.src) AS hit "
        f"FROM (SELECT DISTINCT user_id, item_id FROM {source}) s JOIN {pool} p ON s.item_id = p.src{near}) "
        f"WHERE hit <= {keep} GROUP BY 1, 2)"
    )


def _neighbours(pool: str, trained: str, n: int) -> str:
    return (
        "SELECT src, dst, nb_rank FROM (SELECT src, dst, ROW_NUMBER() OVER (PARTITION BY src ORDER BY rank, dst) "
        f"AS nb_rank FROM {pool}) WHERE nb_rank <= {n} AND src IN (SELECT item_id FROM {trained})"
    )


def _favourites(plays: str, neighbours: str, top: int, limit: int, where: str, order: str) -> str:
    return (
        "SELECT user_id, item_id, pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id "
        "ORDER BY fav_rank, nb_rank, item_id) AS pos FROM ("
        "SELECT user_id, dst AS item_id, MIN(fav_rank) AS fav_rank, "
        "arg_min(nb_rank, fav_rank * 100000 + nb_rank) AS nb_rank FROM ("
        f"SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {order}, item_id) AS fav_rank "
        f"FROM {plays} WHERE {where}) f JOIN {neighbours} ON item_id = src WHERE fav_rank <= {top} "
        f"GROUP BY 1, 2)) WHERE pos <= {limit}"
    )


def _merge(pools: list[str], excluded: str | None) -> str:
    stacked = " UNION ALL ".join(f"SELECT user_id, item_id, {i} AS prio, pos FROM {p}" for i, p in enumerate(pools))
    gone = "" if excluded is None else (
        f" WHERE NOT EXISTS (SELECT 1 FROM {excluded} x WHERE x.user_id = m.user_id AND x.item_id = m.item_id)"
    )
    return (
        "SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY prio, pos, item_id) AS pos FROM ("
        "SELECT user_id, item_id, prio, pos FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id "
        f"ORDER BY prio, pos) AS seen FROM ({stacked})) WHERE seen = 1) m{gone}"
    )


_EXCLUDED = "SELECT user_id, item_id FROM history UNION SELECT user_id, item_id FROM recs UNION SELECT user_id, item_id FROM yesterday"
_SPECIAL = ("special", _pool_recall("recent_plays", "pool", 100, 80))
_THEME = ("theme", _pool_recall("recent_plays", "pool_type", 5, 10))
_SINGER = ("singer_list", _pool_recall("recent_plays", "pool_brand", 20, 10))
_POOLS = ["pool", "pool_type", "pool_brand", "recent_plays"]
_HISTORIES = ["history", "recs", "yesterday"]
_NEIGH = ("neighbours", _neighbours("pool", "plays", 100))


def _excluded(v: View) -> DataFrame:
    return lists.exclusion_set(v.history, v.recs, v.yesterday)


def _special(v: View) -> DataFrame:
    return recall.pool_recall(v.recent_plays, v.shared_pool, 100, 80)


def _theme(v: View) -> DataFrame:
    return recall.pool_recall(v.recent_plays, v.pool_same("p_type"), 5, 10)


def _singer(v: View) -> DataFrame:
    return recall.pool_recall(v.recent_plays, v.pool_same("p_brand"), 20, 10)


# --- filters and simple top-N ----------------------------------------------------------

_USER_TEXT = "lpad(CAST(o_custkey AS VARCHAR), 9, '0')"


def _user_text():
    return F.lpad(F.col("o_custkey").cast("string"), 9, "0")


@query(
    "traffic_bucket",
    with_views([], "SELECT uid, CAST(COUNT(*) AS BIGINT) AS orders FROM "
    f"(SELECT {_USER_TEXT} AS uid FROM orders) WHERE substr(uid, 9, 1) = '8' AND CAST(substr(uid, 7, 2) AS INT) % 5 = 1 GROUP BY 1"),
)
def traffic_bucket(v: View) -> DataFrame:
    users = v.table("orders").select(_user_text().alias("uid"))
    return filters.traffic_bucket(users, "uid", "8-1").groupBy("uid").agg(F.count("*").alias("orders"))


@query(
    "good_bad_filter",
    with_views(["item_size"], "SELECT item_id, n FROM item_size WHERE item_id IN (SELECT p_partkey FROM part WHERE "
    "p_type IN ('SMALL', 'ECONOMY', 'PROMO')) AND item_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 40)"),
)
def good_bad(v: View) -> DataFrame:
    part = v.table("part").withColumnRenamed("p_partkey", "item_id")
    size = v.playlist_item.groupBy("item_id").agg(F.count("*").alias("n"))
    good = part.where(F.col("p_type").isin("SMALL", "ECONOMY", "PROMO"))
    return filters.good_bad_filter(size, good, part.where(F.col("p_size") > 40))


@query(
    "seeded_sample",
    with_views(["plays"], f"SELECT user_id, item_id FROM plays WHERE {_draw_int(1, 'user_id', 'item_id')} < {int(0.2 * 2**32)}"),
)
def seeded_sample(v: View) -> DataFrame:
    return filters.bernoulli_sample(v.plays, 0.2, 1, "user_id", "item_id").select("user_id", "item_id")


@query(
    "topn_per_key",
    with_views(["plays"], "SELECT user_id, item_id, dur, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id "
    "ORDER BY dur DESC, item_id) AS rank FROM plays) WHERE rank <= 10"),
)
def topn_per_key(v: View) -> DataFrame:
    return recall.topn_per_key(v.plays, "user_id", "dur", "item_id", 10)


@query(
    "idf_rating",
    with_views(["plays", "idf"], "SELECT user_id, item_id, ROUND(log10(dur / 0.01 + 1) * idf, 6) AS rating "
    "FROM plays JOIN idf USING (item_id)"),
)
def rating(v: View) -> DataFrame:
    return idf_rating(v.plays, v.idf).withColumn("rating", F.round("rating", 6))


# --- recall ----------------------------------------------------------------------------


@query(
    "neighbour_table",
    with_views(["pool", "pool_brand", "plays"],
    "SELECT src, dst, MIN(nb_rank) AS nb_rank FROM ("
    f"{_neighbours('pool', 'recent', 20)} UNION ALL {_neighbours('pool_brand', 'recent', 5)}) GROUP BY 1, 2",
    [("recent", "SELECT item_id FROM plays WHERE dur >= 4")]),
)
def neighbour_table(v: View) -> DataFrame:
    trained = v.plays.where(F.col("dur") >= 4)
    return recall.neighbour_table(v.shared_pool, trained, 20, v.pool_same("p_brand"), 5, numbered=True)


@query(
    "favourite_recall",
    with_views(["pool", "plays"], _favourites("plays", "neighbours", 30, 5000, "dur >= 2.0", "dur DESC"), [_NEIGH]),
)
def favourite_recall(v: View) -> DataFrame:
    return recall.favourite_recall(v.plays, recall.neighbour_table(v.pool, v.plays, numbered=True))


@query(
    "singer_recall",
    with_views(["pool", "pool_brand", "plays"],
    "SELECT user_id, item_id, pos FROM (" + _merge(["by_singer", "by_item"], None) + ") WHERE pos <= 5000",
    [_NEIGH, ("same", _neighbours("pool_brand", "plays", 4)),
     ("by_singer", _favourites("plays", "same", 250, 5000, "dur >= 2.0", "dur DESC")),
     ("by_item", _favourites("plays", "neighbours", 30, 5000, "dur >= 2.0", "dur DESC"))]),
)
def singer_recall(v: View) -> DataFrame:
    return recall.singer_recall(v.plays, v.pool_same("p_brand"), recall.neighbour_table(v.shared_pool, v.plays, numbered=True))


@query(
    "dislike_expand",
    with_views(["pool", "plays"], "SELECT user_id, item_id FROM ("
    + _favourites("plays", "neighbours", 10, 10**9, "dur <= 0.3", "dur") + ")", [_NEIGH]),
)
def dislike_expand(v: View) -> DataFrame:
    return recall.dislike_expand(v.plays, recall.neighbour_table(v.pool, v.plays, numbered=True))


@query("exclusion_set", with_views(_HISTORIES, _EXCLUDED))
def exclusion_set(v: View) -> DataFrame:
    return _excluded(v)


@query(
    "pool_recall",
    with_views(_POOLS, " UNION ALL ".join(f"SELECT '{n}' AS pool, user_id, item_id, pos FROM {t}"
    for n, t in (("special", "special"), ("theme", "theme"), ("singer", "singer_list"))), [_SPECIAL, _THEME, _SINGER]),
)
def pool_recall(v: View) -> DataFrame:
    named = {"special": _special(v), "theme": _theme(v), "singer": _singer(v)}
    out = None
    for name, df in named.items():
        part = df.select(F.lit(name).alias("pool"), "user_id", "item_id", "pos")
        out = part if out is None else out.unionByName(part)
    return out


# name -> (pool view, rank below, places); the tables have no language or audio, so these share the type and brand pools
PRESETS = {
    "special": ("pool", 100, 80), "theme": ("pool_type", 5, 10), "language": ("pool_type", 50, 50), "singer": ("pool_brand", 20, 10),
    "audio": ("pool_brand", None, 5), "behaviour": ("pool", 100, 150),
}
#: name -> (pool view, rank below, best, drawn from them)
SHUFFLED = {"special": ("pool", 100, 150, 50), "language": ("pool_type", 50, 150, 30), "behaviour": ("pool", 100, 400, 200)}


def _preset_pools(v: View) -> dict[str, DataFrame]:
    return {"pool": v.shared_pool, "pool_type": v.pool_same("p_type"), "pool_brand": v.pool_same("p_brand")}


def _stacked(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("pool"), "user_id", "item_id", "pos")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "pool_recall_presets",
    with_views(_POOLS, " UNION ALL ".join(f"SELECT '{n}' AS pool, user_id, item_id, pos FROM ({_pool_recall('recent_plays', *preset)})"
    for n, preset in PRESETS.items())),
)
def pool_recall_presets(v: View) -> DataFrame:
    """All six presets of pool recall, at their own ranks and places."""
    pools = _preset_pools(v)
    return _stacked({n: recall.pool_recall(v.recent_plays, pools[pool], rank, keep) for n, (pool, rank, keep) in PRESETS.items()})


@query(
    "pool_recall_shuffled_presets",
    with_views(_POOLS, " UNION ALL ".join(
        f"SELECT '{n}' AS pool, user_id, item_id, rn AS pos FROM (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "
        f"{_draw(1, 'user_id', 'item_id')}, user_id, item_id) AS rn FROM ({_pool_recall('recent_plays', pool, rank, best)})) WHERE rn <= {drawn}"
        for n, (pool, rank, best, drawn) in SHUFFLED.items())),
)
def pool_recall_shuffled_presets(v: View) -> DataFrame:
    pools = _preset_pools(v)
    return _stacked({n: recall.pool_recall_shuffled(v.recent_plays, pools[p], rank, best, drawn) for n, (p, rank, best, drawn) in SHUFFLED.items()})


@query(
    "pool_recall_shuffled",
    with_views(_POOLS, "SELECT user_id, item_id, rn AS pos FROM (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "
    f"{_draw(1, 'user_id', 'item_id')}, user_id, item_id) AS rn FROM best) WHERE rn <= 50",
    [("best", _pool_recall("recent_plays", "pool", 100, 150))]),
)
def pool_recall_shuffled(v: View) -> DataFrame:
    return recall.pool_recall_shuffled(v.recent_plays, v.pool, 100, 150, 50)


@query(
    "pool_recall_filtered",
    with_views(_POOLS + _HISTORIES, "SELECT user_id, item_id, rn AS pos FROM (SELECT user_id, item_id, "
    "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY pos) AS rn FROM special s WHERE NOT EXISTS "
    "(SELECT 1 FROM excluded x WHERE x.user_id = s.user_id AND x.item_id = s.item_id)) WHERE rn <= 30",
    [("excluded", _EXCLUDED), _SPECIAL]),
)
def pool_recall_filtered(v: View) -> DataFrame:
    return recall.pool_recall_filtered(v.recent_plays, v.pool, _excluded(v), 100, 80, 30)


@query(
    "channel_recall",
    with_views(["pool"], "SELECT item_id, channel, score, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id "
    "ORDER BY score DESC, channel) AS rank FROM (SELECT dst AS item_id, channel, ROUND(SUM(sim), 9) AS score FROM "
    "(SELECT DISTINCT p_type || '/' || p_brand AS channel, p_partkey FROM part) JOIN pool ON p_partkey = src "
    "WHERE sim >= 0.03 AND rank <= 200 GROUP BY 1, 2)) WHERE rank <= 10"),
)
def channel_recall(v: View) -> DataFrame:
    channels = v.table("part").select(
        F.concat_ws("/", "p_type", "p_brand").alias("channel"), F.col("p_partkey").alias("item_id")
    )
    return recall.channel_recall(channels, v.pool, min_sim=0.03)


# --- merging and list surgery ----------------------------------------------------------


@query(
    "pool_merge",
    with_views(_POOLS + _HISTORIES, _merge(["special", "theme", "singer_list"], "excluded"),
    [("excluded", _EXCLUDED), _SPECIAL, _THEME, _SINGER]),
)
def pool_merge(v: View) -> DataFrame:
    return lists.pool_merge([_special(v), _theme(v), _singer(v)], v.taken)


@query(
    "fill_to_n",
    with_views(_POOLS, "SELECT user_id, item_id, rn AS pos FROM (SELECT user_id, item_id, ROW_NUMBER() OVER "
    "(PARTITION BY user_id ORDER BY prio, pos, item_id) AS rn FROM (SELECT *, 0 AS prio FROM theme UNION ALL "
    "SELECT *, 1 AS prio FROM behaviour)) WHERE rn <= 200", [_THEME, ("behaviour", _pool_recall("recent_plays", "pool", 100, 400))]),
)
def fill_to_n(v: View) -> DataFrame:
    return lists.fill_to_n(_theme(v), recall.pool_recall(v.recent_plays, v.shared_pool, 100, 400), 200)


def _interleave(distinct: bool) -> str:
    both = (
        "SELECT user_id, item_id, pos * 2 AS slot FROM special UNION ALL SELECT b.user_id, item_id, b.pos * 2 + 1 "
        "FROM behaviour b JOIN (SELECT user_id, MAX(pos) AS len FROM special GROUP BY 1) l ON l.user_id = b.user_id WHERE b.pos <= len"
    )
    if distinct:
        both = f"SELECT user_id, item_id, MIN(slot) AS slot FROM ({both}) GROUP BY 1, 2"
    return f"SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY slot) AS pos FROM ({both})"


@query(
    "interleave",
    with_views(_POOLS, _interleave(True), [_SPECIAL, ("behaviour", _pool_recall("recent_plays", "pool", 50, 200))]),
)
def interleave(v: View) -> DataFrame:
    return lists.interleave(_special(v), recall.pool_recall(v.recent_plays, v.shared_pool, 50, 200), distinct=True)


@query(
    "group_list_filter",
    with_views(_POOLS + ["history", "recs"], "SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY pos, item_id) AS pos "
    "FROM special s WHERE user_id IN (SELECT user_id FROM theme) AND NOT EXISTS (SELECT 1 FROM gone x WHERE "
    "x.user_id = s.user_id AND x.item_id = s.item_id)",
    [_SPECIAL, _THEME, ("gone", "SELECT user_id, item_id FROM recs UNION SELECT user_id, item_id FROM history UNION SELECT user_id, item_id FROM theme")]),
)
def group_list_filter(v: View) -> DataFrame:
    return lists.group_list_filter(_special(v), v.spans((HISTORY_END, RECS_END)), v.spans((None, HISTORY_END)), _theme(v))


_HOT = (
    "hot", "SELECT item_id, players, ROW_NUMBER() OVER (ORDER BY players DESC, item_id) AS hot_rank FROM "
    "(SELECT item_id, COUNT(*) AS players FROM plays GROUP BY 1) ORDER BY players DESC, item_id LIMIT 300"
)
_EXPLORE = [
    _HOT,
    ("dealt", "SELECT item_id, (n - 1) % 30 AS stratum, (n - 1) // 30 AS slot FROM "
     f"(SELECT item_id, ROW_NUMBER() OVER (ORDER BY {_draw(1, 'item_id')}, item_id) AS n FROM hot)"),
    ("drawn", "SELECT user_id, stratum, "
     f"{_draw_int(1, 'user_id', 'stratum')} % size AS slot FROM (SELECT DISTINCT user_id FROM recent_plays), "
     "(SELECT stratum, COUNT(*) AS size FROM dealt GROUP BY 1)"),
    ("picked", "SELECT user_id, item_id FROM drawn JOIN dealt USING (stratum, slot) EXCEPT SELECT user_id, item_id FROM excluded"),
    ("explore", "SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "
     f"{_draw(1, 'user_id', 'item_id')}, user_id, item_id) AS pos FROM picked"),
]


def _explore(v: View) -> DataFrame:
    return recall.hot_explore(v.recent_plays, recall.hot_items(v.plays, 300), _excluded(v))


@query(
    "hot_explore",
    with_views(["plays", "recent_plays"] + _HISTORIES, "SELECT user_id, item_id, pos FROM explore", [("excluded", _EXCLUDED), *_EXPLORE]),
)
def hot_explore(v: View) -> DataFrame:
    return _explore(v)


@query(
    "random_mix",
    with_views(["plays"] + _POOLS + _HISTORIES,
    "SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY slot) AS pos FROM ("
    "SELECT user_id, item_id, MIN(slot) AS slot FROM (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id "
    "ORDER BY round, part, item_id) AS slot FROM offered) WHERE slot <= 200 GROUP BY 1, 2)",
    [("excluded", _EXCLUDED), *_EXPLORE, _SPECIAL,
     ("listed", "SELECT * FROM special WHERE user_id IN (SELECT user_id FROM explore)"),
     ("len", "SELECT user_id, MAX(pos) AS len FROM listed GROUP BY 1"),
     ("offered",
      "SELECT l.user_id, l.item_id, o.round, 0 AS part FROM (SELECT user_id, round, "
      f"{_draw_int(1, 'user_id', 'round')} % 100 + 1 AS pos FROM (SELECT DISTINCT user_id FROM explore), "
      "(SELECT UNNEST(range(0, 200)) AS round)) o JOIN listed l ON l.user_id = o.user_id AND l.pos = o.pos "
      "UNION ALL SELECT user_id, item_id, pos - 1, 1 FROM explore WHERE user_id IN (SELECT user_id FROM len) "
      "UNION ALL SELECT l.user_id, item_id, len - pos, 2 FROM listed l JOIN len ON len.user_id = l.user_id WHERE pos > 1")]),
)
def random_mix(v: View) -> DataFrame:
    return lists.random_mix(_special(v), _explore(v))


@query(
    "tail_replace",
    with_views(_POOLS + _HISTORIES, "SELECT s.user_id, COALESCE(n.item_id, s.item_id) AS item_id, s.pos FROM cut s LEFT JOIN ("
    "SELECT p.user_id, p.item_id, len - pick + 1 AS pos FROM picks p JOIN (SELECT user_id, MAX(pos) AS len FROM cut GROUP BY 1) l "
    "ON l.user_id = p.user_id WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.user_id = p.user_id AND c.item_id = p.item_id)) n "
    "ON n.user_id = s.user_id AND n.pos = s.pos",
    [("excluded", _EXCLUDED), _SPECIAL, _THEME, ("cut", "SELECT * FROM special WHERE pos <= 30"),
     ("usable", "SELECT DISTINCT user_id, item_id FROM theme WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 45) "
      "EXCEPT SELECT user_id, item_id FROM excluded"),
     ("picks", "SELECT user_id, item_id, pick FROM (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "
      f"{_draw(1, 'user_id', 'item_id')}, user_id, item_id) AS pick FROM usable) WHERE pick <= 2")]),
)
def tail_replace(v: View) -> DataFrame:
    cut = _special(v).where(F.col("pos") <= 30)
    invalid = v.table("part").where(F.col("p_size") > 45).select(F.col("p_partkey").alias("item_id"))
    picks = lists.fresh_picks(_theme(v), invalid, _excluded(v))
    return lists.tail_replace(cut, picks)


# --- audio recall ----------------------------------------------------------------------

_AUDIO = [
    ("excluded", _EXCLUDED),
    ("ranked", "SELECT user_id, item_id, rank FROM (SELECT user_id, item_id, ROW_NUMBER() OVER (PARTITION BY user_id "
     "ORDER BY dur DESC, item_id) AS rank FROM recent_plays) WHERE rank <= 8"),
    ("hits", "SELECT r.user_id, p.dst AS item_id, r.rank AS src_rank, r.item_id AS src, (1 - 0.3 * (r.rank - 1)) * p.sim AS c "
     "FROM ranked r JOIN pool p ON r.item_id = p.src WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE "
     "x.user_id = r.user_id AND x.item_id = p.dst)"),
    ("folded", "SELECT user_id, item_id, ROUND(SUM(c * CASE WHEN k = 1 THEN 1.0::DOUBLE ELSE POWER(0.6::DOUBLE, k - GREATEST(i, 2) + 1) END), 9) AS score FROM "
     "(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id ORDER BY src_rank, src) AS i, "
     "COUNT(*) OVER (PARTITION BY user_id, item_id) AS k FROM hits) GROUP BY 1, 2"),
    ("decayed", "SELECT user_id, item_id, score, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "
     "score DESC, item_id) AS rank FROM folded) WHERE rank <= 100"),
    ("capped", "SELECT user_id, item_id, score, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM "
     "(SELECT d.*, author, ROW_NUMBER() OVER (PARTITION BY user_id, author ORDER BY score DESC, d.item_id) AS g FROM decayed d "
     "LEFT JOIN authors a ON a.item_id = d.item_id) WHERE g <= 2 OR author IS NULL"),
]
_AUTHORS = ("authors", "SELECT p_partkey AS item_id, p_brand AS author FROM part WHERE p_size <= 40")
_AUDIO_VIEWS = ["pool", "recent_plays"] + _HISTORIES


def _decayed(v: View) -> DataFrame:
    ranked = top_n(v.recent_plays, ["user_id"], [F.desc("dur"), F.col("item_id")], 8)
    pool = v.pool.select("src", "dst", F.col("sim").alias("score"))
    return recall.decayed_recall(ranked, pool, _excluded(v))


def _authors(v: View) -> DataFrame:
    known = v.table("part").where(F.col("p_size") <= 40)
    return known.select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("author"))


@query("decayed_recall", with_views(_AUDIO_VIEWS, "SELECT user_id, item_id, score, rank FROM decayed", [_AUTHORS, *_AUDIO]))
def decayed_recall(v: View) -> DataFrame:
    return _decayed(v)


@query(
    "author_cap",
    with_views(_AUDIO_VIEWS, "SELECT user_id, string_agg(item_id || ':' || printf('%.5f', score), ',' ORDER BY rank) AS items "
    "FROM capped WHERE rank <= 20 GROUP BY 1", [_AUTHORS, *_AUDIO]),
)
def author_cap(v: View) -> DataFrame:
    capped = recall.author_cap(_decayed(v), _authors(v), 2, 20).withColumnRenamed("rank", "pos")
    shown = F.concat(F.col("item_id").cast("string"), F.lit(":"), F.format_string("%.5f", "score"))
    return lists.format_list(capped, shown)


# tag weights of a user: shares of listening per item type, in the order of the type names
_TAG_STEPS = [
    ("tag_no", "SELECT tag, ROW_NUMBER() OVER (ORDER BY tag) - 1 AS no FROM (SELECT DISTINCT tag FROM item_tag)"),
    ("weights", "SELECT user_id, no, ROUND(SUM(dur), 6) AS w FROM recent_plays JOIN item_tag USING (item_id) JOIN tag_no USING (tag) GROUP BY 1, 2"),
    ("dominant", "SELECT user_id, arg_max(no, w * 100 - no) AS tag FROM weights GROUP BY 1"),
]


@query(
    "tag_fill",
    with_views(_AUDIO_VIEWS + ["item_tag"],
    "SELECT user_id, item_id, score, rank FROM short UNION ALL SELECT user_id, item_id, 0.0::DOUBLE, have + turn_rank FROM ("
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY turn) AS turn_rank FROM candidates) "
    "WHERE turn_rank <= 20 - have",
    [_AUTHORS, *_AUDIO, *_TAG_STEPS, ("short", "SELECT * FROM capped WHERE rank <= 12"),
     ("need", "SELECT d.user_id, d.tag, COALESCE(h.have, 0) AS have FROM dominant d LEFT JOIN (SELECT user_id, COUNT(*) AS have "
      "FROM short GROUP BY 1) h ON h.user_id = d.user_id WHERE COALESCE(h.have, 0) < 20"),
     ("slots", "SELECT no AS tag, item_id, ROW_NUMBER() OVER (PARTITION BY no ORDER BY b // 16777216, b, item_id) - 1 AS slot FROM "
      f"(SELECT no, item_id, {_draw_int(1, 'item_id')} AS b FROM item_tag JOIN tag_no USING (tag))"),
     ("sizes", "SELECT tag, COUNT(*) AS size FROM slots GROUP BY 1"),
     ("draws", "SELECT n.user_id, n.tag, n.have, t.turn, "
      f"({_draw_int(1, 'n.user_id')} + t.turn) % size AS slot FROM need n JOIN sizes s ON s.tag = n.tag "
      "JOIN (SELECT UNNEST(range(0, 40)) AS turn) t ON t.turn < s.size"),
     ("candidates", "SELECT d.user_id, s.item_id, d.have, d.turn FROM draws d JOIN slots s ON s.tag = d.tag AND s.slot = d.slot "
      "WHERE NOT EXISTS (SELECT 1 FROM short x WHERE x.user_id = d.user_id AND x.item_id = s.item_id)")]),
)
def tag_fill(v: View) -> DataFrame:
    short = recall.author_cap(_decayed(v), _authors(v), 2, 12)
    weights = v.recent_plays.join(v.item_tag, "item_id").groupBy("user_id", "tag").agg(F.round(F.sum("dur"), 6).alias("weight"))
    return recall.tag_fill(short, weights, v.item_tag.select("tag", "item_id"), 20)

