"""Exposure, play, favourite and listening-time reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import ids, measures
from tunecrate.operators import filters, recall, sessions
from tunecrate.plans.registry import query
from tunecrate.plans.views import PATHS, View, with_views
from tunecrate.sources.sinks import neighbour_lines

# --- by playlist size ------------------------------------------------------------------


@query(
    "rpt_plays_by_size",
    with_views(["log", "mapping"], "SELECT size_tag, SUM(plays)::BIGINT AS plays, COUNT(DISTINCT global_id) AS playlists FROM "
    "(SELECT playlist, COUNT(*) AS plays FROM log WHERE day >= '1998-01-01' GROUP BY 1) JOIN mapping ON playlist = any_id GROUP BY 1"),
)
def plays_by_size(v: View) -> DataFrame:
    plays = v.log.where(F.col("day") >= "1998-01-01").groupBy("playlist").agg(F.count("*").alias("plays"))
    return (
        plays.join(v.mapping, F.col("playlist") == F.col("any_id"))
        .groupBy("size_tag")
        .agg(F.sum("plays").alias("plays"), F.countDistinct("global_id").alias("playlists"))
    )


@query(
    "rpt_favs_by_size",
    with_views(["log", "mapping"], "SELECT size_tag, COUNT(*) AS favs, COUNT(DISTINCT global_id) AS playlists, COUNT(DISTINCT uid) AS users "
    "FROM (SELECT DISTINCT uid, path, item_id, playlist FROM log WHERE day >= '1996-01-01' AND day < '2000-01-01' AND flag IN ('R') "
    "AND length(playlist) >= 1 AND TRY_CAST(uid AS INT) >= 0 AND ((line = 4 AND qty > 10) OR line <> 4)) "
    "JOIN mapping ON playlist = any_id GROUP BY 1"),
)
def favs_by_size(v: View) -> DataFrame:
    favs = v.log.where(
        (F.col("day") >= "1996-01-01") & (F.col("day") < "2000-01-01") & F.col("flag").isin("R")
        & (F.length("playlist") >= 1) & (F.col("uid").try_cast("int") >= 0)
        & (((F.col("line") == 4) & (F.col("qty") > 10)) | (F.col("line") != 4))
    ).select("uid", "path", "item_id", "playlist").distinct()
    return (
        favs.join(v.mapping, F.col("playlist") == F.col("any_id"))
        .groupBy("size_tag")
        .agg(F.count("*").alias("favs"), F.countDistinct("global_id").alias("playlists"), F.countDistinct("uid").alias("users"))
    )


@query(
    "rpt_exposed_not_played",
    with_views(["log", "mapping"], "SELECT size_tag, COUNT(*) AS rows_left, COUNT(DISTINCT global_id) AS playlists, COUNT(DISTINCT uid) AS users "
    "FROM shown s WHERE NOT EXISTS (SELECT 1 FROM played p WHERE p.uid = s.uid AND p.global_id = s.global_id) GROUP BY 1",
    [("shown", "SELECT DISTINCT size_tag, uid, global_id FROM log JOIN mapping ON playlist = any_id WHERE flag = 'N'"),
     ("played", "SELECT DISTINCT size_tag, uid, global_id FROM log JOIN mapping ON playlist = any_id WHERE flag = 'A'")]),
)
def exposed_not_played(v: View) -> DataFrame:
    def mapped(flag: str) -> DataFrame:
        facts = v.log.where(F.col("flag") == flag).select("uid", "playlist")
        return filters.to_global_ids(facts, "playlist", v.mapping)

    left = filters.missing_pairs(mapped("N"), mapped("A"), "uid", "global_id")
    return left.groupBy("size_tag").agg(
        F.count("*").alias("rows_left"), F.countDistinct("global_id").alias("playlists"), F.countDistinct("uid").alias("users")
    )


@query(
    "canonical_id_join",
    with_views(["log", "mapping"], "SELECT DISTINCT uid, global_id, qty FROM log JOIN mapping ON playlist = any_id "
    "WHERE playlist IS NOT NULL AND playlist <> 'NULL' AND day >= '2001-01-01'"),
)
def canonical_id_join(v: View) -> DataFrame:
    facts = v.log.where((F.col("day") >= "2001-01-01") & F.col("playlist").isNotNull() & (F.col("playlist") != "NULL"))
    return filters.to_global_ids(
        facts.select("uid", "playlist", "qty"), "playlist", v.mapping.select("any_id", "global_id").distinct()
    )


# --- listening time --------------------------------------------------------------------

_LISTEN_MODULE = "CASE " + " ".join(
    f"WHEN regexp_matches(path, '{pattern}') THEN '{label}'" for pattern, label in measures.MODULE_RULES
) + f" ELSE '{measures.DEFAULT_MODULE}' END"
_PATHS_SQL = "[" + ", ".join(f"'{p}'" for p in PATHS) + "]"
_EFFECTIVE = (
    "CASE WHEN reported > 50 * len_ms THEN len_ms / 1000 ELSE reported / 1000 END"
)
_LISTEN = (
    "listen",
    f"SELECT event_id, user_id, t, {_EFFECTIVE} AS secs, {_LISTEN_MODULE} AS module FROM ("
    "SELECT event_id, user_id, t, CASE WHEN version < 7900 AND value * 30000 >= 0 THEN value * 30000 "
    "WHEN version >= 7900 AND value * 20000 >= 0 THEN value * 20000 ELSE 0 END AS reported, len_ms, path FROM ("
    f"SELECT *, 7850 + k AS version, (k + 1) * 1000.0::DOUBLE AS len_ms, ({_PATHS_SQL})[k % 7 + 1] AS path FROM ev WHERE event_type = 'click'))",
)


def _listening(v: View) -> DataFrame:
    """Clicks in the role of plays: seconds listened and source module."""
    k = F.col("k")
    path = F.element_at(F.array(*[F.lit(p) for p in PATHS]), k % 7 + 1)
    secs = measures.effective_seconds(
        k + 7850, F.col("value") * 30000, F.col("value") * 20000, (k + 1).cast("double") * 1000
    )
    return v.events.where(F.col("event_type") == "click").select(
        "event_id", "user_id", "t", secs.alias("secs"), measures.path_module(path).alias("module")
    )


@query(
    "effective_duration",
    with_views(["ev"], "SELECT event_id, user_id, ROUND(secs, 6) AS secs, module FROM listen", [_LISTEN]),
)
def effective_duration(v: View) -> DataFrame:
    return _listening(v).select("event_id", "user_id", F.round("secs", 6).alias("secs"), "module")


@query(
    "interval_overlap_time",
    with_views(["ev"], "SELECT module, ROUND(SUM(LEAST(f.e, l.t) - GREATEST(f.s, l.t - l.secs)), 4) AS seconds, COUNT(DISTINCT l.user_id) AS users "
    "FROM (SELECT user_id, t AS s, t + value * 60 AS e FROM ev WHERE event_type = 'view') f JOIN listen l "
    "ON f.user_id = l.user_id AND f.s <= l.t AND l.t - l.secs <= f.e GROUP BY 1", [_LISTEN]),
)
def interval_overlap_time(v: View) -> DataFrame:
    foreground = v.events.where(F.col("event_type") == "view").select(
        "user_id", F.col("t").alias("start"), (F.col("t") + F.col("value") * 60).alias("end")
    )
    listening = _listening(v).select(
        "user_id", (F.col("t") - F.col("secs")).alias("start"), F.col("t").alias("end"), "module"
    )
    return sessions.interval_overlap(foreground, listening).withColumn("seconds", F.round("seconds", 4))


@query(
    "rpt_listen_by_module",
    with_views(["ev"], "SELECT module, ROUND(SUM(secs), 4) AS seconds, COUNT(DISTINCT user_id) AS users FROM listen "
    "WHERE user_id IN (SELECT user_id FROM ev WHERE event_type = 'view' AND k < 20) GROUP BY 1", [_LISTEN]),
)
def listen_by_module(v: View) -> DataFrame:
    app_users = v.events.where((F.col("event_type") == "view") & (F.col("k") < 20)).select("user_id").distinct()
    return (
        _listening(v).join(app_users, "user_id", "left_semi").groupBy("module")
        .agg(F.round(F.sum("secs"), 4).alias("seconds"), F.countDistinct("user_id").alias("users"))
    )


@query(
    "focus_sessions",
    with_views(["ev"], "SELECT user_id, ROUND(MIN(t), 6) AS session_start, ROUND(MAX(t), 6) AS session_end, ROUND(MAX(t) - MIN(t), 6) AS seconds, "
    "COUNT(*) AS events FROM (SELECT *, SUM(is_new) OVER (PARTITION BY user_id ORDER BY t, event_id) AS session FROM ("
    "SELECT *, CASE WHEN t - LAG(t) OVER (PARTITION BY user_id ORDER BY t, event_id) < 21600 THEN 0 ELSE 1 END AS is_new FROM ev)) "
    "GROUP BY user_id, session"),
)
def focus_sessions(v: View) -> DataFrame:
    out = sessions.focus_sessions(v.table("events").select("user_id", "ts"), 21600)
    return out.select(
        "user_id", *[F.round(c, 6).alias(c) for c in ("session_start", "session_end", "seconds")], "events"
    )


# --- pools -----------------------------------------------------------------------------


@query(
    "rpt_top20_list",
    with_views(["pool"], "SELECT src, string_agg(dst || ':' || printf('%.6f', sim), ',' ORDER BY sim DESC, dst) AS neighbours "
    "FROM pool WHERE rank <= 20 GROUP BY 1"),
)
def top20_list(v: View) -> DataFrame:
    return neighbour_lines(v.pool, 20)


@query(
    "rpt_pairs_missing",
    with_views(["pool", "pool_type"], "SELECT COUNT(*) AS pairs FROM pool a WHERE rank < 300 AND NOT EXISTS "
    "(SELECT 1 FROM pool_type b WHERE b.src = a.src AND b.dst = a.dst AND b.rank < 300 AND b.sim > 0.03)"),
)
def pairs_missing(v: View) -> DataFrame:
    b = v.pool_same("p_type").where((F.col("rank") < 300) & (F.col("sim") > 0.03))
    return filters.missing_pairs(v.shared_pool.where(F.col("rank") < 300), b, "src", "dst").agg(F.count("*").alias("pairs"))


@query(
    "rpt_sources_missing",
    with_views(["pool", "pool_brand"], "SELECT src, dst, sim, rank FROM pool WHERE rank < 50 AND src NOT IN "
    "(SELECT src FROM pool_brand WHERE sim > 0.05) ORDER BY src, rank LIMIT 300"),
)
def sources_missing(v: View) -> DataFrame:
    b = v.pool_same("p_brand").where(F.col("sim") > 0.05)
    return filters.missing_pairs(v.shared_pool.where(F.col("rank") < 50), b, "src").select(
        "src", "dst", "sim", "rank"
    ).orderBy("src", "rank").limit(300)


# --- traffic, modules, conversion ------------------------------------------------------


@query(
    "rpt_by_tail_digit",
    with_views(["log"], "SELECT substr(uid, 9, 1) AS digit, COUNT(DISTINCT uid) AS users, COUNT(*) AS plays, SUM(qty) AS duration FROM log "
    "WHERE path LIKE '/电台/有声电台/推荐/%' AND substr(version, 1, 3) = '930' GROUP BY 1"),
)
def by_tail_digit(v: View) -> DataFrame:
    rows = v.log.where(F.col("path").like("/电台/有声电台/推荐/%") & (F.substring("version", 1, 3) == "930"))
    return rows.groupBy(ids.tail_digit(F.col("uid")).alias("digit")).agg(
        F.countDistinct("uid").alias("users"), F.count("*").alias("plays"), F.sum("qty").alias("duration")
    )


@query(
    "rpt_rec_hits",
    with_views(["plays", "recent_plays"], "SELECT COUNT(DISTINCT user_id) AS users, COUNT(*) AS hits FROM "
    "(SELECT DISTINCT user_id, item_id FROM recent_plays WHERE user_id % 10 = 8) JOIN (SELECT user_id, item_id FROM (SELECT *, "
    "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY dur DESC, item_id) AS rank FROM plays) WHERE rank <= 6 AND user_id % 10 = 8) "
    "USING (user_id, item_id)"),
)
def rec_hits(v: View) -> DataFrame:
    tail = ids.tail_digit(F.col("user_id").cast("string")) == "8"
    shown = recall.topn_per_key(v.plays.where(tail), "user_id", "dur", "item_id", 6)
    return (
        v.recent_plays.where(tail).select("user_id", "item_id").distinct()
        .join(shown.select("user_id", "item_id"), ["user_id", "item_id"])
        .agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("hits"))
    )


# Fixed value: source paths counted as playlist recommendation.
_RECOMMENDED = "^/歌单(/全部分类)?/推荐|首页/个性化推荐/歌单"


def _users_by(rows: DataFrame, key: str, out: str) -> DataFrame:
    return rows.groupBy(key).agg(F.countDistinct("uid").alias(out))


@query(
    "rpt_worst_conversion",
    with_views(["log"], "SELECT w.supp || '|' || s_name || '|' || n_name || '|' || p_name AS line FROM (SELECT a.supp, b.played / a.skipped AS pre FROM "
    "(SELECT supp, COUNT(DISTINCT uid) AS skipped FROM log WHERE flag = 'N' GROUP BY 1 HAVING COUNT(DISTINCT uid) > 100) a JOIN "
    f"(SELECT supp, COUNT(DISTINCT uid) AS played FROM log WHERE flag = 'A' AND regexp_matches(path, '{_RECOMMENDED}') GROUP BY 1) b "
    "ON a.supp = b.supp ORDER BY pre, a.supp LIMIT 300) w JOIN supplier ON s_suppkey = w.supp JOIN nation ON n_nationkey = s_nationkey "
    "JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) m ON m.l_suppkey = w.supp JOIN part ON p_partkey = l_partkey"),
)
def worst_conversion(v: View) -> DataFrame:
    skipped = _users_by(v.log.where(F.col("flag") == "N"), "supp", "skipped").where(F.col("skipped") > 100)
    played = _users_by(v.log.where((F.col("flag") == "A") & F.col("path").rlike(_RECOMMENDED)), "supp", "played")
    worst = (
        skipped.join(played, "supp").select("supp", (F.col("played") / F.col("skipped")).alias("pre"))
        .orderBy("pre", "supp").limit(300)
    )
    lists = v.table("supplier").join(v.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    songs = v.table("lineitem").select("l_suppkey", "l_partkey").distinct().join(
        v.table("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    )
    return (
        worst.join(lists, F.col("supp") == F.col("s_suppkey")).join(songs, F.col("supp") == F.col("l_suppkey"))
        .select(F.concat_ws("|", F.col("supp").cast("string"), "s_name", "n_name", "p_name").alias("line"))
    )


@query(
    "rpt_conversion_rate",
    with_views(["log", "mapping", "playlists"], "SELECT local_id, song_count, ROUND(pre, 9) AS pre, skipped FROM (SELECT local_id, skipped, song_count, "
    "played / (skipped + played) AS pre FROM (SELECT global_id, skipped FROM (SELECT split_part(shown, ':', 1) AS any_id, COUNT(DISTINCT uid) AS skipped "
    "FROM (SELECT uid, playlist || ':' || line AS shown FROM log WHERE flag = 'N') GROUP BY 1 HAVING COUNT(DISTINCT uid) > 3) s JOIN "
    "(SELECT DISTINCT any_id, global_id FROM mapping) m ON m.any_id = s.any_id) a JOIN "
    "(SELECT global_id, COUNT(DISTINCT uid) AS played FROM log JOIN mapping ON playlist = any_id WHERE flag = 'A' GROUP BY 1) b "
    "ON a.global_id = b.global_id JOIN playlists p ON p.global_id = a.global_id) ORDER BY pre, local_id, skipped LIMIT 100"),
)
def conversion_rate(v: View) -> DataFrame:
    pairs = v.mapping.select("any_id", "global_id").distinct()
    shown = v.log.where(F.col("flag") == "N").select(
        "uid", F.concat_ws(":", "playlist", F.col("line").cast("string")).alias("shown")
    )
    skipped = _users_by(shown.withColumn("any_id", F.split("shown", ":")[0]), "any_id", "skipped").where(F.col("skipped") > 3)
    played = _users_by(
        v.log.where(F.col("flag") == "A").join(pairs, F.col("playlist") == F.col("any_id")), "global_id", "played"
    )
    rate = F.col("played") / (F.col("skipped") + F.col("played"))
    return (
        skipped.join(pairs, "any_id").join(played, "global_id").join(v.playlists, "global_id")
        .select("local_id", "song_count", rate.alias("pre"), "skipped")
        .orderBy("pre", "local_id", "skipped").limit(100).withColumn("pre", F.round("pre", 9))
    )


_SEARCHED = "day >= '1997-01-01' AND TRY_CAST(uid AS INT) > 0 AND path LIKE '%搜索/%/歌单%' AND flag <> 'N'"


def _searched(v: View) -> DataFrame:
    return v.log.where(
        (F.col("day") >= "1997-01-01") & (F.col("uid").try_cast("int") > 0)
        & F.col("path").like("%搜索/%/歌单%") & (F.col("flag") != "N")
    )


@query(
    "rpt_module_totals",
    with_views(["log"], f"SELECT COUNT(DISTINCT playlist) AS playlists, COUNT(DISTINCT uid) AS users, COUNT(*) AS plays FROM log WHERE {_SEARCHED}"),
)
def module_totals(v: View) -> DataFrame:
    return _searched(v).agg(
        F.countDistinct("playlist").alias("playlists"), F.countDistinct("uid").alias("users"), F.count("*").alias("plays")
    )


@query(
    "rpt_module_totals_mapped",
    with_views(["log", "mapping"], "SELECT COUNT(DISTINCT global_id) AS playlists, COUNT(DISTINCT uid) AS users, SUM(plays)::BIGINT AS plays FROM "
    f"(SELECT playlist, uid, COUNT(*) AS plays FROM log WHERE {_SEARCHED} GROUP BY 1, 2) JOIN mapping ON playlist = any_id"),
)
def module_totals_mapped(v: View) -> DataFrame:
    facts = _searched(v).groupBy("playlist", "uid").agg(F.count("*").alias("plays"))
    return facts.join(v.mapping, F.col("playlist") == F.col("any_id")).agg(
        F.countDistinct("global_id").alias("playlists"), F.countDistinct("uid").alias("users"), F.sum("plays").alias("plays")
    )


# Popularity-rank ranges and their printed labels.
_RANK_RANGES = [
    (1, 1000, "(1,1000)"),
    (1001, 5000, "(1000,5000)"),
    (5001, 50000, "(10000,50000)"),
    (50001, 100000, "(50000,100000)"),
    (100001, 500000, "(100000,500000)"),
    (500001, 1000000, "(500000,1000000)"),
]


@query(
    "rpt_plays_by_rank_bucket",
    with_views(["log"], "SELECT CASE " + " ".join(f"WHEN p_partkey + 1 BETWEEN {a} AND {b} THEN '{t}'" for a, b, t in _RANK_RANGES)
    + " ELSE '>100w' END AS rank_tag, COUNT(DISTINCT p_partkey) AS songs, SUM(pv)::BIGINT AS plays FROM "
    "(SELECT lower(md5(CAST(item_id AS VARCHAR))) AS hash, COUNT(*) AS pv FROM log WHERE "
    "substr(uid, 9, 1) || '-' || (CAST(substr(uid, 7, 2) AS INT) % 10) = '4-1' GROUP BY 1) f JOIN part "
    "ON upper(trim(hash)) = upper(md5(CAST(p_partkey AS VARCHAR))) GROUP BY 1"),
)
def plays_by_rank_bucket(v: View) -> DataFrame:
    hashed = F.lower(F.md5(F.col("item_id").cast("string")))
    facts = filters.traffic_bucket(v.log, "uid", "4-1", 10).groupBy(hashed.alias("hash")).agg(F.count("*").alias("pv"))
    songs = v.table("part").select(
        F.upper(F.md5(F.col("p_partkey").cast("string"))).alias("song_hash"), "p_partkey",
        measures.range_label(F.col("p_partkey") + 1, _RANK_RANGES, ">100w").alias("rank_tag"),
    )
    return filters.same_key(facts, songs, "hash", "song_hash").groupBy("rank_tag").agg(
        F.countDistinct("p_partkey").alias("songs"), F.sum("pv").alias("plays")
    )


@query(
    "rpt_inconsistent_lists",
    with_views(["playlists"], "SELECT local_id, song_count, l_orderkey AS songid, l_linenumber * 20 AS sort FROM "
    "(SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_linenumber * 20 > 100) "
    "JOIN playlists ON local_id = CAST(l_partkey AS VARCHAR) WHERE song_count < 100 ORDER BY local_id, songid, sort LIMIT 10"),
)
def inconsistent_lists(v: View) -> DataFrame:
    sort = F.col("l_linenumber") * 20
    placed = v.table("lineitem").where(sort > 100).select(
        F.col("l_partkey").cast("string").alias("local_id"), F.col("l_orderkey").alias("songid"), sort.alias("sort")
    ).distinct()
    small = v.playlists.where(F.col("song_count") < 100).select("local_id", "song_count")
    return placed.join(small, "local_id").select("local_id", "song_count", "songid", "sort").orderBy(
        "local_id", "songid", "sort"
    ).limit(10)


# --- histograms ------------------------------------------------------------------------

_YEARS = [(None, 1996, "<1997"), (1997, 1998, "1997-1998"), (1999, 2000, "1999-2000")]


@query(
    "bucket_histogram",
    with_views([], "SELECT type, COUNT(*) AS playlists FROM (SELECT CASE WHEN y <= 1996 THEN '<1997' WHEN y BETWEEN 1997 AND 1998 THEN '1997-1998' "
    "WHEN y BETWEEN 1999 AND 2000 THEN '1999-2000' ELSE '2001' END AS type FROM (SELECT year(o_orderdate) AS y FROM orders)) GROUP BY 1"),
)
def bucket_histogram(v: View) -> DataFrame:
    label = measures.range_label(F.year("o_orderdate"), _YEARS, "2001")
    return v.table("orders").groupBy(label.alias("type")).agg(F.count("*").alias("playlists"))


# Publish-year ranges of the exposure report.
_PUBLISH_YEARS = [
    (2019, 2019, "2019"),
    (2018, 2018, "2018"),
    (2017, 2017, "2017"),
    (2014, 2016, "2014-2016"),
    (2010, 2013, "2010-2013"),
    (2000, 2009, "2000-2009"),
    (None, 1999, "2000以前"),
]


@query(
    "explode_exposures",
    with_views(["ev"], "SELECT type, COUNT(*) AS shown, COUNT(DISTINCT item) AS items FROM (SELECT DISTINCT user_id, CAST(split_part(sp, '::', 1) AS BIGINT) AS item "
    "FROM (SELECT user_id, UNNEST(string_split(k || '::a,' || (k * 7 + 3) || '::b,' || (k * 11 + 5) || '::c', ',')) AS sp FROM ev WHERE event_type = 'view')) "
    "JOIN (SELECT p_partkey, CASE WHEN y = 2019 THEN '2019' WHEN y = 2018 THEN '2018' WHEN y = 2017 THEN '2017' WHEN y BETWEEN 2014 AND 2016 THEN '2014-2016' "
    "WHEN y BETWEEN 2010 AND 2013 THEN '2010-2013' WHEN y BETWEEN 2000 AND 2009 THEN '2000-2009' WHEN y <= 1999 THEN '2000以前' ELSE '0' END AS type "
    "FROM (SELECT p_partkey, 1990 + p_size AS y FROM part)) ON item = p_partkey GROUP BY 1"),
)
def explode_exposures(v: View) -> DataFrame:
    k = F.col("k")
    listed = F.concat(
        k.cast("string"), F.lit("::a,"), (k * 7 + 3).cast("string"), F.lit("::b,"), (k * 11 + 5).cast("string"), F.lit("::c")
    )
    shown = v.events.where(F.col("event_type") == "view").select("user_id", F.explode(F.split(listed, ",")).alias("sp"))
    exposed = shown.select("user_id", F.split("sp", "::")[0].try_cast("bigint").alias("item")).distinct()
    years = v.table("part").select(
        F.col("p_partkey").alias("item"), measures.range_label(F.col("p_size") + 1990, _PUBLISH_YEARS, "0").alias("type")
    )
    return exposed.join(years, "item").groupBy("type").agg(
        F.count("*").alias("shown"), F.countDistinct("item").alias("items")
    )


@query(
    "rpt_format_counts",
    with_views(["ev"], "SELECT event_type AS wm, COUNT(*) AS n FROM ev WHERE user_id % 10 = 1 GROUP BY 1 ORDER BY 1 LIMIT 20"),
)
def format_counts(v: View) -> DataFrame:
    tail = ids.tail_digit(F.col("user_id").cast("string")) == "1"
    return v.events.where(tail).groupBy(F.col("event_type").alias("wm")).agg(F.count("*").alias("n")).orderBy("wm").limit(20)


@query(
    "rpt_duration_ratio",
    with_views(["ev"], "SELECT user_id, ROUND(a.spt1 / b.spt2, 6) AS ratio FROM (SELECT user_id, SUM(value) / 1000 AS spt1 FROM ev WHERE event_type = 'view' GROUP BY 1) a "
    "JOIN (SELECT user_id, SUM(value) / 1000 AS spt2 FROM ev WHERE event_type IN ('click', 'purchase') GROUP BY 1) b USING (user_id)"),
)
def duration_ratio(v: View) -> DataFrame:
    def total(out: str, *types: str) -> DataFrame:
        return v.events.where(F.col("event_type").isin(*types)).groupBy("user_id").agg((F.sum("value") / 1000).alias(out))

    return total("spt1", "view").join(total("spt2", "click", "purchase"), "user_id").select(
        "user_id", F.round(F.try_divide("spt1", "spt2"), 6).alias("ratio")
    )


@query(
    "rpt_ratio_histogram",
    with_views(["ev"], "SELECT tag, COUNT(*) AS n FROM (SELECT CASE WHEN r > 0.8 THEN '>0.8' WHEN r <= 0.8 AND r > 0.5 THEN '(0.5,0.8]' "
    "WHEN r <= 0.5 AND r > 0.2 THEN '(0.2,0.5]' ELSE '<=0.2' END AS tag FROM (SELECT value / (k + 1) AS r FROM ev)) GROUP BY 1"),
)
def ratio_histogram(v: View) -> DataFrame:
    """The middle bucket is reachable here; the ranges meet without gaps."""
    r = F.col("value") / (F.col("k") + 1)
    tag = F.when(r > 0.8, ">0.8").when(r > 0.5, "(0.5,0.8]").when(r > 0.2, "(0.2,0.5]").otherwise("<=0.2")
    return v.events.groupBy(tag.alias("tag")).agg(F.count("*").alias("n"))


@query(
    "flag_rate",
    with_views(["ev"], "SELECT wm, fs, SUM(lyric)::BIGINT AS lyrics, SUM(fav)::BIGINT AS favs FROM (SELECT DISTINCT p.user_id, p.sh, p.wm, p.fs, "
    "CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS lyric, CASE WHEN f.user_id IS NULL THEN 0 ELSE 1 END AS fav FROM "
    "(SELECT user_id, 'Hash' || k AS sh, k % 3 AS wm, CASE WHEN value > 50 THEN 'done' ELSE 'cut' END AS fs FROM ev WHERE event_type = 'click') p "
    "LEFT JOIN (SELECT DISTINCT user_id, 'HASH' || k AS sh FROM ev WHERE event_type = 'view') l ON l.user_id = p.user_id AND upper(l.sh) = upper(p.sh) "
    "LEFT JOIN (SELECT DISTINCT user_id, 'hash' || k AS sh FROM ev WHERE event_type = 'purchase') f ON f.user_id = p.user_id AND upper(f.sh) = upper(p.sh)) GROUP BY 1, 2"),
)
def flag_rate(v: View) -> DataFrame:
    def seen(event: str, prefix: str, out: str) -> DataFrame:
        key = F.upper(F.trim(F.concat(F.lit(prefix), F.col("k").cast("string"))))
        return v.events.where(F.col("event_type") == event).select(
            "user_id", key.alias("key"), F.lit(1).alias(out)
        ).distinct()

    played = v.events.where(F.col("event_type") == "click").select(
        "user_id", F.upper(F.concat(F.lit("Hash"), F.col("k").cast("string"))).alias("key"),
        (F.col("k") % 3).alias("wm"), F.when(F.col("value") > 50, "done").otherwise("cut").alias("fs"),
    )
    flags = (
        played.join(seen("view", "HASH", "lyric"), ["user_id", "key"], "left")
        .join(seen("purchase", "hash", "fav"), ["user_id", "key"], "left")
        .select("user_id", "key", "wm", "fs", F.coalesce("lyric", F.lit(0)).alias("lyric"), F.coalesce("fav", F.lit(0)).alias("fav"))
        .distinct()
    )
    return flags.groupBy("wm", "fs").agg(F.sum("lyric").alias("lyrics"), F.sum("fav").alias("favs"))
