"""Queries of the training-data operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tunecrate.llm import (
    cube_mix, decontaminate, lexical_search, line_crf, near_dedup, packing, quality_rules, secret_scan, sharding, spelling, substring_dedup,
    url_filter, wavelet_store,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION_SQL = rf"""
WITH item_words AS (SELECT item_id, {WORDS.format(text="text")} AS w FROM benchmark),
items AS (SELECT item_id, least(5, len(w)) AS k, w FROM item_words WHERE len(w) > 0),
item_shingles AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS s FROM items),
sizes AS (SELECT item_id, k, count(*) AS n FROM item_shingles GROUP BY ALL),
doc_words AS (SELECT doc_id, {WORDS.format(text="text")} AS w FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS s
  FROM doc_words, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
met AS (SELECT doc_id, item_id, count(*) AS found FROM doc_shingles JOIN item_shingles USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, found AS n_found, found / n AS containment
FROM met JOIN sizes USING (item_id) WHERE found / n >= 0.8 - 1e-9
"""


@query("op1_decontaminate", DECONTAMINATION_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_compression_bands")
def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.compression_bands(table(spark, sf_dir, "documents"))


def _spans_sql(kind: int, pattern: str, group: int, least: int) -> str:
    greedy = pattern.replace("*+", "*")  # the engine knows no possessive groups; here they match the same
    quoted = "'" + greedy.replace("'", "''") + "'"
    return f"""
SELECT doc_id, {kind} AS kind, s.start AS start, s.stop AS stop FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    'start': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'stop': list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))),
    'size': length(g[i])}})) AS s
  FROM (SELECT doc_id, string_split_regex(text, {quoted}) AS p, regexp_extract_all(text, {quoted}) AS m,
               regexp_extract_all(text, {quoted}, {group}) AS g FROM texts)
) WHERE s.size >= {least}"""


def _secret_sql() -> str:
    kinds = secret_scan.RULES
    found = "\nUNION ALL".join(_spans_sql(i, r.pattern, r.group, r.least) for i, r in enumerate(kinds))
    names = ", ".join(f"'{r.kind}'" for r in kinds)
    base = ", ".join(str(i) for i, r in enumerate(kinds) if r.kind in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{r.kind}" for i, r in enumerate(kinds) if r.kind in secret_scan.BASE)
    outer = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_scan.BASE)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
named AS (SELECT *, ([{names}])[kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS s FROM found),
listed AS (
  SELECT doc_id, {counts}, string_agg(s, ',' ORDER BY start, kind) FILTER (kind IN ({base})) AS base,
         string_agg(s, ',' ORDER BY start, kind) AS spans
  FROM named GROUP BY doc_id)
SELECT doc_id, {outer}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""


@query("op10_secret_scan", _secret_sql())
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_prob_minhash")
def op7_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


SHARDING_SQL = f"""
WITH rows AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash,
         strlen(coalesce(text, '')) AS n_bytes
  FROM documents),
buckets AS (
  SELECT depth, hash >> (60 - depth)::INT AS prefix, sum(n_bytes)::BIGINT AS size
  FROM rows, (SELECT unnest(range(0, 61))::INT AS depth) GROUP BY ALL),
leaves AS (
  SELECT b.depth, b.prefix, b.size FROM buckets b LEFT JOIN buckets p ON p.depth = b.depth - 1 AND p.prefix = b.prefix >> 1
  WHERE (b.size <= {sharding.LIMIT} OR b.depth = 60) AND (b.depth = 0 OR p.size > {sharding.LIMIT}))
SELECT doc_id, n_bytes, right(lpad(bin(prefix), 60, '0'), depth) AS shard, depth, size AS shard_bytes, size > {sharding.LIMIT} AS over_limit
FROM rows JOIN leaves ON rows.hash >> (60 - depth)::INT = prefix
"""


@query("op4_extendible_hashing", SHARDING_SQL)
def op4_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def dated_lists(keys: DataFrame) -> DataFrame:
    """Dated entries (list, key, added, at) over keys seen in the captures: which, where and when follow from the key's MD5."""
    lot = F.conv(F.substring(F.md5("key"), 1, 7), 16, 10).cast("bigint")
    day = lambda n: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(n.cast("int"))
    listed = keys.withColumn("lot", lot).where(F.col("lot") % 5 == 0)
    name = F.when(F.col("lot") % 11 == 0, "allow").when(F.col("lot") % 3 == 0, "adult").when(F.col("lot") % 3 == 1, "malware").otherwise("spam")
    dates = F.array_compact(F.array(
        F.struct(F.lit(True).alias("added"), day(F.col("lot") % 180).alias("at")),
        F.when(F.col("lot") % 2 == 0, F.struct(F.lit(False).alias("added"), day(180 + F.col("lot") % 120).alias("at"))),
        F.when(F.col("lot") % 7 < 3, F.struct(F.lit(True).alias("added"), day(F.lit(320)).alias("at"))),
    ))
    return listed.select(name.alias("list"), "key", F.inline(dates))


URL_SQL = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes((page_id * 7919) % 525600) AS fetched FROM pages),
bare AS (
  SELECT page_id, fetched, regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', ''), '^[^/@?]*@', '') AS b
  FROM captures WHERE url <> ''),
plain AS (
  SELECT page_id, fetched, lower(regexp_extract(b, '^([^/?:]*)', 1)) || regexp_replace(b, '^[^/?:]*(:[0-9]*)?', '') AS b FROM bare),
parts AS (
  SELECT page_id, fetched, b, string_split(regexp_extract(b, '^([^/?]*)', 1), '.') AS labels, string_split(regexp_replace(b, '\?.*$', ''), '/') AS steps
  FROM plain),
keys AS (
  SELECT DISTINCT page_id, fetched, unnest(
    list_transform(range(1, len(labels) + 1), lambda i: 'h:' || array_to_string(labels[i:], '.'))
    || list_transform(range(1, len(steps)), lambda i: 'p:' || array_to_string(steps[1:i], '/') || '/') || ['u:' || b]) AS key
  FROM parts),
lots AS (
  SELECT key, lot FROM (SELECT DISTINCT key, ('0x' || substr(md5(key), 1, 7))::BIGINT AS lot FROM keys WHERE key NOT LIKE 'u:%') WHERE lot % 5 = 0),
entries AS (
  SELECT CASE WHEN lot % 11 = 0 THEN 'allow' WHEN lot % 3 = 0 THEN 'adult' WHEN lot % 3 = 1 THEN 'malware' ELSE 'spam' END AS list, key, added, dated
  FROM (SELECT key, lot, true AS added, TIMESTAMP '2024-01-01' + to_days((lot % 180)::INT) AS dated FROM lots
        UNION ALL SELECT key, lot, false, TIMESTAMP '2024-01-01' + to_days((180 + lot % 120)::INT) FROM lots WHERE lot % 2 = 0
        UNION ALL SELECT key, lot, true, TIMESTAMP '2024-01-01' + to_days(320) FROM lots WHERE lot % 7 < 3)),
spans AS (
  SELECT list, key, added, dated AS since, coalesce(lead(dated) OVER (PARTITION BY list, key ORDER BY dated), TIMESTAMP '9999-12-31') AS until FROM entries),
active AS (SELECT page_id, list FROM keys JOIN spans USING (key) WHERE added AND fetched >= since AND fetched < until),
verdict AS (
  SELECT page_id, count(*) AS n_active, min(list) FILTER (list <> 'allow') AS first_list, bool_or(list = 'allow') AS allowed FROM active GROUP BY page_id)
SELECT page_id, url, fetched, coalesce(n_active, 0) AS n_active, first_list, coalesce(first_list IS NOT NULL AND NOT allowed, false) AS blocked
FROM captures LEFT JOIN verdict USING (page_id)
"""


@query("op9_temporal_url_filter", URL_SQL)
def op9_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("page_id") * 7919 % 525600).cast("int"))
    keys = pages.where("url <> ''").select(F.explode(url_filter.url_keys(F.col("url"))).alias("key")).where(~F.col("key").startswith("u:"))
    return url_filter.filtered(pages.withColumn("fetched", fetched), dated_lists(keys.distinct()))


@query("op6_wavelet_matrix")
def op6_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet_store.round_trip(table(spark, sf_dir, "documents"))


@query("op8_gear_chunks")
def op8_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


@query("op3_line_crf")
def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.scored(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


@query("op11_cube_mix")
def op11_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.mixed(table(spark, sf_dir, "documents"))


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 bit by bit over the UTF-8 bytes of '<doc_id>:<run>'; a pair of near words shares a gap or is a deletion.
SPELLING_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({LOWERED}, '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM counted),
typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[1:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (SELECT word, n, i, word[1:i] AS x, word[i + 2:] AS y FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.x = b.x AND a.y = b.y AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.x || g.y
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.x || g.y),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.root FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


@query("op12_permuterm", SPELLING_SQL)
def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_words(table(spark, sf_dir, "documents"))


TERMS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH doc_terms AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
item_terms AS (SELECT item_id, unnest({TERMS}) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS qtf FROM item_terms GROUP BY ALL),
sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM doc_terms WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sizes),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc_terms) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
impacts AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // all_terms)) AS impact FROM tf JOIN sizes USING (r), total),
scores AS (
  SELECT item_id, r, doc_id, sum(qtf * w * impact)::BIGINT AS score FROM q JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
WHERE rank <= 20
"""


@query("op13_dual_tree", SEARCH_SQL)
def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
