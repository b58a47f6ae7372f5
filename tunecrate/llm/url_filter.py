"""URL filters with dated lists: a temporal join of captures with list entries.

List entries are dated: an entry adds a pattern to a list or takes it off again. Entries of a
(list, pattern) become validity intervals [from, to). A capture is judged by the entries that
were active when it was fetched, not by today's list.

A pattern is a host (which covers its subdomains), a host with a path prefix that ends at a
slash, or a whole URL without scheme. A capture is looked up under its host, each parent
domain, each path prefix and its whole URL: as many keys as its URL has parts.

As-of join: intervals are cut into time slots and matched by equality on (key, slot), so a
capture meets only the intervals of its slot, not a key's whole history. A slot's key with a
third of all captures is split by adaptive execution; matches are pre-aggregated per capture.

Defined cases: null or empty URLs and captures without a time match nothing and are kept
allowed; entries without a date or pattern are ignored; of several entries of one pattern at
the same moment the removal wins; adding twice is one interval; repeated captures are judged
alike, each row on its own; extra columns are ignored; empty lists or captures give an empty
match, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunecrate.llm.storage import small_enough, stored

SLOT_DAYS = 30
FOREVER = "9999-12-31 00:00:00"


def without_scheme(url: Column) -> Column:
    """Lower-case host, path and query of a URL, without scheme, user, port and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[^/@?]*@", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?:]*)", 1))
    return F.concat(host, F.regexp_replace(bare, r"^[^/?:]*(:[0-9]*)?", ""))


def url_keys(url: Column) -> Column:
    """All patterns that cover a URL: hosts as ``h:``, path prefixes as ``p:``, the URL itself as ``u:``."""
    bare = without_scheme(url)

    def keys(b: Column) -> Column:
        host = F.regexp_extract(b, r"^([^/?]*)", 1)
        labels = F.split(host, r"\.", -1)
        hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")))
        steps = F.split(F.regexp_replace(b, r"\?.*$", ""), "/", -1)
        paths = F.when(
            F.size(steps) > 1,
            F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.concat(F.lit("p:"), F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))),
        ).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(hosts, paths, F.array(F.concat(F.lit("u:"), b))))

    return F.element_at(F.transform(F.array(bare), keys), 1)


def validity(entries: DataFrame) -> DataFrame:
    """(list, key, since, until) from dated entries (list, key, added boolean, at)."""
    usable = entries.where(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("list").isNotNull())
    moments = usable.groupBy("list", "key", "at").agg(F.min("added").alias("added"))
    after = Window.partitionBy("list", "key").orderBy("at")
    spans = moments.withColumn("until", F.lead("at").over(after)).withColumn("_was", F.lag("added").over(after))
    return spans.where("added").select("list", "key", F.col("at").alias("since"), F.coalesce("until", F.lit(FOREVER).cast("timestamp")).alias("until"))


def _slot(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at.cast("timestamp")) / (SLOT_DAYS * 86400)).cast("bigint")


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(row, list, key): entries active at the fetch of each capture (row, url, fetched)."""
    usable = stored(
        captures.where((F.col("url") != "") & F.col("fetched").isNotNull()).select("row", "fetched", F.explode(url_keys(F.col("url"))).alias("key")), "keys"
    )
    low, high = usable.agg(F.min("fetched")).scalar(), usable.agg(F.max("fetched")).scalar()
    spans = validity(entries).where((F.col("until") > low) & (F.col("since") <= high))  # clipped to the captures' time
    slots = F.sequence(_slot(F.greatest(F.col("since"), low)), _slot(F.least(F.col("until"), high)))
    spans = small_enough(stored(spans.select("list", "key", "since", "until", F.explode(slots).alias("slot")), "intervals"), 100_000)
    met = usable.withColumn("slot", _slot(F.col("fetched"))).join(spans, ["key", "slot"])
    return met.where((F.col("fetched") >= F.col("since")) & (F.col("fetched") < F.col("until"))).select("row", "list", "key")


def judged(captures: DataFrame, entries: DataFrame, allow: str = "allow") -> DataFrame:
    """(row, n_active, first_list, blocked): blocked if an entry of any list but ``allow`` is active and none of ``allow``."""
    of_allow = F.col("list") == allow
    verdict = active_entries(captures, entries).groupBy("row").agg(
        F.count("*").alias("n_active"), F.min(F.when(~of_allow, F.col("list"))).alias("first_list"), F.max(of_allow).alias("_allowed")
    )
    blocked = F.col("first_list").isNotNull() & ~F.col("_allowed")
    return verdict.select("row", "n_active", "first_list", blocked.alias("blocked"))


def filtered(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(page_id, url, fetched, n_active, first_list, blocked) per row of ``captures``."""
    rows = captures.select(F.col(capture_id).alias("page_id"), F.col(url).alias("url"), F.col(fetched).alias("fetched"))
    distinct = rows.select("url", "fetched").distinct()  # equal captures are judged once
    key = F.struct("url", "fetched")
    verdict = judged(distinct.select(key.alias("row"), "url", "fetched"), entries)
    verdict = verdict.select(F.col("row.url").alias("_url"), F.col("row.fetched").alias("_fetched"), "n_active", "first_list", "blocked")
    same = rows["url"].eqNullSafe(verdict["_url"]) & rows["fetched"].eqNullSafe(verdict["_fetched"])
    joined = rows.join(verdict, same, "left")
    return joined.select(
        "page_id", "url", "fetched", F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"), "first_list",
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
    )
