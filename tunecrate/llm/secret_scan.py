"""Secret scan through a trigram inverted index, in DataFrame functions only.

1. Each rule's expression gives a Boolean trigram query (``trigram_query``).
2. One pass over the texts writes postings (trigram, document) for the trigrams that some
   query mentions: the vocabulary is bounded by the rules, the postings by the hits.
3. Postings of a document meet in one aggregation; a rule's candidates are the documents
   whose trigrams satisfy its query.
4. Only candidates run the rule's expression. Rules without mandatory trigrams scan all texts.

Postings group by document, never by trigram, so a trigram that a third of all texts share
is spread like its documents. Candidates are broadcast only after their number was checked;
beyond that the join shuffles.

Defined cases: null text is the empty text; null ids, repeated rows and equal ids with other
texts get their own rows; extra columns stay out of ``find_secrets`` and pass through
``mask_secrets``; an empty table gives an empty result. Texts are searched whole, positions
count code points. Letters of keywords match in either ASCII case.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunecrate.llm.storage import keyed, small_enough, stored
from tunecrate.llm.trigram_query import trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share. A match counts if its ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = ("assign", "access", "hex")

#: From a private key's BEGIN line to its END line: what lies between holds no five hyphens in a row. Where END is missing,
#: over the header lines and base64 lines that follow. Repeated groups are possessive: Java runs those as loops, others by
#: recursion, and what follows each can never begin inside it, so other engines find the same without.
_KEY_BODY = (
    r"(?:(?:[^-]+|-{1,4}[^-])*+-{5,}END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:[\r\n]+(?:Proc-Type|DEK-Info|Version|Comment|MessageID|Hash|Charset): [^\r\n]*)*+"
    r"[A-Za-z0-9+/=\\\r\n]*(?:[\x20\t\r\n]+[A-Za-z0-9+/=\\]{16,})*+)"
)

#: Production rules. A run of hex digits is matched from 16 on: greedy runs make that the same as matching
#: every run and dropping short ones. Failing matches of ``assign`` still use up their text.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----" + _KEY_BODY),
)

SPAN = "struct<start:int,kind:int,end:int,size:int>"
SPANS = f"array<{SPAN}>"

#: Items that one array is grown by; a longer list is handled block by block, so work stays near linear in its length.
BLOCK = 256


def _demands(rules: Sequence[Rule]) -> dict[int, list[list[str]]]:
    """Alternatives of mandatory trigrams by rule number; rules that demand nothing are left out."""
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    return {i: sorted(map(sorted, q)) for i, q in queries.items() if frozenset() not in q}


def postings(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(doc_id, _h, trigram) for each trigram of ``vocabulary`` in a text, upper and lower case alike."""
    low = docs.select("doc_id", "_h", F.lower("text").alias("_low"))
    present = F.array_compact(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in vocabulary)))
    return low.select("doc_id", "_h", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, demands: dict[int, list[list[str]]]) -> DataFrame:
    """(doc_id, _h, rules): numbers of the rules whose trigram query the postings of a text satisfy."""
    have = F.col("_have")

    def satisfied(alternatives: list[list[str]]) -> Column:
        out = F.lit(False)
        for needed in alternatives:
            out = out | (F.size(F.array_except(F.array(*map(F.lit, needed)), have)) == 0)
        return out

    rules = F.array_compact(F.array(*(F.when(satisfied(a), F.lit(i)) for i, a in demands.items())))
    met = index.groupBy("doc_id", "_h").agg(F.collect_set("trigram").alias("_have"))
    return met.select("doc_id", "_h", rules.alias("rules")).where(F.size("rules") > 0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column, of_block: Callable[[Column], Column]) -> Column:
    """``of_block`` of each BLOCK consecutive items; one empty block where there are none."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: of_block(F.slice(items, b * BLOCK + 1, F.lit(BLOCK))))


def _running(items: Column, kind: str, size: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """(before, item) per item of type ``kind``: ``size`` of all earlier items, put together by ``join`` from 0 on."""
    entries, numbers = F.array().cast(f"array<struct<before:int,item:{kind}>>"), F.array().cast("array<int>")

    def inside(block: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            entry = F.struct(acc["at"].alias("before"), x.alias("item"))
            return F.struct(join(acc["at"], size(x)).alias("at"), F.concat(acc["out"], F.array(entry)).alias("out"))

        return F.aggregate(block, F.struct(F.lit(0).alias("at"), entries.alias("out")), step)

    def ahead(acc: Column, block: Column) -> Column:
        return F.struct(join(acc["at"], block["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def shifted(block: Column, at: Column) -> Column:
        return F.transform(block["out"], lambda e: F.struct(join(at, e["before"]).alias("before"), e["item"].alias("item")))

    def together(done: Column) -> Column:
        starts = F.aggregate(done, F.struct(F.lit(0).alias("at"), numbers.alias("out")), ahead, lambda acc: acc["out"])
        return F.flatten(F.zip_with(done, starts, shifted))

    return _let(items, lambda all_items: _let(_blocks(all_items, inside), together))


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """Spans of a rule's matches in a text: lengths of matches and of the pieces between them, summed up."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    pieces = F.split(text, rule.pattern, -1)
    zipped = F.zip_with(
        F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m"))),
        counted,
        lambda x, v: F.struct(x["p"].alias("p"), x["m"].alias("m"), F.length(v).alias("v")),
    )
    placed = _running(zipped, "struct<p:int,m:int,v:int>", lambda x: x["p"] + x["m"], lambda a, b: a + b)

    def span(e: Column) -> Column:
        start = e["before"] + e["item"]["p"]
        return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + e["item"]["m"]).alias("end"), e["item"]["v"].alias("size"))

    return F.filter(F.transform(placed, span), lambda s: s["size"] >= rule.least)


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` in the place of its sorted spans (at least one); an overlap belongs to the earlier span."""
    with_end = _running(spans, SPAN, lambda s: s["end"], F.greatest)
    gaps = F.transform(
        F.filter(with_end, lambda e: e["item"]["start"] >= e["before"]),
        lambda e: F.struct(e["before"].alias("start"), e["item"]["start"].alias("end")),
    )

    def kept(block: Column) -> Column:
        first, last = F.element_at(block, 1)["start"], F.element_at(block, -1)["end"]
        part = F.substring(text, first + 1, last - first)
        return _let(part, lambda t: F.array_join(F.transform(block, lambda g: F.substring(t, g["start"] - first + 1, g["end"] - g["start"])), mask))

    at = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.concat(_let(gaps, lambda g: F.array_join(_blocks(g, kept), mask)), F.lit(mask), F.substring(text, at + 1, F.length(text)))


def with_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, text, _h, spans) of keyed ``docs``: spans by start, then by the rules' order."""
    demands = _demands(rules)
    vocabulary = sorted({t for a in demands.values() for needed in a for t in needed})
    met = stored(candidates(stored(postings(docs, vocabulary), "postings"), demands), "candidates")
    met = small_enough(met).withColumnsRenamed({"doc_id": "_id", "_h": "_key"})
    joined = docs.join(met, docs["doc_id"].eqNullSafe(met["_id"]) & (docs["_h"] == met["_key"]), "left").drop("_id", "_key")
    none = F.array().cast(SPANS)
    found = [
        F.when(F.array_contains("rules", i) if i in demands else F.col("text").rlike(r.pattern), _spans(F.col("text"), i, r)).otherwise(none)
        for i, r in enumerate(rules)
    ]
    return joined.select("doc_id", "text", "_h", F.array_sort(F.concat(*found)).alias("spans"))


def _number(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def _listed(spans: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all spans."""
    found = with_spans(keyed(docs, doc_id, text), rules)
    base = [i for i, r in enumerate(rules) if r.kind in BASE]
    counts = [_number("spans", i).cast("bigint").alias(f"n_{rules[i].kind}") for i in base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *counts, F.sha2(_listed(of_base, rules), 256).alias("base_sha256"), _listed(F.col("spans"), rules).alias("spans")
    )


def mask_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span found replaced by ``mask``; overlapping spans are one. All columns stay, as does null text."""
    spans = stored(
        with_spans(keyed(docs, doc_id, text), rules).where(F.size("spans") > 0).select("doc_id", "_h", "spans").distinct(), "spans"
    )
    spans = small_enough(spans).toDF("_id", "_key", "_spans")
    whole = F.struct(*(docs[c] for c in docs.columns))
    rows = docs.select(whole.alias("_row"), docs[doc_id].alias("_doc"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    rows = rows.withColumn("_h", F.xxhash64("_text"))
    joined = rows.join(spans, rows["_doc"].eqNullSafe(spans["_id"]) & (rows["_h"] == spans["_key"]), "left")

    masked = F.when(F.col("_spans").isNull(), F.col(f"_row.{text}")).otherwise(_masked(F.col("_text"), F.col("_spans"), mask))
    return joined.select(*(masked.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns))
