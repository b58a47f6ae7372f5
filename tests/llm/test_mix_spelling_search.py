"""Balanced mixing, spelling groups and dual-tree search against brute force on a small awkward table."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunecrate.llm import cube_mix, lexical_search, packing, quality_rules, spelling, token_ids, words

R = random.Random(11)
NAMES = ["".join(R.choice("abcdeghilmnoprstuéß") for _ in range(R.randint(5, 9))) for _ in range(150)]
SCHEMA = "doc_id bigint, text string, source string, size string, n bigint, word string, p double, term string, _h bigint, _block int"


def prose(n):
    return " ".join(R.choice(NAMES[: R.randint(1, 150)]) for _ in range(n))


TEXTS = [(i, prose(R.randint(1, 60)), R.choice(["b", "a", "a", "z", "", "é"])) for i in range(300)]
TEXTS += [(400 + i, prose(4), "solo") for i in range(2)] + [(403, "word", None)] * 7
TEXTS += [(1, TEXTS[1][1], TEXTS[1][2]), (None, prose(30), None), (None, None, None), (500, None, "a"), (501, "", "b"), (502, " \n\t-- --", "b"), (503, prose(6000), "z")]
TEXTS += [(600 + i, "Ärger ÄRGER straße strasse colour colours color Color aab abb aabb", "z") for i in range(9)]
TEXTS += [(700 + i, TEXTS[3][1], "a") for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "x", 1, "w", 0.5, "t", 3, 2) for i, t, s in TEXTS], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(rows, weights=(5, 2, 1), most=3.0):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    full, budget = set(), sum(sizes.values())
    while True:
        free = sum(weight[s] for s in order if s not in full)
        left = budget - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target, sizes
        full |= over


@pytest.mark.parametrize("block", [1000, 20])
def test_cube_mix(docs, none, block):
    target, sizes = expected_targets(TEXTS)
    got = cube_mix.mixed(docs, block=block).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, size_of(t), s) for i, t, s in TEXTS)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        mean = r["target"] / r["source_size"] if r["source_size"] else 0
        if r["size"]:
            assert r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"]
            assert math.floor(mean - 1e-9) <= r["taken"] // r["size"] <= math.ceil(mean + 1e-9)
        taken[r["source"]] += r["taken"]
    for s in sizes:
        rows_of = [size_of(t) for _, t, x in TEXTS if x == s]
        coarse = len(rows_of) < 10 or max(rows_of) > target[s] / 2  # a document that no others can make up for
        assert abs(taken[s] - target[s]) <= (max(rows_of) if coarse else 5), (s, taken[s], target[s])
    again = cube_mix.mixed(docs.repartition(2), block=block)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    assert cube_mix.mixed(none).count() == 0


def test_flight_keeps_totals_and_expectations():
    size = np.sort(np.random.default_rng(3).integers(0, 400, 60))[::-1].astype(np.int64)
    p = np.random.default_rng(4).random(60)
    mean = np.zeros(60)
    for k in range(400):
        out = cube_mix.flight(p, size, cube_mix._Draws("t", k).next)
        open_ = (out > 0) & (out < 1)
        assert open_.sum() <= 2 and out.min() >= 0 and out.max() <= 1
        assert out.sum() == pytest.approx(p.sum(), abs=1e-6) and out @ size == pytest.approx(p @ size, abs=1e-4)
        mean += out / 400
    assert np.abs(mean - p).max() < 0.12
    for same in (np.zeros(9, np.int64), np.full(9, 5, np.int64), np.array([9] + [5] * 8), np.array([9, 9, 9, 5, 5, 0, 0, 0, 0])):
        out = cube_mix.flight(np.full(9, 0.3), same, cube_mix._Draws("s").next)
        assert ((out > 0) & (out < 1)).sum() <= 2 and out.sum() == pytest.approx(2.7) and out @ same == pytest.approx(0.3 * same.sum())


def near_words(counts):
    near, gaps = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in counts:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    return near


def spelling_rows(counts, ratio=5):
    near, form = near_words(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts[form[w]] if form[w] else 0) for w, n in counts.items())


def plain(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_vocabulary_and_spelling(docs, none):
    counts = Counter()
    for i, t, _ in TEXTS:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 2}
    found = spelling.vocabulary(docs, least_length=6, delete_every=0)
    assert all(len(r["word"]) >= 6 and r["n"] >= 5 for r in found.collect()) and "Ärger" not in {r["word"] for r in found.collect()}
    made = spelling.vocabulary(docs, least_length=5, least_count=2, delete_every=3)
    long = {w: n for w, n in counts.items()}
    got = {r["word"]: r["n"] for r in made.collect()}
    assert all(long[w] >= n for w, n in got.items())  # runs of under five letters are not words however they are typed
    assert plain(spelling.spelling_groups(made)) == spelling_rows(got)
    assert spelling.document_words(none).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(made, ratio=1)


def test_repeated_letters_and_chains(spark):
    table = {"aab": 1, "ab": 5, "aaab": 2, "abb": 100, "b": 700, "aabb": 9, "bab": 5, "baab": 5, "ca": 7, "cb": 7, "cc": 40, "c": 1, "x😀y": 3, "xy": 15, "x😁y": 3}
    df = spark.createDataFrame(list(table.items()), "word string, n int")
    assert plain(spelling.spelling_groups(df)) == spelling_rows(table)
    assert plain(spelling.spelling_groups(df, ratio=2)) == spelling_rows(table, 2)


def brute_search(rows, items, k):
    terms = [lexical_search.terms(t) for _, t in rows]
    used = [i for i, t in enumerate(terms) if t]
    total, tf = sum(map(len, terms)), [Counter(t) for t in terms]
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for i in used:
            m = 100 - 25 + (25 * len(terms[i]) * len(used)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(used) + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[i][t]) // (1000 * tf[i][t] + 12 * m))
                for t in lexical_search.terms(text) if tf[i][t]
            )
            if score > 0:
                scored.append((-score, rows[i][0] is None, rows[i][0] or 0))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def test_dual_tree_search(spark, docs, none, monkeypatch):
    items = [(1, TEXTS[3][1]), (2, TEXTS[8][1] + " " + TEXTS[8][1]), (2, "Straße"), (3, None), (4, ""), (5, "unknown 123"), (None, prose(300)), (7, "colour-COLOR")]
    items += [(20 + i, prose(8)) for i in range(30)]
    table = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id int, text string, score double")
    rows = [(i, t) for i, t, _ in TEXTS]
    expected = brute_search(rows, items, 20)
    monkeypatch.setattr(lexical_search, "BATCH", 32)
    got = sorted((tuple(r) for r in lexical_search.search(docs, table).collect()), key=repr)
    assert got == expected
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 100)  # several blocks
    assert sorted((tuple(r) for r in lexical_search.search(docs, table, k=3).collect()), key=repr) == brute_search(rows, items, 3)
    text_ids = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    named = lexical_search.search(text_ids, table, k=3)
    assert Counter(r["score"] for r in named.collect()) == Counter(r[3] for r in brute_search(rows, items, 3))
    assert lexical_search.search(none, table).count() == lexical_search.search(docs, none, item_id="doc_id").count() == 0


def thue_morse(a, b, k):
    for _ in range(k):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_of_words_that_fool_polynomial_hashes(name):
    encoder = token_ids.Encoder(token_ids.installed(name))
    texts = [w for k in (6, 9, 10, 11, 12) for w in (*thue_morse("a", "b", k), *thue_morse("q", "z", k))]
    got = [ids[o[i] : o[i + 1]].tolist() for low, high, ids, o in encoder.encode(pa.array(texts)) for i in range(high - low)]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_such_words_are_no_repeats(spark):
    a, b = thue_morse("a", "b", 10)
    assert a != b and len(np.unique(lexical_search._hashes([a, b]))) == 2
    text = f"{a} one two three four {b} one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules.compression_bands(docs).first()["n_repeat_words"] == 0
    packed = packing.pack_documents(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert len({r["ids_crc32"] for r in packed}) == len(packed)
    assert words.SHORT < 1024
