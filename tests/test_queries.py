"""Every query with a SQL twin against DuckDB; the others run and keep their row contract."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def clean(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(clean(x) for x in value)
    return value


def rows(records, order):
    return sorted((tuple(clean(r[i]) for i in order) for r in records), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 2e-6
    return a == b


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, duck):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(columns) == sorted(df.columns)
    left = rows(got, [df.columns.index(c) for c in sorted(columns)])
    right = rows(expected, [columns.index(c) for c in sorted(columns)])
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_pool_counts_every_pair_of_a_long_playlist(spark, tmp_path):
    from tunecrate.plans.views import View

    rows = [(1, i) for i in range(900)] + [(2, 3), (2, 5), (2, 5), (3, 5)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    pool = View(spark, str(tmp_path)).pool
    assert pool.count() == 900 * 200
    top = pool.where("src = 3").orderBy("rank").first()
    assert (top["dst"], top["sim"]) == (5, round(2 / math.sqrt(2 * 3), 9))


def test_pool_reads_the_lines_few_times(spark):
    from tunecrate.plans.views import View

    plan = View(spark, SF_DIR).pool._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 3  # one scan and its copies for long playlists, was 6


def _small_part(spark, tmp_path, parts):
    lines = [(o, i) for o, items in {1: (1, 2, 3, 4, 5), 2: (1, 2, 5), 3: (2, 6), 4: (1, 6)}.items() for i in items]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")


def test_attribute_pools_read_the_stored_pool_without_joins(spark, tmp_path):
    from tunecrate.plans.views import View

    _small_part(spark, tmp_path, [(i, "t", "b") for i in range(1, 7)])
    plan = View(spark, str(tmp_path)).pool_same("p_type")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_attribute_pools_follow_sql_with_repeated_and_missing_parts(spark, tmp_path):
    from tunecrate.plans.views import View, with_views

    _small_part(spark, tmp_path, [(1, "t", "a"), (1, "t", "b"), (2, "t", "b"), (2, "t", None), (3, "u", "b"), (4, None, "a"), (5, "t", "a"), (5, "t", "a")])
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    view = View(spark, str(tmp_path))
    for frame, name in ((view.shared_pool, "pool"), (view.pool_same("p_type"), "pool_type"), (view.pool_same("p_brand"), "pool_brand")):
        expected = con.execute(with_views([name], f"SELECT src, dst, sim, rank FROM {name}")).fetchall()
        assert sorted(tuple(r) for r in frame.select("src", "dst", "sim", "rank").collect()) == sorted(expected), name


def test_neighbours_come_from_the_whole_training(spark, monkeypatch):
    from tunecrate.operators import embeddings

    asked = {}

    def train(seqs, **params):
        asked.update(params)
        return spark.createDataFrame([("1", [1.0, 0.0]), ("2", [1.0, 1.0])], "id string, features array<double>")

    monkeypatch.setattr(embeddings, "item2vec", train)
    assert QUERIES["item2vec_neighbours"](spark, SF_DIR).count() == 2
    assert (asked["size"], asked["partitions"], asked["iterations"]) == (200, 20, 10) and asked["min_count"] <= 200


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["item_id", "channel", "score", "rank"]


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
