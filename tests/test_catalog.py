"""Every query of the catalog against its SQL in DuckDB on the smallest tables, and the shape of the plans that matter."""

import os

import duckdb
import pytest

from threadloom.plans import catalog, catalog_io  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and x != x):
        return "None"
    if hasattr(x, "isoformat"):
        return str(x).removesuffix(" 00:00:00")
    return repr(round(x, 9)) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    if name not in catalog.ORACLES:
        assert rows
        return
    got = duck.execute(catalog.ORACLES[name])
    columns = sorted(c[0] for c in got.description)
    assert columns == sorted(df.columns)
    at = [[c[0] for c in got.description].index(c) for c in columns]
    assert sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall()) == sorted(tuple(plain(r[c]) for c in columns) for r in rows)


def test_small_ratios_have_no_exponent(spark, tmp_path):
    """A few known words in long texts: shares below a thousandth."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i::BIGINT AS doc_id, repeat('zq ', 3400) || repeat('the ang ', (i % 5)::INT) AS text, 'en' AS lang, 's' AS source FROM range(1, 41) t(i)) TO '{tmp_path}/documents.parquet'")
    con.execute(f"COPY (SELECT i::BIGINT AS doc_id, (i % 2)::INT AS quality FROM range(1, 41) t(i)) TO '{tmp_path}/labels.parquet'")
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    df = catalog.QUERIES["p12_export_rows"](spark, str(tmp_path))
    want = con.execute(f"SELECT item_id, lid FROM ({catalog.ORACLES['p12_export_rows']}) x").fetchall()
    got = [tuple(r) for r in df.select("item_id", "lid").collect()]
    assert sorted(got) == sorted(want) and any("|0.0006|" in lid for _, lid in got)


def test_ratios_round_as_the_sql_does(spark, tmp_path):
    """Texts of 800 and 1,600 words, whose shares lie halfway between two of four places."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT n * 10000 + k AS doc_id, repeat('the ', k::INT) || repeat('ang ', (k // 3)::INT) || repeat('zq ', (n - k - k // 3)::INT) AS text, 'en' AS lang, 's' AS source
        FROM (VALUES (800::BIGINT), (1600)) a(n), range(1, 600, 2) b(k)) TO '{tmp_path}/documents.parquet'""")
    con.execute(f"COPY (SELECT doc_id, (doc_id % 2)::INT AS quality FROM '{tmp_path}/documents.parquet') TO '{tmp_path}/labels.parquet'")
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    for name, columns in (("p12_export_rows", ["item_id", "lid"]), ("u01_language", ["doc_id", "language", "en_ratio", "tl_ratio", "other_ratio"]), ("u01_with_a_model", ["doc_id", "language", "tl_ratio"])):
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]}) x").fetchall()
        assert sorted(map(tuple, catalog.QUERIES[name](spark, str(tmp_path)).select(*columns).collect())) == sorted(want), name


def explained(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    assert "TakeOrderedAndProject" in explained(spark, "w01_target_set")
    for name in ("f05_missing_results", "f07_pending_annotator", "f08_pending_adjudicator", "w02_pending_in_target"):
        assert "LeftAnti" in explained(spark, name)
    assert "Window" in explained(spark, "w09_author_history")
    for name in ("w09_author_history", "a15_aggregation", "f03_candidates", "p12_export_rows", "g04_contexts"):
        plan = explained(spark, name)
        assert "Python" not in plan and "CartesianProduct" not in plan
    assert "WindowGroupLimit" in explained(spark, "w05_daily_sample")
