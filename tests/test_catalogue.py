import duckdb
import pytest

import __spark_entry__
from quillgrid import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def near(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(near(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(near(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr) and got


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_strips_of_a_page_are_folded_without_python_rows(spark, sf):
    plan = catalogue.QUERIES["merged_entities"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_every_user_has_a_segmented_page(spark, sf, duck):
    got = [r.stem for r in catalogue.QUERIES["segmented_pages"](spark, sf).select("stem").collect()]
    assert sorted(got) == sorted(str(k) for (k,) in duck.execute("SELECT DISTINCT user_id FROM events").fetchall()) and len(got) > 6


def test_every_page_has_its_place(spark, sf):
    from quillgrid.operators import export

    stems = [f"c{a}p{b}" for a in range(1, 40) for b in (1, 2, 10, 11, 100, 101)]
    pages = spark.createDataFrame([(s,) for s in reversed(stems)], "stem string")
    for ranges in (3, 256):
        assert [r.stem for r in export.places(pages, ranges).orderBy("place").collect()] == stems
    every = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert 200 < catalogue.QUERIES["natural_page_order"](spark, sf).count() <= every
