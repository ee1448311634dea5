import duckdb
import pytest

from lexmill.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canon(df):
    import pandas as pd

    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        return repr(round(float(v), 5)) if hasattr(v, "__float__") and not isinstance(v, (str, bool)) else str(v)

    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, sf, db, name):
    got = catalogue.queries()[name](spark, sf).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql:
        assert canon(got) == canon(db.execute(sql).df())
    else:
        assert len(got)


def test_every_query_but_few_has_sql():
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"pca_2d", "hdbscan"}
