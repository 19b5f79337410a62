"""Every registered query of the citation engine against its SQL."""

import math

import duckdb
import pytest

from glossa import queries, queries_grammar, queries_text  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    def cell(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) == "<NA>":
            return None
        return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(str([cell(x) for x in r]) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(name, spark, sf_dir, duck):
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql(name, spark, sf_dir):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0
