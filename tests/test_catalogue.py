"""Every query against its SQL, plans that are wanted, and what the package does not import."""

import datetime
import io
import contextlib
import subprocess
import sys

import duckdb
import pytest
from pyrelake.plans.oracle import ORACLE_SQL
from pyrelake.plans.queries import queries

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(x):
    if x is None or x != x:
        return "~"
    if isinstance(x, datetime.datetime):
        return str(x)[:10]
    return repr(x + 0.0) if isinstance(x, float) else str(x)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_each_query_has_its_sql():
    assert set(queries()) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    order = sorted(df.columns)
    found = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == order
    at = [columns.index(c) for c in order]
    want = sorted(tuple(plain(r[k]) for k in at) for r in found.fetchall())
    assert sorted(tuple(map(plain, r)) for r in df.select(*order).collect()) == want and want


@pytest.mark.parametrize("name", ["file_status", "status_counts"])
def test_files_of_one_name_have_states_of_their_own(spark, tmp_path, name):
    """Suppliers beyond 400, whose files have the names of earlier ones."""
    spark.sql("SELECT id AS s_suppkey, concat('S', id) AS s_name, CAST(id % 25 AS INT) AS s_nationkey FROM range(1300)").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    df = queries()[name](spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall())


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_plans_stay_in_the_engine_and_read_few_columns(spark, sf):
    p = plan(queries()["extent_global"](spark, sf))
    assert "Python" not in p and "CartesianProduct" not in p
    assert "l_comment" not in p and "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_linestatus:string,l_shipdate:" in p


def test_the_optional_subpackage_is_not_needed():
    code = "import sys; sys.modules['pyrelake.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 50"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=120).returncode == 0
