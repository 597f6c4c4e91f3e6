"""Every registered query of the library's own operators against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from silverbrook import catalog
from silverbrook.catalog.compare import connect, differences
from silverbrook.catalog.tables import Tables


@pytest.fixture(scope="module")
def duck(data):
    con = connect(data)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in catalog.ENTRIES.items() if sql))
def test_matches_sql(name, spark, data, duck):
    query, sql = catalog.ENTRIES[name]
    assert differences(query(Tables(spark, data)), duck, sql) == []


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in catalog.ENTRIES.items() if not sql))
def test_runs(name, spark, data):
    assert catalog.ENTRIES[name][0](Tables(spark, data)).count() > 0


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert set(catalog.ENTRIES) <= set(names)


def test_frequency_just_below_a_whole_number(spark, tmp_path):
    """999 lines of 250 customers: 3.996 orders each, which two digits make 4."""
    con = duckdb.connect()
    con.execute("CREATE VIEW lines AS SELECT i % 250 + 1 AS k, i // 250 + 1 AS line FROM range(999) t(i)")
    for name, sql in {
        "customer": "SELECT i + 1 AS c_custkey, 'n' || i AS c_name, 1 AS c_nationkey, 10.0::DOUBLE AS c_acctbal, 'S' AS c_mktsegment FROM range(250) t(i)",
        "nation": "SELECT 1 AS n_nationkey, 'FRANCE' AS n_name, 1 AS n_regionkey",
        "part": "SELECT 1::BIGINT AS p_partkey, 'p' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size, 2.0::DOUBLE AS p_retailprice",
        "orders": "SELECT i + 1 AS o_orderkey, i + 1 AS o_custkey, 'F' AS o_orderstatus, 9.0::DOUBLE AS o_totalprice, TIMESTAMP '1995-01-02' AS o_orderdate, '1' AS o_orderpriority FROM range(250) t(i)",
        "lineitem": "SELECT k AS l_orderkey, 1::BIGINT AS l_partkey, 1::BIGINT AS l_suppkey, CAST(line AS INTEGER) AS l_linenumber, 1.0::DOUBLE AS l_quantity, 3.0::DOUBLE AS l_extendedprice, 0.0::DOUBLE AS l_discount, 0.0::DOUBLE AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '1995-01-09' AS l_shipdate FROM lines",
    }.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet'")
    query, sql = catalog.ENTRIES["G5_segment_shares"]
    assert differences(query(Tables(spark, str(tmp_path))), connect(str(tmp_path)), sql) == []
