"""Every query that has SQL is held against DuckDB; the entry point runs."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_against_duckdb(spark, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "events"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    c.register("got", got)
    c.sql(f"CREATE TABLE want AS {catalogue.oracle_sql()[name]}")
    columns = ", ".join(f'"{x}"' for x in got.columns)
    assert sorted(got.columns) == sorted(r[0] for r in c.sql("DESCRIBE want").fetchall())
    assert c.sql(f"(SELECT {columns} FROM got EXCEPT ALL SELECT {columns} FROM want) UNION ALL (SELECT {columns} FROM want EXCEPT ALL SELECT {columns} FROM got)").fetchall() == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_reservoir_keeps_its_share_of_a_large_table(spark, tmp_path):
    """5 % of 1,040,000 rows are over 50,000; the SQL has no cap."""
    c = duckdb.connect()
    c.sql(f"COPY (SELECT e.* REPLACE (event_id + 1000 * k AS event_id) FROM '{SF}/events.parquet' e, range(1040) r(k)) TO '{tmp_path}/events.parquet'")
    for t in ("region", "nation", "customer"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    c.register("got", catalogue.queries()["reservoir"](spark, str(tmp_path)).toPandas())
    c.sql(f"CREATE TABLE want AS {catalogue.oracle_sql()['reservoir']}")
    assert c.sql("SELECT count(*) FROM want").fetchall() == [(52_000,)]
    assert c.sql("(FROM got EXCEPT ALL FROM want) UNION ALL (FROM want EXCEPT ALL FROM got)").fetchall() == []
