"""Every registered query against its SQL in DuckDB, all rows and columns."""

from threading import Timer

import __spark_entry__ as registry
import oracle
import pytest
from compare import differences

OWN = sorted(oracle.STATEMENTS)


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(OWN) <= set(registry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, duck, sf_dir, name):
    ours = registry.queries()[name](spark, sf_dir)
    theirs = duck.sql(registry.oracle_sql()[name])
    assert differences(ours, theirs) == ([], [])


@pytest.mark.parametrize("name", OWN)
def test_sql_ends_when_only_some_rows_are_taken(duck, name):
    """A statement that is streamed and cut off must end as well."""
    timer = Timer(60, duck.interrupt)
    timer.start()
    try:
        rows = duck.sql(f"SELECT * FROM ({oracle.STATEMENTS[name]}) LIMIT 5").fetchall()
    finally:
        timer.cancel()
    assert len(rows) <= 5


def test_entry(spark):
    assert registry.entry(spark).count() > 0
