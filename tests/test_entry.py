"""Driver contract: entry() runs; every query has an oracle except the rows-only ones."""

import __spark_entry__ as E
from feedline import suite


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and rows[0]["status"] == "SUCCESS" and rows[0]["rows_written"] > 0


def test_queries_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(suite.QUERIES) <= set(o)  # the corpus operators have tests of their own
