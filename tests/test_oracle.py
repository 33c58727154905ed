"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from compare import connect, difference
from conftest import SF_DIR

from clickfolk.catalog.registry import all_queries

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    query = QUERIES[name]
    table = query.run(spark, SF_DIR).toArrow()
    if query.sql is None:
        assert table.num_rows > 0
        return
    con = connect(SF_DIR)
    assert difference(table, con.execute(query.sql).to_arrow_table()) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
