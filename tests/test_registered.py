"""Every registered query against its SQL, on whole tables."""

import pytest
from oracle import difference

from tidemark.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, name):
    assert QUERIES[name].sql, "every query has SQL"
    assert difference(spark, name, SF) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(QUERIES)
    assert entry.entry(spark).count() > 0
