"""Every query of the library against its SQL, or rows where it has none."""

import pytest

from quarry import catalog

from compare import same

WITH_SQL = sorted(catalog.oracle_sql())
WITHOUT = sorted(set(catalog.queries()) - set(WITH_SQL))


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, sf, name):
    same(catalog.queries()[name](spark, sf), catalog.oracle_sql()[name], sf)


@pytest.mark.parametrize("name", WITHOUT)
def test_query_gives_rows(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
