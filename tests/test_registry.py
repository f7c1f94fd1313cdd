import pytest
from compare import duck_rows, spark_rows

from textkiln import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    columns, rows = spark_rows(df)
    if name in registry.ORACLE_SQL:
        want_columns, want = duck_rows(registry.ORACLE_SQL[name], SF)
        assert columns == want_columns
        assert rows == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
