import pytest
from duck import compare

from slidemill.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    left, right = compare(spark, sf, registry.QUERIES[name], registry.ORACLES[name])
    assert left == right
    assert left or name == "filename_filter"


def test_entry_reaches_every_status(spark):
    import __spark_entry__

    assert {r["status"] for r in __spark_entry__.entry(spark).collect()} == {"new", "updated", "duplicate", "copied_exists", "skipped_unchanged"}


def test_every_oracle_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
