import os

import pytest

import __spark_entry__ as entry


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "flagship_star_answer" in entry.queries()


@pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="no tables on this machine")
def test_flagship_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["nation", "order_status", "orders", "measured", "eligible", "mean_index", "pooled_index"]
    assert df.count() > 0
