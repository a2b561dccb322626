"""The native operator's plan, and that every query runs over the smallest tables."""

import pytest

import __spark_entry__ as entry
from rasterloom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


def test_url_filter_is_native(spark):
    text = QUERIES["op3_url_filters"](spark, DIR)._jdf.queryExecution().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
    assert "html" not in text.split("ReadSchema", 1)[1].split("\n")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    assert entry.queries()[name](spark, DIR).count() > 0
