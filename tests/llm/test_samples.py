"""Bounded samples for the fits: never empty through rounding, and an error if they are."""

import numpy as np
import pytest

from lumenpath.llm import common


def test_the_share_of_a_very_large_table_is_not_cut_to_none():
    for rows in (10**10, 10**13, 10**15):
        hashes = common.below(12_000 / rows) + (1 << 63)
        assert hashes > 0 and abs(hashes / 2.0**64 * rows / 12_000 - 1) < 1e-3
    assert common.below(1.0) == (1 << 63) - 1 and common.below(0.0) == -(1 << 63)


def test_a_sample_has_about_its_share(spark):
    df = spark.range(40_000).withColumnRenamed("id", "k")
    some, n = common.bounded_sample(df, ["k"], 4_000)
    assert n == 40_000 and 3_500 < some.count() < 4_500
    assert common.bounded_sample(df, ["k"], 50_000)[0].count() == 40_000


def test_an_empty_sample_of_known_rows_is_an_error(spark):
    none = spark.createDataFrame([], "doc_id long, th long, text string, label int")
    assert common.fitted(none, 0, lambda texts, labels: 1) is None
    with pytest.raises(ValueError):
        common.fitted(none, 5, lambda texts, labels: 1)
    one = spark.createDataFrame([(1, 2, "t", 1)], none.schema)
    assert common.fitted(one, 1, lambda texts, labels: (texts, np.asarray(labels).tolist())) == (["t"], [1.0])
