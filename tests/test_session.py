"""Scratch tables are there until they are discarded."""

import os

from geocadence.session import discard, stored


def test_a_discarded_table_leaves_no_files(spark):
    table, other = stored(spark.range(10), "one"), stored(spark.range(3), "two")
    assert table.count() == 10 and os.path.isdir(table._scratch_path)
    discard(table)
    assert not os.path.exists(table._scratch_path) and other.count() == 3
