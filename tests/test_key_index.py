"""Indexed loads against plain ones: same rows, few folders read, types, NULL keys and parts."""

import pytest

from annualis.operators.quality import new_rows
from annualis.sources.key_index import IndexedTable, append_indexed, indexed_table, may_hold, read_rows


def _frame(spark, low, high, per=100):
    return spark.range(low, high).selectExpr("id AS k", f"cast(id div {per} as int) AS part", "cast(id as string) AS v")


def test_loads_are_idempotent_and_read_only_folders_that_may_hold_their_keys(spark, tmp_path, rows):
    whole = _frame(spark, 0, 2_000)
    table = indexed_table(whole, str(tmp_path / "t"), ["k"], "part")
    assert append_indexed(_frame(spark, 0, 1_500), table) == {"added": 1_500, "parts_read": 0}
    again = append_indexed(_frame(spark, 300, 400), table)
    assert again["added"] == 0 and 1 <= again["parts_read"] <= 3
    fresh = append_indexed(_frame(spark, 1_500, 1_600), table)
    assert fresh["added"] == 100 and fresh["parts_read"] <= 2
    assert append_indexed(whole, table)["added"] == 400
    assert rows(read_rows(spark, table), "k", "part", "v") == rows(whole, "k", "part", "v")


def test_no_held_key_is_missed(spark, tmp_path, rows):
    table = IndexedTable(str(tmp_path / "t"), ("k", "v"), "part", 1 << 10)  # far too small: most parts are asked
    append_indexed(_frame(spark, 0, 3_000, 20), table)  # 150 parts, three words
    load = _frame(spark, 2_000, 4_000, 20)
    found = may_hold(spark, table, load.select("k", "v"))
    missed = load.filter("k < 3000").join(found.withColumnRenamed("_part", "part"), ["k", "v", "part"], "left_anti")
    assert missed.count() == 0
    held = read_rows(spark, table)
    expected = rows(held.unionByName(new_rows(load, held, ["k", "v"])), "k", "part", "v")
    append_indexed(load, table)
    assert rows(read_rows(spark, table), "k", "part", "v") == expected


def test_a_large_share_of_the_rows_in_one_part(spark, tmp_path):
    df = spark.range(3_000).selectExpr("id AS k", "if(id < 1000, 'hot', concat('p', id % 20)) AS part")
    table = indexed_table(df, str(tmp_path / "t"), ["k"], "part")
    assert table.slots == 1 << 15
    append_indexed(df, table)
    assert append_indexed(df.filter("part = 'hot'"), table)["added"] == 0


def test_null_keys_are_always_new_and_repeated_keys_are_taken_once(spark, tmp_path, rows):
    table = IndexedTable(str(tmp_path / "t"), ("k",), "part", 1 << 10)
    load = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None)], "k int, part string")
    append_indexed(load, table)
    append_indexed(load, table)
    assert rows(read_rows(spark, table), "k", "part") == [(None, "a"), (None, "a"), (1, "a"), (2, None)]


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_a_load_of_another_type_meets_the_same_keys(spark, tmp_path, kind, rows):
    table = IndexedTable(str(tmp_path / "t"), ("k",), "part", 1 << 10)
    append_indexed(spark.createDataFrame([(1, "01"), (2, "02")], "k bigint, part string"), table)
    load = spark.createDataFrame([(2, "02"), (3, "03")], "k bigint, part string").selectExpr(f"cast(k as {kind}) AS k", "part")
    assert append_indexed(load, table)["added"] == 1
    assert rows(read_rows(spark, table), "k", "part") == [(1, "01"), (2, "02"), (3, "03")]


def test_empty_loads(spark, tmp_path):
    table = IndexedTable(str(tmp_path / "t"), ("k",), "part", 1 << 10)
    append_indexed(_frame(spark, 0, 10), table)
    assert append_indexed(_frame(spark, 0, 0), table) == {"added": 0, "parts_read": 0}
    assert read_rows(spark, table).count() == 10


def test_a_load_whose_rows_were_never_written_can_be_repeated(spark, tmp_path):
    from annualis.sources import key_index

    table = IndexedTable(str(tmp_path / "t"), ("k",), "part", 1 << 12)
    append_indexed(_frame(spark, 0, 100), table)
    load = _frame(spark, 100, 200)
    numbers = key_index._number_parts(spark, table, load)
    assert numbers.count() == 2
    assert append_indexed(load, table)["added"] == 100
    assert append_indexed(load, table)["added"] == 0
