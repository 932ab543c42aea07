from __future__ import annotations

from fixtures import tuples

from trailmill.sinks import tables
from trailmill.sinks.tables import BatchTable, upsert_table

SCHEMA = "k long, click_count long"


def _table(spark, folder, files=2):
    return BatchTable(f"{folder}/t", spark.createDataFrame([], SCHEMA).schema, ("k",), files)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_latest_row_of_a_key_wins(spark, tmp_path):
    table = _table(spark, tmp_path)
    assert table.latest(spark).count() == 0
    assert table.publish(_rows(spark, (1, 1), (2, 2)), 0)
    assert table.publish(_rows(spark, (2, 5), (3, 3)), 1)
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 1), (2, 5), (3, 3)]


def test_replay_changes_nothing(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.publish(_rows(spark, (1, 1)), 0)
    table.publish(_rows(spark, (1, 4)), 1)
    assert not table.publish(_rows(spark, (1, 1)), 0)
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 4)]
    assert tuples(table.totals(spark), "k", "click_count") == [(1, 5)]


def test_half_written_batch_is_not_seen(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.publish(_rows(spark, (1, 1)), 0)
    _rows(spark, (1, 9)).write.parquet(f"{table.path}/_staging/batch-1")
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 1)]
    assert table.publish(_rows(spark, (1, 2)), 1)
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 2)]


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = _table(spark, tmp_path)
    assert table.compact(spark) is None
    for batch in range(4):
        table.publish(_rows(spark, (batch % 2, batch), (9, 1)), batch)
    before = tuples(table.latest(spark), "k", "click_count")
    assert table.compact(spark) == 3
    assert tuples(table.latest(spark), "k", "click_count") == before
    assert table.vacuum(spark) == 4
    assert tuples(table.latest(spark), "k", "click_count") == before
    assert not table.publish(_rows(spark, (1, 100)), 2)  # covered by the snapshot
    table.publish(_rows(spark, (1, 7)), 4)
    assert tuples(table.latest(spark), "k", "click_count") == [(0, 2), (1, 7), (9, 1)]


def test_vacuum_may_spare_the_folders_of_earlier_readers(spark, tmp_path):
    table = _table(spark, tmp_path)
    for batch in range(3):
        table.publish(_rows(spark, (1, batch)), batch)
        table.compact(spark)
    earlier = table.changes(spark)
    table.publish(_rows(spark, (1, 9)), 3)
    table.tidy(spark, every=1)
    assert earlier.count() == 1  # reads snapshot-2, which is still there
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 9)]
    names = sorted(p.name for p in tmp_path.joinpath("t").iterdir() if p.name[0] in "bs")
    assert names == ["batch-3", "snapshot-2", "snapshot-3"]


def test_additive_compaction(spark, tmp_path):
    table = _table(spark, tmp_path)
    for batch in range(3):
        table.publish(_rows(spark, (1, batch + 1)), batch)
    table.compact(spark, additive=True)
    table.publish(_rows(spark, (1, 10)), 3)
    assert tuples(table.totals(spark), "k", "click_count") == [(1, 16)]


def test_upsert_table(spark, tmp_path):
    path = f"{tmp_path}/u"
    upsert_table(_rows(spark, (1, 1)), path, ["k"], 0)
    table = upsert_table(_rows(spark, (1, 2), (2, 2)), path, ["k"], 1)
    assert tuples(table.latest(spark), "k", "click_count") == [(1, 2), (2, 2)]


def test_replace_slices(spark, tmp_path):
    path = f"{tmp_path}/s"
    kind = "date string, province string, ad_id long"
    first = [("d1", "01", 1), ("d1", "a b", 2), ("d2", "01", 3)]
    tables.replace_slices(spark.createDataFrame(first, kind), path, ["date", "province"])
    tables.replace_slices(
        spark.createDataFrame([("d1", "01", 8), ("d1", "01", 9)], kind), path, ["date", "province"]
    )
    schema = spark.createDataFrame([], kind).schema
    got = tables.read_slices(spark, path, schema)
    assert tuples(got, "date", "province", "ad_id") == [
        ("d1", "01", 8),
        ("d1", "01", 9),
        ("d1", "a b", 2),
        ("d2", "01", 3),
    ]


def test_append(spark, tmp_path):
    for _ in range(2):
        tables.append_rows(_rows(spark, (1, 1)), f"{tmp_path}/a")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 2
