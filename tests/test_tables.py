import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from doclake.operators import tables
from doclake.session import scratch_path

SCHEMA = "k string, v int"


def rows(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


@pytest.fixture
def keyed(spark):
    return tables.KeyedTable(spark, scratch_path(spark, "keyed"), "k", SCHEMA)


def test_latest_row_of_a_batch_wins_and_missing_keys_are_rejected(spark, keyed):
    keyed.upsert(spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 9)], SCHEMA), 0, ["v"])
    assert rows(keyed.latest()) == [("a", 3), ("b", 2)]
    assert rows(keyed.rejects()) == [(None, 9)]


def test_replay_changes_nothing_and_later_batches_win(spark, keyed):
    first = spark.createDataFrame([("a", 5), ("b", 2)], SCHEMA)
    second = spark.createDataFrame([("a", 1), ("c", 4)], SCHEMA)
    keyed.upsert(first, 0, ["v"])
    keyed.upsert(second, 1, ["v"])
    keyed.upsert(second, 1, ["v"])
    assert rows(keyed.latest()) == [("a", 1), ("b", 2), ("c", 4)]
    keyed.upsert(first, 0, ["v"])
    assert rows(keyed.latest()) == [("a", 1), ("b", 2), ("c", 4)]
    assert keyed.log().count() == 4


def test_rejects_may_be_empty(spark, keyed):
    keyed.upsert(spark.createDataFrame([("a", 5)], SCHEMA), 0, ["v"])
    assert keyed.rejects().count() == 0


def test_compacted_table_takes_later_batches(spark, keyed):
    for batch in range(3):
        keyed.upsert(spark.createDataFrame([("a", batch), (f"x{batch}", batch)], SCHEMA), batch, ["v"])
    compacted = keyed.compact(scratch_path(spark, "compact"))
    assert rows(compacted.latest()) == rows(keyed.latest())
    assert compacted.log().count() == 6  # a replay may bring back what was replaced
    compacted.upsert(spark.createDataFrame([("x0", 7)], SCHEMA), 3, ["v"])
    assert ("x0", 7) in rows(compacted.latest())


def test_compacted_table_survives_replays(spark, keyed):
    batches = {n: spark.createDataFrame([("a", n), (f"x{n}", n)], SCHEMA) for n in range(3)}
    for n, batch in batches.items():
        keyed.upsert(batch, f"run-{n}", ["v"])
    keyed.upsert(spark.createDataFrame([(None, 1)], SCHEMA), "bad", ["v"])
    expected = rows(keyed.latest())
    compacted = keyed.compact(scratch_path(spark, "compact"))
    assert rows(compacted.rejects()) == [(None, 1)]
    for n in (2, 0, 1, 2):
        compacted.upsert(batches[n], f"run-{n}", ["v"])
        assert rows(compacted.latest()) == expected
    # another source may count from zero again
    compacted.upsert(spark.createDataFrame([("a", 9)], SCHEMA), "stream-0", ["v"])
    assert ("a", 9) in rows(compacted.latest()) and len(rows(compacted.latest())) == 4
    again = compacted.compact(scratch_path(spark, "compact"))
    again.upsert(batches[2], "run-2", ["v"])
    assert ("a", 9) in rows(again.latest())


@pytest.mark.parametrize("in_place", [True, False])
def test_changed_replay_after_compaction_takes_the_place_of_the_first_run(spark, keyed, in_place):
    """20 keys, of which the second run has 15, with new values."""
    first = spark.createDataFrame([(f"k{i}", i) for i in range(20)] + [(None, 1)], SCHEMA)
    again = spark.createDataFrame([(f"k{i}", 100 + i) for i in range(15)] + [(None, 2)] * 2, SCHEMA)
    keyed.upsert(spark.createDataFrame([("k19", -1), ("z", -2)], SCHEMA), "before", ["v"])
    keyed.upsert(first, "run", ["v"])
    keyed.upsert(spark.createDataFrame([("k3", 999)], SCHEMA), "after", ["v"])
    compacted = keyed.compact(None if in_place else scratch_path(spark, "compact"))
    assert len(rows(compacted.latest())) == 21
    compacted.upsert(again, "run", ["v"])
    # a withdrawn key shows what a batch before it had
    expected = sorted([(f"k{i}", 999 if i == 3 else 100 + i) for i in range(15)] + [("k19", -1), ("z", -2)])
    assert rows(compacted.latest()) == expected
    assert rows(compacted.rejects()) == [(None, 2)] * 2
    once_more = compacted.compact()
    assert rows(once_more.latest()) == expected and rows(once_more.rejects()) == [(None, 2)] * 2
    once_more.upsert(first, "run", ["v"])
    assert len(rows(once_more.latest())) == 21 and ("k3", 999) in rows(once_more.latest())


def test_settled_batches_keep_live_rows_only(spark):
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"), "k", SCHEMA, replayable=1)
    table.upsert(spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA), 1)
    table.upsert(spark.createDataFrame([("a", 2)], SCHEMA), 2)
    table.upsert(spark.createDataFrame([("c", 3)], SCHEMA), 3)
    table.compact()
    assert sorted((r["k"], r["v"]) for r in table.log().collect()) == [("a", 2), ("b", 1), ("c", 3)]


def test_names_of_batches_are_told_apart(spark, keyed):
    for i, name in enumerate(["run:1", "run_1", "compacted", "__HIVE_DEFAULT_PARTITION__", "a/b", "a%2Fb", "ü'", "1", "01"]):
        keyed.upsert(spark.createDataFrame([(f"{name}-{x}", i) for x in range(3)], SCHEMA), name)
        assert keyed.written(name) == 3
    assert keyed.written("never") == 0
    before = rows(keyed.latest())
    assert len(before) == 27
    compacted = keyed.compact(scratch_path(spark, "it's"))
    assert rows(compacted.latest()) == before
    compacted.upsert(spark.createDataFrame([("new", 1)], SCHEMA), "compacted")
    assert len(rows(compacted.latest())) == 25 and ("new", 1) in rows(compacted.latest())


def test_reading_shuffles_the_log_alone(spark, keyed):
    keyed.upsert(spark.range(3000).selectExpr("cast(id AS string) k", "cast(id AS int) v"), "all")
    keyed.compact()
    keyed.upsert(spark.createDataFrame([("7", -7), ("x", 0)], SCHEMA), "few")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        latest = keyed.latest()
        plan = plan_of(latest)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert len(scans) == 1
    # the run's scan lies under no exchange: those above it end before the union
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan.splitlines()
    at = lines.index(scans[0])
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert any("Union" in line for line in above) and not any("Exchange" in line for line in above)
    assert latest.count() == 3001 and ("7", -7) in rows(latest.filter("k = '7'"))


def test_runs_are_merged_with_those_not_larger(spark, keyed):
    written = {}
    for n, size in enumerate([500, 20, 30, 5, 5, 400]):
        batch = {f"k{(n * 97 + i) % 700}": n for i in range(size)}
        written |= batch
        keyed.upsert(spark.createDataFrame(list(batch.items()), SCHEMA), n)
        keyed.compact()
        assert rows(keyed.latest()) == sorted(written.items())
        assert len(keyed._runs()[1]) <= 4
    before = keyed.latest()
    count = before.count()
    keyed.remove_old()
    assert rows(keyed.latest()) == sorted(written.items()) and count == len(written)
    again = tables.KeyedTable(spark, keyed.path, "k", SCHEMA)
    again.upsert(spark.createDataFrame([("k1", -1)], SCHEMA), 0)
    assert rows(again.latest())  # a replay of the first batch: older than all others
    assert ("k1", -1) not in rows(again.latest()) or written["k1"] == 0


def test_many_small_batches_are_compacted_on_the_way(spark):
    table = tables.KeyedTable(spark, scratch_path(spark, "keyed"), "k", SCHEMA, compact_every=3)
    for n in range(8):
        table.upsert(spark.createDataFrame([("a", n), (f"x{n}", n)], SCHEMA), n)
    assert table._runs()[0] == 2
    assert rows(table.latest()) == sorted([("a", 7)] + [(f"x{n}", n) for n in range(8)])
    table.upsert(spark.createDataFrame([("y", 1)], SCHEMA), 7)
    assert ("a", 6) in rows(table.latest()) and ("x7", 7) not in rows(table.latest())


def test_replay_without_rows_clears_the_batch(spark, keyed):
    keyed.upsert(spark.createDataFrame([("a", 1), (None, 2)], SCHEMA), "b", ["v"])
    keyed.upsert(spark.createDataFrame([], SCHEMA), "b", ["v"])
    assert rows(keyed.latest()) == [] and rows(keyed.rejects()) == []


def test_hot_key_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("hot"), F.col("id") % 1).alias("k"), F.col("id").cast("int").alias("v"))
    latest = tables.latest_by_key(df, "k", ["v"])
    plan = plan_of(latest)
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]
    assert rows(latest) == [("hot0", 999)]


def test_equal_order_is_settled_the_same_way(spark):
    data = [("a", v) for v in range(50)]
    runs = {
        rows(tables.latest_by_key(spark.createDataFrame(d, SCHEMA).repartition(n), "k", []))[0]
        for d, n in ((data, 1), (data[::-1], 3), (data, 7))
    }
    assert len(runs) == 1


def test_upsert_by_key(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    changes = spark.createDataFrame([("b", 5), ("b", 4), ("c", 3), (None, 8)], SCHEMA)
    assert rows(tables.upsert_by_key(current, changes, "k", ["v"])) == [("a", 1), ("b", 5), ("c", 3)]
    assert rows(tables.rejected_rows(changes, "k")) == [(None, 8)]


def test_write_table_twice(spark):
    folder = scratch_path(spark, "db")
    for n in (3, 5):
        written = tables.write_table(spark.range(n), "written_db.t", f"{folder}/t", folder)
        assert written == n == spark.table("written_db.t").count()


def test_bucketed_marts_join_without_shuffle(spark):
    folder = scratch_path(spark, "db")
    df = spark.range(100).select(F.col("id").cast("string").alias("file_name"))
    a = tables.table_mart(df, "bucket_db.a", f"{folder}/a", database_path=folder)
    b = tables.table_mart(df, "bucket_db.b", f"{folder}/b", database_path=folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = a.join(b, "file_name")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_count():
    assert tables.bucket_count(10) == 4
    assert tables.bucket_count(10**9) == 200
