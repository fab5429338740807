"""Versioned tables: two loads, killed drivers, replayed batches, and what a load reads."""

import datetime

import pytest
from pyspark.sql import functions as F

from prodseries.operators.snapshots import LoadConflict, SnapshotTable, Version

JAN, FEB, MAR = "2024-01-01", "2024-02-01", "2024-03-01"
SCHEMA = "period_date string, code string, unit string, value double"
T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


def batch_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).withColumn("period_date", F.to_date("period_date"))


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["period_date", "code", "unit"], nullable_keys=["unit"], buckets=3)


def found(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select("period_date", "code", "unit", *columns).collect()))


def test_two_loads_and_old_versions(spark, table):
    first = [(JAN, "a", None, 1.0), (JAN, "b", "u", 2.0), (FEB, "a", "u", 3.0)]
    assert table.load(batch_of(spark, first), T1) == {"n_operations": 3, "matched_count": 0, "modified_count": 0, "upserted_count": 3}
    # A NULL unit matches a NULL unit; a column more comes in, the value stays where it is not carried.
    second = batch_of(spark, [(JAN, "a", None, "x"), (JAN, "c", "u", "y"), (MAR, "a", "u", "z")], "period_date string, code string, unit string, note string")
    assert table.load(second, T2) == {"n_operations": 3, "matched_count": 1, "modified_count": 1, "upserted_count": 2}
    assert found(table.rows(), "value", "note", "ingested_at", "updated_at") == [
        (JAN, "a", "None", "1.0", "x", T1, T2), (JAN, "b", "u", "2.0", "None", T1, T1), (JAN, "c", "u", "None", "y", T2, T2),
        (FEB, "a", "u", "3.0", "None", T1, T1), (MAR, "a", "u", "None", "z", T2, T2),
    ]
    assert found(table.rows(number=1), "value") == [(JAN, "a", "None", "1.0"), (JAN, "b", "u", "2.0"), (FEB, "a", "u", "3.0")]
    assert found(table.rows(months=[FEB])) == [(FEB, "a", "u")]
    assert table.rows(months=["1999-01-01"]).collect() == []
    assert table.version().number == 2 and table.version().buckets == 3
    with pytest.raises(ValueError, match="no version 9"):
        table.version(9)


def test_a_load_reads_its_months_only_and_does_not_move_what_is_stored(spark, table):
    months = [datetime.date(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]
    table.load(batch_of(spark, [(str(m), f"k{i}", "u", float(i)) for m in months for i in range(20)]), T1)
    batch = batch_of(spark, [(str(m), f"k{i}", "u", 0.5) for m in months[3:5] for i in range(15, 25)])
    version = table.version()
    held = {str(m): version.months[str(m)] for m in months[3:5]}
    with table._stored(version, held) as stored:
        files = stored.inputFiles()
        assert files and all(any(f"_month={m}" in f for m in held) for f in files)
        plan = table.merged(stored, batch, version.schema, version.buckets, T2)
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan")[0]
    join = final.index("ShuffledHashJoin")
    side = final[join : final.index("FileScan parquet")]
    assert "Exchange" not in side and "Sort" not in side and "Bucketed: true" in final and "FullOuter" in side
    counters = table.load(batch, T2)
    assert counters == {"n_operations": 20, "matched_count": 10, "modified_count": 10, "upserted_count": 10}
    moved = {m for m, load in table.version().months.items() if load != version.months[m]}
    assert moved == set(held)
    assert table.rows().count() == 30 * 20 + 10
    assert table.rows().groupBy("period_date", "code").count().filter("count > 1").count() == 0


def test_a_killed_driver_leaves_the_old_version(spark, table, monkeypatch):
    table.load(batch_of(spark, [(JAN, "a", "u", 1.0), (FEB, "a", "u", 1.0)]), T1)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.load(batch_of(spark, [(JAN, "a", "u", 2.0), (FEB, "a", "u", 2.0)]), T2)
    assert found(table.rows(), "value") == [(JAN, "a", "u", "1.0"), (FEB, "a", "u", "1.0")]
    table.load(batch_of(spark, [(JAN, "a", "u", 3.0)]), T2)
    assert found(table.rows(), "value") == [(JAN, "a", "u", "3.0"), (FEB, "a", "u", "1.0")]
    # Tables registered for a load are gone.
    assert [t for t in spark.catalog.listTables() if t.name.startswith(("snapshot_", "load_"))] == []


def test_of_two_loads_at_once_one_fails(spark, table, monkeypatch):
    table.load(batch_of(spark, [(JAN, "a", "u", 1.0)]), T1)
    own = table.version()
    table.load(batch_of(spark, [(JAN, "a", "u", 2.0)]), T2)
    with pytest.raises(LoadConflict):
        table._commit(Version(2, own.schema, own.keys, own.buckets, own.months))
    assert found(table.rows(), "value") == [(JAN, "a", "u", "2.0")]


def test_bad_batches(spark, table):
    with pytest.raises(Exception, match="duplicate key in batch"):
        table.load(batch_of(spark, [(JAN, "a", None, 1.0), (JAN, "a", None, 2.0)]), T1)
    with pytest.raises(Exception, match="key without a value: code"):
        table.load(batch_of(spark, [(JAN, None, "u", 1.0)]), T1)
    with pytest.raises(ValueError, match="no load has reached"):
        table.rows()
    assert table.load(batch_of(spark, []), T1)["n_operations"] == 0
    assert table.rows().collect() == []


def test_a_batch_that_comes_again_is_left_alone(spark, table):
    load = table.loader("feed", lambda i: f"2025-01-0{i + 1} 00:00:00")
    load(batch_of(spark, [(JAN, "a", "u", 1.0)]), 0)
    load(batch_of(spark, [(JAN, "a", "u", 2.0), (FEB, "b", "u", 2.0)]), 1)
    before = found(table.rows(), "value", "updated_at")
    again = table.loader("feed", lambda i: "2030-01-01 00:00:00")
    again(batch_of(spark, [(JAN, "a", "u", 1.0)]), 0)
    again(batch_of(spark, [(JAN, "a", "u", 2.0), (FEB, "b", "u", 2.0)]), 1)
    assert found(table.rows(), "value", "updated_at") == before
    assert table.version().number == 2
    # Another stream counts for itself.
    table.loader("other", lambda i: T2)(batch_of(spark, [(JAN, "a", "u", 5.0)]), 0)
    assert table.version().batches == {"feed": 1, "other": 0}


def test_a_stream_without_its_checkpoint_changes_nothing(spark, table, tmp_path):
    source = str(tmp_path / "in")
    for i in range(3):
        batch_of(spark, [(JAN, f"k{i}", "u", float(i)), (FEB, "same", "u", float(i))]).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint, now):
        arriving = spark.readStream.schema("period_date date, code string, unit string, value double").option("maxFilesPerTrigger", 1).parquet(source)
        query = arriving.writeStream.foreachBatch(table.loader("feed", lambda i: now)).option("checkpointLocation", str(tmp_path / checkpoint))
        query.trigger(availableNow=True).start().awaitTermination()
        return found(table.rows(), "value", "ingested_at", "updated_at")

    first = run("c1", T1)
    assert len(first) == 4 and table.version().number == 3
    assert run("c1", T2) == first
    assert run("c2", T2) == first and table.version().number == 3


def test_nested_columns(spark, table):
    rows = spark.sql("SELECT date'2024-01-05' AS period_date, 'a' AS code, 'u' AS unit, array(named_struct('d', date'2024-02-01', 'v', 1.5d)) AS points")
    table.load(rows, T1)
    table.load(rows.withColumn("points", F.concat("points", "points")), T2)
    (row,) = table.rows().collect()
    assert [p.v for p in row.points] == [1.5, 1.5] and str(row.ingested_at) == T1
