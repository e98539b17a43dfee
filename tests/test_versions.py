"""Versioned tables: merge into itself, readers during a write, untouched buckets, UNIQUE, conflicts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corridor.operators.segments import upsert
from corridor.sinks.commits import ConcurrentChange
from corridor.sinks.versions import KeyIsNull, VersionedTable

COLUMNS = "segment_id long, osm_id long, name string"


def frame(spark, rows, schema=COLUMNS):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def table(spark, tmpdir_path):
    t = VersionedTable(spark, f"{tmpdir_path}/segments", "osm_id", buckets=8)
    with pytest.raises(LookupError):
        t.read()
    assert t.reload(frame(spark, [(i, 100 + i, f"road {i}") for i in range(40)])) == 1
    return t


def test_upsert_into_itself(spark, table):
    stored = table.read()
    incoming = stored.where("segment_id % 2 = 0").select(
        "segment_id", "osm_id", F.concat("name", F.lit(" new")).alias("name")).unionByName(frame(spark, [(77, 990, "added")]))
    want = rows_of(upsert(stored, incoming))
    assert table.upsert(incoming) == 2
    assert rows_of(table.read()) == want and len(want) == 41
    assert rows_of(table.read(1)) == rows_of(stored)


def test_reader_mid_write_sees_the_old_version(spark, table):
    reader = table.read()
    old = rows_of(reader)
    table.upsert(frame(spark, [(1, 101, "changed")]))
    assert rows_of(reader) == old
    table.reload(frame(spark, [(5, 5, "only")]))
    assert rows_of(reader) == old and rows_of(table.read()) == [(5, 5, "only")]
    assert table.vacuum(keep=1, grace=0.0) == 2 and rows_of(table.read()) == [(5, 5, "only")]


def test_untouched_buckets_are_not_rewritten(spark, table):
    before = table.manifest()["buckets"]
    table.upsert(frame(spark, [(1, 101, "changed"), (3, 101, "changed again")]).withColumn("ordinal", F.col("segment_id")))
    after = table.manifest()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == 8
    assert [r.name for r in table.read().where("osm_id = 101").collect()] == ["changed again"]
    assert table.upsert(frame(spark, [])) == 2                 # nothing to do: no new version


def test_failed_write_changes_nothing(spark, table):
    old = rows_of(table.read())
    with pytest.raises(Exception, match="boom"):
        table.merge(frame(spark, [(1, 101, "x")]), lambda base, new: base.select("segment_id", "osm_id", F.raise_error(F.lit("boom")).alias("name")))
    assert rows_of(table.read()) == old and table.version() == 1
    with pytest.raises(KeyIsNull):
        table.upsert(frame(spark, [(1, None, "x")]))


def test_second_of_two_writers_is_refused(spark, table):
    other = VersionedTable(spark, table.path, "osm_id")
    table.upsert(frame(spark, [(1, 101, "first")]))
    other.version = lambda: 1                                  # it began before
    with pytest.raises(ConcurrentChange):
        other.upsert(frame(spark, [(2, 102, "second")]))
    assert table.version() == 2 and [r.name for r in table.read().where("osm_id IN (101, 102)").orderBy("osm_id").collect()] == ["first", "road 2"]


def test_insert_enforces_unique(spark, table):
    batch = frame(spark, [(200, 300, "a", 1), (201, 300, "b", 2), (202, 105, "c", 3), (203, 301, "d", 4)], COLUMNS + ", ordinal int")
    folders = table.manifest()["buckets"]
    seen = []
    real = table._frame
    table._frame = lambda m, only=None, columns=None: seen.append((only, columns)) or real(m, only, columns)
    version, rejected = table.insert(batch)
    table._frame = real
    assert version == 2 and sorted((r.segment_id, r.reason) for r in rejected.collect()) == [(201, "osm_id_repeated"), (202, "osm_id_stored")]
    assert len(seen) == 1 and len(seen[0][0]) <= 3 and seen[0][1] == ["osm_id"]      # keys of the batch's buckets only
    assert rows_of(table.read().where("osm_id >= 200")) == [(200, 300, "a"), (203, 301, "d")]
    after = table.manifest()["buckets"]
    assert all(after[b][0] == f[0] for b, f in folders.items()) and table.read().count() == 42
    version, rejected = table.insert(batch)
    assert rejected.count() == 4 and table.read().count() == 42
    table.delete(frame(spark, [(0, 300, "")]))
    assert table.read().where("osm_id = 300").count() == 0 and table.read().count() == 41


def test_updated_at_is_stamped(spark, tmpdir_path):
    t0, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    schema = "id long, status string, created_at timestamp, updated_at timestamp"
    t = VersionedTable(spark, f"{tmpdir_path}/incidents", "id", buckets=4)
    t.reload(frame(spark, [(1, "active", t0, t0), (2, "active", t0, t0)], schema))
    t.upsert_touch(frame(spark, [(2, "cleared", now, now), (3, "active", now, now)], schema), now=F.lit(now))
    assert rows_of(t.read()) == [(1, "active", t0, t0), (2, "cleared", t0, now), (3, "active", now, now)]
