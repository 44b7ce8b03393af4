"""What leaves the disk, and when: shuffle files, tables stored on the way, groups of parts."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casebook import session
from casebook.operators import merge
from casebook.plans import catalog
from tests import side_by_side

SF_DIR = "/root/testdata/sf0.001"


def _shuffled(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("/shuffle_" in line for line in manager.getAllFiles().mkString("\n").split("\n"))


def _gone(spark, before: int) -> bool:
    """Files go a moment after the query that made them has ended."""
    for _ in range(100):
        if _shuffled(spark) <= before:
            return True
        time.sleep(0.05)
    return False


def _events(spark, ids, stamp: str, day: str = "2024-05-01"):
    frame = spark.createDataFrame([(k, f"{stamp} {k}") for k in ids], "event_id string, event_title string")
    own = {
        "event_id": F.col("event_id"), "event_title": F.col("event_title"), "event_source": F.lit("OSHA"),
        "event_date": F.lit(day).cast("timestamp"), "ingested_at": F.lit(stamp).cast("timestamp"),
    }
    return frame.select(*[own.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in merge.schemas.SILVER.fields])


def test_stored_tables_leave_no_shuffle_files(spark):
    before, setting = _shuffled(spark), spark.conf.get(session.FREE)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert len(session.stored(rows, "counts").collect()) == 10
    assert _gone(spark, before)
    with session.freed(spark):
        assert len(rows.select("*").collect()) == 10
    assert _gone(spark, before)
    assert spark.conf.get(session.FREE) == setting


def test_tables_of_a_block_go_with_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: f"file:{tmp_path}")
    names = lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    outside = session.stored(spark.range(3), "outside")
    with pytest.raises(ZeroDivisionError), session.passing(spark):
        session.stored(spark.range(3), "outer")
        kept = session.stored(spark.range(3), "kept", lasting=True)
        with session.passing(spark):
            session.stored_in_turn([spark.range(3), spark.range(2)], "inner")
            assert names() == ["inner", "kept", "outer", "outside"]
        assert names() == ["kept", "outer", "outside"]
        raise ZeroDivisionError
    assert names() == ["kept", "outside"]
    assert outside.count() == kept.count() == 3


def test_groups_hold_every_part_once():
    parts = {str(k) for k in (0, 2, 4, 6)}
    assert session.groups(session.GROUP_ROWS, parts) == [["0", "2", "4", "6"]]
    assert session.groups(2 * session.GROUP_ROWS, parts) == [["0", "4"], ["2", "6"]]
    assert session.groups(99 * session.GROUP_ROWS, parts) == [["0"], ["2"], ["4"], ["6"]]
    assert session.groups(99 * session.GROUP_ROWS, parts, 2) == [["0", "4"], ["2", "6"]]
    assert session.groups(99 * session.GROUP_ROWS, set()) == [[]]


@pytest.mark.parametrize("group_rows", [session.GROUP_ROWS, 20])
def test_a_merge_by_groups_of_parts_is_the_same(spark, tmp_path, monkeypatch, group_rows):
    monkeypatch.setattr(session, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: f"file:{tmp_path}/shared")
    written, write = [], merge._write_version
    monkeypatch.setattr(merge, "_write_version", lambda parts, *place: write((written.append(p) or p for p in parts), *place))
    table = f"file:{tmp_path}/silver"
    ids = [f"event {k}" for k in range(200)]
    assert merge.merge_into_silver(spark, _events(spark, ids, "2024-01-01"), table) == 1
    # Some come anew, in another year; one is older than what is there; one is new.
    late = _events(spark, ids[:40], "2024-02-01", "2025-05-01").unionByName(_events(spark, ["more"], "2024-02-01"))
    late = late.unionByName(_events(spark, ids[50:51], "2023-02-01"))
    assert merge.merge_into_silver(spark, late, table) == 2
    assert len(written) == (2 if group_rows > 200 else 16)
    title = {k: f"2024-01-01 {k}" for k in ids} | {k: f"2024-02-01 {k}" for k in [*ids[:40], "more"]}
    silver = merge.read_silver(spark, table)
    assert {r.event_id: r.event_title for r in silver.collect()} == title and silver.count() == 201
    assert {r.event_title for r in merge.read_silver(spark, table, 1).collect()} == {f"2024-01-01 {k}" for k in ids}
    signed = merge.changes(spark, table, 2).select("sign", "event_id", "event_title").collect()
    assert sorted(tuple(r) for r in signed) == sorted(
        [(-1, k, f"2024-01-01 {k}") for k in ids[:40]] + [(1, k, f"2024-02-01 {k}") for k in [*ids[:40], "more"]]
    )
    # Ids given twice are refused before anything is written, null ones too.
    for twice in (["a", "a"], [None, None]):
        with pytest.raises(ValueError):
            merge.merge_into_silver(spark, _events(spark, twice, "2024-03-01"), table)
    assert merge.newest_version(spark, table) == 2 and not (tmp_path / "silver/data/version=3").exists()
    left = {p.name.rsplit("-", 1)[0] for p in Path(tmp_path, "shared").iterdir()}
    assert left <= {"changes"}


@pytest.mark.parametrize(
    "name, left",
    [
        ("entity_refresh", {"refresh", "late", "touched-state", "touched-city", "touched-company", "touched-site"}),
        ("documents_stored_upsert", {"keyed-documents", "late", "touched-state", "touched-city", "touched-company", "touched-site"}),
        ("serving_refresh", {"serving"}),
    ],
)
def test_refreshes_keep_no_table_of_the_way(spark, tmp_path, monkeypatch, name, left):
    """Worked off by groups, they give what their SQL says, and only what is read later stays."""
    monkeypatch.setattr(session, "GROUP_ROWS", 2000)
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: f"file:{tmp_path}")
    before = _shuffled(spark)
    rows = catalog.QUERIES[name](spark, SF_DIR)
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} == left
    # Lookups of a few rows (parts, versions, names) may leave theirs until the driver collects garbage.
    assert _gone(spark, before + 60)
    assert side_by_side.differences(side_by_side.connect(SF_DIR), rows, catalog.ORACLES[name]) is None
