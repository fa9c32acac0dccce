"""Feed documents are parsed once; snapshots stay few."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirecount.plans import ingest
from wirecount.schemas import REGISTRY
from wirecount.session import SMALL_FILES, small_files
from wirecount.sources import entries, snapshots


def document(folder, channel, name, *items):
    place = f"{folder}/landing/channel_id={channel}"
    os.makedirs(place, exist_ok=True)
    body = "".join(f"<item><title>{t}</title><pubDate>{p}</pubDate></item>" for t, p in items)
    with open(f"{place}/{name}.xml", "w") as f:
        f.write(f"<rss><channel>{body}</channel></rss>")


@pytest.fixture
def root(spark, tmp_path):
    snapshots.publish_channels(spark.createDataFrame(
        [(1, "one", "u1", 0), (2, "two", "u2", 0)], REGISTRY), str(tmp_path))
    return str(tmp_path)


def run(spark, root, **options):
    return ingest.ingest_landed(spark, f"{root}/landing", root,
                                ingest.to_folder(f"{root}/messages"), **options)


@pytest.mark.parametrize("named", [100, 0])
def test_a_second_run_parses_nothing(spark, root, monkeypatch, named):
    document(root, 1, "a", ("x", "2024-01-01T00:00:00Z"))
    document(root, 2, "b", ("y", "2024-01-01T00:00:00Z"), ("z", "2024-01-02T00:00:00Z"))
    assert run(spark, root, named_at_most=named) == 3
    seen = []
    real = entries.read_entries_xml
    monkeypatch.setattr(entries, "read_entries_xml",
                        lambda *a, **b: seen.append(b.get("documents")) or real(*a, **b))
    assert run(spark, root, named_at_most=named) == 0 and seen == []
    document(root, 1, "c", ("w", "2024-01-03T00:00:00Z"), ("old", "2023-01-01T00:00:00Z"))
    assert run(spark, root, named_at_most=named) == 1
    assert len(seen) == 1 and (not named or [d.rsplit("/", 1)[1] for d in seen[0]] == ["c.xml"])
    # Changed later: parsed again, and its earlier entries are behind the mark.
    document(root, 1, "c", ("w", "2024-01-03T00:00:00Z"), ("v", "2024-01-04T00:00:00Z"))
    os.utime(f"{root}/landing/channel_id=1/c.xml", (2e9, 2e9))
    assert run(spark, root, named_at_most=named) == 1
    assert run(spark, root, named_at_most=named) == 0


def test_a_run_that_fails_is_made_up_for(spark, root):
    document(root, 1, "a", ("x", "2024-01-01T00:00:00Z"))

    def lost(rows, version):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        ingest.ingest_landed(spark, f"{root}/landing", root, lost)
    assert run(spark, root) == 1


def test_removed_documents_leave_the_record(spark, root):
    document(root, 1, "a", ("x", "2024-01-01T00:00:00Z"))
    run(spark, root)
    os.remove(f"{root}/landing/channel_id=1/a.xml")
    document(root, 1, "b", ("y", "2024-01-02T00:00:00Z"))
    assert run(spark, root) == 1
    known = snapshots.read(spark, f"{root}/{snapshots.PARSED}").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in known] == ["b.xml"]


def test_an_empty_folder(spark, root):
    os.makedirs(f"{root}/landing/channel_id=1")
    assert run(spark, root) == 0


def test_versions_and_announcements_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "SEGMENT", 3)
    monkeypatch.setattr(snapshots, "KEPT", 1)
    path = str(tmp_path)
    assert snapshots.latest(spark, path) is None and snapshots.read(spark, path) is None
    for version in range(14):
        snapshots.publish(spark.createDataFrame([(version,)], "v long"), path, version,
                          run=f"r{version}")
    assert rows(snapshots.read(spark, path)) == [(13,)]
    assert snapshots.latest(spark, path) == 13
    assert snapshots.latest(spark, path, at_most=11) == 11
    assert snapshots.latest(spark, path, at_most=2) is None
    assert snapshots.version_of(spark, path, "r13") == 13
    assert snapshots.version_of(spark, path, "r10") == 10
    assert snapshots.version_of(spark, path, "r1") is None
    assert sorted(map(int, os.listdir(f"{path}/data"))) == list(range(9, 14))
    assert sorted(os.listdir(f"{path}/announced")) == ["3", "4"]
    # Announced again after a repeated run: one version, the same rows.
    snapshots.publish(spark.createDataFrame([(13,)], "v long"), path, 13, run="r13")
    assert rows(snapshots.read(spark, path)) == [(13,)]


def test_a_gap_between_segments_is_passed_over(spark, tmp_path):
    path = str(tmp_path)
    for version in (5, 205):
        snapshots.publish(spark.createDataFrame([(version,)], "v long"), path, version)
    assert snapshots.latest(spark, path, at_most=204) == 5
    assert snapshots.latest(spark, path) == 205


def test_landed_lists_documents_without_reading_them(spark, root):
    document(root, 1, "a", ("x", "2024-01-01T00:00:00Z"))
    there = entries.landed(spark, f"{root}/landing")
    assert [(r["path"].rsplit("/", 1)[1], r["bytes"] > 10) for r in there.collect()] == [
        ("a.xml", True)]
    assert "content" not in there._jdf.queryExecution().executedPlan().toString().split(
        "ReadSchema")[1]
    assert entries.landed(spark, f"{root}/landing", datetime(2100, 1, 1)).count() == 0


def test_a_feed_document_holds_many_entries(spark):
    """A file per channel, not per channel and day; a busy channel has several; none is lost."""
    from workload import inputs

    quiet = [(c, f"t{d}", f"2024-01-{d:02}T00:00:00Z") for c in (1, 2) for d in range(1, 21)]
    busy = [(3, f"<&{n}", None) for n in range(500)]
    given = spark.createDataFrame(quiet + busy, "channel_id long, title string, published string")
    made = inputs.feed_documents(given, size=50).collect()
    per = {c: [r["value"] for r in made if r["channel_id"] == c] for c in (1, 2, 3)}
    assert len(per[1]) == len(per[2]) == 1 and 5 <= len(per[3]) <= 10
    assert sum(v.count("<item>") for v in per[1]) == 20
    assert sum(v.count("<item><title>&lt;&amp;") for v in per[3]) == 500


def test_many_small_documents_are_few_tasks(spark, root, monkeypatch):
    """A task reads small documents by the hundred; four a task, as the engine has it, were 75."""
    for channel in range(300):
        document(root, channel, "a", ("x", "2024-01-01T00:00:00Z"))
    names = list(SMALL_FILES)
    before = [spark.conf.get(n, None) for n in names]
    tasks = []
    real = entries.read_entries_xml

    def read(*given, **options):
        made = real(*given, **options)
        tasks.append(made.rdd.getNumPartitions())
        return made

    monkeypatch.setattr(entries, "read_entries_xml", read)
    assert run(spark, root) == 2
    assert len(tasks) == 1 and tasks[0] <= 2 * spark.sparkContext.defaultParallelism
    assert [spark.conf.get(n, None) for n in names] == before


def test_settings_for_small_files_end_with_a_failure(spark):
    name = "spark.sql.files.openCostInBytes"
    spark.conf.set(name, "1k")
    try:
        with pytest.raises(RuntimeError, match="lost"), small_files(spark):
            assert spark.conf.get(name) == "1k"
            assert int(spark.conf.get(
                "spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 256
            raise RuntimeError("lost")
        assert spark.conf.get(name) == "1k"
    finally:
        spark.conf.unset(name)


def test_every_document_is_landed_in_a_file_of_its_own(spark, tmp_path):
    from workload import inputs

    given = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "ü")],
                                  "channel_id long, value string")
    for folder in (f"{tmp_path}/plain 1", f"file://{tmp_path}/with%20scheme"):
        for _ in range(2):
            inputs.land(given.coalesce(1).sortWithinPartitions("channel_id"), folder)
        held = spark.read.option("basePath", folder).option("wholetext", "true").text(folder)
        assert rows(held.groupBy("channel_id").agg(F.count("*"), F.sort_array(
            F.collect_set("value"))).na.fill(-1)) == [
            (-1, 2, ["ü"]), (1, 4, ["a", "b"]), (2, 2, ["c"])]
        assert held.select("_metadata.file_path").distinct().count() == 8
