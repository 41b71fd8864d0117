"""Snapshots of the lake: killed writes, versions, bases, vacuum, two writers."""
import json

import pytest
from helpers import SF
from pyspark.sql import functions as F

from checks import fixtures as fx
from rowlog.plans.convert import build_changes
from rowlog.session import scratch_path
from rowlog.sinks import manifest
from rowlog.sinks import parquet as sink
from rowlog.sinks.parquet import read_lake, write_by_table


@pytest.fixture(scope="module")
def changes(spark):
    return build_changes(fx.shop_log(spark, SF), fingerprints=False).cache()


def test_a_killed_rewrite_leaves_the_old_snapshot(spark, changes, monkeypatch):
    root = scratch_path(spark, "t-killed")
    write_by_table(changes, root, by_file=True)
    before = read_lake(spark, root, by_file=True)
    n = before.count()

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "_publish", killed)  # all files are there, the rename is not
    with pytest.raises(KeyboardInterrupt):
        write_by_table(changes.where("event = 'EXT_WRITE_ROWS'"), root, by_file=True)
    monkeypatch.undo()
    assert len([x for x in manifest.names(spark, root) if x.startswith("generation=")]) == 2
    assert read_lake(spark, root, by_file=True).count() == n == before.count() and manifest.versions(spark, root) == [1]
    write_by_table(changes.where("event = 'EXT_WRITE_ROWS'"), root, by_file=True)
    assert read_lake(spark, root, by_file=True).count() == changes.where("event = 'EXT_WRITE_ROWS'").count()
    gone = manifest.vacuum(spark, root)
    assert len(gone) == 2 and read_lake(spark, root, by_file=True).count() == changes.where("event = 'EXT_WRITE_ROWS'").count()


def test_a_job_that_fails_half_way_commits_nothing(spark, changes):
    root = scratch_path(spark, "t-half")
    write_by_table(changes, root, by_file=True)
    bad = changes.withColumn("data", F.when(F.col("position") % 7 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("data")))
    with pytest.raises(Exception, match="lost"):
        write_by_table(bad, root, by_file=True)
    assert manifest.versions(spark, root) == [1] and read_lake(spark, root, by_file=True).count() == changes.count()


def test_a_writer_lists_no_folder_of_the_lake(spark, changes, monkeypatch):
    """Only names in the manifest's own folder are listed, and only the new generation's files are read."""
    root = scratch_path(spark, "t-list")
    write_by_table(changes, root, by_file=True)
    listed, real = [], manifest.names
    monkeypatch.setattr(manifest, "names", lambda spark, path: listed.append(path) or real(spark, path))
    read, old = [], manifest.listed
    monkeypatch.setattr(manifest, "listed", lambda spark, root, g: read.append(old(spark, root, g)) or read[-1])
    write_by_table(changes.where("server_id = 4"), root, by_file=True)
    assert set(listed) == {f"{root}/_manifest"}
    files = read[0].inputFiles()
    assert files and len({f.split("generation=")[1][:24] for f in files}) == 1


def test_versions_bases_and_vacuum(spark, changes):
    root = scratch_path(spark, "t-versions")
    one = changes.where("server_id = 4").withColumn("table", F.lit("shop.né w"))
    for i in range(manifest.BASE_EVERY + 2):
        write_by_table(one.where(f"position div 600 % {i + 1} = 0"), root, by_file=True)
    write_by_table(changes.where("server_id = 1"), root, by_file=True)
    count = [one.where(f"position div 600 % {i + 1} = 0").count() for i in range(manifest.BASE_EVERY + 2)]
    for v in (1, 2, manifest.BASE_EVERY, manifest.BASE_EVERY + 1):
        assert read_lake(spark, root, by_file=True, version=v).count() == count[v - 1]
    total = count[-1] + changes.where("server_id = 1").count()
    assert read_lake(spark, root, by_file=True).count() == total
    assert len(manifest._lists(spark, root, None)) == 4  # the base and three lists
    assert read_lake(spark, root, by_file=True, tables=["shop.né w"]).count() == count[-1]
    manifest.vacuum(spark, root, keep=2)
    assert manifest.versions(spark, root)[0] == manifest.BASE_EVERY + 2
    assert read_lake(spark, root, by_file=True).count() == total
    assert read_lake(spark, root, by_file=True, version=manifest.BASE_EVERY + 2).count() == count[-1]
    with pytest.raises(ValueError, match="no version"):
        read_lake(spark, root, by_file=True, version=1)
    write_by_table(changes.where("server_id = 2"), root, by_file=True, replace="all")
    assert read_lake(spark, root, by_file=True).count() == changes.where("server_id = 2").count()


def test_two_writers_take_one_version_after_the_other(spark, changes, monkeypatch):
    root = scratch_path(spark, "t-two")
    write_by_table(changes.where("server_id = 1"), root, by_file=True)
    real, met = manifest._publish, []

    def publish(spark, path, text):
        if not met:  # another writer is quicker
            met.append(path)
            monkeypatch.setattr(manifest, "_publish", real)
            write_by_table(changes.where("server_id = 2"), root, by_file=True)
        return real(spark, path, text)

    monkeypatch.setattr(manifest, "_publish", publish)
    write_by_table(changes.where("server_id = 3"), root, by_file=True)
    assert manifest.versions(spark, root) == [1, 2, 3]
    assert read_lake(spark, root, by_file=True).count() == changes.where("server_id < 4").count()
    assert [json.loads(manifest._read_text(spark, f"{root}/_manifest/{v:012d}.json"))["kind"] for v in (1, 2, 3)] == ["touched"] * 3


def test_the_list_says_what_the_files_hold(spark, changes):
    root = scratch_path(spark, "t-listed")
    write_by_table(changes, root, by_file=True)
    files = manifest.live(spark, root)
    sums = files.agg(*(F.sum(c).alias(c) for c in ("rows", "writes", "updates", "deletes")), F.min("first_ms").alias("a"), F.max("last_ms").alias("b")).first()
    want = changes.agg(F.count("*").alias("n"), *(F.count_if(F.col("event") == e).alias(e) for e in ("EXT_WRITE_ROWS", "EXT_UPDATE_ROWS", "EXT_DELETE_ROWS")),
                       F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    assert tuple(sums) == tuple(want)
    one = files.orderBy("file").limit(1)
    row = one.first()
    back = sink.read_files(spark, root, one, whole_folders=False)
    assert (back.count(), *back.agg(F.min("position"), F.max("position")).first()) == (row["rows"], row["first_position"], row["last_position"])


def test_intermediates_of_a_run_can_be_dropped(spark):
    from rowlog.session import drop_scratch, run_folder, written

    assert written(spark.range(3), "kept").count() == 3
    other = spark.newSession()  # of the same application: the same folder
    assert run_folder(other) == run_folder(spark) and manifest.names(spark, run_folder(spark))
    import rowlog.session as session

    real = session.run_folder
    session.run_folder = lambda _: f"{real(spark)}/part"  # not those of the other tests
    try:
        one = written(spark.range(3), "gone")
        assert len(manifest.names(spark, session.run_folder(spark))) == 1 and one.count() == 3
        drop_scratch(spark)
        assert not manifest.exists(spark, session.run_folder(spark))
    finally:
        session.run_folder = real
