"""The versioned store and imports that are broken off: readers see whole versions, and an import ends the same wherever it was interrupted."""

import pytest
from pyspark.sql import functions as F

from talkmill.operators import capture, state
from talkmill.sources import sinks, versions
from talkmill.streaming import importer


class Lost(Exception):
    """The driver was lost."""


@pytest.fixture(scope="module")
def planned(spark):
    said = [("agent:a:1", "1", "user" if n % 2 == 0 else "assistant", 1_704_067_200_000 + 1000 * n, f"text number {n}") for n in range(12)]
    rows = spark.createDataFrame(said, "session_key string, session_id string, role string, ts_ms long, content string")
    return capture.planned_rows(capture.expected_capture(rows)).persist()


def content(store):
    rows = sorted(r.message_text for r in store.read("rows").collect())
    assert rows == sorted(r.message_text for r in store.read("index").collect())
    return rows


def test_readers_see_whole_versions(spark, tmp_path):
    store = versions.Store(spark, f"file://{tmp_path}/store", {"rows": "n long", "index": "n long, word string"})
    assert store.read("rows").count() == 0 and store.current().number == 0
    folders = {}
    for table, columns in (("rows", ["id AS n"]), ("index", ["id AS n", "'w' AS word"])):
        folders[table] = store.stage(table, spark.range(3).selectExpr(*columns), "b1")
        assert store.read("rows").count() == store.read("index").count() == 0  # staged, not published
    first = store.publish(store.current(), "b1", folders, 3)
    assert store.read("rows").count() == store.read("index").count() == 3
    later = {"rows": store.stage("rows", spark.range(5).selectExpr("id AS n"), "b2"), "index": store.stage("index", spark.range(5).selectExpr("id AS n", "'w' AS word"), "b2")}
    with pytest.raises(versions.Conflict):
        store.publish(versions.Version(), "b2", later, 5)  # begun before b1 was published
    second = store.publish(first, "b2", later, 5)
    assert (second.number, second.accepted_total) == (2, 8)
    assert store.read("rows", first).count() == 3 and store.read("rows").count() == store.read("index").count() == 8
    assert not [n for n in store._files.names("") if n.startswith("_part")]


@pytest.mark.parametrize("phase", ["planned", "rows-committed", "lines-appended", "verified-ok"])
@pytest.mark.parametrize("before", [True, False])
def test_imports_go_on_after_each_phase(spark, tmp_path, planned, phase, before, monkeypatch):
    """The driver is lost just before a phase is noted (its work done), or just after it; the import then ends as if nothing had been."""
    root = f"file://{tmp_path}/store"
    store = importer.open_store(spark, root)
    note = versions.Store.note

    def lose(self, batch, now, facts):
        if now == phase and before:
            raise Lost
        note(self, batch, now, facts)
        if now == phase:
            raise Lost

    monkeypatch.setattr(versions.Store, "note", lose)
    with pytest.raises(Lost):
        importer.import_batch(store, planned, "2024-01", "batch-001")
    if phase != "verified-ok":
        assert content(store) == []  # nothing is published half-way
    monkeypatch.setattr(versions.Store, "note", note)
    for _ in range(2):
        assert importer.import_batch(store, planned, "2024-01", "batch-001") == "verified-ok"
    assert content(store) == sorted(r.captured for r in planned.collect())
    assert store.current().accepted_total == 12 and store.current().number == 1
    assert spark.read.json(f"{root}/lines").count() == 12
    assert [e["phase"] for e in store.journal("2024-01-batch-001")] == ["planned", "rows-committed", "lines-appended", "verified-ok"]


def test_imports_that_may_not_be_are_stopped(spark, tmp_path, planned):
    store = importer.open_store(spark, f"file://{tmp_path}/store")
    half = planned.where("ts_ms < 1704067206000")
    assert importer.import_batch(store, half, "2024-01", "batch-001") == "verified-ok"
    assert importer.import_batch(store, planned, "2024-01", "batch-002") == "stop"  # holds rows that are there
    assert importer.import_batch(store, planned.where("false"), "2024-01", "batch-002") == "stop"  # has ended
    rest = planned.join(half, "record_id", "left_anti").select(*planned.columns)
    assert importer.import_batch(store, rest, "2024-01", "batch-002-retry-1") == "verified-ok"
    assert importer.import_batch(store, planned.where("false"), "2024-01", "batch-003") == "stop"  # empty
    assert store.current().accepted_total == 12
    phases = state.latest_phase(store.journals(), ["batch"]).select("batch", "phase").collect()
    assert {r.batch: r.phase for r in phases} == {"2024-01-batch-001": "verified-ok", "2024-01-batch-002": "stop", "2024-01-batch-002-retry-1": "verified-ok", "2024-01-batch-003": "stop"}
    with pytest.raises(ValueError):
        importer.import_batch(store, planned, "2024-02", "batch-001", allowed=state.executable_batches())
    with pytest.raises(ValueError):
        importer.import_batch(store, planned, "2024-01", "batch-1")


def test_a_stream_of_imports_is_lost_and_begun_again(spark, tmp_path, planned, monkeypatch):
    for k in range(3):
        planned.where(F.pmod(F.xxhash64("record_id"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    root, note = f"file://{tmp_path}/store", versions.Store.note
    lost = []

    def lose(self, batch, now, facts):
        note(self, batch, now, facts)
        if now == "rows-committed" and batch.endswith("002") and not lost:
            lost.append(batch)
            raise Lost

    def run():
        stream = spark.readStream.schema(planned.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        importer.import_stream(stream, root, "2024-01", str(tmp_path / "state")).awaitTermination(120)

    monkeypatch.setattr(versions.Store, "note", lose)
    with pytest.raises(Exception):
        run()
    assert lost and importer.open_store(spark, root).current().number == 1
    run()
    store = importer.open_store(spark, root)
    assert content(store) == sorted(r.captured for r in planned.collect()) and store.current().number == 3


def test_output_folders_are_not_used_twice(spark, tmp_path):
    """Leftovers of a run without output are put away; output, or anything unknown, is left as it is and refused."""
    out, archive = tmp_path / "out", tmp_path / "away"
    claim = lambda: sinks.claim_folder(spark, f"file://{out}", f"file://{archive}")
    assert claim() == []
    out.mkdir()
    (out / "run.log").write_text("failed")
    (out / "live-before.json").write_text("{}")
    assert claim() == ["live-before.json", "run.log"] and not list(out.iterdir())
    (attempt,) = archive.iterdir()
    assert (attempt / "run.log").read_text() == "failed"
    for name in ("records", "notes.txt"):
        (out / name).mkdir()
        (out / "run.log").write_text("kept")
        with pytest.raises(ValueError, match=name):
            claim()
        (out / name).rmdir()
    assert (out / "run.log").read_text() == "kept"


def test_keys_of_a_month_are_one_pruned_scan(spark, tmp_path):
    rows = [("agent:a:1:seed:2024-01", "user", 5, "Some text", "x"), ("agent:a:1:seed:2024-02", "user", 5, "Some text", "y"), ("agent:a:1", "user", 5, "Some text", "z")]
    spark.createDataFrame(rows, "session_key string, role string, ts_ms long, message_text string, session_id string").write.parquet(str(tmp_path / "rows"))
    found = capture.live_keys(spark.read.parquet(str(tmp_path / "rows")), "2024-01")
    said = capture.expected_capture(spark.createDataFrame([("agent:a:1:seed:2024-01", "user", 5, "Some text")], "session_key string, role string, ts_ms long, content string"))
    assert [r.compare_key for r in found.collect()] == [r.compare_key for r in said.collect()]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "session_id" not in plan and "Exchange" not in plan and "PushedFilters: [IsNotNull(session_key)" in plan


def test_dated_lines_of_many_dates(spark, tmp_path):
    """A file for each date and at most one more for each task, whatever tasks the rows came from; a batch again replaces all of its lines, with dates that it no longer has."""
    path = f"file://{tmp_path}/lines"
    rows = spark.range(6000).selectExpr("IF(id = 5, NULL, 1704067200000 + (id % 300) * 86400000 + id) AS ts_ms", "concat('text ', id) AS message_text", "IF(id % 2 = 0, NULL, id) AS n").repartition(16)
    sinks.write_dated_lines(rows, path, batch_id="batch-001")
    sinks.write_dated_lines(rows.where("ts_ms < 1704067200000 + 86400000"), path, batch_id="batch-002")
    files = [f for f in (tmp_path / "lines").rglob("*") if f.is_file()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= 301 + tasks + 1 + tasks and not [f for f in files if not f.name.endswith(".json")]
    read = spark.read.schema("ts_ms long, message_text string, n long, rec_date string, batch_id string").json(path)
    got = read.where("batch_id = 'batch-001'")
    assert sorted(map(str, got.select("ts_ms", "message_text", "n").collect())) == sorted(map(str, rows.collect()))
    assert got.where("rec_date <> date_format(timestamp_millis(ts_ms), 'yyyy-MM-dd')").isEmpty()
    sinks.write_dated_lines(rows.where("ts_ms >= 1704067200000 + 86400000"), path, batch_id="batch-001")
    read = spark.read.schema("ts_ms long, rec_date string, batch_id string").json(path)
    assert {r.batch_id: r.n for r in read.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {"batch-001": 5979, "batch-002": 20}
