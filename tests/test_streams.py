"""Streams against what a batch job gives, also when they are stopped in between."""

import random

import pytest
from pyspark.sql import functions as F

from talkmill.operators import audit
from talkmill.sources import transcripts
from talkmill.streaming import growing, progress


def test_cursors_give_what_a_batch_gives(spark, tmp_path):
    """Rows and statements in files that come one after the other; the stream is started anew for each, and once with nothing new."""
    draw = random.Random(4)
    rows, statements = [], []
    for n in range(3):
        events = [(f"s{draw.randrange(6)}", draw.randrange(1, 4), None, None, None, None) for _ in range(40)] + [("hot", 1, None, None, None, None)] * 50
        events += [(f"s{draw.randrange(9)}", None, 100 * draw.randrange(50) + n, draw.choice([None, 0, 5, 60]), draw.randrange(80), draw.random() < 0.5) for _ in range(8)]
        draw.shuffle(events)
        spark.createDataFrame(events, progress.EVENTS).repartition(2).write.mode("append").json(str(tmp_path / "in"))
        rows += [e for e in events if e[1]]
        statements += [e for e in events if e[2] is not None]
        for _ in range(2):
            source = spark.readStream.schema(progress.EVENTS).json(str(tmp_path / "in"))
            progress.keep_states(source, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
        stored = spark.createDataFrame(rows, progress.EVENTS).groupBy("session_key").agg(F.sum("n").alias("l0"))
        last = {}
        for e in statements:
            last[e[0]] = max(last.get(e[0], e), e, key=lambda x: x[2])
        stated = spark.createDataFrame([(e[0], *e[3:]) for e in last.values()], "session_key string, total_l0 long, next_offset long, completed boolean")
        assert sorted(map(tuple, progress.latest_progress(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, audit.session_progress(stored, stated).collect()))


def test_growing_files_give_each_line_once(spark, tmp_path):
    """Lines are appended, one of them in two parts; a file is added, one is blank at first; numbers are those of a batch read."""
    sessions = tmp_path / "state" / "agents" / "mill" / "sessions"
    sessions.mkdir(parents=True)
    other = sessions / "b.trajectory.jsonl"
    other.write_text('{"no":1}\n')
    draw = random.Random(6)
    steps = [
        {"a": '{"n":1}\n\n  {"n":2} \r\n{"n":', "b": "\n\n"},
        {"a": '3}\n{"n":4}\n', "c": "".join(f'{{"n":{k},"t":"{"é" * draw.randrange(90)}"}}\n' for k in range(400))},
        {},
        {"a": '{"n":5}', "b": '{"n":6}\n', "c": '{"n":7}\n'},
        {"a": "\n"},
    ]
    for step in steps:
        for name, text in step.items():
            with open(sessions / f"{name}.jsonl", "ab") as f:
                f.write(text.encode())
        stream = growing.growing_transcripts(spark, f"file://{tmp_path}/state", splitBytes=1000)
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = transcripts.read_transcripts(spark, str(tmp_path / "state"))
    columns = ["line_no", "line", "source_type", "session_id", "session_key"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert got.count() == 6 + 401 and {r.session_id for r in got.select("session_id").distinct().collect()} == {"a", "b", "c"}


def test_lines_of_splits(tmp_path):
    """Whatever the splits, each line belongs to one of them; a line may be longer than many."""
    draw = random.Random(7)
    lines = [b"x" * draw.choice([0, 1, 5, 300]) for _ in range(80)]
    path = tmp_path / "f"
    path.write_bytes(b"".join(x + b"\n" for x in lines) + b"unfinished")
    size = path.stat().st_size
    with open(path, "rb") as f:
        end = growing.end_of_lines(f, size)
        assert end == size - len(b"unfinished") and growing.end_of_lines(f, 0) == 0
        first = sum(len(x) + 1 for x in lines[:7])
        for split in (1, 2, 7, 64, 1000, 10**6):
            got = [x for a in range(first, end, split) for x in growing.split_lines(f, a, min(a + split, end), first)]
            assert got == list(enumerate(lines, 1))[7:]


def test_replaced_files_are_read_again(tmp_path):
    reader = growing.GrowingLinesReader(f"file://{tmp_path}", ".jsonl", 100)
    (tmp_path / "a.jsonl").write_bytes(b"one\ntwo\n")
    first = reader.latestOffset()
    (tmp_path / "a.jsonl").write_bytes(b"new\n")
    second = reader.latestOffset()
    assert [list(reader.read(p))[0][1:] for p in reader.partitions(first, second)] == [(1, "new")]
    assert reader.partitions(second, second) == [] and len(reader.partitions(reader.initialOffset(), second)) == 1


def test_cursors_are_moved_without_python(spark, tmp_path):
    """Sessions by the thousand cost no call of Python each; the columns of a session's last statement are those of one statement."""
    said = spark.range(20_000).selectExpr("concat('s', id % 5000) AS session_key", "CAST(NULL AS LONG) AS n", "id DIV 5000 AS seq", "IF(id % 3 = 0, NULL, id) AS total_l0", "id + 1 AS next_offset", "id % 2 = 0 AS completed")
    said.unionByName(said.selectExpr("session_key", "2L AS n", *(f"CAST(NULL AS {t}) AS {c}" for c, t in (("seq", "LONG"), ("total_l0", "LONG"), ("next_offset", "LONG"), ("completed", "BOOLEAN"))))).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(progress.EVENTS).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    plan = progress.session_states(source)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    progress.keep_states(source, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    states = spark.read.parquet(str(tmp_path / "out"))
    last = {r.session_key: r for r in states.orderBy("batch").collect()}
    assert states.select("batch").distinct().count() > 1 and len(last) == 5000
    for k in range(5000):
        n, r = 15_000 + k, last[f"s{k}"]
        assert (r.stored, r.seq, r.total_l0, r.next_offset, r.completed) == (8, 3, None if n % 3 == 0 else n, n + 1, n % 2 == 0)


def test_small_files_share_tasks(tmp_path):
    """A thousand files of a line are a handful of tasks, and a large file among them still is cut; each line is read once."""
    want = {}
    for k in range(1000):
        (tmp_path / f"{k}.jsonl").write_bytes(b"%d\nrest" % k)
        want[f"{tmp_path}/{k}.jsonl"] = [(1, str(k))]
    (tmp_path / "large.jsonl").write_bytes(b"".join(b"%05d\n" % n for n in range(20_000)))
    want[f"{tmp_path}/large.jsonl"] = [(n + 1, f"{n:05d}") for n in range(20_000)]
    reader = growing.GrowingLinesReader(f"file://{tmp_path}", ".jsonl", 50_000)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert 4 <= len(parts) <= 10
    got = {}
    for p in parts:
        for file, number, line in reader.read(p):
            got.setdefault(file, []).append((number, line))
    assert {f: sorted(rows) for f, rows in got.items()} == want
