"""The seed document of a page, read again; ages, active months and reports."""

import json
import os
import stat

import pytest
from pyspark.sql import functions as F

from talkmill.operators import audit, capture
from talkmill.plans import seeds
from talkmill.sources import transcripts


@pytest.fixture(scope="module")
def lines(spark):
    """Two agents' files and a channel's; the channel's comes first, then the larger file. One message belongs to another month."""
    rows = []
    for file, source, session, n in (("f1", "agent:a", "s1", 3), ("f2", "agent:a", "s2", 5), ("f3", "discord", "s3", 2)):
        for k in range(2 * n):
            ts = 1_704_067_200_000 + 60_000 * k
            line = {"message": {"role": "user" if k % 2 == 0 else "assistant", "content": f"{file} text number {k}"}, "timestamp": ts}
            if source == "discord":
                line = {"role": line["message"]["role"], "content": line["message"]["content"], "ts": ts}
            rows.append((file, k + 1, source, session, f"{source}:{session}", json.dumps(line)))
    rows.append(("f1", 99, "agent:a", "s1", "agent:a:s1", json.dumps({"message": {"role": "user", "content": "a month later"}, "timestamp": 1_706_800_000_000})))
    return spark.createDataFrame(rows, "file string, line_no long, source_type string, session_id string, session_key string, line string")


def test_a_page_is_written_and_read_again(spark, lines, tmp_path):
    page = seeds.seed_page(lines, "2024-01", 4, 2)
    path = str(tmp_path / "out" / "seed.json")
    seeds.write_seed(page, path, [str(tmp_path)])
    assert stat.S_IMODE(os.stat(path).st_mode) == 0o600
    document = json.load(open(path, encoding="utf-8"))
    assert document["metadata"] == {"month": "2024-01", "sourceType": None, "batchId": "batch-002", "offsetRounds": 4, "limitRounds": 4, "rangeStartRound": 5, "rangeEndRound": 8, "totalAvailableRounds": 10, "filters": {"file": None, "sessionId": None, "sessionKey": None, "batchSize": 4, "batchIndex": 2, "rejectBatchDuplicates": False}}
    got = [(s["sessionKey"], s["sourceFile"], [[m["content"] for m in r] for r in s["conversations"]]) for s in document["sessions"]]
    two = lambda f, k: [f"{f} text number {2 * k}", f"{f} text number {2 * k + 1}"]
    assert got == [("agent:a:s2:seed:2024-01", "f2", [two("f2", 2), two("f2", 3), two("f2", 4)]), ("agent:a:s1:seed:2024-01", "f1", [two("f1", 0)])]
    flat = transcripts.flatten_seed(transcripts.read_seed_input(spark, path))
    assert [r.content for r in flat.orderBy("session_no", "round_no", "message_no").collect()] == [t for _, _, rounds in got for r in rounds for t in r]
    assert page.beyond.count() == 0
    with pytest.raises(ValueError):
        seeds.write_seed(page, "/elsewhere/seed.json", [str(tmp_path)])


def test_pages_are_all_rounds_and_none_twice(lines):
    places = [r.place for k in (1, 2) for r in seeds.seed_page(lines, "2024-01", 5, k).rounds.collect()]
    assert sorted(places) == list(range(10))


def test_filters_and_pages_beyond(lines, tmp_path):
    page = seeds.seed_page(lines, "2024-01", 10, sessionId="s1", sourceType="agent:a")
    assert {r.sourceFile for r in page.rounds.collect()} == {"f1"} and page.metadata["totalAvailableRounds"] == 3 and page.metadata["rangeEndRound"] == 3
    beyond = seeds.seed_page(lines, "2024-01", 10, 2, sessionId="s1")
    assert [r.reason for r in beyond.beyond.collect()] == ["offset_beyond_available_rounds"] and beyond.metadata["rangeStartRound"] is None
    with pytest.raises(ValueError):
        seeds.write_seed(beyond, str(tmp_path / "x.json"), [str(tmp_path)])
    for wrong in ({"month": "2024-1"}, {"batch_size": 0}, {"batch_id": "b"}):
        with pytest.raises(ValueError):
            seeds.seed_page(lines, **({"month": "2024-01", "batch_size": 5} | wrong))


def test_ages_and_active_months(spark):
    ages = spark.createDataFrame([(None,), (-5.0,), (59.9,), (307.0,), (7500.0,)], "s double").select(audit.age_words(F.col("s")).alias("a"))
    assert [r.a for r in ages.collect()] == ["-", "0s ago", "59s ago", "5m 7s ago", "2h 5m ago"]
    commands = spark.createDataFrame([("node catchup.mjs --month 2024-01 --x",), ("node catchup.mjs",), ("node catchup.mjs --month 2024-01",)], "command string")
    months = audit.active_months(commands)
    assert [r.month for r in months.collect()] == ["2024-01"]
    files = spark.createDataFrame([("2024-01-progress.json", 1_000), ("2024-02-progress.json", 90_000)], "name string, modified_ms long")
    assert audit.latest_progress(files, 61_000, months).first().age == "1m 0s ago"
    assert audit.latest_progress(files, 61_000, months.limit(0)).first().age == audit.latest_progress(files, 61_000).first().age == "0s ago"
    assert audit.latest_progress(files.limit(0), 61_000).first().age == "-"


def test_reports_are_in_order(spark):
    records = spark.createDataFrame([("b",), ("b",), ("a",), ("",), (None,), ("c",), ("c",)], "type string")
    assert [tuple(r) for r in audit.ordered_types(records).collect()] == [("b", 2), ("c", 2), ("unknown", 2), ("a", 1)]
    rows = spark.createDataFrame([("s:b",), ("s:A",), ("s:a",), ("s:B",)], "session_key string")
    assert [r.session_key for r in audit.session_report(rows).collect()] == ["s:a", "s:A", "s:b", "s:B"]
    plan = spark.createDataFrame([("r", "k", "user", 5, "h", "", 3, "", "/f", 0)], "record_id string, session_key string, role string, ts_ms long, fingerprint string, session_id string, chars int, source_key string, source_file string, source_line long")
    row = capture.import_summary(plan, "batch-001").first()
    assert (row.sourceFile, row.sourceLine, row.sourceKey) == ("/f", None, None) and capture.import_summary(plan.drop("source_file", "source_line"), "b").first().sourceFile is None
