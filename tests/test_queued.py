"""Queued messages within queued messages against a plain loop."""

from pyspark.sql import functions as F

from talkmill.functions import extract
from talkmill.plans.queued import unnest_queued

HEADER = "[Queued messages while agent was busy]"
FENCE = 'Sender (untrusted metadata):\n```json\n{"name":"x"}\n```\n'


def queue(*parts):
    return "\n---\n".join([HEADER, *(f"Queued #{n + 1}\n{p}" for n, p in enumerate(parts))])


def plain(text):
    """The same for these texts: a sender's fence goes, then the header, then each part in turn."""
    text = text.strip()
    if text.startswith(FENCE.strip()):
        text = text[len(FENCE.strip()) :].strip()
    if not text.startswith(HEADER):
        return text
    out = []
    for part in text[len(HEADER) :].split("\n---\n"):
        part = part.strip()
        if part.startswith("Queued #"):
            part = part.split("\n", 1)[1].strip() if "\n" in part else ""
        if part and not part.startswith("stdout"):
            out.append(plain(part))
    return "\n\n".join(x for x in out if x).strip()


def test_three_levels(spark):
    texts = [
        "plain",
        queue("first", "stdout noise", "second"),
        queue(FENCE + "stripped part", "other"),
        queue(FENCE + HEADER + " " + "inner one", "after"),
        queue(FENCE + HEADER + FENCE + HEADER + "\n" + FENCE + HEADER + " third level", "x"),
        queue(HEADER, HEADER + HEADER + " deep", "stdout"),
        HEADER,
        "",
    ]
    rows = spark.createDataFrame([(n, r, t) for n, t in enumerate(texts) for r in ("user", "assistant")], "i int, role string, content string")
    stripped = extract.strip_envelopes(rows, queued_parts=True).select("i", "role", "content", "queued_parts")
    got = {(r.i, r.role): r.content for r in unnest_queued(stripped).collect()}
    for n, t in enumerate(texts):
        assert got[n, "user"] == plain(t), t
        assert HEADER not in got[n, "user"]
    assert got[1, "assistant"].startswith(HEADER)  # only users' messages are queued
    assert unnest_queued(stripped.where(F.col("i") == 0)).columns == ["i", "role", "content"]
