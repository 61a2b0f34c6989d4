"""Terms against all cuts of short runs, and an index in which large terms are dealt over salts."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talkmill.operators import capture, fulltext

WORDS = {"收到": 50, "我": 90, "先看": 30, "看": 60, "一下": 40, "看一下": 20, "我看": 5, "一": 9, "磨坊主人": 4, "磨坊": 12, "主人": 8, "坊主": 3, "磨坊主": 2}


def best_cuts(run):
    """The greatest product of shares over all cuts."""
    total = sum(WORDS.values())
    share = lambda w: WORDS[w] / total if w in WORDS else (1 / total / 2 if len(w) == 1 else 0)
    best, found = 0, []
    for mask in range(1 << (len(run) - 1)):
        cut, a = [], 0
        for b in range(1, len(run) + 1):
            if b == len(run) or mask >> (b - 1) & 1:
                cut.append(run[a:b])
                a = b
        p = math.prod(map(share, cut))
        if p > best * (1 + 1e-9):
            best, found = p, [cut]
        elif p and p > best * (1 - 1e-9):
            found.append(cut)
    return found


def test_the_likeliest_path():
    draw, segmenter = random.Random(1), fulltext.Segmenter(WORDS)
    for _ in range(300):
        run = "".join(draw.choices("收到我先看一下磨坊主人龘", k=draw.randrange(1, 9)))
        assert segmenter.path(run) in best_cuts(run)
    assert segmenter.terms("磨坊主人, OK看一下v2_x été") == ["磨坊", "坊主", "主人", "磨坊主", "磨坊主人", "OK", "一下", "看一下", "v2", "x", "été"]
    assert segmenter.terms("磨坊主人", search=False) == ["磨坊主人"] and segmenter.terms(None) == segmenter.terms(" ,。") == []
    assert fulltext.Segmenter({}).terms("磨坊 a") == ["磨", "坊", "a"]
    assert len(segmenter.terms("看一下" * 50_000)) == 100_000


def test_postings_and_search(spark, tmp_path):
    """A term that every record holds is in many files; a search reads the buckets of its terms alone."""
    draw = random.Random(2)
    texts = [" ".join(["every", *draw.choices(["mill", "wheel", "磨坊主人", "stone", "water"], k=draw.randrange(0, 6))]) for _ in range(500)] + [None, "", "…"]
    rows = spark.createDataFrame(list(enumerate(texts)), "record_id long, content string").repartition(4)
    found = fulltext.postings(rows, WORDS)
    cut = fulltext.Segmenter(WORDS).terms
    assert sorted(map(tuple, found.collect())) == sorted((i, t, n) for i, text in enumerate(texts) for t, n in Counter(cut(text)).items())
    salts = {r.term: r.salts for r in fulltext.salted(found, most=50).groupBy("term").agg(F.count_distinct("salt").alias("salts")).collect()}
    assert salts["every"] == 10 and salts["磨坊"] <= 10
    path = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fulltext.write_index(found, path, most=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = spark.read.parquet(path)
    assert index.count() == found.count()
    assert index.where("term = 'every'").select(F.input_file_name()).distinct().count() > 1
    for terms in (["every", "mill"], ["磨坊", "water", "water"], ["stone"], ["none"]):
        hits = fulltext.search(spark, path, terms)
        want = {i: sum(Counter(cut(t))[x] for x in {*terms}) for i, t in enumerate(texts) if {*terms} <= {*cut(t)}}
        assert {r.record_id: r.n for r in hits.collect()} == want
        assert "PartitionFilters: [isnotnull(bucket" in str(hits._jdf.queryExecution().executedPlan()) or "bucket#" in re.search(r"PartitionFilters: \[[^\]]*", hits._jdf.queryExecution().executedPlan().toString())[0]
    with pytest.raises(ValueError):
        fulltext.search(spark, path, [])


def test_index_text_of_a_plan(spark):
    said = spark.createDataFrame([("s", "1", "user", 1000 * n, t, "", n) for n, t in enumerate(["我看一下 the mill", "收到"])], "session_key string, session_id string, role string, ts_ms long, content string, source_key string, seq long")
    plan = capture.numbered_plan(capture.planned_rows(capture.expected_capture(said)), "seq", fulltext.index_text(spark, WORDS))
    assert [r.fts_text for r in plan.orderBy("seq").collect()][:1] == ["我 一下 看一下 the mill"]


def test_an_index_has_few_files(spark, tmp_path):
    """A file for each bucket and one more for each task at most, where tasks are not put together; texts with and without Han runs are cut alike."""
    rows = spark.range(2000).selectExpr("id AS record_id", "concat('every w', id % 700, ' v', id, IF(id % 2 = 0, ' 磨坊', '')) AS content").repartition(8)
    found = fulltext.postings(rows, WORDS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fulltext.write_index(found, str(tmp_path / "index"), most=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = spark.read.parquet(str(tmp_path / "index"))
    assert len(index.inputFiles()) <= fulltext.BUCKETS + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, index.select("record_id", "term", "n").collect())) == sorted(map(tuple, found.collect()))
    cut = fulltext.Segmenter(WORDS).terms
    assert cut("v2_x été, OK") == cut("v2_x été, OK 磨坊")[:-1]
