"""Index text and postings: texts are cut into terms, Han runs along a dictionary by their likeliest path, and terms become an inverted index.

Terms are runs of letters and digits; other characters part them. A run of Han characters is cut where the product of its words' shares is
greatest (a lattice over the dictionary's words, best path by Viterbi); characters that no word covers stand alone. For search, longer words
also give the words of two and three characters inside them, before themselves. A null text has no terms.

Postings are a row for each record and term. A term that many records hold is dealt over salts of its own, so that no task has to hold its
list, and a search reads only the buckets of its terms.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged
from .ordered import narrow

_HAN = "㐀-䶿一-鿿豈-﫿"
_RUN = re.compile(f"([{_HAN}]+)|([^\\W_{_HAN}]+)")
_ANY_HAN, _PLAIN = re.compile(f"[{_HAN}]"), re.compile("[^\\W_]+")
#: Records of a term that one salt holds.
SALT_RECORDS = 1_000_000
#: Buckets of an index, by the term's hash.
BUCKETS = 64


class Segmenter:
    """``words``: a dictionary with counts, small enough to be sent to every worker."""

    def __init__(self, words: dict[str, int]):
        self.words = {w: n for w, n in words.items() if w and n > 0}
        self.longest = max(map(len, self.words), default=1)
        whole = math.log(sum(self.words.values()) or 1)
        self.weight = {w: math.log(n) - whole for w, n in self.words.items()}
        self.alone = -whole - math.log(2)  # a character that is no word

    def path(self, run: str) -> list[str]:
        """The words of the likeliest path through a run; of equal paths the one whose first word is longest."""
        best: list[tuple[float, int]] = [(0.0, 0)] * (len(run) + 1)
        for a in range(len(run) - 1, -1, -1):
            steps = [(self.alone + best[a + 1][0], 1)]
            for n in range(1, min(self.longest, len(run) - a) + 1):
                if (w := self.weight.get(run[a : a + n])) is not None:
                    steps.append((w + best[a + n][0], n))
            best[a] = max(steps)
        out, a = [], 0
        while a < len(run):
            out.append(run[a : a + best[a][1]])
            a += best[a][1]
        return out

    def terms(self, text: str | None, search: bool = True) -> list[str]:
        if not text or not _ANY_HAN.search(text):  # without Han runs, letters and digits are all there is
            return _PLAIN.findall(text or "")
        out = []
        for m in _RUN.finditer(text):
            if m[2]:
                out.append(m[2])
                continue
            for word in self.path(m[1]):
                if search:
                    out += [p for n in (2, 3) if len(word) > n for a in range(len(word) - n + 1) if (p := word[a : a + n]) in self.words]
                out.append(word)
        return out


_kept: list = ["", None]


def _segmenter(name: str, sent) -> Segmenter:
    """The worker's segmenter of a broadcast dictionary."""
    if _kept[0] != name:
        _kept[:] = [name, Segmenter(sent.value)]
    return _kept[1]


def index_text(spark: SparkSession, words: dict[str, int]):
    """A Column function for ``capture.numbered_plan``: a text's terms for search, joined by spaces."""
    sent, name = spark.sparkContext.broadcast(words), uuid.uuid4().hex

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array) -> pa.Array:
        segmenter = _segmenter(name, sent)
        return pa.array([None if t is None else " ".join(segmenter.terms(t)) for t in texts.to_pylist()], pa.string())

    return lambda text: cut(text)


def postings(rows: DataFrame, words: dict[str, int], key: str = "record_id", text: str = "content", search: bool = True) -> DataFrame:
    """(key, term, n): how often each term stands in each record. A map; nothing is shuffled."""
    sent, name = rows.sparkSession.sparkContext.broadcast(words), uuid.uuid4().hex
    given = rows.select(key, F.col(text).cast("string").alias("_text"))
    schema = T.StructType([given.schema[key], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        segmenter = _segmenter(name, sent)
        for batch in batches:
            texts, row, terms, counts = batch.column(1), [], [], []

            def given_out():
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(terms, pa.string()), pa.array(counts, pa.int64())], names=schema.names)

            for i in range(batch.num_rows):
                found = Counter(segmenter.terms(texts[i].as_py(), search))
                row += [i] * len(found)
                terms += found
                counts += found.values()
                if len(row) > 50_000:
                    yield given_out()
                    row, terms, counts = [], [], []
            if row:
                yield given_out()

    return given.mapInArrow(run, schema)


def term_counts(found: DataFrame) -> DataFrame:
    """(term, records, occurrences) over postings."""
    return found.groupBy("term").agg(F.count("*").alias("records"), F.sum("n").alias("occurrences"))


def salted(found: DataFrame, key: str = "record_id", most: int = SALT_RECORDS) -> DataFrame:
    """Postings with ``bucket`` and ``salt``: terms of over ``most`` records, at most one for each so many postings, get a salt for each ``most``."""
    large = narrow(staged(term_counts(found).where(F.col("records") > most).select("term", F.ceil(F.col("records") / most).cast("int").alias("_salts")), "large-terms"))
    salt = F.pmod(F.xxhash64(key), F.coalesce("_salts", F.lit(1))).cast("int")
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")
    return found.join(large, "term", "left").withColumn("bucket", bucket).withColumn("salt", salt).drop("_salts")


def write_index(found: DataFrame, path: str, key: str = "record_id", most: int = SALT_RECORDS) -> None:
    """An inverted index as Parquet: a folder for each bucket, rows in order of term, large terms in many files. Tasks take ranges of buckets, so there is a file for each bucket and one more for each task at most."""
    dealt = salted(staged(found, "postings"), key, most).repartitionByRange("bucket", "salt", "term", key).sortWithinPartitions("bucket", "term", key)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def search(spark: SparkSession, path: str, terms: Iterable[str], key: str = "record_id") -> DataFrame:
    """(key, terms, n) for the records that hold all of ``terms``: how many these are, and their occurrences. Reads the terms' buckets alone."""
    asked = sorted({*terms})
    if not asked:
        raise ValueError("no terms to look for")
    index = spark.read.parquet(path)
    buckets = [r.b for r in spark.createDataFrame([(t,) for t in asked], "term string").select(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("b")).collect()]
    near = index.where(F.col("bucket").isin(buckets) & F.col("term").isin(asked))
    return near.groupBy(key).agg(F.count("*").alias("terms"), F.sum("n").alias("n")).where(F.col("terms") == len(asked))
