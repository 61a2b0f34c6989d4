"""The corpus pipeline: toxic rows go, one row of each group of near-duplicates stays, contaminated rows go, personal data is masked, and the rest is packed.

All stages but the last return the columns of their input, extra ones of any name included; packing returns a row per piece. Null and
empty texts are no stage's reason to fail: they are not toxic or contaminated unless the fitted intercepts say so, they are copies of each
other, nothing in them is masked, and they are packed as their end token. Of repeated rows (equal doc_id and text) one stays; rows without
a doc_id are treated like others. Empty tables of documents give empty tables; without labels nothing is toxic, without a benchmark nothing
is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkmill.llm import decontaminate, packing, pii, simhash, toxicity
from talkmill.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train_chain(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers have held other stages' states before, so this one's cache of words is kept small.
    return packing.pack_documents(docs, tokenizer=lambda: packing.WordTokenizer(cache_words=40_000))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: Classifiers, fingerprints, alignments and packing have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes Parquet that the next reads."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
