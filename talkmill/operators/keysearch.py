"""Keys that stand in lines as substrings, in time linear in the lines: an automaton over a block of keys reads each line once.

The different keys come in blocks of bounded size, each sent to the tasks once; a block costs one pass over the lines, whatever the lines'
lengths. Empty and null keys are not looked for, null lines hold none, and a line holds a key once, however often it repeats it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a block of keys: an automaton takes about a hundred bytes for each.
BLOCK_CHARS = 2_000_000
#: Rows that are found go on in batches of this many.
FOUND_ROWS = 20_000

_automaton: list = ["", None]


def _automaton_of(name: str, keys: list[str]):
    """The worker's automaton of a block, kept for its next task."""
    if _automaton[0] != name:
        made = ahocorasick.Automaton()
        for n, key in enumerate(keys):
            made.add_word(key, n)
        made.make_automaton()
        _automaton[:] = [name, made]
    return _automaton[1]


def key_blocks(keys: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The different non-empty values of ``key``, in blocks of about ``chars`` characters; the driver holds a block and a partition of keys at a time."""
    block, size = [], 0
    for r in keys.select("key").where(F.coalesce("key", F.lit("")) != "").distinct().toLocalIterator():
        if block and size + len(r.key) > chars:
            yield block
            block, size = [], 0
        block.append(r.key)
        size += len(r.key)
    if block:
        yield block


def lines_with_keys(lines: DataFrame, keys: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns of ``lines`` but its ``line``, with each ``key`` that stands in the line as a substring."""
    kept = [c for c in lines.columns if c != "line"]
    schema = T.StructType([*(lines.schema[c] for c in kept), T.StructField("key", T.StringType())])
    out = lines.sparkSession.createDataFrame([], schema)
    for block in key_blocks(keys, chars):
        out = out.unionByName(_search(lines.select(*kept, "line"), block, schema))
    return out


def _search(lines: DataFrame, block: list[str], schema: T.StructType) -> DataFrame:
    sent, name = lines.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches):
        keys = sent.value
        automaton = _automaton_of(name, keys)
        for batch in batches:
            texts, rows, found = batch.column(batch.num_columns - 1), [], []

            def given_out():
                part = batch.take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string())], names=schema.names)

            for i in range(batch.num_rows):
                hits = {n for _, n in automaton.iter(texts[i].as_py() or "")}
                rows += [i] * len(hits)
                found += [keys[n] for n in sorted(hits)]
                if len(rows) > FOUND_ROWS:
                    yield given_out()
                    rows, found = [], []
            if rows:
                yield given_out()

    return lines.mapInArrow(run, schema)
