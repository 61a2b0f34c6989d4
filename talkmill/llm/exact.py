"""Exact duplicates by owners kept in Patricia tries: texts are equal if the same bytes are left once ASCII white space is deleted.

Equal texts of a slice of a task are put together first, so a text that many rows hold travels once a slice. What is left goes to partitions
by length and content hash, ordered by both, and each partition inserts the full byte strings (behind length and hash) into one compressed
radix trie, whose terminal nodes hold the owner: the row with the most code points, then the smallest doc_id. Bytes decide; the hash only
says where they meet. When a trie has grown over its bound, every subtree but that of the length and hash being read is finished, as rows
come in order: such subtrees are given out as result rows and cut off, and what waits to be read is in Spark's own sort, which spills.

Texts that hold over 1/500 of the rows are owned in two steps: first within a salt, then over the salts' owners.

A null text is empty, so it is a copy of '' and of white space alone. A null doc_id is greater than any other. Of repeated rows (equal doc_id
and text) exactly one is kept, and the others count in the group's size. An empty table gives no rows. Only doc_id and text are read, so
further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_KEYS, free_name, join_with_hot_keys, numbered_copies, slices, stored

#: Deleted before texts are compared.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: A trie of more bytes than this gives its finished subtrees away.
TRIE_BYTES = 64 << 20
#: What a node costs beside its label.
NODE_BYTES = 300
#: Texts of a task are put together in slices of about this many bytes.
COMBINE_BYTES = 16 << 20
#: Parts of a text that a large part of all rows holds.
SALTS = 64


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: tuple | None = None):
        self.label, self.children, self.owner = label, {}, owner


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """How many bytes ``a`` has in common with ``b`` from ``at`` on, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def better(a: tuple, b: tuple) -> tuple:
    """The owner of both: (rows, code points, doc_id). More code points, then the smaller doc_id; null is the greatest."""
    first = a if (-a[1], a[2] is None, a[2] or 0) <= (-b[1], b[2] is None, b[2] or 0) else b
    return (a[0] + b[0], first[1], first[2])


class OwnerTrie:
    """A Patricia trie: a node for each branch or terminal, with the bytes that lead to it as its label."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner: tuple) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], owner)
                self.size += len(key) - at + NODE_BYTES
                return
            if not key.startswith(child.label, at):
                n = common_prefix(child.label, key, at)
                branch = Node(child.label[:n])
                child.label = child.label[n:]
                branch.children[child.label[0]] = child
                node.children[key[at]] = child = branch
                self.size += NODE_BYTES
            node, at = child, at + len(child.label)
        node.owner = owner if node.owner is None else better(node.owner, owner)

    def _terminals(self, node: Node, path: bytes) -> Iterator[tuple[bytes, tuple]]:
        waiting = [(node, path)]
        while waiting:
            node, path = waiting.pop()
            self.size -= len(node.label) + NODE_BYTES
            if node.owner is not None:
                yield path, node.owner
            waiting += [(c, path + c.label) for c in node.children.values()]

    def cut(self, but: bytes | None = None) -> Iterator[tuple[bytes, tuple]]:
        """Gives out and cuts off every terminal whose string does not begin with ``but`` (all of them if it is None)."""
        node, path = self.root, b""
        while but is not None and len(path) < len(but):
            away = [b for b, c in node.children.items() if not (path + c.label[: len(but) - len(path)] == but[: len(path) + len(c.label)])]
            for b in away:
                child = node.children.pop(b)
                yield from self._terminals(child, path + child.label)
            if node.owner is not None:
                yield path, node.owner
                node.owner = None
            if not node.children:
                return
            (node,) = node.children.values()
            path += node.label
        if but is None:
            if node.owner is not None:
                yield path, node.owner
            for child in node.children.values():
                yield from self._terminals(child, path + child.label)
            self.root, self.size = Node(b""), 0


OWNERS = "key binary, text binary, n long, points long, doc_id long"
_ARROW = pa.schema([("key", pa.binary()), ("text", pa.binary()), ("n", pa.int64()), ("points", pa.int64()), ("doc_id", pa.int64())])


def normalised(text: bytes | None) -> bytes:
    return (text or b"").translate(None, SPACES)


def key_of(text: bytes) -> bytes:
    """SHA-256 and length of what is compared."""
    return hashlib.sha256(text).digest() + struct.pack(">Q", len(text))


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, points, key) of each row: the code points of its text as given, the key of what is left of it."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                keys = [key_of(normalised(t)) for t in batch.column(1).cast(pa.binary()).to_pylist()]
                points = pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), points, pa.array(keys, pa.binary())], names=["doc_id", "points", "key"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, "doc_id long, points long, key binary")


def slice_owners(docs: DataFrame) -> DataFrame:
    """A row for each different text of a slice of a task, with its owner there."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, most=COMBINE_BYTES):
                points = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
                owners: dict[bytes, tuple] = {}
                for doc_id, raw, p in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), points):
                    text, row = normalised(raw), (1, p, doc_id)
                    owners[text] = better(owners[text], row) if text in owners else row
                yield _as_batch([(key_of(t), t, *o) for t, o in owners.items()])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, OWNERS)


def trie_owners(rows: DataFrame, hash_bytes: int = 8, most_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row for each different text of each salt of ``rows`` (key, text, n, points, doc_id, salt), with its owner and the sum of n.

    Partitions go by length and by ``hash_bytes`` of the content hash; each fills a trie in that order. The text is given out where the
    salt is not 0, as it has to meet the other salts' owners.
    """
    place = F.concat(F.substring("key", 33, 8), F.substring("key", 1, hash_bytes))
    dealt = rows.select("key", "text", "n", "points", "doc_id", place.alias("place"), F.col("salt").cast("int").alias("salt")).repartition("place", "salt").sortWithinPartitions("salt", "place")
    lead = 4 + 8 + hash_bytes

    def run(batches):
        trie, now = OwnerTrie(), None

        def given_out(found) -> Iterator[pa.RecordBatch]:
            out, size, subtree, seen = [], 0, None, set()
            for string, owner in found:  # the strings of a subtree follow each other
                text = string[lead:]
                if string[:lead] != subtree:
                    subtree, seen = string[:lead], set()
                key = key_of(text)
                if key in seen:
                    raise RuntimeError("two different texts of one length and SHA-256")
                seen.add(key)
                salted = subtree[:4] != bytes(4)
                out.append((key, text if salted else None, *owner))
                size += NODE_BYTES + len(text) * salted
                if size > COMBINE_BYTES:
                    yield _as_batch(out)
                    out, size = [], 0
            if out:
                yield _as_batch(out)

        for whole in batches:
            for batch in slices(whole):
                for key, text, n, points, doc_id, place, salt in zip(*(c.to_pylist() for c in batch.columns)):
                    subtree = struct.pack(">I", salt) + place
                    if subtree != now and trie.size > most_bytes:
                        yield from given_out(trie.cut(subtree))
                    now = subtree
                    trie.insert(subtree + text, (n, points, doc_id))
        yield from given_out(trie.cut())

    return dealt.mapInArrow(run, OWNERS)


def exact_duplicates(docs: DataFrame, hot: int = HOT_KEYS, **options) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``: the text's owner, the rows that hold it, whether this row stays.

    ``hot``: texts of over 1/hot of all rows are owned in two steps; there are fewer than ``hot`` of them, so their keys are broadcast.
    """
    members = stored(numbered_copies(keyed_rows(docs), "copy"), "members")
    total = members.count()
    large = members.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") * hot > total)
    salt = F.when(F.col("rows").isNotNull(), 1 + F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0)
    first = stored(trie_owners(slice_owners(docs).join(F.broadcast(large), "key", "left").withColumn("salt", salt), **options), "owners")
    again = trie_owners(first.where("text is not null").withColumn("salt", F.lit(0)), **options)
    owners = first.where("text is null").unionByName(again).select("key", F.col("doc_id").alias("keep_id"), F.col("points").alias("most"), F.col("n").alias("group_size"))
    joined = join_with_hot_keys(members, owners, "key", "group_size", total)
    stays = (F.col("points") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
    return joined.select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text another row owns; all columns stay. Of repeated rows that are kept one stays, the others go."""
    name = free_name(docs.columns, "kept_key")
    once = exact_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias(f"{name}_id"), F.col("text_sha256").alias(f"{name}_sha"))
    text = F.translate(F.coalesce("text", F.lit("")), "\x20\x09\x0a\x0b\x0c\x0d", "")
    mine = docs.withColumn(name, F.sha2(text.cast("binary"), 256))
    held = mine.join(once, mine["doc_id"].eqNullSafe(once[f"{name}_id"]) & (mine[name] == once[f"{name}_sha"]))
    first = Window.partitionBy("doc_id", name).orderBy(F.desc(F.length("text")))
    return held.withColumn(f"{name}_row", F.row_number().over(first)).where(F.col(f"{name}_row") == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
