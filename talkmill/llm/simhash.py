"""SimHash near-duplicates: tiled exact comparison in numpy (exclusive-or and bit counts), tiles skipped by population count.

Fingerprints that are equal fall together first, so copies never meet in pairs. Different fingerprints are compared exactly inside
blocks that lose no link:

* ``simhash_components`` (64 bits, radius r): of m bands of bits, two fingerprints within r bits agree in m - r at least. m grows with the
  number of fingerprints; blocks that are large all the same are parted by finer bands.
* ``near_duplicate_groups`` (wide fingerprints, for a similarity of word shingles): bands of min-hashes of the same shingles. Texts whose
  fingerprints are near come into one cluster; inside a cluster the sets of shingles of near texts are compared exactly.

Inside a block rows are ordered by population count and compared tile by tile; a tile whose counts differ beyond the radius is
skipped. Blocks over ``BLOCK_ROWS`` rows are cut into chunks, and each pair of chunks is compared in its own group: exact, with no
group in one task beyond two chunks. A block gives links to one member per group of linked rows, never all pairs.

Null and empty texts have no words: fingerprint zero, linked like any other. Repeated rows are copies. Rows without a doc_id are linked
like others; a group's name is the smallest doc_id in it (null if it has none). An empty table gives no rows. Only doc_id and text are
read, so further columns of any name do no harm.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, join_with_hot_keys, map_texts, small, stored
from .components import connected_components

SEED = 42
#: Blocks beyond this many rows are cut into chunks that are compared pair by pair.
BLOCK_ROWS = 1024
#: Rows of a tile.
TILE = 256
#: Up to this size all groups of a batch are compared at once, by shifts.
SMALL = 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(data: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the space-joined shingles of ``width`` words, repeats included; A-Z lower-cased; ASCII white space parts words."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))  # one past each word's following space
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :])], np.uint64)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Further 64 bits from a hash, one set for each k (k = 0: the hash itself)."""
    if k == 0:
        return h
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(h: np.ndarray, words: int = 1) -> np.ndarray:
    """``words`` x 64 bits: a bit is 1 if it is set in over half the hashes."""
    out = np.zeros(words, np.uint64)
    if not len(h):
        return out
    for k in range(words):
        octets = mixed(h, k).view(np.uint8).reshape(-1, 8)
        if len(h) < 64:
            ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
        out[k] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return out


def block_keys(h: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band: ``rows`` min-hashes of the set of shingles."""
    h = h ^ (h >> np.uint64(29))
    keys = np.zeros(bands, np.uint64)
    for b in range(bands):
        for r in range(rows):
            odd = np.uint64(((b * rows + r + 1) * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (2**64 - 1) | 1)
            keys[b : b + 1] = keys[b : b + 1] * np.uint64(0x100000001B3) ^ (h * odd).min()
        keys[b : b + 1] = mixed(keys[b : b + 1], b + 1)
    return keys


# ---------------------------------------------------------------- comparison inside blocks


def small_links(starts: np.ndarray, sizes: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs within the radius in groups of at most SMALL rows, all groups at once."""
    keep = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    last = np.repeat(starts + sizes, sizes)
    left, right = [], []
    for d in range(1, SMALL):
        i = np.flatnonzero(keep & (np.arange(len(keep)) + d < last))
        if not len(i):
            break
        near = np.bitwise_count(prints[i] ^ prints[i + d]).sum(axis=1, dtype=np.int64) <= radius
        left.append(i[near])
        right.append(i[near] + d)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def tile_groups(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the place of one row of its group of rows linked within the radius.

    Rows go by population count. From each row not yet reached, tiles of reached rows are compared with tiles of the rest whose
    counts are within the radius; rows that are reached leave the rest, so a dense group costs little more than its size.
    """
    counts = np.bitwise_count(prints).sum(axis=1, dtype=np.int64)
    order = np.argsort(counts, kind="stable")
    prints, counts = prints[order], counts[order]
    group = np.full(len(prints), -1, np.int64)
    rest = np.arange(len(prints))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        group[seed] = seed
        reached = np.array([seed])
        while len(reached) and len(rest):
            tile, reached = reached[:TILE], reached[TILE:]
            low = np.searchsorted(counts[rest], counts[tile].min() - radius, "left")
            high = np.searchsorted(counts[rest], counts[tile].max() + radius, "right")
            hit = np.zeros(high - low, bool)
            for at in range(low, high, 8 * TILE):
                other = rest[at : min(at + 8 * TILE, high)]
                differ = np.zeros((len(tile), len(other)), np.int64)
                for w in range(prints.shape[1]):
                    differ += np.bitwise_count(prints[tile, w][:, None] ^ prints[other, w][None, :])
                hit[at - low : at - low + len(other)] = (differ <= radius).any(axis=0)
            new = rest[low:high][hit]
            group[new] = seed
            reached = np.concatenate([reached, new])
            rest = np.concatenate([rest[:low], rest[low:high][~hit], rest[high:]])
    out = np.empty_like(group)
    out[order] = order[group]
    return out


def link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a[a != b], pa.int64()), pa.array(b[a != b], pa.int64())], names=["a", "b"])


def tiled_links(rows: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows (block, id, fingerprint words) of whole blocks, to one member per group of linked rows."""
    block, ids = rows[0], rows[1]
    prints = np.stack(rows[2:], axis=1).view(np.uint64)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    sizes = np.diff(np.r_[starts, len(block)])
    i, j = small_links(starts, sizes, prints, radius)
    a, b = [ids[i]], [ids[j]]
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        group = tile_groups(prints[s : s + n], radius)
        a.append(ids[s : s + n])
        b.append(ids[s : s + n][group])
    return np.concatenate(a), np.concatenate(b)


def similar_rows(rows: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows (block, id, part, shingles, fingerprint words) of whole blocks, to one member per group of similar rows.

    Rows are similar if their sets of shingles are, compared exactly; sets are compared where fingerprints are within the radius and the
    sets' sizes allow it. In a block of two parts only rows of different parts are compared.
    """
    block, ids, parts, sets = rows[:4]
    prints = np.stack(rows[4:], axis=1).view(np.uint64)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    a, b = [ids[:0]], [ids[:0]]
    for s, n in zip(starts.tolist(), np.diff(np.r_[starts, len(block)]).tolist(), strict=True):
        if n > 1:
            group = similar_groups(prints[s : s + n], [np.frombuffer(x, np.uint64) for x in sets[s : s + n]], parts[s : s + n], radius)
            a.append(ids[s : s + n])
            b.append(ids[s : s + n][group])
    return np.concatenate(a), np.concatenate(b)


def similar_groups(prints: np.ndarray, sets: list[np.ndarray], parts: np.ndarray, radius: int) -> np.ndarray:
    """For each row the place of one row of its group of rows linked by similarity. Rows that are reached leave the rest, as in ``tile_groups``."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat, begin = np.concatenate(sets), np.r_[0, np.cumsum(sizes)[:-1]]
    across = len(np.unique(parts)) > 1
    group, rest = np.full(len(prints), -1, np.int64), np.arange(len(prints))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        group[seed] = seed
        reached = [seed]
        while reached and len(rest):
            i = reached.pop()
            near = np.bitwise_count(prints[rest] ^ prints[i]).sum(axis=1, dtype=np.int64) <= radius
            near &= np.minimum(sizes[rest], sizes[i]) * SIMILAR[1] >= np.maximum(sizes[rest], sizes[i]) * SIMILAR[0]
            if across:
                near &= parts[rest] != parts[i]
            some = rest[near]
            if not len(some):
                continue
            n = sizes[some]
            common = np.zeros(len(some), np.int64)
            if sizes[i]:
                ends = np.cumsum(n)
                element = flat[np.repeat(begin[some] - (ends - n), n) + np.arange(ends[-1])]
                at = np.minimum(np.searchsorted(sets[i], element), sizes[i] - 1)
                common = np.bincount(np.repeat(np.arange(len(some)), n), sets[i][at] == element, len(some)).astype(np.int64)
            new = some[common * SIMILAR[1] >= (n + sizes[i] - common) * SIMILAR[0]]
            group[new] = seed
            reached += new.tolist()
            rest = rest[group[rest] < 0]
    return group


def links_in_blocks(keyed: DataFrame, columns: list[str], radius: int, block_rows: int = BLOCK_ROWS, finer: Column | None = None) -> DataFrame:
    """(a, b) ids linked within ``radius`` among the rows of ``keyed`` (key long, id long, fingerprint words ``columns``) with equal keys.

    ``finer``: an array of keys of which linked rows share one; large blocks are parted by them before they are cut to chunks.
    """
    big = stored(keyed.groupBy("key").count().where(F.col("count") > block_rows).select("key", F.ceil(F.col("count") / block_rows).cast("int").alias("chunks")), "big-blocks")
    if big.isEmpty():
        parted = keyed.select(F.col("key").alias("block"), "id", *columns)
    elif finer is not None:
        dense = keyed.join(small(big), "key", "left_semi").withColumn("part", F.explode(finer)).select(F.xxhash64("key", "part").alias("key"), "id", *columns)
        calm = keyed.join(small(big), "key", "left_anti")
        return links_in_blocks(calm, columns, radius, block_rows).union(links_in_blocks(dense, columns, radius, block_rows))
    else:
        cut = keyed.join(small(big), "key", "left").withColumn("chunk", F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1))).cast("int"))
        others = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
        parted = cut.withColumn("other", F.explode(others)).select(
            F.when(F.col("chunks").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other"))).alias("block"), "id", *columns
        )
    return links_of_blocks(parted, lambda rows: tiled_links(rows, radius))


def links_of_blocks(parted: DataFrame, linked) -> DataFrame:
    """(a, b) of all blocks; ``linked`` takes the rows (block first) of whole blocks and returns the two sides of their links."""

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            part = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in range(batch.num_columns)]
            held = part if held is None else [np.concatenate(x) for x in zip(held, part, strict=True)]
            cut_at = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0  # the last block may go on in the next batch
            if cut_at:
                yield link_batch(*linked([x[:cut_at] for x in held]))
                held = [x[cut_at:] for x in held]
        if held is not None and len(held[0]):
            yield link_batch(*linked(held))

    return parted.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- the operators


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, print): the 64-bit fingerprint of each row's text as a long."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("print", T.LongType())])

    def rows(ids, texts):
        found = np.array([fingerprint(shingle_hashes((t or "").encode(), width))[0] for t in texts], np.uint64)
        return ids, found.view(np.int64)

    return map_texts(docs, rows, schema)


def bit_bands(prints: str, radius: int, bands: int) -> Column:
    """A key for each choice of bands - radius of the bands: the choice's number and its bits."""
    edges = [64 * k // bands for k in range(bands + 1)]
    bits = [F.shiftrightunsigned(F.shiftleft(F.col(prints), 64 - b), 64 - (b - a)) if b - a < 64 else F.col(prints) for a, b in zip(edges, edges[1:])]
    return F.array(*(F.xxhash64(F.lit(k), *(bits[i] for i in some)) for k, some in enumerate(combinations(range(bands), bands - radius))))


def bands_for(n: int, radius: int) -> int:
    """So many bands that a block has about 64 of ``n`` fingerprints at most, if their bits are spread."""
    bands = radius + 1
    while bands < 4 * (radius + 1) and n > 64 << (64 * (bands - radius) // bands):
        bands += 1
    return bands


def named_by_least(nodes: DataFrame, links: DataFrame, node: str, ident: str, name: str) -> DataFrame:
    """``nodes`` with ``root``, the smallest node of each one's component, and ``name``: the smallest ``ident`` in it, nulls last, and its node."""
    roots = connected_components(links).withColumnRenamed("id", node)
    rooted = stored(nodes.join(roots, node, "left").withColumn("root", F.coalesce("root", node)), "rooted")
    best = rooted.groupBy("root").agg(F.count("*").alias("_n"), F.min(F.struct(F.col(ident).isNull().alias("none"), F.col(ident).alias("ident"), F.col(node).alias("node"))).alias("_best"))
    return join_with_hot_keys(rooted, best, "root", "_n", rooted.count()).withColumn(name, F.struct("_best.ident", "_best.node")).drop("_n", "_best")


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row: 16 hex digits, and the smallest doc_id reachable over links of at most ``radius`` bits."""
    found = stored(fingerprints(docs, width), "prints")
    classes = stored(found.groupBy("print").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "print-classes")
    bands = bands_for(classes.count(), radius)
    keyed = classes.select(F.explode(bit_bands("print", radius, bands)).alias("key"), F.col("print").alias("id"), "print")
    links = links_in_blocks(keyed, ["print"], radius, finer=bit_bands("print", radius, bands + 2))
    named = stored(named_by_least(classes, links, "print", "id", "best").select("print", "rows", F.col("best.ident").alias("component_id")), "named")
    out = join_with_hot_keys(found, named, "print", "rows", found.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


#: The similarity of word shingles (of their sets) from which two texts are near-duplicates, as a fraction.
SIMILAR = (4, 5)
#: Wide fingerprints for candidates: at 0.8, 512 bits differ in 78 places on average (deviation 8; at most 96 and 9, in texts of four or
#: five shingles), so the radius lies over five deviations off; it takes pairs from about 0.46. Sets are compared exactly after that.
WORDS, RADIUS, BANDS, ROWS = 8, 144, 12, 2


def text_node(text: str | Column = "text") -> Column:
    """The number of a text: its XXH64. Equal texts have equal numbers, different texts different ones but for about n * n / 4e19 pairs of n texts."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def wide_prints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, p0.., keys): the text's number, wide fingerprints over distinct shingles and block keys of each row."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("node", T.LongType())]
        + [T.StructField(f"p{k}", T.LongType()) for k in range(WORDS)]
        + [T.StructField("keys", T.ArrayType(T.LongType()))]
    )

    def rows(ids, texts):
        data = [(t or "").encode() for t in texts]
        nodes = np.array([xxhash.xxh64_intdigest(d, SEED) for d in data], np.uint64).view(np.int64)
        hashes = [np.unique(shingle_hashes(d, width)) for d in data]
        prints = np.array([fingerprint(h, WORDS) for h in hashes], np.uint64).view(np.int64).reshape(len(data), WORDS)
        keys = [block_keys(h, BANDS, ROWS).view(np.int64).tolist() if len(h) else [0] for h in hashes]  # texts without words meet in one block
        return [ids, nodes, *prints.T, keys]

    return map_texts(docs, rows, schema)


#: Bytes of sets of shingles of a cluster that are compared in one task; larger clusters are cut, and each pair of their parts compared.
BLOCK_BYTES = 16 << 20


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the set of hashes of each text of ``nodes`` (node, id), read from the one row of that doc_id. Only sets are shuffled if there are few such texts."""
    needed = small(nodes)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("shingles", T.BinaryType())])
    own = docs.select("doc_id", "text", text_node().alias("node"))
    some = own.join(needed, (own["node"] == needed["node"]) & own["doc_id"].eqNullSafe(needed["id"]), "left_semi").select(F.col("node").alias("doc_id"), "text")
    found = map_texts(some, lambda ids, texts: [ids, [np.unique(shingle_hashes((t or "").encode(), width)).tobytes() for t in texts]], schema)
    return found.groupBy(F.col("doc_id").alias("node")).agg(F.any_value("shingles").alias("shingles"))  # repeated rows have one


def similar_links(clustered: DataFrame, prints: list[str], radius: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): links of similar texts inside each cluster of ``clustered`` (cluster, node, shingles, fingerprint words), to one member per group."""
    sizes = clustered.groupBy("cluster").agg(F.sum(F.octet_length("shingles") + 100).alias("bytes"))
    big = small(stored(sizes.where(F.col("bytes") > block_bytes).select("cluster", F.ceil(F.col("bytes") / block_bytes).cast("int").alias("chunks")), "big-clusters"))
    cut = clustered.join(big, "cluster", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))).cast("int"))
    each = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    block = F.xxhash64("cluster", F.least("part", "other"), F.greatest("part", "other"))
    parted = each.select(block.alias("block"), "node", "part", "shingles", *prints)
    return links_of_blocks(parted, lambda rows: similar_rows(rows, radius))


def near_duplicate_groups(docs: DataFrame, width: int = 5, radius: int = RADIUS) -> DataFrame:
    """(node, id, root, kept) for each different text: its smallest doc_id, the smallest doc_id of its group of near-duplicates, and whether it is the one of its group that stays.

    Links: an exact similarity of sets of word shingles of SIMILAR or more. Texts that meet in a min-hash band (missed at 0.8 with a chance
    of five in a million) with wide fingerprints at most ``radius`` bits apart make clusters; the texts of a cluster are compared with each
    other. Blocks and clusters give one link for each of their rows at most, so groups of copies give no more than they have rows.
    """
    prints = [f"p{k}" for k in range(WORDS)]
    found = wide_prints(docs, width)
    classes = stored(found.groupBy("node").agg(F.min("doc_id").alias("id"), F.any_value(F.struct(*prints, "keys")).alias("w")), "text-classes")
    keyed = classes.select(F.explode("w.keys").alias("key"), F.col("node").alias("id"), *(f"w.{p}" for p in prints))
    clusters = connected_components(links_in_blocks(keyed, prints, radius)).select(F.col("id").alias("node"), F.col("root").alias("cluster"))
    near = stored(clusters.join(classes, "node").select("node", "cluster", "id", *(f"w.{p}" for p in prints)), "near")
    sets = shingle_sets(docs, near.select("node", "id"), width)
    clustered = stored(near.drop("id").join(sets, "node"), "clustered")
    links = similar_links(clustered, prints, radius)
    named = named_by_least(classes.select("node", "id"), links, "node", "id", "best")
    return named.select("node", "id", F.col("best.ident").alias("root"), (F.col("best.node") == F.col("node")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id. All columns stay.

    Repeated rows (equal doc_id and text) count as copies; of rows that differ in other columns alone, one is picked by a hash. Texts
    without words (null, empty, white space) are copies of each other. Groups without a doc_id keep one row. Texts are shuffled only
    where more ids are dropped than a broadcast may hold, and for doc_ids that stand more than once.
    """
    groups = stored(near_duplicate_groups(docs, width, radius), "groups")
    ident, node = free_name(docs.columns, "_i"), free_name(docs.columns, "_n")
    again = stored(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias(ident)), "repeated-ids")
    kept_ids = groups.where("kept").select(F.col("id").alias(ident))
    gone = docs.select(F.col("doc_id").alias(ident)).where(F.col(ident).isNotNull()).join(kept_ids, ident, "left_anti")
    gone = stored(gone.union(again.where(F.col(ident).isNotNull())).distinct(), "dropped-ids")
    once = docs.where(F.col("doc_id").isNotNull()).join(small(gone), F.col("doc_id") == F.col(ident), "left_anti")
    if again.isEmpty():
        return once
    # Ids that stand more than once, or none: each row is judged by its text, too.
    of, as_ = free_name(docs.columns, "_of"), free_name(docs.columns, "_as")
    rows = docs.join(small(again), docs["doc_id"].eqNullSafe(F.col(ident)), "left_semi").withColumn(node, text_node())
    kept = groups.where("kept").select(F.col("node").alias(of), F.col("id").alias(as_))
    rows = rows.join(kept, (F.col(node) == F.col(of)) & F.col("doc_id").eqNullSafe(F.col(as_)), "left_semi")
    whole = [F.col(f"`{c}`") for c in docs.columns]
    one = rows.groupBy("doc_id", node).agg(F.min_by(F.struct(*whole), F.xxhash64(*whole)).alias("_row"))
    return once.unionByName(one.select("_row.*"))
