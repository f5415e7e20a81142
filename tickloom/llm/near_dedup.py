"""MinHash near-duplicate detection with tensored banding.

Two collections of `tables` half keys are computed per text, each half key made of `width` minhashes.
Every pair of a half key of the first collection with one of the second is a table key, so that
2 * tables * width minhashes serve tables ** 2 tables of 2 * width minhashes each. Two texts with
similarity s meet in some table with probability (1 - (1 - s**width) ** tables) ** 2: with 10 and 3,
0.9985 at s = 0.8 and 0.99997 at 0.9.

Texts with equal shingle sets are one node. Buckets with the same nodes are one bucket with a weight.
First the groups are collapsed: in every turn each bucket draws a head, and a node is checked, on full
sets, against the head of another component that it shares most tables with; a turn makes at most one
pair a node. What then still lies in buckets of several components goes through an exact join: nodes
are put into blocks, and blocks whose nodes share a prefix shingle are compared as wholes on the full
sets, so that no linked pair that shares a bucket is left in two components, whatever the turns have
found; a comparison gives fewer links than it has components, never all pairs. Components come from large-star and small-star steps on DataFrames.

Nothing gathers a bucket, a component or a node's copies in one task: counts and heads are combined
map-side, and the joins that bring them back have a written table on either side, which adaptive
execution can split. Tables that are no longer read are deleted.

Defined cases: null and blank texts have no shingles, no links and their own id as component; a text
of fewer words than a shingle has the whole sequence as its one shingle; repeated rows fall in one
node; a null doc_id takes the smallest id of its component (null if all are null); equal ids with
different texts are different rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tickloom.llm.arrow import slices, texts
from tickloom.session import Scratch

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MEMO = 200_000  # words whose hash a task remembers
BATCH = 1_000  # texts or sets that a Python worker gets at once


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Whole texts -> sorted distinct 64-bit shingle hashes."""

    def __init__(self, size: int):
        self.size, self.memo = size, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
        if not words:
            return np.empty(0, np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words):
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(ids))
        h = _mixed(ids[: len(ids) - size + 1] + np.uint64(size))
        for k in range(1, size):
            h = _mixed(h * M3 + ids[k : len(ids) - size + 1 + k])
        return np.unique(h)


def minhashes(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out, short = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32), shingles.astype(np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(out, (factors[:, None] * short[at : at + 4096]).min(1), out=out)
    return out.astype(np.uint64)


def half_keys(shingles: np.ndarray, factors: np.ndarray, width: int) -> np.ndarray:
    """All half keys of a text, the first collection's and then the second's."""
    low = _mixed(minhashes(shingles, factors)).reshape(-1, width)
    key = low[:, 0]
    for k in range(1, width):
        key = _mixed(key * M3 + low[:, k])
    return key


def sketch(docs: DataFrame, shingle: int, tables: int, width: int, seed: int) -> DataFrame:
    """doc_id, text_key, n_shingles, lo and hi (identity of the set), first and second half keys."""
    long = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("first", long), T.StructField("second", long),
    ])
    factors = np.random.default_rng(seed).integers(0, 1 << 31, 2 * tables * width, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(shingle)
        for batch in slices(batches):
            sets = [shingles_of(text) for text in texts(batch)]
            keys = [half_keys(s, factors, width).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
            lo, hi = zip(*map(identity, sets))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
                pa.array([k[:tables] for k in keys], pa.list_(pa.int64())), pa.array([k[tables:] for k in keys], pa.list_(pa.int64())),
            ], schema.names)

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    return int(_mixed(shingles ^ M3).sum(dtype=np.uint64).view(np.int64)), int(_mixed(shingles ^ M2).sum(dtype=np.uint64).view(np.int64))


def distinct_sets(sketches: DataFrame) -> DataFrame:
    """node, lo, hi, rep (least doc_id), at (one document with the set), n, first, second.

    node is lo, but for sets that share it with another one: these are numbered by hi.
    """
    sets = sketches.filter("n_shingles > 0").groupBy("lo", "hi").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "text_key")).alias("at"), F.first("n_shingles").alias("n"), F.first("first").alias("first"), F.first("second").alias("second")
    )
    nth = F.row_number().over(Window.partitionBy("lo").orderBy("hi"))
    return sets.withColumn("nth", nth).withColumn("node", F.when(F.col("nth") == 1, F.col("lo")).otherwise(F.xxhash64("lo", "hi", "nth"))).drop("nth")


def table_rows(nodes: DataFrame) -> DataFrame:
    """node, n, key: every pair of a first with a second half key is a table's key."""
    half = nodes.select("node", "n", F.posexplode("first").alias("i", "a"), "second")
    return half.select("node", "n", "i", "a", F.posexplode("second").alias("j", "b")).select("node", "n", F.xxhash64("i", "j", "a", "b").alias("key"))


def shared_buckets(nodes: DataFrame, hold: Scratch) -> DataFrame:
    """bucket, node, n, weight: the buckets of two nodes or more; weight counts the tables in which the same nodes meet.

    Only keys and their counts go through the first exchange, and only rows of shared keys beyond the second.
    """
    rows = table_rows(nodes)
    keys = hold.write(rows.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1").select("key"), "keys")
    met = hold.write(rows.join(keys, "key", "left_semi"), "met")
    print_of = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1))))
    marks = hold.write(met.groupBy("key").agg(print_of.alias("bucket")), "marks")
    out = hold.write(met.join(marks, "key").groupBy("bucket", "node", "n").agg(F.count("*").alias("weight")), "buckets")
    hold.drop(keys, met, marks)
    return out


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node, shingles of the wanted nodes (node, lo, hi, at), made from the whole texts of one document each."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(shingle)
        for batch in slices(batches):
            sets, node = [shingles_of(t) for t in texts(batch)], batch.column("node").to_pylist()
            same = [identity(s) == i for s, i in zip(sets, zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist()))]
            yield pa.RecordBatch.from_arrays([
                pa.array([x for x, ok in zip(node, same) if ok], pa.int64()), pa.array([s.view(np.int64) for s, ok in zip(sets, same) if ok], pa.list_(pa.int64())),
            ], schema.names)

    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    asked = wanted.select("node", "lo", "hi", F.col("at.doc_id").alias("of"), F.col("at.text_key").alias("text_key"))
    found = own.join(asked, (own["text_key"] == asked["text_key"]) & own["doc_id"].eqNullSafe(asked["of"])).select("node", "lo", "hi", "text")
    return found.mapInArrow(run, schema).dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (x, y) those with 100 * intersection >= percent * union of the full sets."""
    a = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
    b = sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    return pairs.join(a, "x").join(b, "y").filter(100 * both >= percent * (F.size("sx") + F.size("sy") - both)).select(pairs.columns)


def crowded_buckets(buckets: DataFrame, comps: DataFrame | None, turn: int, hold: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of the buckets that hold several components, with these, and the head that each such bucket draws in this turn."""
    named = buckets.select("bucket", "node", "n", "weight")
    named = named.withColumn("component", F.col("node")) if comps is None else named.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = hold.write(named, "named")
    drawn = F.struct(F.xxhash64("component", F.lit(turn)), F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("n"), F.col("component"))
    heads = named.groupBy("bucket").agg(F.min(drawn).alias("h"), F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("held")).filter("a <> b")
    heads = hold.write(heads.select("bucket", "held", F.col("h.node").alias("head"), F.col("h.n").alias("head_n"), F.col("h.component").alias("head_component")), "heads")
    rows = hold.write(named.join(heads.select("bucket"), "bucket", "left_semi"), "crowded")
    hold.drop(named)
    return rows, heads


def nearest_heads(crowded: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """x, y, c_x, c_y: each node with the head of another component that it shares most tables with and whose size allows the similarity."""
    fits = f"component <> head_component and 100 * least(n, head_n) >= {percent} * greatest(n, head_n)"
    met = crowded.join(heads, "bucket").filter(fits).groupBy("node", "component", "head", "head_component").agg(F.sum("weight").alias("met"))
    best = met.groupBy("node").agg(F.max(F.struct("met", "head", "component", "head_component")).alias("p"))
    return best.select(F.col("node").alias("x"), F.col("p.head").alias("y"), F.col("p.component").alias("c_x"), F.col("p.head_component").alias("c_y"))


def prefix_rows(members: DataFrame, sets: DataFrame, percent: int, slots: int) -> DataFrame:
    """members (node, component) -> node, n, component, s, at, short: the rarest shingles of each set, in order.

    Shingles are ordered by how often they occur, counted in a fixed number of slots. Sets of a and b
    shingles, a <= b, that reach the similarity have o = ceil(percent (a + b) / (100 + percent)) in
    common, so their first a - o + 1 and b - o + 1 share one; short marks the prefix that the smaller
    set of a pair needs.
    """
    named = sets.join(members, "node")
    slot = F.pmod(F.col("s"), F.lit(slots)).cast("int")
    often = np.zeros(slots, np.int64)
    counts = named.select(F.explode("shingles").alias("s")).groupBy(slot.alias("slot")).count().toArrow()
    often[counts["slot"].to_numpy()] = counts["count"].to_numpy()
    shared = members.sparkSession.sparkContext.broadcast(often)
    schema = "node long, n long, component long, s long, at long, short boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cols = [[] for _ in range(6)]
            for node, component, shingles in zip(batch["node"].to_pylist(), batch["component"].to_pylist(), batch["shingles"]):
                s = shingles.values.to_numpy()
                n = len(s)
                long, short = n + 1 + -percent * n // 100, n + 1 + -2 * percent * n // (100 + percent)
                first = s[np.lexsort((s, shared.value[s % slots]))[:long]]
                for col, values in zip(cols, (np.full(long, node), np.full(long, n), np.full(long, component), first, np.arange(long), np.arange(long) < short)):
                    col.append(values)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], ["node", "n", "component", "s", "at", "short"])

    return named.select("node", "component", "shingles").mapInArrow(run, schema)


SET_SIZE = 2000  # shingles of a set up to which a block is counted in sets


def blocks_of(crowded: DataFrame, heads: DataFrame, percent: int, block: int, hold: Scratch) -> DataFrame:
    """node, component, block, size_class: about `block` nodes that are likely alike to a block, fewer where
    they have more than SET_SIZE shingles each on average.

    A component of more nodes or shingles than that has blocks of its own, other nodes are put by their largest
    bucket. Sets whose sizes allow the similarity are in the same size class or in neighbouring ones.
    """
    width = 1.001 * math.log(100 / percent) if percent < 100 else 1.0
    size_class = F.floor(F.ln("n") / width)
    nodes = crowded.join(heads.select("bucket", "held"), "bucket").groupBy("node", "n", "component").agg(F.max(F.struct("held", "bucket")).alias("b"))
    nodes = hold.write(nodes.select("node", "n", "component", F.col("b.bucket").alias("bucket"), size_class.alias("size_class")), "grouped")
    full = F.greatest(F.count("*") / block, F.sum("n") / (block * SET_SIZE))
    large = nodes.groupBy("component").agg(full.alias("k")).filter(F.col("k") > 1).select("component", F.lit(True).alias("large"))
    large = hold.write(large, "large")
    nodes_by = nodes.join(large, "component", "left").withColumn("family", F.when(F.col("large"), F.xxhash64("component", F.lit(1))).otherwise(F.col("bucket")))
    nodes_by = hold.write(nodes_by.drop("bucket", "large"), "families")
    parts = hold.write(nodes_by.groupBy("family", "size_class").agg(F.ceil(full).alias("parts")), "parts")
    part = F.pmod(F.xxhash64("node"), "parts")
    out = nodes_by.join(parts, ["family", "size_class"]).select("node", "component", "size_class", F.xxhash64("family", "size_class", part).alias("block"))
    out = hold.write(out, "blocks")
    hold.drop(nodes, large, nodes_by, parts)
    return out


def block_pairs(prefixes: DataFrame, members: DataFrame, hold: Scratch) -> DataFrame:
    """a, b (a <= b): the blocks in which nodes of different components share a prefix shingle and sizes allow the similarity."""
    held = prefixes.join(members.select("node", "block", "size_class"), "node").groupBy("s", "block", "size_class").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("short").alias("short")
    )
    held = hold.write(held, "held")
    mixed = held.groupBy("s").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l <> h").select("s")
    held_by = hold.write(held.join(mixed, "s", "left_semi"), "mixed")
    a, b = (held_by.select("s", *[F.col(c).alias(f"{c}_{e}") for c in ("block", "size_class", "low", "high", "short")]) for e in "ab")
    needed = "block_a <= block_b and abs(size_class_a - size_class_b) <= 1 and (short_a or short_b) and not (low_a = high_b and high_a = low_b)"
    out = hold.write(a.join(b, "s").filter(needed).select(F.col("block_a").alias("a"), F.col("block_b").alias("b")).distinct(), "block-pairs")
    hold.drop(held, held_by)
    return out


def shared_counts(sets: list[np.ndarray], slab: int = 8192) -> np.ndarray:
    """Sizes of all intersections of the sets, by products of their incidence matrix, slab by slab of its columns."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, column = row[often[column] > 1], column[often[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    counts, order = np.zeros((len(sets), len(sets)), np.float32), np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, slab):
        a, b = np.searchsorted(column, (at, at + slab))
        part = np.zeros((len(sets), slab), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        counts += part @ part.T
    return counts.astype(np.int64)


def spanning_links(comps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Places of pairs at the similarity that join the components they join: one fewer than these, at most."""
    n, both = np.array([len(s) for s in sets]), shared_counts(sets)
    close = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (comps[:, None] != comps[None, :])
    root = {c: c for c in comps.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(np.triu(close))):
        p, q = find(int(comps[i])), find(int(comps[j]))
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((int(i), int(j)))
    return out


def remaining_links(crowded: DataFrame, heads: DataFrame, sets: DataFrame, percent: int, hold: Scratch, block: int, slots: int = 1 << 20) -> DataFrame:
    """Rows of crowded buckets -> c_x, c_y: components joined by pairs among these nodes that are at the similarity.

    Nodes are put into blocks; blocks that can hold such a pair, by shared prefix shingles, are compared
    as wholes on their full sets, and a comparison gives no more links than it has components.
    """
    members = blocks_of(crowded, heads, percent, block, hold)
    prefixes = hold.write(prefix_rows(members.select("node", "component"), sets, percent, slots), "prefixes", BATCH)
    pairs = block_pairs(prefixes, members, hold)
    whole = hold.write(members.join(sets, "node").select("component", "block", "shingles"), "block-sets")
    asked = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    schema = T.StructType([T.StructField("c_x", T.LongType()), T.StructField("c_y", T.LongType())])

    def compare(table: pa.Table) -> pa.Table:
        comps = table["component"].to_numpy()
        found = spanning_links(comps, [s.values.to_numpy() for s in table["shingles"]], percent)
        return pa.table([pa.array([comps[i] for i, _ in found], pa.int64()), pa.array([comps[j] for _, j in found], pa.int64())], schema.names)

    links = asked.join(whole, "block").groupBy("a", "b").applyInArrow(compare, schema)
    out = hold.write(links.distinct(), "links")
    hold.drop(members, prefixes, pairs, whole)
    return out


def _unsettled(edges: DataFrame) -> bool:
    """True unless every left end has one edge and is no edge's right end, so that edges are stars."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("met"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    return not ends.filter("out > 1 or (out = 1 and met = 1)").isEmpty()


def components(links: DataFrame, hold: Scratch | None = None) -> DataFrame:
    """links (x, y) -> node, component (its least node), for nodes with links but the least ones.

    Large-star and small-star in turn; each step is a written table, until all edges form stars.
    """
    hold = hold or Scratch(links.sparkSession)
    edges = hold.write(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct(), "edges")
    while _unsettled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = hold.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = hold.write(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        hold.drop(least, edges)
        least = hold.write(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = hold.write(small.distinct(), "edges")
        hold.drop(least, large)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def merged_components(comps: DataFrame | None, links: DataFrame, hold: Scratch) -> DataFrame:
    """comps after more links between components (c_x, c_y): only the components that they join are gone through again."""
    up = components(links.select(F.col("c_x").alias("x"), F.col("c_y").alias("y")), hold)
    if comps is None:
        return hold.write(up, "components")
    moved = comps.join(up.toDF("component", "root"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    out = hold.write(moved.union(up), "components")
    hold.drop(comps)
    return out


def linked(buckets: DataFrame, sets: DataFrame, percent: int, block: int, hold: Scratch) -> DataFrame | None:
    """node, component of the nodes that share a bucket and have links, but for the least of each component; None without any."""
    comps, turn = None, 0
    if buckets.isEmpty():
        return None
    while True:
        crowded, heads = crowded_buckets(buckets, comps, turn, hold)
        links = hold.write(confirmed(nearest_heads(crowded, heads, percent), sets, percent), "links")
        new, left = links.count(), heads.count()
        if new:
            comps = merged_components(comps, links, hold)
        hold.drop(buckets, heads, links)
        buckets, turn = crowded, turn + 1
        if 20 * new <= left:  # few links for the buckets left: the exact join is the shorter way
            break
    crowded, heads = crowded_buckets(buckets, comps, turn, hold)
    links = remaining_links(crowded, heads, sets, percent, hold, block)
    if not links.isEmpty():
        comps = merged_components(comps, links, hold)
    hold.drop(buckets, crowded, heads, links)
    return comps


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, tables: int = 10, width: int = 3, seed: int = 1, block: int = 256) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_shingles, component_id, kept, group, text_key, one row per document.

    group is the same for the documents of a component and null without words; text_key tells rows of
    equal ids apart. block bounds what the exact join compares at once; it has no influence on the result.
    """
    hold = Scratch(docs.sparkSession)
    sketches = hold.write(sketch(docs, shingle, tables, width, seed), "sketches", BATCH)
    nodes = hold.write(distinct_sets(sketches), "nodes")
    buckets = shared_buckets(nodes, hold)
    sets = hold.write(shingle_sets(docs, nodes.join(buckets.select("node").distinct(), "node", "left_semi"), shingle), "sets", BATCH)
    comps = linked(buckets, sets, percent, block, hold)
    ids = nodes.select("node", "lo", "hi", "rep", F.col("node").alias("group"))
    if comps is not None:
        own = comps.union(comps.select("component", "component").distinct())
        least = hold.write(own.join(nodes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least")), "least")
        ids = ids.join(own.join(least, "component"), "node", "left")
        ids = ids.select("lo", "hi", F.coalesce("least", "rep").alias("rep"), F.coalesce("component", "group").alias("group"))
    ids = hold.write(ids.select("lo", "hi", F.col("rep").alias("component_id"), "group"), "ids")
    hold.drop(nodes, sets, comps)
    with_words = sketches.filter("n_shingles > 0").join(ids, ["lo", "hi"]).select("doc_id", "n_shingles", "component_id", "group", "text_key")
    out = with_words.union(sketches.filter("n_shingles = 0").select("doc_id", "n_shingles", "doc_id", F.lit(None), "text_key"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group", "text_key")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs without all but one document of each group; all columns stay.

    Documents without words stay, and rows equal in id and text stay or go together.
    """
    judged = near_duplicates(docs, **options)
    first = judged.filter("kept and group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("at"))
    stay = first.select("at.*").union(judged.filter("group is null").select("doc_id", "text_key").distinct())
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("text_key"))
    same = (keyed["text_key"] == stay["text_key"]) & keyed["row.doc_id"].eqNullSafe(stay["doc_id"])
    return keyed.join(stay, same, "left_semi").select("row.*")
