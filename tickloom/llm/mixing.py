"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source, its documents in hash order one after the other, are cut into blocks: of
`block_words`, or where that is None of a 128th of the source's target, from 1 to 256 words, so that a
quota of whole blocks comes within some hundredths of any target. A source's target gives its exact quota of block draws; a quota above the number of
blocks means a second pass. A binary tree deals the quotas to output shards: at each node the
vector of quotas is split by one multivariate-hypergeometric draw, until each leaf (shard) has its
own. Within a source and pass the blocks stand in a keyed permutation, and each shard owns a run of
it, so that the shards' draws are disjoint. What a shard gets is shuffled within the shard only.
A document's words go to the shards whose blocks hold them: the plan and the mix have an entry for
each document, pass and shard, so that a shard holds exactly its own quotas.

The driver holds the weights' table alone: one row per source, as the weights are set by source, with
its shards' edges (8 bytes each, at most `most_shards`, in one array), which tasks get as they are. A shard has about `shard_words` words, at
least 64 shards are made. A source's word order is by hash buckets of about `bucket_rows` rows, at
most 2**20 of them, so that neither a source nor a group of copies is ever one task; only rows equal
in doc_id, text and source meet in one bucket.

Defined cases: a null source is a source of its own, last in order; a null or blank text has size 0
and nothing is taken; repeated rows and ids take part one by one; an empty table gives an empty mix;
extra columns are ignored by the plan and kept by the mix, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickloom.llm.arrow import slices

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Share `share` times all sizes by weight; no target above `most` times its size."""
    total, caps = share * sum(sizes), [most * s for s in sizes]
    targets, free = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    while free:
        left = total - sum(caps[i] for i in range(len(sizes)) if i not in free)
        level = left / sum(weights[i] for i in free)
        full = {i for i in free if level * weights[i] > caps[i]}
        if not full:
            return [level * weights[i] if i in free else caps[i] for i in range(len(sizes))]
        free -= full
    return [min(c, t or c) for c, t in zip(caps, targets, strict=True)]


def splitting_tree(quotas: list[int], depth: int, seed: int) -> np.ndarray:
    """quotas per source -> array (2**depth shards, sources); every column adds up to its quota."""
    level = np.asarray(quotas, np.int64).reshape(1, -1)
    for d in range(depth):
        rng = np.random.default_rng((seed, d))
        left, rest = np.zeros_like(level), level.sum(1)
        to_left = rest // 2
        for i in range(level.shape[1]):  # conditional draws of the multivariate law, source by source
            rest = rest - level[:, i]
            left[:, i] = hypergeometric(rng, level[:, i], rest, to_left)
            to_left = to_left - left[:, i]
        level = np.stack([left, level - left], 1).reshape(2 * len(level), -1)
    return level


def hypergeometric(rng, good: np.ndarray, bad: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Draws of the hypergeometric law for counts of any size: beyond numpy's bound of 10**9 by inversion."""
    small = good + bad < 1_000_000_000
    out = np.zeros(len(good), np.int64)
    out[small] = rng.hypergeometric(good[small], bad[small], draws[small])
    for i in np.flatnonzero(~small):
        out[i] = _by_inversion(rng.random(), int(good[i]), int(bad[i]), int(draws[i]))
    return out


def _by_inversion(u: float, good: int, bad: int, draws: int) -> int:
    """The law's quantile at u, from ratios of neighbouring probabilities over 12 standard deviations on either side of the mode."""
    n, low, high = good + bad, max(0, draws - bad), min(good, draws)
    mode = (draws + 1) * (good + 1) // (n + 2)
    reach = 2 + int(12 * (draws * (good / n) * (bad / n) * ((n - draws) / max(1, n - 1))) ** 0.5)
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    cdf = np.cumsum(np.exp(logs - logs.max()))
    return low + min(int(np.searchsorted(cdf, u * cdf[-1], "right")), high - low)


def _mix64(x: np.ndarray, key: int) -> np.ndarray:
    x = x ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    for factor in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def permuted(block: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a four-round Feistel network, walked until within range."""
    half = max(1, (max(2, n) - 1).bit_length() + 1 >> 1)
    mask, out = np.uint64((1 << half) - 1), block.astype(np.uint64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        for r in range(4):
            left, right = x >> np.uint64(half), x & mask
            x = (right << np.uint64(half)) | (left ^ (_mix64(right, key * 4 + r) & mask))
        out[todo] = x
        todo[todo] = x >= n
    return out.astype(np.int64)


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    size: int
    target: float
    blocks: int
    quota: int
    edges: np.ndarray  # first slot of each shard, then the quota
    key: int
    block_words: int


def plan_sources(sizes: list[tuple[str | None, int]], block_words: int | None, depth: int, weights=(3, 1, 2), share=1.5, most=2.0, seed=7) -> list[SourcePlan]:
    """Targets, quotas and shard edges; sizes: (source, words), one entry per source."""
    ranked = sorted(sizes, key=lambda s: (s[0] is None, [ord(c) for c in s[0] or ""]))
    targets = water_fill([n for _, n in ranked], [weights[i % len(weights)] for i in range(len(ranked))], share, most)
    words = [block_words or max(1, min(256, int(t // 128))) for t in targets]
    blocks = [-(-n // w) for (_, n), w in zip(ranked, words, strict=True)]
    quotas = [min(int(most * b), round(t / n * b)) if n else 0 for (_, n), t, b in zip(ranked, targets, blocks, strict=True)]
    shards = splitting_tree(quotas, depth, seed)
    edges = np.vstack([np.zeros(len(ranked), np.int64), shards.cumsum(0)])
    return [
        SourcePlan(s, n, t, b, q, edges[:, i].copy(), seed * 1_000_003 + i, w)
        for i, ((s, n), t, b, q, w) in enumerate(zip(ranked, targets, blocks, quotas, words, strict=True))
    ]


@dataclass(frozen=True)
class Draws:
    """Block draws of some rows, ordered by row, pass, shard and word; one entry per piece of a block within a row."""

    row: np.ndarray
    turn: np.ndarray
    shard: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def parts(self) -> np.ndarray:
        """Where a new row, pass or shard begins."""
        if not len(self.row):
            return np.empty(0, np.int64)
        new = (np.diff(self.row) != 0) | (np.diff(self.turn) != 0) | (np.diff(self.shard) != 0)
        return np.concatenate(([0], np.flatnonzero(new) + 1))


def draw_rows(plans: dict[str | None, SourcePlan], sources: list, at: np.ndarray, size: np.ndarray) -> Draws:
    """The draws that fall on rows with these sources, first words in the source's order, and sizes."""
    found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 5]
    where: dict = {}
    for i, source in enumerate(sources):
        where.setdefault(source, []).append(i)
    for source, index in where.items():
        plan, index = plans[source], np.asarray(index)
        start, words, block_words = at[index], size[index], plan.block_words
        first = start // block_words
        reach = np.where(words > 0, (start + words - 1) // block_words - first + 1, 0)
        row = np.repeat(np.arange(len(index)), reach)
        block = np.repeat(first, reach) + (np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach))
        low = np.maximum(block * block_words - start[row], 0)
        high = np.minimum((block + 1) * block_words - start[row], words[row])
        for p in range(-(-plan.quota // plan.blocks) if plan.blocks else 0):
            slot = p * plan.blocks + permuted(block, plan.blocks, plan.key + p)
            ok = slot < plan.quota
            shard = np.searchsorted(plan.edges, slot[ok], "right") - 1
            found.append([index[row[ok]], np.full(len(shard), p), shard, low[ok], high[ok]])
    row, turn, shard, low, high = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((low, shard, turn, row))
    return Draws(row[order], turn[order], shard[order], low[order], high[order])


def _placed(docs: DataFrame, carried: Column, block_words: int | None, shards: int | None, weights, share: float, most: float, seed: int, bucket_rows: int, shard_words: int, most_shards: int):
    """Rows (row, source, size, at) with the place of their first word in their source's order, and the sources' plans."""
    rows = docs.select(carried.alias("row"), F.col("source").alias("source"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("of"), "doc_id",
                       word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text", "source", F.lit(seed)).alias("place"))
    sums = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    total = sum(r["words"] for r in sums)
    depth = max(0, ((shards or min(most_shards, max(64, -(-int(total * share) // shard_words)))) - 1).bit_length())
    plans = plan_sources([(r["source"], r["words"]) for r in sums], block_words, depth, weights, share, most, seed)
    buckets = min(1 << 20, max(64, -(-sum(r["n"] for r in sums) // bucket_rows)))
    rows = rows.withColumn("bucket", F.pmod("place", F.lit(buckets)))
    starts = rows.groupBy("of", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("of", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy("of", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(starts, ["of", "bucket"])
    return rows.select("row", "source", "size", (F.col("before") + F.col("start")).alias("at")), {p.source: p for p in plans}, 1 << depth


OPTIONS = dict(block_words=None, shards=None, weights=(3, 1, 2), share=1.5, most=2.0, seed=7, bucket_rows=2_000, shard_words=32_000_000, most_shards=1 << 17)
PART = T.StructType([T.StructField("shard", T.LongType()), T.StructField("pass", T.LongType()), T.StructField("words", T.LongType())])


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, source, size, source_size, target, taken, parts.

    parts: shard, pass (0 or 1) and words for each shard that draws words of the document; taken is
    the sum of these words. options: see OPTIONS.
    """
    options = OPTIONS | options
    rows, plans, _ = _placed(docs, F.struct("doc_id"), **options)
    schema = T.StructType([
        docs.schema["doc_id"], docs.schema["source"], T.StructField("size", T.LongType()), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("taken", T.LongType()), T.StructField("parts", T.ArrayType(PART)),
    ])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            source, size = batch.column("source").to_pylist(), batch.column("size").to_numpy()
            d = draw_rows(plans, source, batch.column("at").to_numpy(), size)
            edge = d.parts()
            words = np.add.reduceat(d.high - d.low, edge) if len(edge) else np.empty(0, np.int64)
            row = d.row[edge]
            offsets = np.searchsorted(row, np.arange(len(size) + 1)).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(x) for x in (d.shard[edge], d.turn[edge], words)], ["shard", "pass", "words"])
            taken = np.bincount(row, words, len(size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("source"), batch.column("size"), pa.array([plans[s].size for s in source], pa.int64()),
                pa.array([plans[s].target for s in source], pa.float64()), pa.array(taken), pa.ListArray.from_arrays(pa.array(offsets), parts),
            ], schema.names)

    return rows.select("row.doc_id", "source", "size", "at").mapInArrow(draw, schema)


def _cut(text: str, edges: tuple[np.ndarray, np.ndarray], low: np.ndarray, high: np.ndarray) -> str:
    """The words [low, high) of each span, in order, with the text's own spacing inside spans that touch."""
    starts, ends = edges
    first = np.concatenate(([True], low[1:] != high[:-1]))
    a, b = low[first], high[np.concatenate((first[1:], [True]))]
    if len(a) == 1 and a[0] == 0 and b[0] == len(starts):
        return text
    return "\n".join(text[starts[x] : ends[y - 1]] for x, y in zip(a.tolist(), b.tolist()))


def _word_edges(text: str) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.concatenate(([False], ~((code == 32) | ((code >= 9) & (code <= 13))), [False]))
    step = np.diff(word.astype(np.int8))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def free_name(name: str, taken: list[str]) -> str:
    """name, with underscores appended while a column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def mix(docs: DataFrame, shuffled: bool = True, **options) -> DataFrame:
    """The mix itself: one row per document, pass and shard with something drawn, with docs' own columns.

    text holds the words that the shard draws of the document in that pass (the whole text where these
    are all), n_chars their code points where docs has that column; mix_pass and mix_shard come last,
    with underscores appended where docs has columns of these names. Each shard is shuffled by itself.
    The text moves twice: into its source's order, and to its shards.
    """
    options = OPTIONS | options
    rows, plans, shards = _placed(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), **options)
    seed, names = options["seed"], docs.columns
    turn, shard = free_name("mix_pass", names), free_name("mix_shard", names)
    schema = T.StructType([*docs.schema.fields, T.StructField(turn, T.LongType()), T.StructField(shard, T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            d = draw_rows(plans, batch.column("source").to_pylist(), batch.column("at").to_numpy(), batch.column("size").to_numpy())
            own = batch.column("row")
            text, edge = own.field("text").to_pylist(), d.parts()
            row, out, last, words = d.row[edge], [], -1, None
            for i, a, b in zip(row.tolist(), edge.tolist(), [*edge[1:].tolist(), len(d.row)]):
                if i != last:
                    last, words = i, _word_edges(text[i])
                out.append(_cut(text[i], words, d.low[a:b], d.high[a:b]))
            columns = {c: own.field(k).take(pa.array(row)) for k, c in enumerate(names)} | {"text": pa.array(out, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in out], pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(d.turn[edge]), pa.array(d.shard[edge])], schema.names)

    mixed = rows.mapInArrow(cut, schema)
    if not shuffled:
        return mixed
    order = F.xxhash64("doc_id", "text", turn, F.lit(seed))
    return mixed.repartition(shards, shard).sortWithinPartitions(shard, order)
