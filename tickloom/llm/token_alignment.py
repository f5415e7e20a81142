"""Alignment of two tokenizers' tokens over the same text, and what it says of their vocabularies.

Both tokenizers encode the text after one space; a token is the range of bytes that it stands for. In
each batch the tokens of either side are looked up on the other by an as-of merge, keyed by document:
the token that covers a start is the last one that begins at or before it. Both directions together
give every pair of tokens whose ranges overlap, since of two ranges that overlap one holds the other's
start. Byte offsets where tokens of both sides end cut a document into groups.

A pair of ids counts the documents that hold it linked. Pairs are exploded and counted with map-side
partial aggregates; the counts, at most one row per pair of ids of the two vocabularies, are joined back
to the documents' pairs, as a broadcast only if they are few, else over the pair and a salt.

Defined cases: a text that is null, empty or does not come back byte by byte from the tokens of either
side has no tokens (zeros and an empty digest) and counts for no pair; control strings inside texts are
ordinary text; rows equal in id and text are documents of their own; a null doc_id is kept; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tickloom.llm.arrow import bounded, texts
from tickloom.llm.bpe import byte_letters
from tickloom.llm.chunk_memo import ChunkMemo
from tickloom.session import Scratch

MEMO = 500_000  # parts of texts whose ids a task remembers
BATCH_ROWS, BATCH_BYTES = 256, 4_000_000  # what is handled at a time; a longer text goes by itself
PART_CHARS = 2_000_000  # what is aligned at a time
BROADCAST_PAIRS = 400_000  # rows of the table of counts up to which it is broadcast: some 20 MB
SALTS = 16
TOGETHER = 500  # new parts that are encoded as one text
#: A space before white space.
BEFORE_BLANK = regex.compile(r" (?=\p{White_Space})")


def beside_blank(text: str) -> bool:
    """True if a space of the text stands at its end or before white space, or the text begins with white space."""
    if text[0].isspace() or text[-1] == " " or "  " in text:
        return True
    if text.isascii():
        return any(f" {c}" in text for c in "\n\t\r\x0b\x0c")
    return BEFORE_BLANK.search(text) is not None


class Side:
    """One tokenizer: ids of texts that begin with a space, and the bytes of each id (none for control tokens).

    parted says that no token reaches from a character over a single space to what follows it.
    """

    def __init__(self, token_bytes: list[bytes | None], ids_of: Callable[[str], list[int]], parted: bool):
        self.token_bytes, self.ids_of, self.parted = token_bytes, ids_of, parted
        self.size = np.array([len(b or b"") for b in token_bytes], np.int64)

    def joined(self, ids: list[int]) -> bytes | None:
        """The bytes of the ids in turn; None if one of them stands for no bytes."""
        parts = [self.token_bytes[i] for i in ids]
        return None if None in parts else b"".join(parts)

    def encode(self, text: str) -> bytes | None:
        """The ids as 32-bit integers; None if they do not stand for the text's very bytes."""
        ids = self.ids_of(text)
        return array("i", ids).tobytes() if self.joined(ids) == text.encode("utf-8", "surrogatepass") else None

    def encode_parts(self, parts: list[str]) -> list[bytes | None]:
        """The ids of parts of texts, each a space and what follows up to the next: all as one text, cut again
        where the parts end; where that fails, by halves, down to the part that is not what its ids say."""
        if len(parts) == 1:
            return [self.encode(parts[0])]
        if not parts:
            return []
        made = self.encode("".join(parts))
        if made is not None:
            ends = np.cumsum(self.size[np.frombuffer(made, np.int32)])
            cuts = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in parts])
            place = np.searchsorted(ends, cuts)
            if np.array_equal(ends[place], cuts):
                at = [0, *(4 * place + 4).tolist()]
                return [made[x:y] for x, y in itertools.pairwise(at)]
        half = len(parts) // 2
        return self.encode_parts(parts[:half]) + self.encode_parts(parts[half:])


class Both:
    """Two tokenizers over the same texts; the ids of parts that come again are remembered."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.memo = ChunkMemo(self._made, MEMO)
        self.parted, self.odd = a.parted and b.parted, set()

    def _made(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of both sides; parts for whose very bytes either side's do not stand are noted as odd."""
        spaced = [" " + p for p in parts]
        made = [[x for i in range(0, len(spaced), TOGETHER) for x in s.encode_parts(spaced[i : i + TOGETHER])] for s in (self.a, self.b)]
        self.odd.update(p for p, x, y in zip(parts, *made, strict=True) if x is None or y is None)
        return [(x or b"", y or b"") for x, y in zip(*made, strict=True)]

    def _whole(self, text: str) -> tuple[bytes, bytes] | None:
        x, y = self.a.encode(text), self.b.encode(text)
        return None if x is None or y is None else (x, y)

    def encode(self, given: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of a space and each text on both sides; none where either side's bytes differ from it.

        A text is cut at its spaces where each stands alone between other characters than white space,
        which is where either side begins a token; other texts are encoded whole.
        """
        plain = [self.parted and t != "" and not beside_blank(t) for t in given]
        cut = [t.split(" ") if p else [] for t, p in zip(given, plain, strict=True)]
        if len(self.odd) > MEMO:
            self.odd.clear()
            self.memo = ChunkMemo(self._made, MEMO)
        known = self.memo.known(set(itertools.chain.from_iterable(cut))).__getitem__
        out = []
        for text, ok, parts in zip(given, plain, cut, strict=True):
            if ok and self.odd.isdisjoint(parts):
                x, y = map(b"".join, zip(*map(known, parts), strict=True))
            else:
                x, y = (self._whole(" " + text) if text else None) or (b"", b"")
            out.append((np.frombuffer(x, np.int32), np.frombuffer(y, np.int32)))
        return out


def byte_level_side(file: str) -> Side:
    """A tokenizers file of byte-level BPE; it encodes a space and the text, control strings as text."""
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    library = tokenizers.Tokenizer.from_file(file)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    letters = byte_letters()
    token_bytes: list[bytes | None] = [None] * library.get_vocab_size()
    for word, i in library.get_vocab(with_added_tokens=False).items():
        token_bytes[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else None
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec["pre_tokenizer"] or {}
    words = spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    return Side(token_bytes, lambda text: library.encode_batch_fast([text], add_special_tokens=False)[0].ids, bool(words))


def piece_side(file: str) -> Side:
    """A sentencepiece model that puts a space before the text by itself."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=file)
    token_bytes: list[bytes | None] = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        if library.is_byte(i):
            token_bytes.append(bytes([int(piece[3:-1], 16)]))
        else:
            token_bytes.append(None if library.is_control(i) or library.is_unknown(i) else piece.replace("▁", " ").encode())
    parted = all(b is None or b" " not in b.lstrip(b" ") for b in token_bytes)
    # the text's own first space is the one that the library puts there
    return Side(token_bytes, lambda text: library.encode(text[1:], num_threads=1), parted)


@functools.lru_cache(4)
def both(file_a: str, file_b: str) -> Both:
    return Both(*(byte_level_side(f) if f.endswith(".json") else piece_side(f) for f in (file_a, file_b)))


def covering(starts: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """For each row of starts (doc, start, in order) the token of others that covers its start."""
    return pd.merge_asof(starts[["start", "doc"]], others[["start", "doc", "token"]], on="start", by="doc")["token"].to_numpy(np.int64)


def links(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens whose ranges overlap: tokens of b that cover a start of a, and
    tokens of a that cover a start of b, but for equal starts, which both directions find."""
    over_a, over_b = covering(a, b), covering(b, a)
    inside = a["start"].to_numpy()[over_b] != b["start"].to_numpy()
    places = np.arange(len(b))[inside]
    return np.concatenate([np.arange(len(a)), over_b[inside]]), np.concatenate([over_a, places])


@functools.lru_cache(2)
def _numbers(size: int) -> list[np.ndarray]:
    """Decimal ids followed by what stands behind them: the next id of the side, the other side, the next group."""
    return [np.array([f"{i}{mark}".encode() for i in range(size)], object) for mark in (",", "|", ";")]


class Aligned:
    """Tokens of a batch of documents: flat arrays, document by document, with places in one byte stream."""

    def __init__(self, ids: list[tuple[np.ndarray, np.ndarray]], size_a: np.ndarray, size_b: np.ndarray):
        self.n, self.vocabulary = len(ids), max(len(size_a), len(size_b))
        self.a, self.b = self._flat([x for x, _ in ids], size_a), self._flat([y for _, y in ids], size_b)
        self.left, self.right = links(self.a, self.b) if len(self.a) and len(self.b) else (np.zeros(0, np.int64),) * 2
        ends_a, ends_b = self.a["end"].to_numpy(), self.b["end"].to_numpy()
        self.cut_a, self.cut_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)

    @staticmethod
    def _flat(ids: list[np.ndarray], size: np.ndarray) -> pd.DataFrame:
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        end = np.cumsum(size[flat])
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        return pd.DataFrame({"doc": doc, "start": end - size[flat], "end": end, "id": flat, "token": np.arange(len(flat))})

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.n)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different pairs of ids of each document, a << 32 | b, with their links: doc, pair, n."""
        doc = self.a["doc"].to_numpy()[self.left]
        pair = self.a["id"].to_numpy().astype(np.int64)[self.left] << 32 | self.b["id"].to_numpy()[self.right]
        return _summed(doc, pair, np.ones(len(doc), np.int64))

    def group_texts(self) -> list[bytes]:
        """The groups of each document as `a1,a2|b1;a3|b2,b3`."""
        group_a, group_b = (np.cumsum(np.r_[False, cut[:-1]]) if len(cut) else np.zeros(0, np.int64) for cut in (self.cut_a, self.cut_b))
        in_a, in_b = np.cumsum(np.r_[0, np.bincount(group_a)]), np.cumsum(np.r_[0, np.bincount(group_b)])
        # a token stands behind those of its side and, of the other side, those of earlier groups (for b: of its own too)
        place_a, place_b = np.arange(len(group_a)) + in_b[group_a], np.arange(len(group_b)) + in_a[group_b + 1]
        more, turn, close = _numbers(self.vocabulary)
        out = np.empty(len(group_a) + len(group_b), object)
        for place, ids, cut, mark in ((place_a, self.a["id"].to_numpy(), self.cut_a, turn), (place_b, self.b["id"].to_numpy(), self.cut_b, close)):
            out[place] = more[ids]
            out[place[cut]] = mark[ids[cut]]
        ends = np.cumsum(self.per_doc(self.a["doc"]) + self.per_doc(self.b["doc"]))
        return [b"".join(out[x:y].tolist())[:-1] for x, y in zip(np.r_[0, ends[:-1]], ends, strict=True)]


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about PART_CHARS characters, cut at single spaces before other characters than white
    space, where both sides begin a token; the space is left out, as each part is encoded behind one."""
    start = 0
    while len(text) - start > PART_CHARS:
        end = text.find(" ", start + PART_CHARS)
        while end > 0 and (text[end - 1] == " " or text[end + 1 : end + 2].isspace()):
            end = text.find(" ", end + 1)
        if end < 0 or end + 1 >= len(text):
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _summed(row: np.ndarray, pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of n for equal rows and pairs, in their order."""
    order = np.lexsort((pair, row))
    row, pair, n = row[order], pair[order], n[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])]) if len(row) else np.zeros(0, np.int64)
    return row[first], pair[first], np.add.reduceat(n, first) if len(row) else n


def aligned_rows(sides: Both, texts: list[str]) -> list[tuple]:
    """Of each text n_a, n_b, n_groups, n_links, the digest of its groups, its pairs and their links.

    Long texts go part by part, so that the tokens of no more than some PART_CHARS are held at a time.
    """
    rows, counts = len(texts), np.zeros((4, len(texts)), np.int64)
    digests, lost = [hashlib.sha256() for _ in texts], set()
    found = [np.zeros(0, np.int64)] * 3

    def take(held: list[str], owner: list[int]) -> None:
        nonlocal found
        ids, of = sides.encode(held), np.array(owner)
        lost.update(i for i, (x, _) in zip(owner, ids, strict=True) if not len(x))
        x = Aligned(ids, sides.a.size, sides.b.size)
        doc, pair, n = x.pairs()
        for k, c in enumerate((x.per_doc(x.a["doc"]), x.per_doc(x.b["doc"]), x.per_doc(x.a["doc"].to_numpy()[x.cut_a]), np.bincount(doc, n, x.n))):
            np.add.at(counts[k], of, c.astype(np.int64))
        for i, said in zip(owner, x.group_texts(), strict=True):
            digests[i].update((b";" if begun[i] else b"") + said)
            begun[i] = True
        found = [np.concatenate([u, v]) for u, v in zip(found, (of[doc], pair, n), strict=True)]
        if len(set(owner)) < len(owner) or (len(found[0]) and owner[0] in split):
            found = list(_summed(*found))

    begun, split, held, owner, size = [False] * rows, set(), [], [], 0
    for i, text in enumerate(texts):
        for k, part in enumerate(parts_of(text)):
            if k:
                split.add(i)
            if held and size + len(part) > PART_CHARS:
                take(held, owner)
                held, owner, size = [], [], 0
            held.append(part)
            owner.append(i)
            size += len(part)
    if held:
        take(held, owner)
    at = np.searchsorted(found[0], np.arange(rows + 1))
    none = (0, 0, 0, 0, "", found[1][:0], found[2][:0])
    return [none if i in lost else (*counts[:, i].tolist(), digests[i].hexdigest(), found[1][at[i] : at[i + 1]], found[2][at[i] : at[i + 1]]) for i in range(rows)]


def align(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (array of pair, n)."""
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    pair = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])
    schema = T.StructType([docs.schema["doc_id"], *longs, T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(pair))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = both(file_a, file_b)
        for batch in bounded(batches, "text", BATCH_ROWS, BATCH_BYTES):
            *counts, digests, pairs, n = zip(*aligned_rows(sides, texts(batch)), strict=True)
            structs = pa.StructArray.from_arrays([pa.array(np.concatenate(pairs), pa.int64()), pa.array(np.concatenate(n), pa.int64())], ["pair", "n"])
            offsets = np.r_[0, np.cumsum([len(x) for x in pairs])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)],
                schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n_docs (documents that hold it linked), best (no pair of the same A id has more)."""
    counts = aligned.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.select("pair", "n_docs", (F.col("n_docs") == F.max("n_docs").over(of_a)).alias("best"))


def alignment_counts(docs: DataFrame, file_a: str, file_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """docs -> doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is a best one of its A id),
    count_sum (over links, the documents that hold the pair), groups_sha256."""
    hold = Scratch(docs.sparkSession)
    rows = hold.write(align(docs, file_a, file_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = hold.write(pair_counts(rows), "pairs")
    linked = rows.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    if counts.count() <= broadcast_pairs:
        joined = linked.join(F.broadcast(counts), "pair")
    else:
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = linked.withColumn("salt", F.pmod(F.hash("row"), F.lit(SALTS))).join(salted.hint("merge"), ["pair", "salt"])
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"))
    out = rows.drop("pairs").join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
