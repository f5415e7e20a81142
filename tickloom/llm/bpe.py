"""Byte-level BPE encoding and decoding over a trie of distinct words.

A batch's distinct pre-tokens are inserted into a trie of bytes. Every node stands for a prefix, and
the BPE encoding of a prefix is that of a shorter prefix and one last token; a depth-first walk finds
each node's last token from its ancestors' alone: of the tokens that end there, the one that may
follow the last token of the ancestor where it begins. So prefixes that words share are encoded once,
and a word's ids are read by hopping from its node up to the root.

Two tokens may stand side by side unless merging by rank would join, across their border, some end of
the left one with some beginning of the right one before either grows on inside its own token.

Defined cases: a null text is encoded as an empty one; control strings that the tokenizer file names
as added tokens get their own id; repeated rows are encoded one by one; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from tickloom.llm.arrow import slices, texts

MEMO = 300_000  # distinct words whose ids a task remembers
#: Fixed value: the pre-tokens of byte-level BPE, with white space as Unicode defines it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: itself if visible, else from U+0100 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieBPE:
    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = {w: bytes(letters[c] for c in w) for w in spec["model"]["vocab"]}
        self.ids = {as_bytes[w]: i for w, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(as_bytes[a], as_bytes[b]): r for r, (a, b) in enumerate(merges)}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: w.encode() for w, i in self.added.items()}
        self.pre = regex.compile(WORDS)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}  # pre-tokens
        self.chunks: dict[str, bytes] = {}  # what stands between spaces
        number = self.ids
        self.pair_ranks = {number[a] << 32 | number[b]: r for (a, b), r in self.ranks.items()}
        self.halves = {number[a + b]: (number[a], number[b], r) for (a, b), r in reversed(self.ranks.items())}
        self.spines: tuple[dict, dict] = ({}, {})
        self.prefixes = {b[:n] for b in self.ids for n in range(1, len(b) + 1)}

    def merged(self, data: bytes) -> list[bytes]:
        """Plain BPE: join the pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts that touch a token's right (side 1) or left (side 0) border while it is built,
        each with the rank of the merge that ends it; the token itself never ends."""
        known = self.spines[side].get(token)
        if known is None:
            known, end = [], 1 << 40
            while True:
                known.append((token, end))
                if token not in self.halves:
                    break
                *parts, end = self.halves[token]
                token = parts[side]
            self.spines[side][known[0][0]] = known
        return known

    def may_follow(self, left: int, right: int) -> bool:
        ranks = self.pair_ranks
        for a, end_a in self.spine(left, 1):
            for b, end_b in self.spine(right, 0):
                rank = ranks.get(a << 32 | b)
                # of equal ranks the left one is merged first
                if rank is not None and rank < end_a and rank <= end_b:
                    return False
        return True

    @functools.cache  # noqa: B019  one encoder a process
    def _built(self, token: int) -> bool:
        return len(self.merged(self.bytes_of[token])) == 1

    def encode_words(self, words: set[str]) -> None:
        """Encode words into the memo through one trie.

        The trie is the sorted list of words: what a word shares with the one before it is the path
        that both have from the root, and going through the list is the depth-first walk. At depth d
        of the path, last[d] is the last token of the prefix, size[d] its bytes, and reach[d] the
        length of the longest end of the prefix that some token begins with.
        """
        ids, prefixes, fits = self.ids, self.prefixes, self.fits
        if len(fits) > 2_000_000:
            fits.clear()
        last, size, reach, before = [-1], [0], [0], b""
        for data, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            n, depth = len(data), 0
            for x, y in zip(before, data, strict=False):
                if x != y:
                    break
                depth += 1
            before = data
            del last[depth + 1 :], size[depth + 1 :], reach[depth + 1 :]
            for d in range(depth + 1, n + 1):
                k = reach[-1] + 1
                while k > 1 and data[d - k : d] not in prefixes:
                    k -= 1
                reach.append(k)
                while True:
                    token = ids.get(data[d - k : d])
                    if token is not None:
                        if k == d:
                            ok = self._built(token)
                        else:
                            pair = last[d - k] << 32 | token
                            ok = fits.get(pair)
                            if ok is None:
                                ok = fits[pair] = self.may_follow(last[d - k], token)
                        if ok:
                            break
                    k -= 1
                last.append(token)
                size.append(k)
            found, at = [], n
            while at:
                found.append(last[at])
                at -= size[at]
            self.memo[word] = array("I", found[::-1]).tobytes()

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        A space before another character always begins a pre-token, so that texts without other
        space around spaces are cut there first, and only different chunks meet the pattern.
        """
        cut = [self._pieces(t) for t in batch]
        wanted = {c for pieces in cut for p in pieces if isinstance(p, list) for c in p}
        if len(self.chunks) + len(wanted) > MEMO:
            self.chunks.clear()
        if len(self.memo) > MEMO:
            self.memo.clear()
        find = self.pre.findall
        fresh = {c: find(c) for c in wanted if c not in self.chunks}
        self.encode_words({w for words in fresh.values() for w in words} - self.memo.keys())
        memo, chunks = self.memo, self.chunks
        for c, words in fresh.items():
            chunks[c] = b"".join([memo[w] for w in words])
        return [b"".join([b"".join([chunks[c] for c in p]) if isinstance(p, list) else p for p in pieces]) for pieces in cut]

    def _pieces(self, text: str) -> list:
        """Lists of chunks, and the ids of added tokens between them."""
        if self.special is None or not any(w in text for w in self.added):
            return [_chunks(text)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [_chunks(text[at : m.start()]), array("I", [self.added[m[0]]]).tobytes()]
            at = m.end()
        return [*out, _chunks(text[at:])]

    def decode(self, ids: bytes) -> str:
        """Bytes of the ids in turn as UTF-8; what isn't UTF-8 becomes U+FFFD."""
        of = self.bytes_of
        return b"".join([of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


BESIDE_SPACE = regex.compile(r" (?=\p{White_Space}|$)")


def _chunks(text: str) -> list[str]:
    """Parts of the text that begin at a space before another character."""
    if not text:
        return []
    if BESIDE_SPACE.search(text):
        return regex.split(r"(?= \P{White_Space})", text)
    first, *rest = text.split(" ")
    return [first, *[" " + c for c in rest]] if first else [" " + c for c in rest]


@functools.lru_cache(2)
def encoder(file: str) -> TrieBPE:
    return TrieBPE(file)


def encode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """docs (doc_id, text) -> doc_id, ids (array of the text's token ids), decoded (from the ids)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_file)
        for batch in slices(batches):
            ids = bpe.encode_batch(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())],
                schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode_digests(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: what encode() gives, digested where it is made."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = encoder(tokenizer_file), lambda b: hashlib.sha256(b).hexdigest()
        for batch in slices(batches):
            ids = bpe.encode_batch(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha(x) for x in ids]), pa.array([sha(bpe.decode(x).encode()) for x in ids])],
                schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
