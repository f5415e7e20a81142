"""Token counts through a cache of content digests.

Every text is normalised as far as its tokenizer cannot tell the difference, and digested. The digest
and the version of the tokenizer (a digest of its file, the library and its version) are joined to the
counts that the cache holds; of the texts that it does not hold, one per digest is encoded, and their
counts are appended. The result is read from the cache, so that a text that was counted in an earlier
delivery, or twice in this one, is encoded once.

A text is encoded chunk by chunk where the tokenizer drops white space, since then no token spans any:
each task keeps the counts of the chunks it has met.

Defined cases: null counts as empty, an empty text has no tokens; rows equal in id and text have a row
each in the result; a null doc_id is kept; an empty table gives an empty result; extra columns are
ignored; a count once stored stands for its digest in all later deliveries; two writers that append the
same digest at once store it twice, with the same count, and are read as one.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.arrow import bounded, stretches
from tickloom.llm.chunk_memo import ChunkMemo
from tickloom.llm.digest_table import DigestTable
from tickloom.session import Scratch

LIMIT = 2048
MEMO = 500_000  # chunks whose counts a task remembers
LONG = 1_000_000  # characters beyond which a text is taken stretch by stretch
BLANKS = r"[\x20\x09-\x0D]+"


@functools.cache
def drops_blanks(file: str) -> bool:
    """True if the file's tokenizer lower-cases, takes white space as one blank and makes no token of it."""
    if not file.endswith(".json"):
        return False
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [(s["type"], s.get("pattern"), s.get("content")) for s in ((spec["normalizer"] or {}).get("normalizers") or [])]
    first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    plain_added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    return (
        steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        and first.get("type") == "Split" and first.get("invert") is True and first.get("behavior") == "Removed" and r"[^\s" in pattern and plain_added
    )


@functools.cache
def version(file: str) -> str:
    """Digest of the tokenizer's file, its library with version, and the normalisation used here."""
    import sentencepiece
    import tokenizers

    library = f"tokenizers {tokenizers.__version__}" if file.endswith(".json") else f"sentencepiece {sentencepiece.__version__}"
    with open(file, "rb") as f:
        return hashlib.sha256(f"{library} {drops_blanks(file)} ".encode() + f.read()).hexdigest()


def normalised(text: Column, file: str) -> Column:
    """The text without what the tokenizer cannot see.

    Where it drops white space, runs of ASCII blanks become one space; ASCII texts are lower-cased too,
    unless they may hold a control string, which counts as written only. Letters before a combining mark
    are not ASCII alone: their composed forms differ by case, so such texts keep theirs.
    """
    text = F.coalesce(text, F.lit(""))
    if not drops_blanks(file):
        return text
    blank = F.trim(F.regexp_replace(text, BLANKS, " "))
    return F.when((F.octet_length(text) == F.length(text)) & ~text.contains("<|"), F.lower(blank)).otherwise(blank)


@functools.lru_cache(2)
def counter(file: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts, as the file's library gives them without added special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if file.endswith(".json"):
        import tokenizers

        library = tokenizers.Tokenizer.from_file(file)
        library.no_truncation()
        library.no_padding()

        def counts(texts: list[str]) -> list[int]:
            return [len(e) for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    else:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=file)

        def counts(texts: list[str]) -> list[int]:
            return [len(ids) for ids in library.encode(texts, num_threads=1)]

    if not drops_blanks(file):
        return counts
    memo = ChunkMemo(counts, MEMO)

    def by_chunks(texts: list[str]) -> list[int]:
        return [sum(map(of_stretches, stretches(t))) for t in texts] if any(len(t) > LONG for t in texts) else of_all(texts)

    def of_stretches(part: str) -> int:
        return of_all([part])[0]

    def of_all(texts: list[str]) -> list[int]:
        cut = [t.split(" ") for t in texts]
        known = memo.known(set(itertools.chain.from_iterable(cut))).__getitem__
        return [sum(map(known, chunks)) for chunks in cut]

    return by_chunks


class TokenCache:
    """Stored counts in `folder`, by digest of content, tokenizer version and append."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = 32):
        self.table = DigestTable(spark, "n_tokens BIGINT", ("tokenizer", "batch"), folder, buckets)

    def counts(self, file: str) -> DataFrame:
        """digest, n_tokens of what is stored for the file's version; no shuffle, as buckets hold whole digests."""
        return self.table.rows().filter(F.col("tokenizer") == version(file)).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counted: DataFrame, file: str) -> None:
        self.table.put(counted, tokenizer=version(file), batch=uuid.uuid4().hex)

    def close(self) -> None:
        self.table.close()


def _keyed(docs: DataFrame, file: str) -> DataFrame:
    content = normalised(F.col("text"), file)
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("content"))


def _encoded(misses: DataFrame, file: str) -> DataFrame:
    """digest, content -> digest, n_tokens; the same digest in turn is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, before = counter(file), None
        for batch in bounded(batches, "content"):
            digests, contents = batch.column("digest").to_pylist(), batch.column("content").to_pylist()
            first = [i for i, d in enumerate(digests) if d != (digests[i - 1] if i else before)]
            before = digests[-1] if digests else before
            yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in first], pa.binary()), pa.array(count([contents[i] for i in first]), pa.int64())], ["digest", "n_tokens"])

    return misses.select("digest", "content").mapInArrow(run, "digest binary, n_tokens long")


def fill(docs: DataFrame, tokenizer_file: str, cache: TokenCache, hold: Scratch | None = None) -> DataFrame:
    """Count what of docs the cache lacks; returns doc_id, n_bytes, digest of every row, written.

    One row per missing digest, that of its least doc_id, is joined by digest and id, so that a hot text
    is dealt by its ids; a row that comes again with the same id is skipped where it is encoded.
    """
    hold = hold or Scratch(docs.sparkSession)
    keyed = _keyed(docs, tokenizer_file)
    rows = hold.write(keyed.drop("content"), "digests", plain=True)
    distinct = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    missing = hold.write(distinct.join(cache.counts(tokenizer_file).hint("merge"), "digest", "left_anti"), "missing", plain=True)
    chosen = keyed.join(missing.withColumnRenamed("digest", "wanted"), (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    counted = _encoded(chosen, tokenizer_file).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    cache.append(counted, tokenizer_file)
    hold.drop(missing)
    return rows


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: TokenCache | None = None, limit: int = LIMIT) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit (more tokens than limit), one row per row.

    A cache of the caller's is filled and goes on; without one the counts live in the scratch folder.
    """
    cache = cache or TokenCache(docs.sparkSession)
    rows = fill(docs, tokenizer_file, cache)
    return counted(rows, tokenizer_file, cache, limit)


def counted(rows: DataFrame, tokenizer_file: str, cache: TokenCache, limit: int = LIMIT) -> DataFrame:
    """The rows that fill() gave, with their stored counts."""
    joined = rows.join(cache.counts(tokenizer_file).hint("merge"), "digest")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def count_deliveries(docs: DataFrame, tokenizer_file: str, deliveries: int, cache: TokenCache | None = None, limit: int = LIMIT) -> DataFrame:
    """As count_tokens, for a table too large for one go: its rows are dealt by id into deliveries, each of
    which counts only what none before it has brought."""
    cache = cache or TokenCache(docs.sparkSession)
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(deliveries))
    rows = [fill(docs.select("doc_id", "text").filter(turn == k), tokenizer_file, cache) for k in range(deliveries)]
    return counted(functools.reduce(DataFrame.unionByName, rows), tokenizer_file, cache, limit)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
