"""Token alignment and token counts against brute force over the libraries, and their edge cases."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.llm import digest_table, queries, token_alignment, token_counts
from tickloom.llm.arrow import stretches
from tickloom.llm.chunk_memo import ChunkMemo

SF = "/root/testdata/sf0.001"
LONG = "word and word again " * 60_000
ODD = [
    "a  b", " a", "a ", "  ", " ", "\n", "a\n b", "x▁y", "<|endoftext|> x</s>", "<|startoftext|>", "x<|STARTOFTEXT|>y", "ﬁ é é", "​   x", "a\x00b", "日本語 テキスト", "😀 😀",
    "ẗ T̈ Ẅ", "\x85a\x85", "a\x0bb\x0cc\x1cd\x1fe", "ΑΣ ΑΣΑ İ", "don't DON'T 12 345", "e ́x", "a  ▁b", " \n \n\n x  \t y", "<0x41> <s>", "one two", "one two",
]
SCHEMA = "doc_id long, text string, n_tokens string, pair string, row long, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", "y", 1, "d") for i, t in enumerate(ODD)] + [(100, None, "x", "y", 1, "d"), (101, "", "x", "y", 1, "d"), (None, "no id", "x", "y", 1, "d"), (25, "one two", "x", "y", 1, "d")]
    return spark.createDataFrame(rows, SCHEMA)


def brute_alignment(rows):
    """doc -> what the query gives, by all pairs of ranges, over the libraries themselves."""
    file_a, file_b = token_alignment.default_tokenizers()
    a = tokenizers.Tokenizer.from_file(file_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=file_b)
    sides = token_alignment.both(file_a, file_b)

    def ranges(ids, side):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(side.token_bytes[i] or b"??"), i))
            at = out[-1][1]
        return out

    made = []
    for _, text in rows:
        said = (" " + (text or "")).encode()
        x, y = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        if not text or any(b"".join(s.token_bytes[i] or b"??" for i in ids) != said for s, ids in ((sides.a, x), (sides.b, y))):
            x, y = [], []
        ra, rb = ranges(x, sides.a), ranges(y, sides.b)
        pairs, start = [], 0
        for p in ra:
            while start < len(rb) and rb[start][1] <= p[0]:
                start += 1
            k = start
            while k < len(rb) and rb[k][0] < p[1]:
                pairs.append((p[2], rb[k][2]))
                k += 1
        ends, groups, low = sorted({p[1] for p in ra} & {p[1] for p in rb}), [], 0
        for high in ends:
            groups.append("|".join(",".join(str(p[2]) for p in side if low < p[1] <= high) for side in (ra, rb)))
            low = high
        made.append((x, y, pairs, groups))
    count = Counter(p for *_, pairs, _ in made for p in set(pairs))
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for (doc, _), (x, y, pairs, groups) in zip(rows, made, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, len(x), len(y), len(groups), len(pairs), sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs), digest))
    return sorted(out, key=str)


def aligned(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()], key=str)


def test_alignment_equals_brute_force(spark, odd):
    files = token_alignment.default_tokenizers()
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter(F.length("text") < 900).limit(80)).cache()
    want = brute_alignment([tuple(r) for r in docs.collect()])
    assert aligned(token_alignment.alignment_counts(docs, *files)) == want
    assert aligned(token_alignment.alignment_counts(docs.repartition(5), *files, broadcast_pairs=0)) == want  # by the pair and a salt


def test_alignment_of_clashing_columns_long_texts_and_nothing(spark, odd):
    files = token_alignment.default_tokenizers()
    assert aligned(token_alignment.alignment_counts(odd, *files)) == brute_alignment([(r.doc_id, r.text) for r in odd.collect()])
    (long,) = aligned(token_alignment.alignment_counts(spark.createDataFrame([(1, LONG + "x")], "doc_id long, text string"), *files))
    assert long[1] > 240_000 and long[4] >= max(long[1], long[2]) and long[5] == long[4] == long[6]
    assert token_alignment.alignment_counts(odd.filter("false"), *files).collect() == []


def test_long_texts_are_aligned_in_parts_alike(monkeypatch, odd):
    files = token_alignment.default_tokenizers()
    sides = token_alignment.both(*files)
    text = "Ein Wort, and another one; " * 400 + "日本 é " * 50 + "end"
    whole = token_alignment.aligned_rows(sides, [text, "short one"])
    monkeypatch.setattr(token_alignment, "PART_CHARS", 300)
    parts = token_alignment.aligned_rows(sides, [text, "short one"])
    assert [r[:5] for r in parts] == [r[:5] for r in whole]
    assert [dict(zip(*r[5:])) for r in parts] == [dict(zip(*r[5:])) for r in whole]


@pytest.mark.parametrize("texts", [ODD, [LONG, LONG.upper()]])
def test_normalised_texts_count_alike(spark, texts):
    file = token_counts.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(file)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.counter(file)(texts) == want
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = [r.c for r in frame.orderBy("doc_id").select(token_counts.normalised(F.col("text"), file).alias("c")).collect()]
    assert token_counts.counter(file)(made) == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t<|>startofexz'sAB7é́̈ẗﬁ日ΣİK\x85 ​.-")), max_size=40))
def test_chunks_count_like_the_library(text):
    file = token_counts.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(file)
    assert token_counts.counter(file)([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_counts_of_all_documents_and_edge_cases(spark, odd):
    library = tokenizers.Tokenizer.from_file(token_counts.default_tokenizer())
    want = lambda rows: sorted(((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in rows), key=str)
    got = lambda df: sorted([tuple(r) for r in df.collect()], key=str)
    assert got(token_counts.count_tokens(odd, token_counts.default_tokenizer())) == want(odd.collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(queries.op12_token_counts(spark, SF)) == want(docs.collect())
    assert token_counts.count_tokens(odd.filter("false"), token_counts.default_tokenizer()).collect() == []


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_tokenizers_count_texts_as_they_are(spark, odd, name):
    import public_tokenizers

    file = public_tokenizers.path(name)
    if name.endswith(".json"):
        library = tokenizers.Tokenizer.from_file(file)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        library = sentencepiece.SentencePieceProcessor(model_file=file)
        count = lambda t: len(library.encode(t))
    rows = token_counts.count_tokens(odd, file).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r.doc_id, count(r.text or "")) for r in odd.collect())


def test_the_cache_encodes_misses_only(spark, tmp_path):
    file = token_counts.default_tokenizer()
    cache = token_counts.TokenCache(spark, str(tmp_path / "cache"), buckets=4)
    one = spark.createDataFrame([(1, "a b c"), (2, "a  B\nc "), (3, "zz")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(one, file, cache).collect()} == {1: 3, 2: 3, 3: 1}
    assert cache.table.rows().count() == 2  # two of the texts are one to the tokenizer
    cache.close()
    cache = token_counts.TokenCache(spark, str(tmp_path / "cache"))  # opened again, with other buckets asked for
    two = spark.createDataFrame([(9, "A b C"), (8, "new text")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(two, file, cache).collect()} == {9: 3, 8: 2}
    assert cache.table.buckets == 4 and cache.table.rows().count() == 3
    some = spark.createDataFrame([(bytes(cache.counts(file).first()["digest"]), 77)], "digest binary, n_tokens long")
    cache.append(some, file)  # what is stored is what is read
    assert 77 in {r.n_tokens for r in token_counts.count_tokens(one.unionByName(two), file, cache).collect()}
    cache.close()


def test_a_digest_table_keeps_its_buckets_and_refuses_strangers(spark, tmp_path):
    rows = spark.range(200).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("x"))
    table = digest_table.DigestTable(spark, "x BIGINT", folder=str(tmp_path / "t"), buckets=64)
    table.put(rows, batch="one")
    table.close()
    again = digest_table.DigestTable(spark, "x BIGINT", folder=str(tmp_path / "t"), buckets=32)
    assert rows.join(again.rows().hint("merge"), "digest", "left_anti").count() == 0 and again.buckets == 64
    again.close()
    rows.withColumn("batch", F.lit("b")).write.partitionBy("batch").parquet(str(tmp_path / "stranger"))
    with pytest.raises(ValueError):
        digest_table.DigestTable(spark, "x BIGINT", folder=str(tmp_path / "stranger")).open()
    assert digest_table.buckets_for(0) == 32 and digest_table.buckets_for(200_000_000) == 128


def test_memo_of_two_generations():
    made = []
    memo = ChunkMemo(lambda parts: [made.append(p) or p.upper() for p in parts], 3)
    assert memo.known({"a", "b"})["a"] == "A"
    assert {memo.known({"a", "c", "d"})[x] for x in "acd"} == {"A", "C", "D"}  # full: a is taken over
    assert sorted(made) == ["a", "b", "c", "d"]
    assert "".join(stretches("ab cd " * 9 + "x" * 50, 7)) == "ab cd " * 9 + "x" * 50 and list(stretches("")) == [""]
