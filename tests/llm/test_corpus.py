"""Corpus operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

import hashlib
import itertools
import math
import os
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.session import Scratch, _owned, scratch_folder, scratch_tables
from tickloom.llm import bpe, chat_format, exact_dedup, gbt_rules, html_text, language_id, mixing, near_dedup, quality_classifier, queries, token_counts, url_filter

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, node long, size long"
LONG = "word and word again " * 60_000
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", None, 3), (5, "one", "en", "a", 3),
    (5, "one", "en", "a", 3), (6, "On  e", "de", "b", 5), (7, LONG, "en", "b", len(LONG)), (None, "no id here at all", "en", "b", 3),
    (9, "ünï \U0001f600 <|endoftext|>\u0000x", "fr", "é", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, "x", 1, 1) for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def crc(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def shingles(text, k):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_components(sets, percent=80):
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    shared = Counter(p for ds in where.values() for p in itertools.combinations(sorted(ds), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def test_quality_held_out_accuracy(spark, labels):
    rows = queries.op1_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    junk = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.97
    assert sum(1 - r.predicted for r in junk) / len(junk) > 0.8
    assert all(crc(r.doc_id, 3) == 1 for r in rows)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, 2400), rng.normal(-2, 1, 1600)])
    assert abs(quality_classifier.estimate_prior(p, u) - 0.6) < 0.06


def test_quality_edges(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (7, 1), (None, 1)], "doc_id long, quality int")
    model = quality_classifier.train_quality(odd, labels)
    rows = quality_classifier.score_quality(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.score_quality(none, quality_classifier.train_quality(none, labels.limit(0))).count() == 0


def brute_targets(sizes, weights, share=1.5, most=2.0):
    caps, got = [most * s for s in sizes], [0.0] * len(sizes)
    excess = share * sum(sizes)
    for _ in range(200):
        free = [i for i in range(len(sizes)) if got[i] < caps[i] - 1e-9]
        if excess < 1e-9 or not free:
            break
        total = sum(weights[i] for i in free)
        add, excess = excess, 0.0
        for i in free:
            new = got[i] + add * weights[i] / total
            got[i], excess = min(new, caps[i]), excess + max(0.0, new - caps[i])
    return got


def test_mixing_targets_and_quotas(spark, docs, texts):
    rows = queries.op2_mixing(spark, SF).collect()
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    size = {d: len(WORD.findall(t or "")) for d, t in texts.items()}
    assert {r.doc_id: r["size"] for r in rows} == size
    total, taken = Counter(), Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        total[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
    names = sorted(total)
    targets = brute_targets([total[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    for name, target in zip(names, targets, strict=True):
        got = {r.target for r in rows if source[r.doc_id] == name}
        assert len(got) == 1 and abs(got.pop() - target) < 1e-3
        assert abs(taken[name] - target) <= 2 * 256
    again = {r.doc_id: [tuple(p) for p in r.parts] for r in mixing.mix_plan(docs.repartition(13)).collect()}
    said = {r.doc_id: [tuple(map(int, p.split(":"))) for p in r.shares.split(",") if p] for r in rows}
    assert again == said and all(r.taken == sum(p[2] for p in said[r.doc_id]) and r.n_parts == len(said[r.doc_id]) for r in rows)


def brute_mix(docs, plans, block_words):
    """Words per (doc_id, pass, shard) from the plans' quotas and permutations, word by word."""
    owner = {}
    for p in plans:
        for turn in range(2):
            slots = turn * p.blocks + mixing.permuted(np.arange(p.blocks), p.blocks, p.key + turn) if p.blocks else []
            owner[p.source, turn] = [int(np.searchsorted(p.edges, s, "right")) - 1 if s < p.quota else None for s in slots]
    out = Counter()
    for doc_id, source, at, size in docs:
        for word in range(at, at + size):
            for turn in range(2):
                shard = owner[source, turn][word // block_words]
                if shard is not None:
                    out[doc_id, turn, shard] += 1
    return out


def placed(docs, **options):
    rows, plans, shards = mixing._placed(docs, F.struct("doc_id"), **(mixing.OPTIONS | options))
    return [(r.row.doc_id, r.source, r["at"], r["size"]) for r in rows.collect()], list(plans.values()), shards


def test_mixing_parts_against_brute_force(docs):
    rows, plans, shards = placed(docs, shards=8, block_words=64)
    want = brute_mix(rows, plans, 64)
    plan = mixing.mix_plan(docs, shards=8, block_words=64).collect()
    assert shards == 8 and {(r.doc_id, p["pass"], p.shard): p.words for r in plan for p in r.parts} == dict(want)
    assert all(r.taken == sum(p.words for p in r.parts) for r in plan)
    for p in plans:  # the words of a source lie one after the other without a gap
        spans = sorted((at, size) for _, source, at, size in rows if source == p.source and size)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) == p.size
        held = Counter()
        for r in plan:
            for x in r.parts:
                held[x.shard] += x.words * (r.source == p.source)
        quotas = np.diff(p.edges)  # each shard holds exactly its quota of blocks; a source's last block may be short
        assert all(0 <= q * 64 - held[k] < 2 * 64 for k, q in enumerate(quotas.tolist())) and sum(quotas) == p.quota


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 530, "b": 290, "c": 100, "d": 50, "e": 600, "f": 61, "g": 9_000, "h": 1, "i": 40_000}
    rows = [(k * 1000 + j, " ".join(["w"] * min(20, n - j)), s) for k, (s, n) in enumerate(sizes.items()) for j in range(0, n, 20)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in plan:
        assert r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.5, 0.02 * target[s]), (s, taken[s], target[s])


def test_mixing_follows_the_tree(docs, monkeypatch):
    right = {r.doc_id: sorted(map(tuple, r.parts)) for r in mixing.mix_plan(docs).collect()}
    assert len({p[0] for parts in right.values() for p in parts}) > 32
    monkeypatch.setattr(mixing, "splitting_tree", lambda quotas, depth, seed: np.vstack([np.asarray(quotas)] + [np.zeros(len(quotas), np.int64)] * (2**depth - 1)))
    wrong = {r.doc_id: sorted(map(tuple, r.parts)) for r in mixing.mix_plan(docs).collect()}
    assert wrong != right and {p[0] for parts in wrong.values() for p in parts} == {0}


def test_splitting_tree_and_large_draws():
    tree = mixing.splitting_tree([1000, 1, 0, 77], 4, 1)
    assert tree.sum(0).tolist() == [1000, 1, 0, 77] and tree.shape == (16, 4) and (tree >= 0).all() and np.ptp(tree.sum(1)) <= 1
    large = mixing.splitting_tree([6 * 10**12, 5, 10**9], 3, 1)
    assert large.sum(0).tolist() == [6 * 10**12, 5, 10**9] and (large >= 0).all() and np.ptp(large.sum(1)) <= 1
    assert sorted(mixing.permuted(np.arange(1000), 1000, 5).tolist()) == list(range(1000))
    # the quantile of the law, against exact binomial coefficients
    from math import comb

    good, bad, draws = 40, 70, 33
    cdf = np.cumsum([comb(good, k) * comb(bad, draws - k) / comb(good + bad, draws) for k in range(draws + 1)])
    for u in np.linspace(0.001, 0.999, 97):
        assert mixing._by_inversion(u, good, bad, draws) == int(np.searchsorted(cdf, u, "right"))
    assert mixing._by_inversion(0.5, 10, 0, 4) == 4 and mixing._by_inversion(0.5, 0, 10, 4) == 0


def test_mix_text_holds_the_taken_words(spark, docs):
    plan = {r.doc_id: r.parts for r in mixing.mix_plan(docs).collect()}
    whole = {r.doc_id: r.text for r in docs.collect()}
    rows = mixing.mix(docs).collect()
    assert {(r.doc_id, r.mix_pass, r.mix_shard): len(WORD.findall(r.text)) for r in rows} == {(d, p["pass"], p.shard): p.words for d, parts in plan.items() for p in parts}
    assert len(rows) == sum(map(len, plan.values()))
    for r in rows:
        assert r.n_chars == len(r.text)
        assert r.text in whole[r.doc_id] or "\n" in r.text


def test_mixing_edges(spark, odd, none):
    rows = mixing.mix_plan(odd).collect()
    assert len(rows) == len(ODD)
    assert sum(r.taken for r in mixing.mix_plan(odd).collect()) == sum(len(WORD.findall(r.text)) for r in mixing.mix(odd).collect())
    empty = mixing.mix_plan(none)
    assert empty.count() == 0 and empty.columns == mixing.mix_plan(odd).columns and mixing.mix(none).count() == 0
    named = odd.selectExpr("*", "5 as nth", "1 as row", "2 as mix_pass", "3 as `Mix_Shard`", "4 as at", "'q' as of", "7 as bucket", "8 as place", "array(1) as parts", "9 as `a.b`")
    mixed = mixing.mix(named)
    assert mixed.columns == [*named.columns, "mix_pass_", "mix_shard_"]
    got = mixed.collect()
    assert got and all((r.nth, r.row, r.mix_pass, r["Mix_Shard"], r["a.b"]) == (5, 1, 2, 3, 9) for r in got)
    assert mixing.mix_plan(named).count() == len(ODD)


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://COM/en/x", "ftp://a.b.Example.com/en/70?x#y", "x://net/de/", "http://example.net/de/8", "http://net?/de/", "https://shop.casino-win.example.com/en/1", "a://b://com/en/", "http://notcom/en/"]
    pages = spark.createDataFrame([(i, u, "h", "old") for i, u in enumerate(urls * 2)], "page_id long, url string, html string, host string")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert len(rows) == 2 * len(urls)
    assert [(rows[i].rule, rows[i].verdict) for i in range(len(urls))] == [
        (None, "allow"), (None, "allow"), (None, "allow"), ("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"),
        ("example.net/de/8", "block"), (None, "allow"), ("com/en/", "block"), (None, "allow"), (None, "allow"),
    ]
    assert rows[4].host == "a.b.example.com" and rows[4].path == "/en/70" and rows[0].host == rows[0].path == "" == rows[2].host
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    assert "html" in url_filter.filter_urls(pages).columns


def test_url_rules_of_every_kind(spark):
    """Upper case in rules, hosts with other letters, rules without a token, clashing names, a rule table, a very long URL."""
    long = "http://long.org/es/" + "a/b?c&" * 200_000
    urls = ["http://x.com/Abc/d", "http://x.com/abc/d", "http://X.COM/Abcd", "http://käse.de/ü/1", "http://é.é/%%%", "http://y.com/q", "http://y.community/q", long, "http://a.y.com"]
    pages = spark.createDataFrame([(i, u, "s", "w", "t", 1) for i, u in enumerate(urls)], "page_id long, url string, site string, word string, token string, `row` int")
    rules = tuple(url_filter.site_rule("block", r) for r in ("x.com/Abc/", "X.com/Abcd", "käse.de/ü/", "é.é/%", "y.com", "org/es/"))
    for given in (rules, url_filter.rule_frame(spark, rules)):
        rows = {r.page_id: r for r in url_filter.filter_urls(pages, given).collect()}
        assert [rows[i].rule for i in range(len(urls))] == ["x.com/Abc/", None, "X.com/Abcd", "käse.de/ü/", "é.é/%", "y.com", None, "org/es/", "y.com"]
        assert {(r.site, r.word, r.token, r.row) for r in rows.values()} == {("s", "w", "t", 1)}


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_rules_base_counts_and_accuracy(spark, texts, labels):
    rows = queries.op4_quality_rules(spark, SF)
    for r in rows.collect():
        base = brute_base(texts[r.doc_id])
        assert tuple(r[c] for c in gbt_rules.BASE) == base, r.doc_id
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        assert r.base_failed == failed and not (failed and r.kept)
    held = [r for r in rows.join(labels, "doc_id").collect() if crc(r.doc_id, 3) == 1]
    good, junk = ([r for r in held if r.quality == q and not r.base_failed] for q in (1, 0))
    assert sum(r.kept for r in good) / len(good) > 0.97
    assert sum(not r.kept for r in junk) / max(1, len(junk)) > 0.6


def test_rules_edges_and_monotone(spark, odd, none):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] + 0.7 * rng.normal(size=3000)) < 0).astype(float)
    model = gbt_rules.fit_trees(x, y, [-1, 0, 1])
    grid = np.zeros((50, 3))
    grid[:, 0] = np.linspace(-3, 3, 50)
    assert (np.diff(model.scores(grid)) <= 1e-12).all() and ((model.scores(x) >= 0.5) == y).mean() > 0.75
    grid = np.zeros((50, 3))
    grid[:, 2] = np.linspace(-3, 3, 50)
    assert (np.diff(model.scores(grid)) >= -1e-12).all()
    empty = gbt_rules.train_rules(none, spark.createDataFrame([], "doc_id long, quality int"))
    rows = gbt_rules.judge(odd, empty).collect()
    assert len(rows) == len(ODD) and sum(r.kept for r in rows) == 0
    for r, text in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        assert tuple(r[c] for c in gbt_rules.BASE) == brute_base(text[1])
    assert gbt_rules.judge(none, empty).count() == 0


def test_near_duplicates_against_brute_force(spark, texts):
    sets = {d: shingles(t, 2) for d, t in texts.items()}
    want = brute_components(sets)
    rows = queries.op5_near_dedup(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_edges(spark, odd, none):
    rows = near_dedup.near_duplicates(odd, shingle=2).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_shingles, r.component_id))
    assert len(rows) == len(ODD)
    assert got[1] == got[2][:0] + [(0, 1)] and got[2] == [(0, 2)] and got[4] == [(1, 4)] and got[5] == [(1, 4)] * 2 and got[6] == [(1, 6)]
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_large_group_and_chains(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(4000)]
    base = [words[i] for i in rng.integers(0, 4000, 80)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.integers(0, 80, 2):
            text[at] = f"x{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(text)))
    chain = [words[i] for i in rng.integers(0, 4000, 60)]
    for i in range(300, 330):  # each differs from the one before by a little
        chain[(i * 7) % 60] = f"y{i}"
        rows.append((i, " ".join(chain)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components({d: shingles(t, 2) for d, t in rows})
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, shingle=2).collect()} == want
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, shingle=2, block=20).collect()} == want


def test_near_duplicates_just_below_and_above_the_threshold(spark):
    """700 texts of 100 words with 4 replaced at random: many pairs just below 0.8, about a thousand above."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(100)]
    for changed in (3, 4):
        rows = []
        for i in range(700):
            text = list(base)
            for at in rng.choice(100, changed, replace=False):
                text[at] = f"x{rng.integers(0, 10**9)}"
            rows.append((i, " ".join(text)))
    want = brute_components({d: shingles(t, 2) for d, t in rows})
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, shingle=2).collect()}
    assert sum(got[d] != want[d] for d in want) <= 2  # pairs that share no table of the hundred
    assert len(set(want.values())) > 100


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    text, other = "a b c d e f g h i j k l", "q w e r t z u i o p"
    rows = [(1, text), (1, other), (None, text), (None, "x y z"), (7, other + " a"), (7, None), (None, "x y z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame, shingle=2).collect())
    assert got == Counter({(1, 1, True): 2, (None, 1, False): 1, (None, None, True): 2, (7, 1, False): 1, (7, 7, True): 1})


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (-8, 9), (9, 7), (7, 7), (2, 1)], "x long, y long")
    assert {r.node: r.component for r in near_dedup.components(links).collect() if r.node != r.component} == {2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: -8, 9: -8}


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def test_bpe_is_the_library_s(spark, docs):
    tokenizer = library()
    got = {r.doc_id: r for r in queries.op6_bpe(spark, SF).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
        )


def test_bpe_edges(odd, none):
    tokenizer = library()
    for r, (_, text, *_) in zip(bpe.encode(odd, bpe.default_tokenizer()).collect(), ODD, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode(none, bpe.default_tokenizer()).count() == 0
    rng = np.random.default_rng(3)
    mixed = ["".join(chr(c) for c in rng.choice([9, 10, 13, 32, 32, 97, 115, 39, 48, 0x1C, 0x85, 0xA0, 0x3000, 0xE9, 0xB2, 0x660, 0x4E2D, 0x1F600], 40)) for _ in range(400)]
    encoder = bpe.encoder(bpe.default_tokenizer())
    want = tokenizer.encode_batch(mixed, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_batch(mixed)] == [w.ids for w in want]


def test_exact_duplicates_edges(odd, none):
    rows = exact_dedup.exact_duplicates(odd).collect()
    blank = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert {r.keep_id for r in blank} == {3} and [r.kept for r in sorted(blank, key=lambda r: r.doc_id)] == [False, False, True]
    assert all(r.text_sha256 == hashlib.sha256(b"").hexdigest() and r.group_size == 3 for r in blank)
    ones = [r for r in rows if r.doc_id in (4, 5)]
    assert {(r.keep_id, r.group_size) for r in ones} == {(4, 3)}
    assert exact_dedup.drop_duplicates(odd).count() == 6 and exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_duplicates(odd).columns == odd.columns


def test_digest_index_goes_on(spark):
    first = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "ab"), (4, "d"), (5, "d ")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, scratch_folder(spark, "index"))
    exact_dedup.exact_duplicates(first, index).collect()
    index.close()
    again = exact_dedup.DigestIndex(spark, index.folder)
    rows = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(second, again).collect()}
    assert rows == {3: (1, False), 4: (5, False), 5: (5, True)} and spark.table(again.table).count() == 3
    once_more = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(second, again).collect()}
    assert once_more == rows and spark.table(again.table).count() == 3  # a batch that comes twice is the same batch
    assert {r.doc_id: r.kept for r in exact_dedup.exact_duplicates(first, again, batch="other").collect()} == {1: False, 2: False}
    again.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index")]
    assert exact_dedup.DigestIndex.buckets_for(10) == 32 and exact_dedup.DigestIndex.buckets_for(10**9) == 512


def test_digest_index_keeps_the_buckets_that_it_has(spark):
    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    for first, then in ((64, 32), (32, 64), (8, 8)):
        index = exact_dedup.DigestIndex(spark, scratch_folder(spark, "index"), buckets=first)
        exact_dedup.exact_duplicates(texts, index, batch="one").collect()
        index.close()
        again = exact_dedup.DigestIndex(spark, index.folder, buckets=then)
        assert exact_dedup.exact_duplicates(texts, again, batch="two").filter("kept").count() == 0 and again.buckets == first
        again.close()


def test_digest_index_after_retries_and_other_content(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    def keepers(index):
        return sorted((r.keep_id, r.group_size) for r in index.keepers().collect())

    index = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.exact_duplicates(frame((1, "a"), (2, "b")), index, batch="one").collect()
    later = lambda: {r.doc_id: r.kept for r in exact_dedup.exact_duplicates(frame((3, "a  "), (4, "c")), index, batch="two").collect()}
    assert later() == {3: False, 4: True} == later()
    assert keepers(index) == [(2, 1), (3, 2), (4, 1)]  # the longer one of a later batch stays over all
    exact_dedup.exact_duplicates(frame((5, "x"), (6, "c")), index, batch="one").collect()  # other content in its place
    assert keepers(index) == [(3, 1), (4, 2), (5, 1)]
    assert later() == {3: True, 4: False}  # 6 of batch one is known, and stood first when two came again
    assert keepers(index) == [(3, 1), (4, 2), (5, 1)]
    index.close()


def test_batches_through_the_index_equal_one_pass(spark, docs, odd, none):
    for frame in (docs.select("doc_id", "text"), odd.select("doc_id", "text"), odd, none):
        one, several = (sorted(map(tuple, f(frame).collect()), key=str) for f in (exact_dedup.exact_duplicates, lambda f: exact_dedup.exact_duplicates_in_batches(f, 3)))
        assert one == several


def test_scratch_tables_leave_nothing(spark, docs, tmp_path):
    some = docs.limit(120)
    with scratch_tables():
        made = [exact_dedup.exact_duplicates_in_batches(some, 2), near_dedup.near_duplicates(some), token_counts.count_tokens(some, token_counts.default_tokenizer()), url_filter.filter_urls(spark.createDataFrame([("http://a.b/c",)], "url string"))]
        assert all(df.count() for df in made)
        folders = [f for _, f in _owned.get()]
        assert folders and any(os.path.exists(f.removeprefix("file:")) for f in folders)
    assert not any(os.path.exists(f.removeprefix("file:")) for f in folders)


def test_exact_duplicates_of_string_ids(spark):
    frame = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", None)], "doc_id string, text string")
    assert {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(frame).collect()} == {"a": ("b", 2), "b": ("b", 2), "c": ("c", 1)}


def test_language_held_out_accuracy(spark, docs):
    rows = queries.op8_language_id(spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r.held_out and re.search(r"[^\W\d_]", r.text or "")]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and (r.held_out == (crc(r.doc_id, 4) == 2)) for r in rows)


def test_language_edges(odd, none):
    rows = language_id.predict_language(odd, language_id.train_language(odd)).collect()
    said = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(ODD) and said[1] == said[2] == said[3] == ("und", 0.0)
    assert language_id.predict_language(none, language_id.train_language(none)).count() == 0
    assert {r.lang_pred for r in language_id.predict_language(odd, language_id.train_language(none)).collect()} == {"und"}
    found, count = language_id.gram_counts("ab" * 100_000)
    assert count.sum() == 3 * 200_000 - 3


def test_visibility_is_inherited_and_can_come_back():
    page = html_text.page_text
    assert page('<p>a<span style="visibility:hidden">b<b style="visibility: visible">c</b>d</span>e</p>') == "a c e"
    assert page('<div style="display:none">a<b style="visibility:visible">b</b></div>c') == "c"
    assert page('<ul style="visibility:hidden"><li>a<li style="visibility:visible">b</ul>') == "- b"
    assert page('<table style="visibility:hidden"><tr><td>a<td style="visibility:visible">b</table>') == "b"
    assert page('<table><tr style="visibility:collapse"><td>a<td>b<tr><td>c<td>d</table>') == "c  d"


def test_numbers_of_items():
    page = html_text.page_text
    assert page("<ol><li>a<li value=9>b<li>c</ol>") == "1. a\n9. b\n10. c"
    assert page("<ol reversed><li>a<li>b<li>c</ol>") == "3. a\n2. b\n1. c"
    assert page("<ol reversed start=10><li>a<li value='4x'>b<li value=x>c</ol>") == "10. a\n4. b\n3. c"
    assert page("<ol start='-1'><li>a<li>b</ol>") == "-1. a\n0. b"
    assert page(f"<ol><li value={'9' * 5000}>a</ol>").endswith("a")


def test_spans_down_take_no_room():
    began = time.perf_counter()
    assert html_text.page_text("<table>" + "<tr><td rowspan=60000>" * 3000 + "</table>") == ""
    assert time.perf_counter() - began < 5
    assert html_text.page_text("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a  b\n   c\nd  e"


def test_temperature_without_a_bound():
    rng = np.random.default_rng(9)
    for scale in (0.01, 1.0, 30.0):
        true = rng.normal(size=(400, 3))
        y = np.array([rng.choice(3, p=np.exp(z) / np.exp(z).sum()) for z in true])
        logits = true * scale
        found = language_id.fit_temperature(logits, y)
        loss = lambda t: language_id.losses(logits, y, t).sum() + 0.5 * np.log(t) ** 2
        grid = np.exp(np.linspace(np.log(scale) - 3, np.log(scale) + 3, 2001))
        assert loss(found) <= min(map(loss, grid)) + 1e-9 and abs(np.log(found / scale)) < 1
    sure = np.eye(3)[np.arange(30) % 3] * 50.0
    assert 0 < language_id.fit_temperature(sure, np.arange(30) % 3) < 100


def test_language_weights_are_sparse(docs):
    model = language_id.train_language(docs)
    seen = np.unique(np.concatenate([language_id.gram_counts(r.text or "")[0] for r in docs.select("text").limit(200).collect()]))
    assert model.sparsity(seen) > 0.5 and 0.05 < model.temperature < 10


def test_pu_gradient_against_finite_differences():
    rng = np.random.default_rng(4)
    s, t, prior = rng.normal(size=40), np.arange(40) < 12, 0.3
    fine = s - 3 * t
    for scores, sign in ((fine, None), (np.where(t, 6.0, -6.0) + 0.1 * s, -1)):
        positive, negative = quality_classifier.risks(scores, t, prior)
        assert (negative >= 0) == (sign is None)
        risk = (lambda z: sum(quality_classifier.risks(z, t, prior))) if sign is None else (lambda z: -quality_classifier.risks(z, t, prior)[1])
        steps = 1e-6 * np.eye(len(scores))
        want = [(risk(scores + e) - risk(scores - e)) / 2e-6 for e in steps]
        assert np.allclose(quality_classifier.risk_gradient(scores, t, prior), want, atol=1e-7)
    # by hand: the positive class weighs by the prior, the unlabelled rows by one
    assert np.isclose(sum(quality_classifier.risks(np.zeros(40), t, prior)), np.log(2) * (prior + 1 - prior))


def test_ftrl_against_a_plain_loop():
    rng = np.random.default_rng(6)
    rows = [("abc"[i % 3], np.sort(rng.choice(50, 6, replace=False)) + 10 * (i % 3), rng.integers(1, 4, 6)) for i in range(40)]
    alpha, beta, l1, l2, epochs, seed = 0.5, 1.0, 0.02, 0.1, 2, 3
    model = language_id.fit_language(rows, alpha, beta, l1, l2, epochs, seed)
    train = [r for i, r in enumerate(rows) if i % 5 != 4]
    have = Counter(g for _, found, _ in train for g in found.tolist())
    idf = {g: math.log((1 + len(train)) / (1 + have[g])) + 1 for g in range(80)}
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return -math.copysign(abs(z[key]) - l1, z[key]) / ((beta + math.sqrt(n[key])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(train)):
            lang, found, count = train[i]
            x = {g: (1 + math.log(c)) * idf[g] for g, c in zip(found.tolist(), count.tolist())}
            norm = math.sqrt(sum(v * v for v in x.values()))
            x = {g: v / norm for g, v in x.items()} | {"bias": 1.0}
            w = {(g, k): weight((g, k)) for g in x for k in "abc"}
            e = {k: math.exp(sum(v * w[g, k] for g, v in x.items())) for k in "abc"}
            for k in "abc":
                miss = e[k] / sum(e.values()) - (k == lang)
                for g, v in x.items():
                    step = (math.sqrt(n[g, k] + (v * miss) ** 2) - math.sqrt(n[g, k])) / alpha
                    z[g, k] += v * miss - step * w[g, k]
                    n[g, k] += (v * miss) ** 2
    for k, name in enumerate(model.languages):
        assert np.allclose(model.weights[:80, k], [weight((g, name)) for g in range(80)], atol=1e-6) and np.isclose(model.bias[k], weight(("bias", name)))
    assert (model.weights[:80] == 0).any() and not model.weights[80:].any()


def test_language_of_string_ids(spark):
    rows = [(f"d{i}", ("der und die das " if i % 2 else "the and of a ") * 5, "de" if i % 2 else "en") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    said = language_id.predict_language(frame, language_id.train_language(frame)).collect()
    assert {r.doc_id: r.lang_pred for r in said} == {d: lang for d, _, lang in rows}


def test_flat_trees_against_recursion():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4))
    model = gbt_rules.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), [0, 0, -1, 1], trees=20)

    def walk(node, row):
        if model.left[node] == node:
            return model.value[node]
        return walk(model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node], row)

    want = [1 / (1 + math.exp(-model.bias - sum(walk(root, row) for root in model.roots))) for row in x]
    assert np.allclose(model.scores(x), want)


def test_chat_round_trip(spark):
    nasty = ["a\\b", "\\c\\n\\\\", "<|im_start|>user\nx<|im_end|>\n", "[INST][/INST]</s>", "", None, "<<|im_end|>", "<|im_end", "\n"]
    rows = [(i, t, role, text) for i, text in enumerate(nasty) for t, role in enumerate(("user", "assistant"))]
    rows += [(50, 1, "assistant", "b"), (50, 0, "a\nb<|im_end|>", "a"), (50, None, None, "z"), (None, 0, "user", "q"), (51, 0, "user", "same"), (51, 0, "user", "same")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(frame)).collect()}
    for i, text in enumerate(nasty):
        assert [(t.role, t.text) for t in got[i].turns] == [("user", text or ""), ("assistant", text or "")]
        assert got[i].loss_text == (text or "") and got[i].valid
        inner = got[i].segments[1].text + got[i].segments[4].text
        assert not any(c in inner for c in chat_format.ChatTemplate().controls)
    assert [(t.role, t.text) for t in got[50].turns] == [("", "z"), ("a\nb<|im_end|>", "a"), ("assistant", "b")]
    assert not got[50].valid and got[50].bad_turn == 0 and not got[51].valid and got[51].bad_turn == 1 and got[None].bad_turn == 1
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), (None, ""), ("plain & simple &lt;x&gt;", "plain & simple <x>"),
        ("<p>One<p>Two<br>three</p>", "One\n\nTwo\nthree"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n\n  - c"),
        ("<ol start=3><li>x</li><li>y</li></ol>", "3. x\n4. y"),
        ("<table><tr><th>name<th>n<tr><td>ab<td>1<tr><td>abcdef<td>22</table>", "name    n\nab      1\nabcdef  22"),
        ("<script>x<p>y</script><style>p{}</style><p style='display: none'>no<p hidden>no<p>yes", "yes"),
        ("<title>t</title><!-- c --><h1>H</h1>  some <b>bold</b>\n text", "H\n\nsome bold text"),
        ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("<a href='x>y'>link</a>", "link"), ("a < b", "a < b"), ("</p>x</div>", "x"),
    ],
)
def test_html_layout(page, text):
    assert html_text.page_text(page or "") == text


def test_html_edges(spark, none):
    deep = "<div>" * 5000 + "x" + "<ul><li>" * 3000 + "y"
    frame = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (3, deep, "t"), (3, "<p>x", "t"), (None, "<p>x", "t")], "page_id long, html string, text string")
    rows = html_text.extract_text(frame).collect()
    assert len(rows) == 5 and rows[3].text == "x" and "x" in rows[2].text and "y" in rows[2].text
    assert html_text.extract_text(frame.limit(0)).count() == 0


def test_html_of_deep_and_broken_pages():
    """Linear in the page's length: deep blocks, lists, unclosed quotes and tags; spans in tables."""
    began = time.time()
    deep = html_text.page_text("<p>a<table><tr><td>" + "<div>" * 100_000 + "x")
    assert deep.split() == ["a", "x"]
    lists = html_text.page_text("".join(f"<ul><li>{i}" for i in range(2000))).split("\n")
    lists = [line for line in lists if line]
    assert len(lists) == 2000 and lists[1999].strip() == "- 1999" and lists[3] == "      - 3"
    assert html_text.page_text("<a title='" * 50_001 + "x") == "<a title='" * 50_001 + "x"
    assert html_text.page_text("<a title=it's>don't</a> say <i x=\">\">so</i> <b y='>now") == "don't say so now"
    assert html_text.page_text("<!" * 100_000 + "<p" * 100_000).startswith("<!<!")
    assert html_text.page_text("a<!-->b<!-- c -->d<!-- e") == "abd"
    assert time.time() - began < 60
    page = "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td colspan=2>long cell</td><td>d</td></tr></table>"
    assert html_text.page_text(page).split("\n") == ["a          b", "           c", "long cell     d"]


def brute_visible(page):
    """The page's words in order, without layout: tags, comments and unseen elements cut out; inline tags part no words."""
    import html

    page = re.sub(r"(?s)<!--.*?-->", "", page)
    page = re.sub(r"(?s)<(script|style|head|title|noscript|template)\b.*?</\1>", "", page)
    page = re.sub(r"(?s)</?(a|b|i|em|strong|span|code|u)\b[^>]*>", "", page)
    return html.unescape(re.sub(r"(?s)<[^>]*>", " ", page)).split()


def test_html_words_in_order_against_brute_force(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op10_html_text(spark, SF).collect():
        assert re.sub(r"(?m)^ *(- |\d+\. )+", "", r.text).split() == brute_visible(pages[r.page_id])
        lines = r.text.split("\n")
        for item in re.findall(r"(?s)<li>([^<]+)", pages[r.page_id]):  # items of plain text have a line and a mark of their own
            assert any(line.strip() == f"- {' '.join(item.split())}" for line in lines) or not item.strip() or "&" in item


def test_merged_components_equal_components_of_all_links(spark):
    old, new = [(1, 2), (2, 3), (10, 11), (20, 21)], [(3, 11), (30, 31), (11, 30), (40, 41)]
    frame = lambda rows: spark.createDataFrame(rows, "x long, y long")
    at_once = near_dedup.components(frame(old + new)).collect()
    comps = {r.node: r.component for r in near_dedup.components(frame(old)).collect()}
    between = spark.createDataFrame([(comps.get(x, x), comps.get(y, y)) for x, y in new], "c_x long, c_y long")
    in_turn = near_dedup.merged_components(near_dedup.components(frame(old)), between, Scratch(spark)).collect()
    assert sorted(in_turn) == sorted(at_once) and {(r.node, r.component) for r in in_turn} >= {(31, 1), (21, 20), (41, 40)}


def test_a_turn_pairs_each_node_once_and_the_rest_joins_all(spark):
    """12 nodes of one bucket: at most one pair a node, of different components; the exact join finds every close pair once."""
    rows = [(1, i, 10, 1, i % 5) for i in range(12)] + [(2, 50, 10, 1, 50), (2, 51, 100, 1, 51)]
    frame = spark.createDataFrame(rows, "bucket long, node long, n long, weight long, component long")
    hold = Scratch(spark)
    crowded, heads = near_dedup.crowded_buckets(frame.drop("component"), frame.select("node", "component").distinct(), 0, hold)
    pairs = near_dedup.nearest_heads(crowded, heads, 80).collect()
    head = heads.filter("bucket = 1").first()
    assert sorted(p.x for p in pairs) == [i for i in range(12) if i % 5 != head.head_component]
    assert all(p.c_x != p.c_y and p.y == head.head for p in pairs)
    sets = {i: set(range(100)) - {i} for i in range(12)} | {50: set(range(500, 600)), 51: set(range(530, 630))}
    made = spark.createDataFrame([(i, [x * 7919 for x in s]) for i, s in sets.items()], "node long, shingles array<long>")
    for block in (2, 1000):
        rest = near_dedup.remaining_links(crowded, heads, made, 80, hold, block)
        joined = {(r.c_x, r.c_y) for r in rest.collect()}
        assert {x for p in joined for x in p} == set(range(5)) and len(joined) <= 4 * 36


def test_shared_counts_and_spanning_links():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)]
    counts = near_dedup.shared_counts(sets, 16)
    assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40))
    comps = np.arange(40) // 2 * 2
    links = near_dedup.spanning_links(comps, sets, 30)
    close = {(comps[i], comps[j]) for i in range(40) for j in range(i + 1, 40) if 100 * counts[i, j] >= 30 * (len(sets[i]) + len(sets[j]) - counts[i, j])}
    roots = lambda pairs: components_of(pairs, set(comps.tolist()))
    assert roots([(comps[i], comps[j]) for i, j in links]) == roots(close) and len(links) < 20
    assert near_dedup.spanning_links(np.arange(2), [np.array([1, 2]), np.array([3])], 80) == []


def components_of(pairs, nodes):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates_among_many_texts_just_below_the_threshold(spark):
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(400):  # any two at 0.75, page i + 400 at 0.9 to page i
        texts[i] = base + [f"v{i}_{k}" for k in range(16)]
        if i % 80 == 0:
            texts[i + 400] = base + [f"v{i}_{k}" for k in range(9)] + [f"u{i}_{k}" for k in range(5)]
    sets = {i: shingles(" ".join(t), 2) for i, t in texts.items()}
    assert 0.7 <= len(sets[1] & sets[2]) / len(sets[1] | sets[2]) < 0.8
    want = brute_components(sets)
    assert sum(want[i] != i for i in want) == 5
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = near_dedup.near_duplicates(frame, shingle=2, tables=1, width=1, seed=3).collect()  # one bucket holds 333 of them, and every pair
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_duplicates_beside_texts_of_other_lengths(spark):
    base = [f"w{i}" for i in range(200)]
    texts = {i: base[:100] + [f"v{i}_{k}" for k in range(3)] for i in range(60)}
    for k in range(2):  # two long texts in a bucket of shorter variants
        texts[100 + k] = base[: 150 + 10 * k] + [f"x{k}"] + base[151 + 10 * k :]
    texts = {i: " ".join(t) for i, t in texts.items()}
    want = brute_components({i: shingles(t, 2) for i, t in texts.items()})
    assert want[101] == 100
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for seed in (9, 19, 43):  # all of them are in one bucket
        got = near_dedup.near_duplicates(frame, shingle=2, tables=1, width=1, seed=seed).collect()
        assert {r.doc_id: r.component_id for r in got} == want


def test_html_without_optional_tags_and_deeply_nested():
    assert html_text.page_text("<html><head><title>t</title><p>text") == "text"
    assert html_text.page_text("<head><meta charset=a> <style>b</style> text<title>t</title> more") == "text more"
    assert html_text.page_text("<p aria-hidden=true>seen</p><p hidden>not") == "seen"
    deep = html_text.page_text("<ul><li>a<br>b" * 600)
    assert deep.split() == ["-", "a", "b"] * 600 and len(deep.splitlines()) > 1200
    assert html_text.page_text("<table><tr><td>" * 600 + "<div>a</div>b<tr><td>x<td>y").split("\n") == ["a", "b", "x  y"]
