"""Every stage of the pipeline against brute force on its own input."""

import re

import pytest

import corpus_pipeline
from tests.llm.test_corpus import WORD, brute_components, library, shingles
from tickloom.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialise(stage(spark, docs, SF), name)
    return out


def test_columns_and_counts(stages):
    for name in ("quality", "exact_dedup", "near_dedup", "mixing"):
        assert stages[name].columns == stages["documents"].columns
    assert stages["bpe"].count() == stages["mixing"].count()


def test_quality_keeps_clean_documents(spark, stages):
    kept = {r.doc_id for r in stages["quality"].collect()}
    rows = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, junk = ([r.doc_id in kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.97 and sum(junk) / max(1, len(junk)) < 0.3


def test_exact_stage(stages):
    best = {}
    for r in stages["quality"].collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in stages["exact_dedup"].collect()) == sorted(d for _, d in best.values())


def test_near_stage(stages):
    sets = {r.doc_id: shingles(r.text, 5) for r in stages["exact_dedup"].collect()}
    want = sorted(d for d, c in brute_components(sets).items() if d == c)
    assert sorted(r.doc_id for r in stages["near_dedup"].collect()) == want


def test_mixing_stage(stages):
    size = sum(len(WORD.findall(r.text or "")) for r in stages["near_dedup"].collect())
    taken = sum(len(WORD.findall(r.text)) for r in stages["mixing"].collect())
    assert abs(taken - 1.5 * size) <= 256 * 2 * 20


def test_encoding_stage(stages):
    tokenizer = library()
    want = sorted(len(tokenizer.encode(r.text, add_special_tokens=False).ids) for r in stages["mixing"].collect())
    assert sorted(r.n_tokens for r in stages["bpe"].collect()) == want


ODD = [
    (1, None, "en", None, None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "one", "en", None, 3), (5, "one", "en", "a", 3), (5, "one", "en", "a", 3),
    (5, "another text of the same id", "de", "b", 27), (None, "no id here at all", "en", "b", 17), (None, "no id here at all but two", "en", "b", 25), (7, "word and word again " * 20_000, "en", "b", 400_000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["score", "predicted", "kept", "kept_id", "group", "node", "row", "draws", "mix_pass", "mix_shard", "nth", "digest", "size", "at", "text_key", "a.b"]


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, stage):
    """Nulls, blanks, repeated rows and ids, a very long text, further columns of clashing names, an empty table."""
    run = dict(corpus_pipeline.STAGES)[stage]
    docs = spark.createDataFrame([(*r, *range(len(CLASHES))) for r in ODD], SCHEMA + "".join(f", `{c}` long" for c in CLASHES))
    out = run(spark, docs, SF)
    rows = out.collect()
    if stage != "bpe":
        assert out.columns == docs.columns and all(r["a.b"] == len(CLASHES) - 1 for r in rows)
    texts = [r.text for r in rows] if stage != "bpe" else []
    if stage == "exact_dedup":
        assert sorted(r.doc_id or -1 for r in rows) == [-1, -1, 3, 4, 5, 7]
    if stage == "near_dedup":
        assert texts.count(None) == 1 and texts.count("") == 1 and texts.count("one") == 1 and len(rows) == 8
    if stage == "mixing":
        assert all(WORD.search(t) for t in texts)
    if stage == "bpe":
        assert len(rows) == len(ODD)
    empty = run(spark, docs.limit(0), SF)
    assert empty.columns == out.columns and empty.count() == 0

