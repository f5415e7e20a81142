"""The registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, chat_format, exact_dedup, gbt_rules, html_text, language_id, mixing, near_dedup, quality_classifier, token_alignment, token_counts, url_filter, whitening
from tickloom.llm.folds import in_fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score_quality(docs, model)
    return scored.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """shares: the words that each shard and pass of the splitting tree takes of the document, as shard:pass:words."""
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    shares = F.array_join(F.transform("parts", lambda p: F.concat_ws(":", p["shard"].cast("string"), p["pass"].cast("string"), p["words"].cast("string"))), ",")
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.size("parts").cast("long").alias("n_parts"), shares.alias("shares"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return gbt_rules.judge(docs, gbt_rules.train_rules(docs, table(spark, sf_dir, "labels")))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2).drop("group", "text_key")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe.default_tokenizer())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches through one index, which is opened anew for each."""
    return exact_dedup.exact_duplicates_in_batches(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    said = language_id.predict_language(docs, language_id.train_language(docs))
    return said.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    made = chat_format.read_back(chat_format.format_conversations(talks.unionByName(own)))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "html"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), *token_alignment.default_tokenizers())


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries through one cache: what the first has counted the second does not encode again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_deliveries(docs, token_counts.default_tokenizer(), deliveries=2)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    made = (
        op1_quality, op2_mixing, op3_url_filter, op4_quality_rules, op5_near_dedup, op6_bpe, op7_exact_dedup, op8_language_id, op9_chat_format, op10_html_text,
        op11_token_alignment, op12_token_counts, op13_whitening, pipeline,
    )
    return {f.__name__: f for f in made}


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op3_sql() -> str:
    sites = sorted((r for r in url_filter.SITE_RULES), key=lambda r: -len(r.name))
    words = sorted(url_filter.WORD_RULES, key=lambda r: r.name)
    rule = " ".join(f"WHEN regexp_matches(host || path, {_sql(r.pattern)}) THEN {_sql(r.name)}" for r in sites)
    action = " ".join(f"WHEN rule = {_sql(r.name)} THEN {_sql(r.action)}" for r in sites)
    word = " ".join(f"WHEN regexp_matches(host || path, {_sql(r.pattern)}) THEN {_sql(r.name)}" for r in words)
    word_action = " ".join(f"WHEN word_rule = {_sql(r.name)} THEN {_sql(r.action)}" for r in words)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {rule} END AS rule, CASE {word} END AS word_rule FROM h)
SELECT page_id, host, path, rule, coalesce(CASE {action} END, CASE {word_action} END, 'allow') AS verdict, word_rule FROM r"""


def _op9_sql() -> str:
    t = chat_format.ChatTemplate()

    def broken(text: str) -> str:
        text = f"replace({text}, '\\', '\\b')"
        for c in t.controls:
            text = f"replace({text}, {_sql(c)}, {_sql(c[0] + chr(92) + 'c' + c[1:])})"
        return text

    marks = len(t.opening) + 1 + len(t.closing) + 1
    losses = ", ".join(map(_sql, t.loss_roles))
    moves = " OR ".join(f"(was = {_sql(a)} AND role IN ({', '.join(map(_sql, b))}))" for a, b in t.moves.items())
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (SELECT *, lag(role, 1, {_sql(t.start)}) OVER o AS was, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role IN ({losses})), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role IN ({losses})), '')) AS loss_sha256,
       sum(length(replace({broken('role')}, chr(10), '\\n')) + length({broken('text')}) + {marks})::BIGINT AS formatted_chars,
       bool_and({moves}) AND bool_or(back = 1 AND role IN ({', '.join(map(_sql, t.final))})) AS valid
FROM w GROUP BY conv_id"""


OP7_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": _op3_sql(), "op7_exact_dedup": OP7_SQL, "op9_chat_format": _op9_sql()}
