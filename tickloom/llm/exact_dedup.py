"""Exact duplicates through a persistent index of digests.

The index is a Parquet table bucketed and sorted by digest, one row per different text, partitioned by
the batch that brought it, with the batch's best candidate to stay and the number of its rows. A batch is
aggregated to its own different digests, which sort-merge anti-joins against the index (whose buckets need
no shuffle) part into known and new; the new ones are appended to it, the known ones to a record of
repeats beside it. Who stays of a text over all batches is an aggregate over both. A batch that comes
again, after a lost driver say, replaces its own rows and is judged against the other batches only, so
that its result is the same as before; one that is replaced by other content leaves nothing behind, as the
record holds what other batches had of its texts: `keepers` gives at any time what stays of what there is.

Texts are equal if they are the same after every character of [\x20\x09-\x0D] is deleted; null
counts as empty. Of equal texts the one with the most code points, then the smallest doc_id stays.
Defined cases: rows equal in id and length within a group all count as the row that stays
(`drop_duplicates` keeps one); a null doc_id comes before others; an empty table gives an empty result;
extra columns are ignored; group_size counts the equal rows of all batches in `exact_duplicates_in_batches`
and of the batch at hand in `exact_duplicates`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.digest_table import DigestTable, buckets_for
from tickloom.session import Scratch, delete_folder, scratch_folder

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the text as it is), digest (SHA-256 of the normalised text)."""
    return docs.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"), F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest")
    )


def group_digests(rows: DataFrame) -> DataFrame:
    """One row per digest; map-side partial aggregates keep a hot digest small."""
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id")))
    groups = rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
    return groups.select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"), "group_size")


def best(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_chars, group_size of candidates with these columns."""
    first = F.min(F.struct((-F.col("keep_chars")).alias("less"), F.col("keep_id"))).alias("best")
    groups = rows.groupBy("digest").agg(first, F.sum("group_size").alias("group_size"))
    return groups.select("digest", F.col("best.keep_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"), "group_size")


def _columns(id_type: str) -> str:
    return f"keep_id {id_type}, keep_chars BIGINT, group_size BIGINT"


class DigestIndex:
    """An index in `folder`; opening a folder that has one goes on with it, in the buckets that it has.

    Without a folder the index lives in the scratch folder until close. id_type is that of doc_id; where it
    isn't given, the first batch says it.
    """

    buckets_for = staticmethod(buckets_for)

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = 32, id_type: str | None = None):
        self.spark, self.own, self.typed = spark, folder is None, id_type is not None
        self.folder = folder or scratch_folder(spark, "digest-index")
        kind = _columns(id_type or "bigint")
        self.texts = DigestTable(spark, kind, folder=self.folder, buckets=buckets, name="digest_index")
        self.repeats = DigestTable(spark, kind, folder=f"{self.folder.rstrip('/')}-repeats", buckets=buckets, name="digest_index_repeats")

    @property
    def table(self) -> str:
        return self.texts.name

    @property
    def buckets(self) -> int:
        return self.texts.open().buckets

    def keepers(self) -> DataFrame:
        """Per digest the row that stays of all batches (keep_id, keep_chars) and how many there are (group_size)."""
        return best(self.texts.rows().drop("batch").unionByName(self.repeats.rows().drop("batch")))

    def add(self, rows: DataFrame, batch: str | None = None, hold: Scratch | None = None, judged: bool = True) -> DataFrame | None:
        """Index the digests of a batch; returns its groups, if they are asked for: digest, keep_id, keep_chars, group_size, new.

        batch names it; without a name its own content does, so that the same rows are the same batch.
        """
        hold = hold or Scratch(self.spark)
        keep = lambda df, name: hold.write(df.coalesce(self.buckets), name, plain=True)
        if not self.typed and not self.texts.ready:
            self.texts.columns = self.repeats.columns = _columns(rows.schema["doc_id"].dataType.simpleString())
        if batch is None:
            said = rows.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("digest", "doc_id", "n_points")).alias("x"), F.bit_xor(F.xxhash64("n_points", "doc_id", "digest", F.lit(1))).alias("y")).first()
            batch = f"{said['n']}-{said['x'] or 0}-{said['y'] or 0}"
        groups = keep(group_digests(rows), "groups")
        others = [t.rows().filter(F.col("batch") != batch).drop("batch") for t in (self.texts, self.repeats)]  # what other batches brought
        fresh = groups
        for known in others:
            fresh = fresh.join(known.hint("merge"), "digest", "left_anti")
        fresh = keep(fresh, "fresh")
        seen = groups
        for k, known in enumerate(others):
            first = best(known).select("digest", F.struct((-F.col("keep_chars")).alias("less"), F.col("keep_id").alias("id")).alias(f"known{k}"))
            seen = seen.join(first.hint("merge"), "digest", "left")
        seen = seen.withColumn("known", F.least("known0", "known1")).filter("known is not null")
        seen = keep(seen.select("digest", "keep_id", "keep_chars", "group_size", F.col("known.id").alias("known_id")), "seen")
        self.texts.put(fresh, batch=batch)
        self.repeats.put(seen.drop("known_id"), batch=batch)
        hold.drop(groups)
        if not judged:
            hold.drop(fresh, seen)
            return None
        stands = seen.select("digest", F.col("known_id").alias("keep_id"), "keep_chars", "group_size", F.lit(False).alias("new"))
        return fresh.withColumn("new", F.lit(True)).unionByName(stands)

    def close(self) -> None:
        """Forget the tables' names; their files stay, unless the caller named no folder."""
        for table in (self.texts, self.repeats):
            table.close()
            if self.own:
                delete_folder(self.spark, table.folder)


def _judged(docs: DataFrame, index: DigestIndex | None, batch: str | None) -> tuple[DataFrame, DataFrame]:
    """The batch's digests per row and its groups."""
    hold = Scratch(docs.sparkSession)
    rows = hold.write(digests(docs), "digests", plain=True)
    used = index or DigestIndex(docs.sparkSession, buckets=buckets_for(rows.count()))
    groups = used.add(rows, batch, hold)
    if index is None:
        used.close()
    return rows, groups


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """docs -> doc_id, keep_id, group_size, kept, text_sha256, one row per document.

    Rows whose text another batch of the index brought have that batch's keep_id and are not kept.
    """
    rows, groups = _judged(docs, index, batch)
    kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_chars"))
    return rows.join(groups, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_duplicates_in_batches(docs: DataFrame, batches: int = 4, folder: str | None = None) -> DataFrame:
    """As exact_duplicates, over one index that takes docs batch by batch, dealt by id, and is opened anew for each.

    Who stays, and of how many, is read from the index once it holds all batches.
    """
    spark, hold = docs.sparkSession, Scratch(docs.sparkSession)
    rows = hold.write(digests(docs).withColumn("turn", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")), "digests", plain=True)
    folder = folder or scratch_folder(spark, "digest-index")
    buckets, id_type = buckets_for(rows.count()), docs.schema["doc_id"].dataType.simpleString()
    for k in range(batches):
        index = DigestIndex(spark, folder, buckets, id_type)
        index.add(rows.filter(F.col("turn") == k).drop("turn"), f"batch-{k}", hold, judged=False)
        index.close()
    keepers = DigestIndex(spark, folder, buckets, id_type).keepers().hint("merge")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_chars"))
    return rows.join(keepers, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """docs without the rows whose text another row that stays has; all columns stay."""
    _, groups = _judged(docs, index, batch)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
    )
    stay = groups.filter("new").select("digest", "keep_id", "keep_chars")
    joined = keyed.join(stay, (keyed["digest"] == stay["digest"]) & keyed["id"].eqNullSafe(stay["keep_id"]) & (keyed["points"] == stay["keep_chars"])).select(keyed["digest"], "row")
    return joined.groupBy("digest").agg(F.first("row").alias("row")).select("row.*")
