"""Statistics that validate event windows: mutual information, edges, concordance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.expressions import binned, by, correlation, ratio
from tickloom.session import materialise

#: Candidate windows (days before, days after).
WINDOWS = ((0, 0), (1, 0), (0, 1), (1, 1), (2, 1), (1, 2), (2, 2), (3, 1), (1, 3), (3, 2), (2, 3), (3, 3))


def equal_width_bin(df: DataFrame, x: str, bins: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """x_bin over the range of x, within keys if given; the ranges are a small aggregate joined back."""
    if keys:
        span = df.groupBy(*keys).agg(F.min(x).alias("lo_"), F.max(x).alias("hi_"))
        df = df.join(span, list(keys))
    else:
        df = df.join(F.broadcast(df.agg(F.min(x).alias("lo_"), F.max(x).alias("hi_"))))  # one row
    return df.withColumn(f"{x}_bin", binned(F.col(x), F.col("lo_"), F.col("hi_"), bins)).drop("lo_", "hi_")


def _cells(df: DataFrame, x: str, y: str, keys: list[str]) -> DataFrame:
    """Joint counts of (x, y) with both margins and the total, per keys."""
    cells = df.groupBy(*keys, x, y).agg(F.count("*").alias("nxy"))
    return cells.withColumns({
        "nx": F.sum("nxy").over(Window.partitionBy(*keys, x)), "ny": F.sum("nxy").over(Window.partitionBy(*keys, y)), "n": F.sum("nxy").over(Window.partitionBy(*keys)),
    })


def _mi() -> Column:
    return F.sum(F.col("nxy") / F.col("n") * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny"))))


def contingency_mi(df: DataFrame, x: str, y: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mutual information in nats of two discrete columns."""
    return _cells(df, x, y, list(keys)).groupBy(*keys).agg(F.greatest(F.lit(0.0), _mi()).alias("mi"))


def mutual_info(df: DataFrame, features: list[str], y: str, bins: int = 10, least: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean over the features of the information that their bins have on y's; a feature needs over `least` rows."""
    long = df.select(*keys, F.col(y).cast("double").alias("y"), *[F.col(f).cast("double").alias(f) for f in features]).unpivot([*keys, "y"], features, "feature", "x")
    long = long.filter("x is not null and y is not null").withColumn("rows_", F.count("*").over(Window.partitionBy(*keys, "feature"))).filter(F.col("rows_") > least)
    group = (*keys, "feature")
    cut = equal_width_bin(equal_width_bin(long, "x", bins, group), "y", bins, group)
    each = contingency_mi(cut, "x_bin", "y_bin", group)
    return each.groupBy(*keys).agg(F.avg("mi").alias("mi"), F.count("*").alias("features"))


def normalized_mi(df: DataFrame, x: str, y: str, average: str = "arithmetic") -> DataFrame:
    """Mutual information over a mean of the two entropies."""
    cells = _cells(df, x, y, [])
    entropy = lambda m: -F.sum(F.col("nxy") / F.col("n") * F.ln(F.col(m) / F.col("n")))
    out = cells.agg(_mi().alias("mi"), entropy("nx").alias("hx"), entropy("ny").alias("hy"))
    mean = {"arithmetic": (F.col("hx") + F.col("hy")) / 2, "geometric": F.sqrt(F.col("hx") * F.col("hy")), "max": F.greatest("hx", "hy"), "min": F.least("hx", "hy")}[average]
    return out.select("mi", "hx", "hy", F.coalesce(ratio(F.col("mi"), mean), F.lit(0.0)).alias("nmi"))


def mi_by_relative_day(events: DataFrame, day_features: DataFrame, closes: DataFrame, features: list[str], pre: int = 3, post: int = 3, ahead: int = 3, least_rows: int = 50) -> DataFrame:
    """Information of the features at event day + rel_day on the return over the next calendar days, per event and rel_day."""
    c = closes.select("ticker", "date", "c")
    base = events.join(c, ["ticker", "date"])
    later = c.select("ticker", F.date_add("date", -ahead).alias("date"), F.col("c").alias("later"))
    base = base.join(later, ["ticker", "date"]).select("ticker", "date", "event_type", (ratio(F.col("later"), F.col("c")) - 1).alias("ret"))
    spread = base.select("ticker", "event_type", "ret", F.col("date").alias("event_date"), F.explode(F.sequence(F.lit(-pre), F.lit(post))).alias("rel_day"))
    rows = spread.withColumn("date", F.date_add("event_date", F.col("rel_day"))).join(day_features, ["ticker", "date"])
    rows = materialise(rows.select("event_type", "rel_day", "ret", *features), "event-days")  # read once a feature
    counts = rows.groupBy("event_type", "rel_day").agg(F.count("*").alias("n_rows"))
    mi = mutual_info(rows, features, "ret", keys=("event_type", "rel_day"))
    return counts.join(mi, ["event_type", "rel_day"], "left").select("event_type", "rel_day", "n_rows", F.when(F.col("n_rows") >= least_rows, F.coalesce("mi", F.lit(0.0))).otherwise(0.0).alias("mi"))


def mi_scale(mi: DataFrame) -> DataFrame:
    """mi over the largest of its event."""
    return mi.withColumn("nmi", F.coalesce(ratio(F.col("mi"), F.max("mi").over(Window.partitionBy("event_type"))), F.lit(0.0)))


def suggest_window(mi: DataFrame, least: float = 0.1) -> DataFrame:
    """First and last relative day with at least this share of the event's largest information."""
    return mi_scale(mi).filter(F.col("nmi") >= least).groupBy("event_type").agg(F.min("rel_day").alias("first_day"), F.max("rel_day").alias("last_day"))


def window_grid(joined: DataFrame, windows=WINDOWS) -> DataFrame:
    """Rows joined at the widest reach (see joins.event_window_join), once per window they are in."""
    options = F.array(*[F.struct(F.lit(a).alias("pre_days"), F.lit(b).alias("post_days")) for a, b in windows])
    inside = F.filter(options, lambda w: (F.col("rel_day") >= -w["pre_days"]) & (F.col("rel_day") <= w["post_days"]))
    return joined.withColumn("w", F.explode(inside)).select(*joined.columns, "w.pre_days", "w.post_days")


def weighted_edge(df: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """Weighted mean return where the probability reaches the threshold."""
    taken = F.col("prob") >= threshold
    edge = ratio(F.sum(F.when(taken, F.col("ret_at_outcome") * F.col("weight"))), F.sum(F.when(taken, F.col("weight"))))
    return df.groupBy(*keys).agg(edge.alias("edge"), F.count("*").alias("n_bars"))


def window_model(df: DataFrame, features: list[str], least_rows: int = 100, holdout: float = 0.0, seed: int = 42, trees: int = 100, depth: int = 5) -> DataFrame:
    """Boosted trees on label > 0: one row with auc, edge, n_bars and n_days; null scores below least_rows.

    Rows with a null feature, label, return or weight take no part. Without a row at or above the
    probability the edge is 0. Scores are on the training rows unless holdout gives the share kept apart.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    data = df.dropna(subset=[*features, "label", "ret_at_outcome", "weight"]).withColumn("y", (F.col("label") > 0).cast("double"))
    names = dict.fromkeys([*features, "label", "ret_at_outcome", "weight", "y", "ticker", "date", "bar_no"])
    data = materialise(data.select(*names), "model-rows")  # counted, learned from and scored
    n, kinds, days = data.agg(F.count("*"), F.countDistinct("y"), F.countDistinct("ticker", "date")).first()
    counts = (F.lit(n).cast("long").alias("n_bars"), F.lit(days).cast("long").alias("n_days"))
    if n < least_rows or kinds < 2:
        return df.sparkSession.range(1).select(F.lit(None).cast("double").alias("auc"), F.lit(None).cast("double").alias("edge"), *counts)
    data = VectorAssembler(inputCols=features, outputCol="x", handleInvalid="keep").transform(data)
    apart = F.pmod(F.xxhash64("ticker", "date", "bar_no", F.lit(seed)), F.lit(1000)) < int(1000 * holdout)
    train, test = (data.filter(~apart), data.filter(apart)) if holdout else (data, data)
    model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.05, subsamplingRate=0.8, seed=seed).fit(train)
    scored = model.transform(test).withColumn("prob", vector_to_array("probability")[1])
    auc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction", weightCol="weight").evaluate(scored)
    return weighted_edge(scored, []).select(F.lit(float(auc)).alias("auc"), F.coalesce("edge", F.lit(0.0)).alias("edge"), *counts)


def window_score(results: DataFrame) -> DataFrame:
    """|edge| * auc / ln(n_bars), 0 for one bar or none, and the best window of each event."""
    bars = F.when(F.col("n_bars") > 1, F.ln("n_bars"))
    score = F.coalesce(F.abs(F.coalesce("edge", F.lit(0.0))) * F.coalesce("auc", F.lit(0.5)) / bars, F.lit(0.0))
    rank = F.row_number().over(by("event_type", F.desc("score"), "pre_days", "post_days"))
    return results.withColumn("score", score).withColumn("rank", rank).withColumn("best", F.col("rank") == 1)


def average_rank(df: DataFrame, x: str, out: str) -> DataFrame:
    """Ranks with ties at their mean; df is a table of windows, not of rows."""
    w = Window.orderBy(x)
    return df.withColumn(out, F.rank().over(w) + (F.count("*").over(Window.partitionBy(x)) - 1) / 2)


def spearman(pairs: DataFrame, least: int = 3) -> DataFrame:
    """Rank correlation of mi and edge, with the t statistic of its significance; null below `least` pairs."""
    clean = pairs.filter("mi is not null and edge is not null")
    ranked = average_rank(average_rank(clean, "mi", "r_mi"), "edge", "r_edge")
    out = ranked.agg(correlation(F.col("r_mi"), F.col("r_edge")).alias("rho"), F.count("*").alias("n"))
    rho = F.when(F.col("n") >= least, F.col("rho"))
    return out.select("n", rho.alias("rho"), (rho * F.sqrt(ratio((F.col("n") - 2).cast("double"), 1 - rho * rho))).alias("t"))


def hybrid_score(pairs: DataFrame, alpha: float = 0.6, quantile: float = 0.8) -> DataFrame:
    """alpha * scaled mi + (1 - alpha) * scaled edge, and whether it is at or above the quantile."""
    span = pairs.agg(*[f(c).alias(f"{n}_{c}") for c in ("mi", "edge") for n, f in (("lo", F.min), ("hi", F.max))])
    scaled = lambda c: (F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}") + 1e-10)
    scored = pairs.join(F.broadcast(span)).withColumn("hybrid", alpha * scaled("mi") + (1 - alpha) * scaled("edge")).select(*pairs.columns, "hybrid")
    cut = scored.agg(F.percentile("hybrid", quantile).alias("cut"))
    return scored.join(F.broadcast(cut)).withColumn("selected", F.col("hybrid") >= F.col("cut")).drop("cut")


def concordance_report(pairs: DataFrame) -> DataFrame:
    stats = pairs.agg(F.count("*").alias("n_windows"), *[f(c).alias(f"{n}_{c}") for c in ("mi", "edge") for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))])
    out = stats.join(F.broadcast(spearman(pairs).select("rho")))
    return out.withColumn("concordance", F.when(F.col("rho") > 0.7, "strong").when(F.col("rho") > 0.4, "moderate").otherwise("weak"))
