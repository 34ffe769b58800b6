"""Clustering metrics from a contingency table: (pred, gold, n) rows, all closed forms, no pair enumeration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "__missing_"


def contingency(labels: DataFrame) -> DataFrame:
    """n items for each (pred, gold); rows without either label are left out."""
    return labels.where("pred is not null and gold is not null").groupBy("pred", "gold").agg(F.count("*").alias("n"))


def marginals(cells: DataFrame) -> DataFrame:
    """The cells with a (size of pred) and b (size of gold). Cells, not items, are joined."""
    a = cells.groupBy("pred").agg(F.sum("n").alias("a"))
    b = cells.groupBy("gold").agg(F.sum("n").alias("b"))
    return cells.join(a, "pred").join(b, "gold")


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def _harmonic(x: Column, y: Column) -> Column:
    return _zero(F.try_divide(2 * x * y, x + y))


def b_cubed(labels: DataFrame) -> DataFrame:
    """precision, recall, f1; zeros for no items."""
    m = marginals(contingency(labels))
    n = F.sum("n")
    out = m.agg(_zero(F.try_divide(F.sum(F.col("n") * F.col("n") / F.col("a")), n)).alias("precision"), _zero(F.try_divide(F.sum(F.col("n") * F.col("n") / F.col("b")), n)).alias("recall"))
    return out.withColumn("f1", _harmonic(F.col("precision"), F.col("recall")))


def _pairs(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def adjusted_rand(labels: DataFrame) -> DataFrame:
    """ari: 0 without items, 1 for a single item or a degenerate table that agrees, else the adjusted index."""
    cells = contingency(labels)
    both = cells.agg(F.coalesce(F.sum(_pairs(F.col("n"))), F.lit(0.0)).alias("s"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    side = lambda c: cells.groupBy(c).agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(_pairs(F.col("n"))), F.lit(0.0)).alias(f"s_{c}"))
    t = both.crossJoin(side("pred")).crossJoin(side("gold"))  # one row each
    total = _pairs(F.col("n"))
    expected = F.try_divide(F.col("s_pred") * F.col("s_gold"), total)
    most = (F.col("s_pred") + F.col("s_gold")) / 2
    ari = F.when(F.col("n") == 0, 0.0).when((F.col("n") == 1) | (total == 0), 1.0).when(most - expected == 0, F.when(F.abs(F.col("s") - expected) < 1e-12, 1.0).otherwise(0.0)).otherwise((F.col("s") - expected) / (most - expected))
    return t.select(ari.alias("ari"))


def information(labels: DataFrame) -> DataFrame:
    """mi, h_pred, h_gold, nmi, homogeneity, completeness, v_measure (natural logarithms)."""
    m = marginals(contingency(labels)).crossJoin(contingency(labels).agg(F.sum("n").alias("t")))
    n, a, b, t = (F.col(c).cast("double") for c in ("n", "a", "b", "t"))
    # an entropy over clusters, summed over cells: a cell's share of its cluster is n / a
    out = m.agg(
        _zero(F.sum(n / t * F.ln(n * t / (a * b)))).alias("mi"),
        _zero(-F.sum(n / t * F.ln(a / t))).alias("h_pred"),
        _zero(-F.sum(n / t * F.ln(b / t))).alias("h_gold"),
        _zero(-F.sum(n / t * F.ln(n / a))).alias("h_gold_given_pred"),
        _zero(-F.sum(n / t * F.ln(n / b))).alias("h_pred_given_gold"),
        F.coalesce(F.max("t"), F.lit(0)).alias("t"),
    )
    tiny = 1e-15
    nmi = F.when(F.col("t") == 0, 0.0).when((F.col("h_pred") < tiny) & (F.col("h_gold") < tiny), 1.0).otherwise(_zero(F.try_divide(2 * F.col("mi"), F.col("h_pred") + F.col("h_gold"))))
    h = F.when(F.col("t") == 0, 0.0).when(F.col("h_gold") < tiny, 1.0).otherwise(1 - F.try_divide(F.col("h_gold_given_pred"), F.col("h_gold")))
    c = F.when(F.col("t") == 0, 0.0).when(F.col("h_pred") < tiny, 1.0).otherwise(1 - F.try_divide(F.col("h_pred_given_gold"), F.col("h_pred")))
    out = out.withColumn("nmi", nmi).withColumn("homogeneity", h).withColumn("completeness", c)
    return out.withColumn("v_measure", _harmonic(F.col("homogeneity"), F.col("completeness"))).drop("t", "h_gold_given_pred", "h_pred_given_gold")


def diagnostics(labels: DataFrame) -> DataFrame:
    """clusters, singletons, singleton_rate, over_split, over_merge, duplicate_pred."""
    cells = contingency(labels)
    per_pred = cells.groupBy("pred").agg(F.sum("n").alias("size"), F.count("*").alias("kinds"), F.min("gold").alias("only"))
    pred = per_pred.agg(F.count("*").alias("clusters"), F.count_if(F.col("size") == 1).alias("singletons"), F.count_if(F.col("kinds") > 1).alias("over_merge"))
    gold = cells.groupBy("gold").agg(F.count("*").alias("kinds")).agg(F.count_if(F.col("kinds") > 1).alias("over_split"))
    pure = per_pred.where("kinds = 1").groupBy("only").agg(F.count("*").alias("k")).agg(F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k") - 1)), F.lit(0)).alias("duplicate_pred"))
    out = pred.crossJoin(gold).crossJoin(pure)
    return out.withColumn("singleton_rate", _zero(F.try_divide(F.col("singletons").cast("double"), F.col("clusters"))))


def with_missing(labels: DataFrame) -> DataFrame:
    """Gold items without a prediction become clusters of their own; items without gold drop out."""
    return labels.where("gold is not null").withColumn("pred", F.coalesce("pred", F.concat(F.lit(MISSING), F.col("item").cast("string"))))


def evaluate_level(labels: DataFrame) -> DataFrame:
    """All metrics of one level in one row: coverage, metrics with missing items as singletons, and over covered items."""
    cover = labels.where("gold is not null").agg(F.count("*").alias("gold_items"), F.count("pred").alias("covered"))
    cover = cover.withColumn("coverage", _zero(F.try_divide(F.col("covered").cast("double"), F.col("gold_items"))))
    whole = with_missing(labels)
    out = cover
    for part in (b_cubed(whole), adjusted_rand(whole), information(whole).select("nmi", "v_measure"), b_cubed(labels).select(*[F.col(c).alias(f"covered_{c}") for c in ("precision", "recall", "f1")])):
        out = out.crossJoin(part)  # one row each
    return out


def majority(rows: DataFrame, group: str, label: str, order: str) -> DataFrame:
    """The most frequent label of each group, the first seen among equals, and whether the group is mixed."""
    per = rows.where(F.col(label).isNotNull()).groupBy(group, label).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return per.groupBy(group).agg(F.max_by(label, F.struct("n", -F.col("first"))).alias("majority"), F.max("n").alias("votes"), (F.count("*") > 1).alias("mixed"))
