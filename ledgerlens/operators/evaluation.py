"""Splits, class weights, metrics, gate and score bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X

from . import ordered


def expected_loss(pd: Column | str, lgd: Column | str, ead: Column | str) -> Column:
    return X.col(pd) * X.col(lgd) * X.col(ead)


# Money lost per missed risky customer and per wrongly refused one (fixed values).
COST_FN, COST_FP = 10000, 1000


def business_cost(fn: Column | str, fp: Column | str) -> Column:
    return COST_FN * X.col(fn) + COST_FP * X.col(fp)


def stratified_split(df: DataFrame, label: str, key: str, shares: dict[str, int]) -> DataFrame:
    """Deterministic split per label; ``shares`` are percentages in order.

    Rows are ordered by the MD5 of their key inside each label. The first hex digits cut that order
    into 65536 even pieces, so one label with most of the rows is still spread over many tasks.
    """
    digest = F.md5(F.col(key).cast("string"))
    rows = df.withColumns({"__d": digest, "__p": F.substring(digest, 1, 4)})
    inside = W.partitionBy(label, "__p").orderBy("__d", key)
    rows = rows.withColumn("__r", F.row_number().over(inside))
    pieces = rows.groupBy(label, "__p").agg(F.count(F.lit(1)).alias("__c"))
    lower = W.partitionBy(label).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        label,
        "__p",
        F.coalesce(F.sum("__c").over(lower), F.lit(0)).alias("__o"),
        F.sum("__c").over(W.partitionBy(label)).alias("__n"),
    )
    pos = (F.col("__r") + F.col("__o")) * 100
    split, seen = None, 0
    names = list(shares)
    for name in names[:-1]:
        seen += shares[name]
        test = pos <= F.col("__n") * seen
        split = F.when(test, name) if split is None else split.when(test, name)
    split = split.otherwise(names[-1])
    return rows.join(pieces, [label, "__p"]).withColumn("split", split).drop("__d", "__p", "__r", "__o", "__n")


def split_balance(df: DataFrame, label: str) -> DataFrame:
    total = df.select(F.count(F.lit(1))).scalar()
    return (
        df.groupBy("split")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("positives"), F.avg(F.col(label).cast("double")).alias("rate"))
        .withColumn("share", X.ratio("rows", total))
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Attach ``weight = n / (2 * n_class)`` and ``positive_scale = n0 / n1``."""
    y = F.col(label)
    counts = df.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")).select(F.struct("n0", "n1")).scalar()
    n = counts["n0"] + counts["n1"]
    mine = F.when(y == 1, counts["n1"]).otherwise(counts["n0"])
    return df.withColumns({"weight": X.ratio(n, 2 * mine), "positive_scale": X.ratio(counts["n0"], counts["n1"])})


def confusion(df: DataFrame, keys: list[str], label: str = "is_high_risk", score: str = "risk_score", cut: float = 0.5) -> DataFrame:
    y, p = F.col(label), F.col(score) >= cut
    return df.groupBy(*keys).agg(
        F.count_if((y == 1) & p).alias("tp"),
        F.count_if((y == 0) & p).alias("fp"),
        F.count_if((y == 1) & ~p).alias("fn"),
        F.count_if((y == 0) & ~p).alias("tn"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and error rates; undefined ones are NULL."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": X.ratio(tp + tn, tp + fp + fn + tn),
            "precision": X.ratio(tp, tp + fp),
            "recall": X.ratio(tp, tp + fn),
            "f1": X.ratio(2 * tp, 2 * tp + fp + fn),
            "fnr": X.ratio(fn, fn + tp),
            "fpr": X.ratio(fp, fp + tn),
        }
    )


def roc_auc(df: DataFrame, keys: list[str], label: str = "is_high_risk", score: str = "risk_score") -> DataFrame:
    """Exact area under the ROC curve: pairs won by the positives, ties counting half."""
    narrow = df.select(*keys, label, score)
    cut = ordered.with_bucket(narrow, [score], ordered.splits(narrow, [score]))
    pos = F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    t = ordered.running_totals(cut, keys, score, f"{score}_bucket", {"pos": pos, "neg": neg})
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    return t.groupBy(*keys).agg(
        X.ratio(won, F.max("pos_total").cast("double") * F.max("neg_total")).alias("roc_auc")
    )


def metric_table(df: DataFrame, keys: list[str] = ("model", "split")) -> DataFrame:
    keys = list(keys)
    counts = rates(confusion(df, keys)).withColumn("business_cost", business_cost("fn", "fp"))
    return counts.join(roc_auc(df, keys), keys)


def select_model(metrics: DataFrame, split: str = "test") -> DataFrame:
    """Model with the highest AUC on a split; the first name on ties."""
    own = metrics.where(F.col("split") == split)
    best = own.agg(F.min(F.struct((-F.col("roc_auc")).alias("neg"), F.col("model").alias("model"))).alias("b"))
    return best.select(F.col("b.model").alias("model"), (-F.col("b.neg")).alias("roc_auc"))


def compliance(metrics: DataFrame, min_auc: float = 0.7, max_fnr: float = 0.2) -> DataFrame:
    auc, fnr = F.col("roc_auc") >= min_auc, F.col("fnr") <= max_fnr
    return metrics.withColumns({"roc_auc_met": auc, "fnr_met": fnr, "compliant": auc & fnr})


def business_report(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {
            "detection_rate": F.col("recall") * 100,
            "false_positive_rate": F.col("fpr") * 100,
            "false_negative_rate": F.col("fnr") * 100,
            "annual_savings": F.col("business_cost") * -12,
        }
    )


def risk_levels(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """LOW below 0.3, MEDIUM below 0.7, else HIGH; confidence is the larger class probability. All are NULL without a score."""
    p = F.col(score)
    return df.withColumns(
        {
            "risk_level": F.when(p.isNotNull(), X.bands(p, [(0.3, "LOW"), (0.7, "MEDIUM")], "HIGH", closed="left")),
            "confidence": F.greatest(p, 1 - p),
            "predicted_high_risk": p >= 0.5,
        }
    )


def score_bands(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "risk_level").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("risk_score").alias("mean_score"),
        F.count_if("predicted_high_risk").alias("high_risk"),
    )
