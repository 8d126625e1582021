"""Trailing windows, percent ranks, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut

from . import ordered, skew

KEY, TS = "CustomerId", "TransactionStartTime"


def last_rolling(df: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Rolling sum and count as of each customer's last transaction, one row per customer and window.

    Only the last row of the rolling series is wanted, so it is a conditional sum over the rows
    newer than ``last - days`` (left-open), not a sliding frame.
    """
    last = df.groupBy(KEY).agg(F.max(TS).alias("last_ts"))
    rows = skew.lookup(df.select(KEY, TS, "Value"), last, [KEY], "inner")
    aggs = []
    for name, days in windows.items():
        recent = F.col(TS) > F.col("last_ts") - F.expr(f"interval {days} days")
        aggs += [F.sum(F.when(recent, F.col("Value"))).alias(f"s_{name}"), F.count_if(recent).alias(f"n_{name}")]
    wide = rows.groupBy(KEY).agg(*aggs)
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("window"), F.col(f"s_{n}").alias("rolling_sum"), F.col(f"n_{n}").alias("rolling_count"))
            for n in windows
        ]
    )
    return wide.select(KEY, F.inline(cells))


def rolling_correlation(df: DataFrame, x: str, y: str, days: int = 30, ts: str = TS) -> DataFrame:
    """Correlation of two columns over the trailing ``days`` at every distinct timestamp.

    Each row enters the window at its time and leaves it ``days`` later. Time is cut into chunks as long as the window, so that a
    row leaves in the chunk after its own: a window's sums are those of the previous chunk, plus entries and less exits of
    its own. Sums therefore start anew with every chunk and never carry the rounding of a longer history. Linear work, in time
    buckets, whatever the window holds.
    """
    width = days * X.DAY_MICROS
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.unix_micros(ts).alias("t"), xv.alias("x"), yv.alias("y")
    )
    rows = rows.withColumn("chunk", F.floor(F.col("t") / F.lit(width)).cast("bigint"))
    # a row enters in its chunk; in the next one it is there from the start and leaves
    roles = rows.select(
        "x",
        "y",
        F.inline(
            F.array(
                F.struct(F.col("chunk"), F.col("t").alias("at"), F.lit(1.0).alias("sign")),
                F.struct((F.col("chunk") + 1).alias("chunk"), (F.col("t") + F.lit(width)).alias("at"), F.lit(-1.0).alias("sign")),
            )
        ),
    )
    # centring on the rows a chunk deals with keeps its sums of squares well conditioned
    mid = roles.groupBy("chunk").agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    roles = skew.lookup(roles, mid, ["chunk"]).withColumns({"x": F.col("x") - F.col("mx"), "y": F.col("y") - F.col("my")}).drop("mx", "my")
    edges = ordered.splits(df.select(F.unix_micros(ts).alias("at")), ["at"])
    moves = ordered.with_bucket(roles, ["at"], edges)
    sg, a, b = F.col("sign"), F.col("x"), F.col("y")
    sums = {
        "n": F.sum(sg),
        "sx": F.sum(sg * a),
        "sy": F.sum(sg * b),
        "sxx": F.sum(sg * a * a),
        "syy": F.sum(sg * b * b),
        "sxy": F.sum(sg * a * b),
        "entries": F.count_if(sg > 0),
    }
    measures = [m for m in sums if m != "entries"]
    t = ordered.running_totals(moves, ["chunk"], "at", "at_bucket", sums)
    whole = {"n": F.lit(1.0), "sx": a, "sy": b, "sxx": a * a, "syy": b * b, "sxy": a * b}
    base = roles.where(sg < 0).groupBy("chunk").agg(*[F.sum(v).alias(f"{m}_base") for m, v in whole.items()])
    now = skew.lookup(t.where("entries > 0"), base, ["chunk"], look_at=roles).select(
        "at", *[(F.coalesce(f"{m}_base", F.lit(0.0)) + F.col(f"{m}_before") + F.col(m)).alias(m) for m in measures]
    )
    n = F.col("n")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    # a spread below the rounding error of the sums is no spread
    real = lambda v, s: v > F.lit(1e-9) * n * F.col(s)
    r = F.when(
        real(vx, "sxx") & real(vy, "syy"),
        F.try_divide(n * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(vx * vy)),
    )
    return now.select(F.col("at").alias("ts_us"), F.round("n").cast("bigint").alias("rows"), r.alias("correlation"))


def stability(rolling: DataFrame) -> DataFrame:
    """Coefficient of variation of the rolling correlation and its class."""
    c = F.col("correlation")
    out = rolling.agg(F.avg(c).alias("mean"), F.stddev(c).alias("std")).withColumn("cv", X.ratio("std", "mean"))
    cv = F.col("cv")
    return out.withColumn(
        "stability", F.when(cv < 0.3, "Stable").when(cv < 0.5, "Moderately Stable").otherwise("Unstable")
    )


def percent_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """Average-tie rank over the number of rows."""
    ranked = ordered.ranks_of(df, col, "__rank", "__n")
    return ranked.withColumn(out, X.ratio("__rank", "__n")).drop("__rank", "__n")


def group_ranks(means: DataFrame, col: str) -> DataFrame:
    """Ascending and descending average rank over a table with one row per group."""
    up = ordered.ranks_of(cut(means), col, "rank_ascending", "__n")
    return up.withColumn("rank_descending", F.col("__n") + 1 - F.col("rank_ascending")).drop("__n")


def pareto(totals: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """The top ``n`` groups with their share and cumulative share of the grand total."""
    grand = totals.select(F.sum(value)).scalar()
    shared = totals.withColumn("share", X.ratio(value, grand) * 100)
    top = shared.orderBy(F.desc(value), key).limit(n)
    # n rows by construction
    w = W.partitionBy(F.lit(0)).orderBy(F.desc(value), key).rowsBetween(W.unboundedPreceding, 0)
    return top.withColumn("cumulative_share", F.sum("share").over(w))


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """Share of rows at or below each distinct value."""
    narrow = df.select(col)
    cut = ordered.with_bucket(narrow, [col], ordered.splits(narrow, [col])).where(F.col(col).isNotNull())
    t = ordered.running_totals(cut, [], col, f"{col}_bucket", {"cnt": F.count(F.lit(1))})
    return t.select(F.col(col).alias("value"), "cnt", X.ratio(F.col("cnt_before") + F.col("cnt"), "cnt_total").alias("ecdf"))


def share_of_total(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, X.ratio(col, df.select(F.sum(col)).scalar()) * 100)
