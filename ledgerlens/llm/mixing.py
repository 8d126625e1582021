"""Mixing sources to target weights by pivotal dependent rounding (native).

Every source gets a target of words by water filling. All documents of a source are to be copied
``target / source size`` times; the whole part is certain, the fraction is a probability that has to
become 0 or 1. Units duel in pairs: the pair's mass goes to one of them at random so that one of the
two becomes integral and every unit keeps its probability (pivotal sampling). Units are dealt to small
blocks of alike sizes; a block settles all of its units but one, and the survivors of the blocks meet
again in the next level, a reduction tree whose height grows with the logarithm of the rows.

Defined cases: NULL text has size 0; NULL sources are one source, sorted last; rows that repeat the
same ``doc_id``, source and size share one decision, their sizes counting together; a source without
words has target 0 and takes nothing; an empty table gives an empty result. Random numbers are hashes
of the seed and the unit, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, packed, stored, unpacked, whole

#: Units of a block on average; blocks are dealt by hash, so their sizes stay near it.
FAN_IN = 32
WEIGHTS = (3.0, 1.0, 2.0)


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, ceiling: float) -> DataFrame:
    """(_src, source_size, target) with one row per source.

    The windows run over that table of sources only. A source is capped at ``ceiling`` times its size; with sources
    in the order of cap / weight, the water level is that of the first prefix after which no cap is reached.
    """
    per = sizes.groupBy("_src").agg(F.sum(F.col("size") * F.col("_m")).alias("source_size"))
    order = Window.orderBy(F.col("_src").asc_nulls_last())
    everything = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", ceiling * F.col("source_size"))
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(filled), F.lit(0.0))
    per = per.withColumn("_total", share * F.sum("source_size").over(everything))
    per = per.withColumn("_left_w", F.sum("_w").over(everything) - before("_w"))
    per = per.withColumn("_level", (F.col("_total") - before("_cap")) / F.col("_left_w"))
    # the level of the first source that is not capped holds for it and all later ones
    open_ = F.when(F.col("_cap") >= F.col("_level") * F.col("_w"), F.col("_level"))
    first = F.min(F.when(open_.isNotNull(), F.struct((F.col("_cap") / F.col("_w")).alias("r"), F.col("_level").alias("l")))).over(everything)
    level = first["l"]
    return per.withColumn("_lv", level).select(
        "_src", "source_size", F.when(F.col("_lv").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_lv") * F.col("_w"))).cast("double").alias("target")
    )


def _uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the parts."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def duel(a_p: Column, b_p: Column, u: Column) -> tuple[Column, Column]:
    """(new p of a, new p of b): one of them becomes 0 or 1 and both keep their expectation."""
    s = a_p + b_p
    low = s < 1.0
    # below 1: one gets all, the other 0; else: one becomes 1, the other keeps the rest
    a_wins = F.when(low, u * s < a_p).otherwise(u * (2.0 - s) < 1.0 - b_p)
    rest = F.when(low, F.lit(0.0)).otherwise(s - 1.0)
    top = F.when(low, s).otherwise(F.lit(1.0))
    return F.when(a_wins, top).otherwise(rest), F.when(a_wins, rest).otherwise(top)


EPS = 1e-9


def _block(level: int, seed: int) -> Column:
    """Fold one sorted block: the carried unit duels with the next; what became integral goes to ``done``."""

    def step(acc: Column, x: Column) -> Column:
        a, b = duel(acc["p"], x["p"], _uniform(seed + level, acc["unit"], x["unit"]))
        a_settled = (a <= EPS) | (a >= 1.0 - EPS)
        settled = F.when(a_settled, F.struct(acc["unit"].alias("unit"), a.alias("p"))).otherwise(F.struct(x["unit"].alias("unit"), b.alias("p")))
        return F.struct(
            F.when(a_settled, x["unit"]).otherwise(acc["unit"]).alias("unit"),
            F.when(a_settled, b).otherwise(a).alias("p"),
            F.concat(acc["done"], F.array(settled)).alias("done"),
        )

    head = F.struct(
        F.col("members")[0]["unit"].alias("unit"),
        F.col("members")[0]["p"].alias("p"),
        F.expr("cast(array() as array<struct<unit:bigint,p:double>>)").alias("done"),
    )
    return F.aggregate(F.slice("members", 2, F.greatest(F.size("members") - 1, F.lit(0))), head, step)


def round_units(units: DataFrame, seed: int = 17, fan_in: int = FAN_IN) -> DataFrame:
    """Settle (unit, _src, size, p), p in (0, 1): returns (unit, taken 0 or 1)."""
    settled: DataFrame | None = None
    live = units.select("unit", "_src", F.col("size").cast("double").alias("size"), "p")
    level = 0
    while True:
        # sizes are bucketed so that units of a block weigh much the same; higher levels mix the buckets of a source
        bucket = F.floor(F.log2(F.col("size") + 1.0) * 4).cast("int") if level == 0 else F.lit(0)
        live = live.withColumn("_bucket", bucket)
        counts = live.groupBy("_src", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        most = counts.agg(F.max("_n")).first()[0]
        if most is None:
            break
        blocks = F.greatest(F.lit(1), F.ceil(F.col("_n") / fan_in)).cast("long")
        dealt = live.join(counts.select(F.col("_src").alias("_s2"), F.col("_bucket").alias("_b2"), "_n"), F.col("_src").eqNullSafe(F.col("_s2")) & (F.col("_bucket") == F.col("_b2")))
        dealt = dealt.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed + 1000 + level), "unit"), blocks))
        folded = dealt.groupBy("_src", "_bucket", "_block").agg(F.array_sort(F.collect_list(F.struct("size", "unit", "p"))).alias("members"))
        folded = folded.select("_src", F.col("members")[0]["size"].alias("size"), _block(level, seed).alias("r"))
        folded = stored(folded.select("_src", "size", "r.unit", "r.p", "r.done"), f"pivotal-{level}")
        done = folded.select(F.explode("done").alias("d")).select("d.unit", F.round("d.p").cast("int").alias("taken"))
        live = folded.select("unit", "_src", "size", "p")
        integral = (F.col("p") <= EPS) | (F.col("p") >= 1.0 - EPS)
        done = done.unionByName(live.where(integral).select("unit", F.round("p").cast("int").alias("taken")))
        live = live.where(~integral)
        settled = done if settled is None else settled.unionByName(done)
        last = level > 0 and most <= 1
        level += 1
        if last:
            break
    # one unit per source is left: a draw with its own probability
    final = live.select("unit", (_uniform(seed + 7, F.col("unit")) < F.col("p")).cast("int").alias("taken"))
    return final if settled is None else settled.unionByName(final)


def _unit(seed: int) -> Column:
    """Number of a unit: rows with the same id, source and size are one."""
    src = F.col("source").cast("string")
    return F.xxhash64(F.lit(seed), "doc_id", F.coalesce(src, F.lit("")), src.isNull(), size())


def size() -> Column:
    return F.regexp_count(whole(), F.lit(WORD)).cast("long")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return stored(docs.select("doc_id", F.col("source").cast("string").alias("_src"), size().alias("size"), _unit(seed).alias("unit")), "mix-sizes")


def decide(rows: DataFrame, weights: tuple[float, ...], share: float, ceiling: float, seed: int) -> DataFrame:
    """(unit, source_size, target, copies) of every unit of (doc_id, _src, size, unit) rows."""
    units = stored(rows.groupBy("unit", "_src", "size").agg(F.count(F.lit(1)).alias("_m")), "mix-units")
    goal = stored(targets(units, weights, share, ceiling), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # next to whole rates are whole: no dust of floating point enters the duels
    floor = F.when(F.abs(F.col("_rate") - F.round("_rate")) < EPS, F.round("_rate")).otherwise(F.floor("_rate")).cast("int")
    named = goal.select(F.col("_src").alias("_gs"), "source_size", "target", rate.alias("_rate")).withColumn("_base", floor)
    wanted = units.join(named, F.col("_src").eqNullSafe(F.col("_gs"))).drop("_gs")
    fraction = wanted.withColumn("p", F.col("_rate") - F.col("_base")).where(F.col("p") > EPS)
    won = round_units(fraction.select("unit", "_src", (F.col("size") * F.col("_m")).alias("size"), "p"), seed)
    return wanted.join(won, "unit", "left").select("unit", "source_size", "target", (F.col("_base") + F.coalesce("taken", F.lit(0))).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, ceiling: float = 2.0, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken."""
    rows = _sized(docs, seed)
    out = rows.join(decide(rows, weights, share, ceiling, seed), "unit")
    return out.select("doc_id", F.col("_src").alias("source"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, ceiling: float = 2.0, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    chosen = decide(_sized(docs, seed), weights, share, ceiling, seed).where("copies > 0").select("unit", "copies")
    named = packed(docs, unit=_unit(seed)).join(chosen, "unit")
    return unpacked(named.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))), docs)
