"""Joins and groups in which single keys hold a large part of all rows.

Heavy keys are looked for in a sample of fixed share: those with about ``HEAVY_ROWS`` rows or more, the heaviest
``HEAVY_MOST`` of them; any other key then holds less than that part of the rows. What is found changes the layout of the work, never its
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which a key is dealt out, the most keys dealt out, the share of rows looked at, and the groups a key is dealt to.
HEAVY_ROWS = 100_000
HEAVY_MOST = 1000
SAMPLE_SHARE = 1 / 64
SALTS = 64


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> list:
    """Keys with about ``HEAVY_ROWS`` rows or more, at most ``HEAVY_MOST`` of them."""
    drawn = df.select(*keys)
    if SAMPLE_SHARE < 1:
        drawn = drawn.sample(fraction=SAMPLE_SHARE, seed=11)
    counts = drawn.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= HEAVY_ROWS * SAMPLE_SHARE)
    return counts.orderBy(F.desc("__n"), *keys).limit(HEAVY_MOST).drop("__n").collect()


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", look_at: DataFrame | None = None
) -> DataFrame:
    """Join rows to a table with one row per key.

    The rows of a heavy key are dealt to ``SALTS`` groups by their hash and only that key's table
    row is repeated; all other rows join as they are. Rows without a key match nothing and are
    dealt out too. ``look_at`` names a cheaper table with the same keys to search for heavy ones,
    such as the scan below earlier joins.
    """
    keys = list(keys)
    heavy = heavy_keys(rows if look_at is None else look_at, keys)
    if not heavy:
        return rows.join(table, keys, how)
    schema = rows.select(*keys).schema
    # HEAVY_MOST rows at most
    hot = rows.sparkSession.createDataFrame(heavy, schema).withColumn("__hot", F.lit(True))
    is_hot = F.coalesce(F.col("__hot"), F.lit(False))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    dealt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    salt = F.when(is_hot | no_key, dealt).otherwise(F.lit(0)).cast("int")
    salted_rows = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt).drop("__hot")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_table = table.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return salted_rows.join(salted_table, [*keys, "__salt"], how).drop("__salt")
