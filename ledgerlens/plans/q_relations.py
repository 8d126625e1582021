"""Sources and sinks, filters, joins, windows, sorts and set operations."""

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import behaviour, customer as C, labels, ordered, relations as R, rfm, windows as Wn
from ledgerlens.sources import files, tables

from . import inputs as I
from .q_customer import A1_SQL, GAPS, HOUR_US
from .q_rfm_labels import CLV_SQL, PATTERN_SQL
from .registry import query

# --- sources and sinks --------------------------------------------------------------------------

_IO_OUT = "TransactionId:i CustomerId:i micros:i Value:2 Amount:2 ProductCategory:s FraudResult:i"
_IO_SQL = """SELECT TransactionId, CustomerId, epoch_us(TransactionStartTime) AS micros, Value, Amount, ProductCategory,
 FraudResult FROM ev"""


def _io_cols(df):
    return df.withColumn("micros", F.unix_micros("TransactionStartTime"))


@query("io01_read_csv", _IO_OUT, _IO_SQL)
def io01(s, sf):
    src = I.ev(s, sf).select("TransactionId", "CustomerId", "TransactionStartTime", "Value", "Amount", "ProductCategory", "FraudResult")
    path = files.write(src, files.scratch(s, "transactions-csv"), "csv")
    return _io_cols(files.read_transactions(s, path, src.schema, "csv"))


@query(
    "io02_conform_types",
    "TransactionId:s CustomerId:s Value:2 FraudResult:i",
    """SELECT TransactionId, CustomerId, CASE WHEN PricingStrategy <> 0 THEN Value END AS Value,
       CASE WHEN ChannelId = 'C1' THEN 0 ELSE FraudResult END AS FraudResult FROM ev""",
)
def io02(s, sf):
    raw = I.ev(s, sf).select(
        "TransactionId",
        "CustomerId",
        F.when(F.col("PricingStrategy") == 0, "n/a").otherwise(F.col("Value").cast("string")).alias("Value"),
        F.when(F.col("ChannelId") == "C1", "?").otherwise(F.col("FraudResult").cast("string")).alias("FraudResult"),
    )
    return files.conform(raw, ["TransactionId", "CustomerId"], ["Value"], "FraudResult")


@query(
    "io03_date_columns",
    "column:s non_null:i parsed:i",
    """SELECT 'TransactionStartTime' AS "column", count(*) AS non_null, count(*) AS parsed FROM ev
       UNION ALL SELECT 'update_date', count(*), count(*) FILTER (WHERE ChannelId <> 'C0') FROM ev""",
)
def io03(s, sf):
    raw = I.ev(s, sf).select(
        F.col("TransactionId").cast("string"),
        F.date_format("TransactionStartTime", "yyyy-MM-dd HH:mm:ss").alias("TransactionStartTime"),
        F.when(F.col("ChannelId") == "C0", "none").otherwise(F.date_format("TransactionStartTime", "yyyy-MM-dd HH:mm:ss")).alias("update_date"),
    )
    return files.date_columns(raw, fmt="yyyy-MM-dd HH:mm:ss")


@query(
    "io04_limited_read",
    "TransactionId:i Value:2",
    "SELECT TransactionId, Value FROM ev ORDER BY md5(CAST(TransactionId AS VARCHAR)), TransactionId LIMIT 100",
)
def io04(s, sf):
    return files.first_rows(I.ev(s, sf), 100, "TransactionId")


@query(
    "io05_random_sample",
    "TransactionId:i Value:2",
    """SELECT TransactionId, Value FROM ev
       WHERE CAST(concat('0x', substr(md5(CAST(TransactionId AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 10""",
)
def io05(s, sf):
    return I.ev(s, sf).where(X.portable_bucket("TransactionId") % 100 < 10)


@query(
    "io06_canonical_names",
    "CustomerId:i TransactionStartTime:i Amount:2",
    "SELECT user_id AS CustomerId, epoch_us(ts) AS TransactionStartTime, value AS Amount FROM events",
)
def io06(s, sf):
    df = files.canonical(tables.table(s, sf, "events"))
    return df.withColumn("TransactionStartTime", F.unix_micros(F.col("TransactionStartTime").cast("timestamp")))


@query(
    "io07_required_columns",
    "source:s missing:s rows:i",
    """SELECT 'events' AS source, 'Amount,ProductCategory' AS missing, count(*) AS rows FROM events
       UNION ALL SELECT 'transactions', '', count(*) FROM ev""",
)
def io07(s, sf):
    need = ["CustomerId", "TransactionStartTime", "Amount", "ProductCategory"]
    raw = files.canonical(tables.table(s, sf, "events"), {k: v for k, v in files.ALIASES.items() if k != "Amount"})
    parts = []
    for name, df in (("events", raw), ("transactions", I.ev(s, sf))):
        gone = ",".join(files.missing_columns(df, need))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).withColumns({"source": F.lit(name), "missing": F.lit(gone)}))
    return parts[0].unionByName(parts[1])


@query("io08_write_and_read_back", "CustomerId:i recency_days:i transaction_frequency:i total_monetary_value:2 is_high_risk:i",
       "SELECT CustomerId, recency_days, transaction_frequency, total_monetary_value, is_high_risk FROM lab")
def io08(s, sf):
    lab = I.lab(s, sf)
    path = files.write(lab, files.scratch(s, "labelled-csv"), "csv")
    return files.read_transactions(s, path, lab.schema, "csv")


@query(
    "io09_json_metrics",
    "metric:s value:2",
    """SELECT 'customers' AS metric, count(DISTINCT CustomerId)::DOUBLE AS value FROM od UNION ALL SELECT 'first_second', epoch_us(min(TransactionStartTime)) / 1e6 FROM od
       UNION ALL SELECT 'last_second', epoch_us(max(TransactionStartTime)) / 1e6 FROM od UNION ALL SELECT 'Value_mean', avg(Value) FROM od
       UNION ALL SELECT 'Value_std', stddev(Value) FROM od UNION ALL SELECT 'Value_median', median(Value) FROM od""",
)
def io09(s, sf):
    stats = C.reference_stats(I.od(s, sf), ["Value"])
    path = files.write(stats, files.scratch(s, "metrics-json"), "json")
    return files.read_transactions(s, path, stats.schema, "json")


@query(
    "io10_export_formats",
    "format:s rows:i total:2",
    "SELECT f AS format, count(*) AS rows, sum(Value) AS total FROM od, (VALUES ('csv'), ('parquet'), ('json')) v(f) GROUP BY f",
)
def io10(s, sf):
    src = I.od(s, sf).select("TransactionId", "CustomerId", "Value")
    parts = []
    for fmt in ("csv", "parquet", "json"):
        path = files.write(src, files.scratch(s, f"export-{fmt}"), fmt)
        back = files.read_transactions(s, path, src.schema, fmt)
        parts.append(back.agg(F.count(F.lit(1)).alias("rows"), F.sum("Value").alias("total")).withColumn("format", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "io11_data_dictionary",
    "split:s records:i low_risk:i high_risk:i high_risk_rate:6 columns:s",
    """SELECT split, count(*) AS records, count(*) FILTER (WHERE is_high_risk = 0) AS low_risk,
       sum(is_high_risk) AS high_risk, avg(is_high_risk) * 100 AS high_risk_rate,
       'CustomerId,is_high_risk,model,risk_score' AS columns FROM preds GROUP BY split""",
)
def io11(s, sf):
    d = files.data_dictionary(I.preds(s, sf))
    return d.withColumn("columns", F.concat_ws(",", "columns"))


@query(
    "io13_granularity",
    "source:s rows:i customers:i level:s",
    """SELECT 'events' AS source, count(*) AS rows, count(DISTINCT CustomerId) AS customers, 'transaction' AS level FROM ev
       UNION ALL SELECT 'rfm', count(*), count(DISTINCT CustomerId), 'customer' FROM rfm""",
)
def io13(s, sf):
    a = files.granularity(I.ev(s, sf)).withColumn("source", F.lit("events"))
    b = files.granularity(I.rfm(s, sf)).withColumn("source", F.lit("rfm"))
    return a.unionByName(b)


# --- projections and filters --------------------------------------------------------------------


@query(
    "p01_select_by_type",
    "TransactionId:i CustomerId:i Value:2 Amount:2 PricingStrategy:i FraudResult:i",
    "SELECT TransactionId, CustomerId, Value, Amount, PricingStrategy, FraudResult FROM od",
)
def p01(s, sf):
    return R.numeric_only(I.od(s, sf))


@query(
    "p02_recent_rows",
    "TransactionId:i CustomerId:i Value:2",
    "SELECT * FROM od WHERE TransactionStartTime > (SELECT max(TransactionStartTime) FROM od) - INTERVAL 90 DAY",
)
def p02(s, sf):
    return R.recent(I.od(s, sf), 90)


@query(
    "p03_amount_band_rows",
    "TransactionId:i Amount:2",
    "SELECT TransactionId, Amount FROM ev WHERE Amount >= 10 AND Amount < 100",
)
def p03(s, sf):
    return I.ev(s, sf).where((F.col("Amount") >= 10) & (F.col("Amount") < 100))


@query(
    "p04_validity_counts",
    "rows:i negative_amounts:i future_transactions:i invalid_flags:i",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE Amount < 0) AS negative_amounts,
       count(*) FILTER (WHERE TransactionStartTime > TIMESTAMP '2024-01-20 00:00:00') AS future_transactions,
       count(*) FILTER (WHERE FraudResult NOT IN (0, 1)) AS invalid_flags FROM ev""",
)
def p04(s, sf):
    return R.validity(I.ev(s, sf), "2024-01-20 00:00:00")


@query("p05_complete_cases", "TransactionId:i Value:2 ProductCategory:s FraudResult:i",
       "SELECT * FROM evn WHERE Value IS NOT NULL AND ProductCategory IS NOT NULL AND FraudResult IS NOT NULL")
def p05(s, sf):
    return I.evn(s, sf).dropna(subset=["Value", "ProductCategory", "FraudResult"])


@query(
    "p06_drop_sparse_columns",
    "column:s rows:i",
    """SELECT c AS "column", (SELECT count(*) FROM evn) AS rows FROM (VALUES ('TransactionId'), ('Value'), ('ProductCategory')) v(c)""",
)
def p06(s, sf):
    df = I.evn(s, sf).select("TransactionId", "Value", "ProductCategory")
    df = df.withColumn("DisputedAmount", F.when(F.col("ProductCategory") == "error", F.col("Value")))
    kept = R.drop_sparse_columns(df)
    return kept.agg(F.count(F.lit(1)).alias("rows")).select(
        F.explode(F.array(*[F.lit(c) for c in kept.columns])).alias("column"), "rows"
    )


@query(
    "p07_drop_text_columns",
    "CustomerId:i recency_days:i transaction_frequency:i total_monetary_value:2 cluster:i is_high_risk:i",
    "SELECT * FROM lab",
)
def p07(s, sf):
    lab = I.lab(s, sf).withColumn("note", F.concat(F.lit("cluster "), F.col("cluster")))
    return R.numeric_only(lab)


@query(
    "p08_row_index",
    "TransactionId:i row_index:i",
    "SELECT TransactionId, row_number() OVER (ORDER BY md5(CAST(TransactionId AS VARCHAR)), TransactionId) - 1 AS row_index FROM ev",
)
def p08(s, sf):
    return R.row_index(I.ev(s, sf).select("TransactionId"), "TransactionId")


# --- joins --------------------------------------------------------------------------------------

_RECENT_TARGET = """tgt AS (SELECT CustomerId, max(FraudResult) AS is_high_risk FROM od
  WHERE TransactionStartTime > (SELECT max(TransactionStartTime) FROM od) - INTERVAL 365 DAY GROUP BY 1)"""


def _recent_target(s, sf):
    return R.recent(I.od(s, sf), 365).groupBy("CustomerId").agg(F.max("FraudResult").alias("is_high_risk"))


@query(
    "j01_features_with_target",
    "CustomerId:i total_transaction_amount:2 transaction_count:i is_high_risk:i",
    f"WITH {_RECENT_TARGET}, f AS ({A1_SQL.format(t='od')}) SELECT f.*, coalesce(is_high_risk, 0) AS is_high_risk FROM f LEFT JOIN tgt USING (CustomerId)",
)
def j01(s, sf):
    return R.add_target(C.required(I.od(s, sf)), _recent_target(s, sf))


@query(
    "j02_unmatched_count",
    "unmatched:i",
    f"WITH {_RECENT_TARGET} SELECT count(DISTINCT CustomerId) AS unmatched FROM od WHERE CustomerId NOT IN (SELECT CustomerId FROM tgt)",
)
def j02(s, sf):
    return R.unmatched(I.od(s, sf).select("CustomerId").distinct(), _recent_target(s, sf))


@query(
    "j03_customer_profile_join",
    "CustomerId:i n:i interval_cv:6 amount_cv:4 Predicted_CLV:2 CLV_Segment:s risk_score:i",
    PATTERN_SQL + "SELECT * FROM lv",
)
def j03(s, sf):
    return behaviour.score(I.od(s, sf)).withColumnRenamed("transaction_count", "n")


@query(
    "j04_rfm_with_fraud",
    "CustomerId:i recency_days:i had_fraud:i",
    """SELECT r.CustomerId, recency_days, coalesce(h, 0) AS had_fraud FROM rfm r
       LEFT JOIN (SELECT CustomerId, max(FraudResult) AS h FROM od GROUP BY 1) f USING (CustomerId)""",
)
def j04(s, sf):
    return labels.with_fraud(I.rfm(s, sf), I.od(s, sf))


@query(
    "j05_risk_matrix",
    "ProductCategory:s total_value:2 avg_value:4 fraud_rate:6",
    """SELECT v.*, fraud_rate FROM (SELECT ProductCategory, sum(Amount) AS total_value, avg(Amount) AS avg_value FROM odn
       WHERE ProductCategory IS NOT NULL GROUP BY 1) v
       JOIN (SELECT ProductCategory, avg(FraudResult) * 100 AS fraud_rate FROM odn GROUP BY 1) f USING (ProductCategory)""",
)
def j05(s, sf):
    df = I.odn(s, sf)
    # both sides of the join share their key and their rows: one aggregate is the join
    named = df.where(F.col("ProductCategory").isNotNull())
    return named.groupBy("ProductCategory").agg(
        F.sum("Amount").alias("total_value"), F.avg("Amount").alias("avg_value"), (F.avg("FraudResult") * 100).alias("fraud_rate")
    )


@query(
    "j06_risk_factor_overlap",
    "factor:s customers:i",
    PATTERN_SQL
    + " UNION ALL ".join(
        f"SELECT '{f}' AS factor, count(*) FILTER (WHERE {f} = 1) AS customers FROM lv WHERE risk_level IN ('High', 'Very High')"
        for f in ("high_velocity", "irregular_pattern", "high_variability")
    ),
)
def j06(s, sf):
    scored = behaviour.score(I.od(s, sf)).where(F.col("risk_level").isin("High", "Very High"))
    names = ["high_velocity", "irregular_pattern", "high_variability"]
    one = scored.agg(*[F.count_if(F.col(n) == 1).alias(n) for n in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("factor"), F.col(n).alias("customers")) for n in names])))


@query(
    "j07_feature_frame",
    "CustomerId:i total_transaction_amount:2 median_transaction_amount:4 transaction_hour_mean:6 "
    "time_between_transactions_mean:5 product_category_count:i favorite_product_category:s days_since_last_transaction:i",
    f"""SELECT CustomerId, sum(Value) AS total_transaction_amount, median(Value) AS median_transaction_amount,
        avg(hour(TransactionStartTime)) AS transaction_hour_mean, any_value(gm) AS time_between_transactions_mean,
        count(DISTINCT ProductCategory) AS product_category_count, any_value(fav) AS favorite_product_category,
        (epoch_us((SELECT max(TransactionStartTime) FROM ev)) - epoch_us(max(TransactionStartTime))) // 86400000000
        AS days_since_last_transaction
        FROM ev JOIN (SELECT CustomerId, avg(gap) AS gm FROM ({GAPS.format(t='ev', u=HOUR_US)}) GROUP BY 1) g USING (CustomerId)
        JOIN (SELECT CustomerId, ProductCategory AS fav FROM (SELECT CustomerId, ProductCategory, row_number() OVER (
          PARTITION BY CustomerId ORDER BY count(*) DESC, ProductCategory) rn FROM ev GROUP BY 1, 2) WHERE rn = 1) m USING (CustomerId)
        GROUP BY CustomerId""",
)
def j07(s, sf):
    return C.feature_frame(I.ev(s, sf))


@query(
    "j08_frequency_lookup",
    "TransactionId:i customer_frequency:i category_share:6",
    """SELECT TransactionId, count(*) OVER (PARTITION BY CustomerId) AS customer_frequency,
       count(*) OVER (PARTITION BY ProductCategory) / count(*) OVER () AS category_share FROM ev""",
)
def j08(s, sf):
    df = I.ev(s, sf).select("TransactionId", "CustomerId", "ProductCategory")
    total = df.select(F.count(F.lit(1))).scalar()
    out = R.add_frequencies(df, {"CustomerId": "customer_frequency", "ProductCategory": "n"})
    return out.withColumn("category_share", X.ratio("n", total))


# --- windows ------------------------------------------------------------------------------------


@query(
    "w01_time_since_previous",
    "TransactionId:i CustomerId:i gap:6",
    GAPS.format(t="ev", u=HOUR_US),
)
def w01(s, sf):
    return behaviour.gaps(I.ev(s, sf))


_ROLL = {"D": 1, "W": 7, "M": 30}


@query(
    "w02_last_rolling_totals",
    "CustomerId:i window:s rolling_sum:2 rolling_count:i",
    "WITH r AS (SELECT *, max(TransactionStartTime) OVER (PARTITION BY CustomerId) AS l FROM ev) "
    + " UNION ALL ".join(
        f"""SELECT CustomerId, '{n}' AS "window", sum(Value) FILTER (WHERE TransactionStartTime > l - INTERVAL {d} DAY) AS rolling_sum,
        count(*) FILTER (WHERE TransactionStartTime > l - INTERVAL {d} DAY) AS rolling_count FROM r GROUP BY CustomerId"""
        for n, d in _ROLL.items()
    ),
)
def w02(s, sf):
    return Wn.last_rolling(I.ev(s, sf), _ROLL)


_ROLLCORR = """SELECT epoch_us(TransactionStartTime) AS ts_us, count(*) OVER w AS rows,
  CASE WHEN var_pop(FraudResult) OVER w > 0 AND var_pop(Amount) OVER w > 0 THEN corr(Amount, FraudResult) OVER w END AS correlation
  FROM od WINDOW w AS (ORDER BY TransactionStartTime RANGE BETWEEN INTERVAL '2591999999999 microseconds' PRECEDING AND CURRENT ROW)"""


@query("w03_rolling_correlation", "ts_us:i rows:i correlation:5", f"SELECT DISTINCT * FROM ({_ROLLCORR})")
def w03(s, sf):
    return Wn.rolling_correlation(I.od(s, sf), "Amount", "FraudResult")


@query(
    "w04_correlation_stability",
    "mean:5 std:5 cv:3 stability:s",
    f"""SELECT *, CASE WHEN cv < 0.3 THEN 'Stable' WHEN cv < 0.5 THEN 'Moderately Stable' ELSE 'Unstable' END AS stability
        FROM (SELECT avg(correlation) AS mean, stddev(correlation) AS std, stddev(correlation) / avg(correlation) AS cv
        FROM (SELECT DISTINCT * FROM ({_ROLLCORR})))""",
)
def w04(s, sf):
    return Wn.stability(Wn.rolling_correlation(I.od(s, sf), "Amount", "FraudResult"))


_AVG_RANK = "(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0)"


@query(
    "w05_percent_rank",
    "TransactionId:i pct_rank:8",
    f"SELECT TransactionId, {_AVG_RANK.format(c='Value')} / count(*) OVER () AS pct_rank FROM ev",
)
def w05(s, sf):
    return Wn.percent_rank(I.ev(s, sf).select("TransactionId", "Value"), "Value", "pct_rank")


@query(
    "w06_group_ranks",
    "CountryCode:s mean_value:3 rank_ascending:2 rank_descending:2",
    f"""SELECT CountryCode, mean_value, {_AVG_RANK.format(c='mean_value')} AS rank_ascending,
        count(*) OVER () + 1 - {_AVG_RANK.format(c='mean_value')} AS rank_descending
        FROM (SELECT CountryCode, avg(Value) AS mean_value FROM odc GROUP BY 1)""",
)
def w06(s, sf):
    return Wn.group_ranks(I.odc(s, sf).groupBy("CountryCode").agg(F.avg("Value").alias("mean_value")), "mean_value")


@query(
    "w07_pareto",
    "CountryCode:s total_value:2 share:6 cumulative_share:6",
    """SELECT CountryCode, total_value, share, sum(share) OVER (ORDER BY total_value DESC, CountryCode) AS cumulative_share
       FROM (SELECT *, total_value / sum(total_value) OVER () * 100 AS share FROM (
         SELECT CountryCode, sum(Value) AS total_value FROM odc GROUP BY 1)) ORDER BY total_value DESC, CountryCode LIMIT 10""",
)
def w07(s, sf):
    totals = I.odc(s, sf).groupBy("CountryCode").agg(F.sum("Value").alias("total_value"))
    return Wn.pareto(totals, "CountryCode", "total_value")


@query(
    "w08_empirical_cdf",
    "value:2 cnt:i ecdf:8",
    "SELECT Value AS value, count(*) AS cnt, sum(count(*)) OVER (ORDER BY Value) / (SELECT count(*) FROM ev) AS ecdf FROM ev GROUP BY Value",
)
def w08(s, sf):
    return Wn.ecdf(I.ev(s, sf), "Value")


@query(
    "w08_percentile_markers",
    "feature:s n:i q0:4 q1:4 q2:4 q3:4 q4:4",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, "
        + ", ".join(f"quantile_cont({c}, {p}) AS q{i}" for i, p in enumerate((0.01, 0.25, 0.5, 0.95, 0.99)))
        + " FROM ev"
        for c in ("Value", "Amount")
    ),
)
def w08b(s, sf):
    return ordered.quantiles(I.ev(s, sf), ["Value", "Amount"], [0.01, 0.25, 0.5, 0.95, 0.99])


@query(
    "w09_share_of_total",
    "ProductCategory:s total_value:2 value_share:6",
    "SELECT ProductCategory, sum(Value) AS total_value, sum(Value) / (SELECT sum(Value) FROM ev) * 100 AS value_share FROM ev GROUP BY 1",
)
def w09(s, sf):
    return Wn.share_of_total(I.ev(s, sf).groupBy("ProductCategory").agg(F.sum("Value").alias("total_value")), "total_value", "value_share")


# --- sorts, limits, set operations --------------------------------------------------------------


@query(
    "k01_sort_positions",
    "CustomerId:i TransactionId:i position:i",
    """SELECT CustomerId, TransactionId, row_number() OVER (PARTITION BY CustomerId ORDER BY TransactionStartTime, TransactionId)
       AS position FROM ev""",
)
def k01(s, sf):
    df = I.ev(s, sf).select("CustomerId", "TransactionId", F.unix_micros("TransactionStartTime").alias("t"))
    return ordered.numbered(df, "t", "TransactionId", "position", ["CustomerId"])


@query(
    "k02_top_customers",
    "CustomerId:i total_value:2",
    "SELECT CustomerId, sum(Value) AS total_value FROM od GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def k02(s, sf):
    g = I.od(s, sf).groupBy("CustomerId").agg(F.sum("Value").alias("total_value"))
    return R.top_k(g, "total_value", "CustomerId", 10)


_VC = ["ProductCategory", "ChannelId", "CountryCode", "ProviderId"]


def value_counts_sql(cols, t, k):
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank
        FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= {k}"""
        for c in cols
    )


@query("k03_value_counts", "column:s value:s n:i rank:i", value_counts_sql(_VC, "odc", 5))
def k03(s, sf):
    return R.value_counts(I.odc(s, sf), _VC, 5)


@query(
    "k04_duplicate_rows",
    "rows:i duplicates:i duplicate_pct:6",
    """SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT CustomerId, ProductCategory, ChannelId, PricingStrategy FROM ev)) AS duplicates,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT CustomerId, ProductCategory, ChannelId, PricingStrategy FROM ev))) * 100 / count(*) AS duplicate_pct FROM ev""",
)
def k04(s, sf):
    return R.duplicate_rows(I.ev(s, sf).select("CustomerId", "ProductCategory", "ChannelId", "PricingStrategy"))


@query(
    "k05_duplicate_keys",
    "n:i distinct_keys:i duplicates:i",
    "SELECT count(l_orderkey) AS n, count(DISTINCT l_orderkey) AS distinct_keys, count(l_orderkey) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem",
)
def k05(s, sf):
    return R.duplicate_keys(tables.table(s, sf, "lineitem"), "l_orderkey")


@query("k06_distinct_values", "CustomerId:i", "SELECT DISTINCT CustomerId FROM od")
def k06(s, sf):
    return I.od(s, sf).select("CustomerId").distinct()


_LIMIT = "(SELECT quantile_cont(Value, 0.99) FROM ev)"


@query(
    "k07_union_of_parts",
    "part:s rows:i total:2",
    f"""SELECT 'high' AS part, count(*) AS rows, sum(Value) AS total FROM ev WHERE Value > {_LIMIT}
        UNION ALL SELECT 'rest', count(*), sum(Value) FROM ev WHERE Value <= {_LIMIT}""",
)
def k07(s, sf):
    df = I.ev(s, sf)
    limit = ordered.quantile_row(df, ["Value"], [0.99]).select("Value_q0").scalar()
    agg = [F.count(F.lit(1)).alias("rows"), F.sum("Value").alias("total")]
    high = df.where(F.col("Value") > limit).agg(*agg).withColumn("part", F.lit("high"))
    rest = df.where(F.col("Value") <= limit).agg(*agg).withColumn("part", F.lit("rest"))
    return high.unionByName(rest)


@query(
    "k09_without_flagged_rows",
    "TransactionId:i Value:2",
    f"SELECT TransactionId, Value FROM ev WHERE Value <= {_LIMIT}",
)
def k09(s, sf):
    df = I.ev(s, sf)
    limit = ordered.quantile_row(df, ["Value"], [0.99]).select("Value_q0").scalar()
    return R.without(df, F.col("Value") > limit)
