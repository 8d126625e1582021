"""DuckDB text of the shared input views (the Spark side is in ``inputs.py``)."""

EV = """
SELECT event_id AS TransactionId, user_id AS CustomerId, ts AS TransactionStartTime, value AS Value,
       CASE WHEN event_type = 'error' THEN -value ELSE value END AS Amount,
       event_type AS ProductCategory, concat('C', event_id % 4) AS ChannelId, concat('P', user_id % 6) AS ProviderId,
       'USD' AS CurrencyCode, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS PricingStrategy,
       CASE WHEN event_type = 'error' AND value > 200 THEN 1 ELSE 0 END AS FraudResult
FROM events"""

OD = """
SELECT o_orderkey AS TransactionId, o_custkey AS CustomerId, o_orderdate AS TransactionStartTime,
       o_totalprice AS Value,
       CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS Amount,
       o_orderpriority AS ProductCategory, o_orderstatus AS ChannelId, o_orderkey % 5 AS PricingStrategy,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice >= 450000 THEN 1 ELSE 0 END AS FraudResult
FROM orders"""

ODC = """
SELECT o.*, c.c_mktsegment AS ProviderId, n.n_name AS CountryCode
FROM od o LEFT JOIN customer c ON o.CustomerId = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

_GAPS = """
SELECT * REPLACE (CASE WHEN TransactionId % 13 <> 0 THEN Value END AS Value,
                  CASE WHEN TransactionId % 17 <> 0 THEN ProductCategory END AS ProductCategory) FROM {}"""

RFM = """
SELECT CustomerId,
       (epoch_us((SELECT max(TransactionStartTime) FROM od)) - epoch_us(max(TransactionStartTime))) // 86400000000
           AS recency_days,
       count(*) AS transaction_frequency, abs(sum(Amount)) AS total_monetary_value,
       avg(Amount) AS avg_transaction_value, coalesce(stddev(Amount), 0) AS std_transaction_value
FROM od GROUP BY CustomerId"""

SCORED_RFM = """
SELECT r.*, 0.5e0 * (recency_days - m.r) / m.sr - 0.3e0 * (transaction_frequency - m.f) / m.sf
            - 0.2e0 * (total_monetary_value - m.v) / m.sv AS score
FROM rfm r, (SELECT avg(recency_days) r, stddev_pop(recency_days) sr, avg(transaction_frequency) f,
                    stddev_pop(transaction_frequency) sf, avg(total_monetary_value) v,
                    stddev_pop(total_monetary_value) sv FROM rfm) m"""

LAB = """
SELECT CustomerId, recency_days, transaction_frequency, total_monetary_value, avg_transaction_value,
       std_transaction_value,
       CASE WHEN recency_days > 500 THEN 0 WHEN transaction_frequency >= 10 THEN 1 ELSE 2 END AS cluster,
       CASE WHEN score >= (SELECT quantile_cont(score, 0.9) FROM scored_rfm) THEN 1 ELSE 0 END AS is_high_risk
FROM scored_rfm"""

PREDS = """
SELECT model, split, CustomerId, is_high_risk, risk_score FROM (
  SELECT CustomerId, is_high_risk,
         CASE WHEN CAST(concat('0x', substr(md5(CAST(CustomerId AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 70 THEN 'train'
              WHEN CAST(concat('0x', substr(md5(CAST(CustomerId AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 85 THEN 'val'
              ELSE 'test' END AS split,
         recency_days AS r, transaction_frequency AS f, total_monetary_value AS v FROM lab) s,
  LATERAL (SELECT 'by_recency' AS model, 1 / (1 + exp(-(r - 700) / 150.0e0)) AS risk_score
           UNION ALL SELECT 'by_frequency', 1 / (1 + exp((f - 5) / 2.0e0))
           UNION ALL SELECT 'by_value', 1 / (1 + exp((v - 600000) / 300000.0e0)))"""

SQL: dict[str, str] = {
    "ev": EV,
    "od": OD,
    "odc": ODC,
    "evn": _GAPS.format("ev"),
    "odn": _GAPS.format("od"),
    "rfm": RFM,
    "scored_rfm": SCORED_RFM,
    "lab": LAB,
    "preds": PREDS,
}
