"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_ALL=1`` runs every
registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import catalog  # noqa: E402
from ledgerlens.session import build  # noqa: E402

HEADLINE = """
a01_required_aggregates a02_spread a07_trailing_windows a10_diversity a13_time_means a14_time_gaps a16_time_modes
a17_time_consistency j07_feature_frame r02_rfm_spread r10_training_features r13_lifetime_segments r15_lorenz_curve
r18_behaviour_score l01_kmeans l09_threshold_label l11_validate_label w02_last_rolling_totals w03_rolling_correlation
s03_numeric_descriptives s10_pearson s12_spearman c03_fraud_by_dimension c10_daily_resample m01_null_counts m12_clean_data
wo1_fit wo2_apply e03_frequency_encode o07_method_comparison n01_standard_scale t01_stratified_split
t05_logistic_regression t06_decision_tree t07_random_forest t08_gradient_boosting v03_metric_table sc1_batch_scoring
o08_isolation_forest st1_daily_stream_totals
""".split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(catalog.QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build("bench", cpus)
    # one small query first, so that starting the engine is not charged to the first headline
    catalog.QUERIES["p04_validity_counts"].build(spark, sf).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name].build(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
