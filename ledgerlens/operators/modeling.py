"""Clustering and classifiers with MLlib, model files and batch scoring."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, RobustScaler, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut

from . import evaluation, rfm, search, starts as many

LABEL = "is_high_risk"
KEY = "CustomerId"
RFM = ["recency_days", "transaction_frequency", "total_monetary_value"]
SEED = 42


# --- clustering -----------------------------------------------------------------------------------


def cluster_vectors(df: DataFrame, logs: str | None = None, scaler: str = "standard") -> DataFrame:
    """Scaled vectors of R, F, M; ``logs`` transforms F and M by ``log10`` or ``log1p`` first.

    The table is written once: the clustering reads it in every iteration.
    """
    if logs == "log10":
        made = {c: F.log10(F.col(c) + 1) for c in RFM[1:]}
    elif logs == "log1p":
        made = {c: F.log1p(c) for c in RFM[1:]}
    else:
        made = {}
    src = df.withColumns({f"__{c}": made.get(c, F.col(c).cast("double")) for c in RFM})
    pack = VectorAssembler(inputCols=[f"__{c}" for c in RFM], outputCol="raw")
    if scaler == "robust":
        step = RobustScaler(inputCol="raw", outputCol="features", withCentering=True, withScaling=True)
    else:
        step = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    packed = pack.transform(src).drop(*[f"__{c}" for c in RFM])
    return cut(step.fit(packed).transform(packed).drop("raw"))


def clusters(df: DataFrame, k: int = 3, logs: str | None = None, scaler: str = "standard", starts: int = 1) -> DataFrame:
    """Customers with their cluster in the cheapest of several seeded starts."""
    vectors = cluster_vectors(df.drop("cluster"), logs, scaler)
    best = many.run_all(vectors, [k], starts, SEED)
    if not best:
        return vectors.drop("features").withColumn("cluster", F.lit(None).cast("int"))
    return vectors.withColumn("cluster", many.nearest_center(vector_to_array("features"), best[0].centers)).drop("features")


def davies_bouldin(assigned: DataFrame, centers: list) -> float:
    """Mean over clusters of the worst (scatter_i + scatter_j) / distance_ij; scatter comes from one aggregate."""
    v = vector_to_array("features")
    home = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    own = F.get(home, F.col("cluster"))
    dist = F.sqrt(F.aggregate(F.zip_with(v, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    scatter = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.avg(dist).alias("s")).collect()}
    ids = sorted(scatter)
    worst = []
    for i in ids:
        ratios = []
        for j in ids:
            if i != j:
                gap = math.dist(centers[i], centers[j])
                ratios.append((scatter[i] + scatter[j]) / gap if gap else float("inf"))
        worst.append(max(ratios) if ratios else 0.0)
    return sum(worst) / len(worst)


def k_sweep(df: DataFrame, ks=range(2, 9), logs: str | None = "log10", scaler: str = "robust", starts: int = 20) -> DataFrame:
    """Inertia, silhouette and Davies-Bouldin index per number of clusters, of the cheapest of ``starts`` starts each.

    ``silhouette_sq`` is the silhouette by squared distances, which needs no pairs of rows.
    """
    vectors = cluster_vectors(df.drop("cluster"), logs, scaler)
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    rows = []
    for run in many.run_all(vectors, list(ks), starts, SEED):
        assigned = vectors.withColumn("cluster", many.nearest_center(vector_to_array("features"), run.centers))
        centers = [list(map(float, c)) for c in run.centers]
        rows.append((run.k, float(run.cost), float(silhouette.evaluate(assigned)), float(davies_bouldin(assigned, centers))))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double, davies_bouldin double")


def principal_components(df: DataFrame, k: int = 3) -> DataFrame:
    """Component scores of standardised recency, frequency and log money."""
    src = df.withColumns(
        {"__r": F.col(RFM[0]).cast("double"), "__f": F.col(RFM[1]).cast("double"), "__m": F.log1p(RFM[2])}
    )
    steps = [
        VectorAssembler(inputCols=["__r", "__f", "__m"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        PCA(k=k, inputCol="features", outputCol="pc"),
    ]
    fitted = Pipeline(stages=steps).fit(src)
    share = [float(x) for x in fitted.stages[-1].explainedVariance.toArray()]
    pc = vector_to_array("pc")
    out = fitted.transform(src).select(KEY, *[pc[i].alias(f"pc{i + 1}") for i in range(k)])
    return out.withColumns({f"explained_{i + 1}": F.lit(share[i]) for i in range(k)})


# --- classifiers ----------------------------------------------------------------------------------

#: Inputs next to recency, frequency and money, with what stands in for them where they are not given.
GIVEN = ["avg_transaction_value", "std_transaction_value", "cluster"]
FEATURES = [*RFM, *GIVEN, *(c for c in rfm.TRAINING_COLUMNS if c not in RFM)]
SHARES = {"train": 70, "val": 15, "test": 15}


def training_table(labelled: DataFrame, shares: dict[str, int] = SHARES) -> DataFrame:
    """All features, split and class weight per customer, written once for all fits."""
    base = cut(with_given(labelled).select(KEY, *RFM, *GIVEN, F.col(LABEL).cast("double").alias(LABEL)))
    split = evaluation.stratified_split(base, LABEL, KEY, shares)
    made = rfm.training_features(split, _largest(split))
    return cut(evaluation.class_weights(made, LABEL).drop("positive_scale"))


def with_given(df: DataFrame) -> DataFrame:
    """The optional inputs as given, else derived or 0."""
    return fill_optional(df, GIVEN)


def _largest(table: DataFrame) -> float:
    """Largest monetary value of the training split, which scored customers are put in relation to as well."""
    top = table.where(F.col("split") == "train").agg(F.max("total_monetary_value")).first()[0]
    return 0.0 if top is None else float(top)


def classifier(name: str, rows: int = 1, **options):
    """Classifier by name with the documented settings."""
    common = {"labelCol": LABEL, "featuresCol": "features", "weightCol": "weight"}
    if name == "logistic_regression":
        # the summed loss with C = 1 corresponds to a mean loss with 1 / rows
        return LogisticRegression(maxIter=1000, regParam=1.0 / max(1, rows), standardization=False, **(common | options))
    if name == "decision_tree":
        return DecisionTreeClassifier(**({"maxDepth": 5, "seed": SEED} | common | options))
    if name == "random_forest":
        return RandomForestClassifier(**({"numTrees": 100, "maxDepth": 10, "seed": SEED} | common | options))
    if name == "gradient_boosting":
        return GBTClassifier(**({"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": SEED} | common | options))
    raise ValueError(name)


def feature_steps(features: list[str] = FEATURES, scaled: bool = True) -> list:
    out = "raw" if scaled else "features"
    steps = [VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")]
    if scaled:
        steps.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    return steps


def fit(table: DataFrame, name: str, features: list[str] = FEATURES, **options) -> PipelineModel:
    """Classifier fitted on the training rows without a missing feature.

    The largest monetary value of the training split goes into the model, so that scores do not depend on who is scored together.
    """
    train = table.where((F.col("split") == "train") & _complete(features))
    rows = train.count()
    train = search.few(train, rows, key=KEY)
    first = [] if "value_concentration" not in features else [SQLTransformer(statement=f"SELECT * EXCEPT (value_concentration), {_CONCENTRATION.format(top=_largest(table))} AS value_concentration FROM __THIS__")]
    return Pipeline(stages=[*first, *feature_steps(features), classifier(name, rows, **options)]).fit(train)


_CONCENTRATION = "coalesce(try_divide(CAST(total_monetary_value AS DOUBLE), CAST('{top!r}' AS DOUBLE)), 0D)"


def _complete(features: list[str]) -> Column:
    return F.forall(F.array(*[F.col(c).cast("double") for c in features]), lambda v: v.isNotNull())


def inputs(model: PipelineModel) -> list[str]:
    """Feature columns of a fitted model, in its order."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Probability of the risky class next to the kept columns, for every row; NULL where a feature is missing."""
    known = F.when(_complete(inputs(model)), vector_to_array("probability")[1])
    return model.transform(df).select(*keep, known.alias("risk_score"))


def predictions(table: DataFrame, names: list[str], features: list[str] = FEATURES, **options) -> DataFrame:
    """Long predictions of several models on every split."""
    out = None
    for name in names:
        p = predict(fit(table, name, features, **options.get(name, {})), table, ["split", KEY, LABEL]).withColumn("model", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


def grid_search(table: DataFrame, grid: dict[str, list] = search.GRID, folds: int = 5, parallelism: int = 6) -> DataFrame:
    """Cross-validated AUC of all random-forest settings of the grid."""
    return search.grid_search(table, FEATURES, LABEL, KEY, classifier, grid, folds, parallelism, SEED)


def tuned(table: DataFrame, found: DataFrame) -> DataFrame:
    """Metrics per split of the best setting of a search, refitted on the whole training split."""
    scores = search.refit(table, FEATURES, LABEL, KEY, classifier, search.best_setting(found), SEED)
    return evaluation.metric_table(cut(scores.withColumn("model", F.lit("random_forest_tuned"))))


MODELS = ["logistic_regression", "decision_tree", "random_forest", "gradient_boosting"]


def explainable(model: PipelineModel) -> bool:
    """Whether the classifier says what it relies on: coefficients or importances."""
    return hasattr(model.stages[-1], "coefficients") or hasattr(model.stages[-1], "featureImportances")


def importances(model: PipelineModel, spark, features: list[str] = FEATURES) -> DataFrame:
    """Importance or absolute coefficient per feature, ranked; one row per feature."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values, kind = last.featureImportances.toArray(), "importance"
    else:
        values, kind = last.coefficients.toArray(), "coefficient"
    rows = sorted(((f, float(v)) for f, v in zip(features, values)), key=lambda r: (-abs(r[1]), r[0]))
    data = [(f, v, kind, i + 1, explainable(model)) for i, (f, v) in enumerate(rows)]
    return spark.createDataFrame(data, "feature string, value double, kind string, position int, explainable boolean")


def metadata(metrics: DataFrame, model: str, features: list[str] = FEATURES) -> DataFrame:
    """One-row model record with its test metrics as JSON."""
    own = evaluation.compliance(metrics.where((F.col("model") == model) & (F.col("split") == "test")))
    record = F.to_json(
        F.struct(
            F.col("model"),
            F.struct(*[F.round(c, 6).alias(c) for c in ("roc_auc", "f1", "recall", "precision", "fnr")]).alias("metrics"),
            F.array(*[F.lit(f) for f in features]).alias("features"),
            F.col("compliant"),
        )
    )
    return own.select("model", "roc_auc", "fnr", "compliant", record.alias("record"))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Bulk scoring: shared features, probability, class, level and confidence of every row.

    ``refused`` names the missing inputs of a row without a score, else it is NULL.
    """
    # the model puts its own maximum in place of this one
    p = predict(model, rfm.training_features(with_given(df).select(KEY, *RFM, *GIVEN), 1.0), [KEY, *RFM])
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in RFM])
    return evaluation.risk_levels(p).withColumns({"is_high_risk": F.col("predicted_high_risk"), "refused": F.nullif(missing, F.lit(""))})


# --- train, compare, select, gate, save -----------------------------------------------------------

#: Models of the production flow with their settings beyond the documented ones.
CANDIDATES = {"random_forest": {"minInstancesPerNode": 5}, "gradient_boosting": {}, "logistic_regression": {}}


def train_and_select(table: DataFrame, path: str, features: list[str] = RFM, candidates: dict[str, dict] = CANDIDATES) -> DataFrame:
    """Fit the candidates, compare them on every split, gate and save the one with the highest test AUC.

    Returns metrics per model and split with ``selected`` and ``compliant`` (of the model's test split); the model and its
    record are saved under ``path``.
    """
    fitted = {name: fit(table, name, features, **options) for name, options in candidates.items()}
    scores = None
    for name, model in fitted.items():
        p = predict(model, table, ["split", KEY, LABEL]).withColumn("model", F.lit(name))
        scores = p if scores is None else scores.unionByName(p)
    # one row per model and split
    metrics = cut(evaluation.metric_table(cut(scores)))
    best = evaluation.select_model(metrics).first()["model"]
    save(fitted[best], f"{path}/model")
    record = metadata(metrics, best, features)
    record.write.mode("overwrite").json(f"{path}/record")
    gate = evaluation.compliance(metrics.where(F.col("split") == "test")).select("model", "compliant")
    return metrics.join(gate, "model").withColumn("selected", F.col("model") == best)


# --- scoring inputs -------------------------------------------------------------------------------

OPTIONAL = [
    "avg_transaction_value",
    "value_per_transaction",
    "std_transaction_value",
    "cluster",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "customer_value",
    "engagement_index",
    "value_concentration",
    "transaction_size_variability",
    "estimated_tenure_months",
    "monthly_activity",
]


def fill_optional(df: DataFrame, names: list[str] = OPTIONAL) -> DataFrame:
    """Optional features as given, else derived (mean values) or 0."""
    mean = F.when(F.col("transaction_frequency") > 0, F.col("total_monetary_value") / F.col("transaction_frequency")).otherwise(0.0)
    given = lambda c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
    derived = {"avg_transaction_value": mean, "value_per_transaction": mean}
    return df.withColumns({c: F.coalesce(given(c), derived.get(c, F.lit(0.0))) for c in names})
