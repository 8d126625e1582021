"""The feature flow as a pipeline stage: fitted once, saved with a pipeline, applied to any later table.

Steps, each switched by the configuration: rare categories are grouped and the rest encoded, gaps filled and flagged, values capped
and flagged, scaled, and replaced by their weight of evidence. What a fit finds is a few numbers per column, a share of
``rare`` leaving at most ``1 / rare`` categories per column, so that it travels as text in the stage's parameters.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import cut

from . import cleaning, encoding

DEFAULTS = {
    "encoding": {"enabled": True, "max_one_hot": 15, "rare": 0.01},
    "imputation": {"enabled": True, "numeric": "median", "flags": True},
    "outliers": {"enabled": True, "lower": 0.01, "upper": 0.99, "strategy": "cap", "flags": True},
    "scaling": {"enabled": True, "kind": "standard"},
    "woe": {"enabled": True, "max_bins": 10, "min_iv": 0.02, "unseen": "null"},
}

#: Name of the group of rare and unknown categories.
RARE = "rare"


def merged(given: dict | None) -> dict:
    return {k: v | (given or {}).get(k, {}) for k, v in DEFAULTS.items()}


class FeatureFlow(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the flow on a table of one row per customer. ``key`` and ``target`` pass through untouched."""

    def __init__(self, key: str = "CustomerId", target: str = "is_high_risk", config: dict | None = None):
        super().__init__()
        self.key = Param(self, "key", "identifying column", TypeConverters.toString)
        self.target = Param(self, "target", "label of the weight of evidence", TypeConverters.toString)
        self.config = Param(self, "config", "switches of the steps as text", TypeConverters.toString)
        self._set(key=key, target=target, config=json.dumps(config or {}))

    def _fit(self, df: DataFrame) -> FeatureFlowModel:
        cfg = merged(json.loads(self.getOrDefault(self.config)))
        keep = [self.getOrDefault(self.key), self.getOrDefault(self.target)]
        types = dict(df.dtypes)
        words = [c for c in df.columns if types[c] == "string" and c not in keep]
        numbers = [c for c in cleaning.numeric_columns(df, df.columns) if c not in keep]
        found: dict = {"words": {}, "numbers": numbers, "fills": {}, "flags": [], "bounds": {}, "outlier_flags": cfg["outliers"]["flags"], "strategy": cfg["outliers"]["strategy"], "scale": {}, "bins": [], **{k: cfg["woe"][k] for k in ("unseen", "min_iv")}}
        now = cut(df.withColumns({c: F.col(c).cast("double") for c in numbers}))
        if cfg["encoding"]["enabled"]:
            found["words"] = {c: fit_words(now, c, cfg["encoding"]["max_one_hot"], cfg["encoding"]["rare"]) for c in words}
        if cfg["imputation"]["enabled"] and numbers:
            lost = now.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numbers]).first()
            found["flags"] = [c for c in numbers if lost[c]] if cfg["imputation"]["flags"] else []
            found["fills"] = {c: v for c, v in cleaning.fit_imputer(now, numbers, cfg["imputation"]["numeric"]).items() if v is not None}
            now = cleaning.impute(now, found["fills"])
        if cfg["outliers"]["enabled"] and numbers:
            bounds = cleaning.percentile_bounds(now, numbers, cfg["outliers"]["lower"], cfg["outliers"]["upper"])
            found["bounds"] = {c: b for c, b in bounds.items() if None not in b}
            now = cleaning.treat_outliers(now, found["bounds"], found["strategy"])
        if cfg["scaling"]["enabled"] and numbers:
            found["scale"] = {c: p for c, p in cleaning.fit_scaler(now, numbers, cfg["scaling"]["kind"]).items() if p[0] is not None}
            now = cleaning.scale(now, found["scale"])
        if cfg["woe"]["enabled"] and numbers:
            bins = encoding.fit_woe(cut(now), numbers, self.getOrDefault(self.target), cfg["woe"]["max_bins"])
            # at most max_bins rows per column
            found["bins"] = [r.asDict() for r in bins.select("feature", "bin", "lo", "hi", "binned", "woe", "iv").orderBy("feature", "bin").collect()]
        model = FeatureFlowModel()
        return model._resetUid(self.uid)._set(fitted=json.dumps(found))


def fit_words(df: DataFrame, c: str, max_one_hot: int, rare: float) -> dict:
    """Encoder of a text column and its categories with their shares, those below ``rare`` as one group."""
    if not rare > 0:
        raise ValueError("the share of rare categories bounds the fitted table and must be positive")
    shares = encoding.fit_frequencies(df, c)
    frequent = {r[c]: r[f"{c}_freq"] for r in shares.where(F.col(f"{c}_freq") >= rare).collect()}
    rest = shares.where(F.col(f"{c}_freq") < rare).agg(F.sum(f"{c}_freq")).first()[0]
    kept = sorted(frequent)
    every = sorted([*kept, *([RARE] if rest else [])])
    kind = "label" if len(every) <= 2 else "onehot" if len(every) <= max_one_hot else "frequency"
    return {"kind": kind, "kept": kept, "categories": every, "shares": frequent | ({RARE: rest} if rest else {})}


def _encoded(c: str, fit: dict) -> dict[str, Column]:
    """Output columns of a text column: NULL gives -1, zeros or 0, an unknown value what the rare group gives."""
    v = F.when(F.col(c).isin(fit["kept"]), F.col(c)).when(F.col(c).isNotNull(), F.lit(RARE)) if fit["kept"] else F.when(F.col(c).isNotNull(), F.lit(RARE))
    if fit["kind"] == "onehot":
        return {f"{c}_{x}": F.coalesce((v == x).cast("int"), F.lit(0)) for x in fit["categories"]}
    if fit["kind"] == "label":
        code = F.lit(-1)
        for i, x in enumerate(fit["categories"]):
            code = F.when(v == x, i).otherwise(code)
        return {f"{c}_code": code}
    share = F.lit(0.0)
    for x in fit["categories"]:
        share = F.when(v == x, F.lit(float(fit["shares"][x]))).otherwise(share)
    return {f"{c}_freq": share}


class FeatureFlowModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted flow: one projection, no further pass over the data."""

    def __init__(self):
        super().__init__()
        self.fitted = Param(self, "fitted", "what the fit found, as text", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        found = json.loads(self.getOrDefault(self.fitted))
        out = df.withColumns({c: F.col(c).cast("double") for c in found["numbers"]})
        for c, fit in found["words"].items():
            out = out.withColumns(_encoded(c, fit)).drop(c)
        if found["flags"]:
            out = out.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in found["flags"]})
        out = cleaning.impute(out, found["fills"]) if found["fills"] else out
        if found["bounds"]:
            out = cleaning.treat_outliers(out, {c: tuple(b) for c, b in found["bounds"].items()}, found["strategy"])
            out = out if found["outlier_flags"] else out.drop(*[f"{c}_outlier" for c in found["bounds"]])
        out = cleaning.scale(out, {c: tuple(p) for c, p in found["scale"].items()}) if found["scale"] else out
        return encoding.woe_apply(out, found["bins"], found["unseen"], found["min_iv"]) if found["bins"] else out


