"""Model input pipeline (I1-I8) as Spark ML stages.

* numeric columns: robust scaling ``(x - median) / IQR`` with exact,
  linearly interpolated quantiles fitted on the training rows (the built-in
  ``RobustScaler`` uses approximate quantiles and does not centre by default);
  a zero IQR divides by 1.
* categorical columns: ``StringIndexer`` (alphabetical; unseen values go to
  its extra ``__unknown`` label) + ``OneHotEncoder(dropLast=True)``, which
  drops exactly that extra slot: every training category keeps a slot and
  unseen values (including NULL when it was not seen) encode as zeros.
* everything else is dropped; the output is one ``features`` vector.

The fitted pipeline is an ordinary ``PipelineModel`` and persists with
``write().save()`` / ``PipelineModel.load``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.constants import CATEGORICAL_FEATURES, FEATURE_DROP, NUMERIC_FEATURES, TARGET
from farelane.ml.categories import TableIndexer
from farelane.operators.quantiles import exact_quantiles

NULL_CATEGORY = "__null__"


# ---------------------------------------------------------------- I1 / I2
def prepare_features(df: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> DataFrame:
    """The model feature columns that exist, in list order, without ``pickup_date``."""
    cols = [c for c in list(numeric) + list(categorical) if c in df.columns and c not in FEATURE_DROP]
    return df.select(*cols)


def split_xy(
    df: DataFrame, target: str = TARGET, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES, keep: Sequence[str] = ()
) -> DataFrame:
    """Features plus the label column ``label`` in one frame (I2): X and y stay row-aligned."""
    x = prepare_features(df, numeric, categorical).columns
    return df.select(*keep, *x, F.col(target).cast("double").alias("label"))


# ---------------------------------------------------------------- I3
class _RobustParams(HasInputCols, HasOutputCols):
    quantileLow = Param(Params._dummy(), "quantileLow", "lower quantile of the range", TypeConverters.toFloat)
    quantileHigh = Param(Params._dummy(), "quantileHigh", "upper quantile of the range", TypeConverters.toFloat)
    nullAsMedian = Param(Params._dummy(), "nullAsMedian", "scale NULL / NaN to 0 (the median)", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(quantileLow=0.25, quantileHigh=0.75, nullAsMedian=False)


class ExactRobustScaler(Estimator, _RobustParams, DefaultParamsReadable, DefaultParamsWritable):
    """Robust scaler with exact quantiles of all columns at once (radix selection, bounded state)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, quantileLow=0.25, quantileHigh=0.75, nullAsMedian=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ExactRobustScalerModel:
        cols = self.getInputCols()
        lo, hi = self.getOrDefault("quantileLow"), self.getOrDefault("quantileHigh")
        found = {r["column"]: r["quantiles"] for r in exact_quantiles(df, cols, [lo, 0.5, hi]).collect()}  # one row per column
        centers, scales = [], []
        for c in cols:
            low, middle, high = found.get(c, (0.0, 0.0, 1.0))  # a column without values stays as it is
            centers.append(float(middle))
            scales.append(float(high - low) or 1.0)
        model = ExactRobustScalerModel(
            inputCols=cols,
            outputCols=self.getOutputCols(),
            centers=centers,
            scales=scales,
            nullAsMedian=self.getOrDefault("nullAsMedian"),
        )
        return model._resetUid(self.uid) if hasattr(model, "_resetUid") else model


class ExactRobustScalerModel(Model, _RobustParams, DefaultParamsReadable, DefaultParamsWritable):
    centers = Param(Params._dummy(), "centers", "medians per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "IQR per column (1 where it is 0)", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, centers=None, scales=None, nullAsMedian=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = self.getOrDefault("nullAsMedian")
        cols = []
        for c, o, m, s in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("centers"), self.getOrDefault("scales")):
            v = (F.nanvl(F.col(c).cast("double"), F.lit(None)) - F.lit(m)) / F.lit(s)
            cols.append((F.coalesce(v, F.lit(0.0)) if fill else v).alias(o))
        return df.select("*", *cols)


class CategoryText(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Categories as text with NULL as its own category (so a NULL seen in training gets a slot)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            "*",
            *[
                F.coalesce(F.col(c).cast("string"), F.lit(NULL_CATEGORY)).alias(o)
                for c, o in zip(self.getInputCols(), self.getOutputCols())
            ],
        )


# ---------------------------------------------------------------- I4 / I5
def build_preprocess(
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    output_col: str = "features",
    null_numeric_as_median: bool = True,
    category_path: str | None = None,
) -> Pipeline:
    """Robust scaling of numerics + one-hot of categoricals -> ``features``.

    ``null_numeric_as_median``: Spark's linear and tree learners cannot take
    NaN, so a missing numeric value is placed at the training median (0 after
    scaling) instead of being passed through.

    ``category_path``: keep the categories in a table under this folder and join
    them (any number of categories, none on the driver) instead of in the model.
    """
    numeric = list(NUMERIC_FEATURES if numeric is None else numeric)
    categorical = list(CATEGORICAL_FEATURES if categorical is None else categorical)
    stages = []
    assembled = []
    if numeric:
        scaled = [f"_num_{c}" for c in numeric]
        stages.append(ExactRobustScaler(inputCols=numeric, outputCols=scaled, nullAsMedian=null_numeric_as_median))
        assembled += scaled
    if categorical:
        text = [f"_cat_{c}" for c in categorical]
        idx = [f"_idx_{c}" for c in categorical]
        ohe = [f"_ohe_{c}" for c in categorical]
        indexer = (
            TableIndexer(inputCols=text, outputCols=idx, path=category_path)
            if category_path
            else StringIndexer(inputCols=text, outputCols=idx, stringOrderType="alphabetAsc", handleInvalid="keep")
        )
        stages += [
            CategoryText(inputCols=categorical, outputCols=text),
            indexer,
            OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"),
        ]
        assembled += ohe
    stages.append(VectorAssembler(inputCols=assembled, outputCol=output_col, handleInvalid="keep"))
    return Pipeline(stages=stages)


def fitted_input_columns(model: PipelineModel) -> list[str]:
    cols: list[str] = []
    for st in model.stages:
        if isinstance(st, (ExactRobustScalerModel, CategoryText)):
            cols += st.getInputCols()
    return cols


# ---------------------------------------------------------------- I6 / I7
def fit_preprocess(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on the training rows only."""
    return pipeline.fit(train)


def transform(model: PipelineModel, df: DataFrame, target: str | None = TARGET, keep: Sequence[str] = ()) -> DataFrame:
    """Apply the fitted pipeline; returns ``features`` (+ ``label`` when the target exists)."""
    cols = [*keep, "features"] + (["label"] if target and target in df.columns else [])
    out = model.transform(df)
    if target and target in df.columns:
        out = out.withColumn("label", F.col(target).cast("double"))
    return out.select(*cols)


def save_preprocess(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_preprocess(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- I8
def transform_splits(splits: DataFrame, model: PipelineModel, target: str = TARGET, split_col: str = "split") -> dict[str, DataFrame]:
    """Read each split with only the fitted columns + target and transform it (I8)."""
    cols = sorted(set(fitted_input_columns(model) + [target]))
    out = {}
    for name in ("train", "val", "test"):
        part = splits.where(F.col(split_col) == name).select(*cols)
        out[name] = transform(model, part, target)
    return out
