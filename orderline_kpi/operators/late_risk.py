"""Late-delivery risk: features, logistic regression and its evaluation.

With the default features the measured days (``ship_real``) are an input although they
decide whether a delivery is late, so the score says little about prediction: pass
``numeric=("ship_sched", "sales")`` for a model that knows only what is known at order
time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.schema import require_columns
from orderline_kpi.sources.scratch import WorkArea

NUMERIC_FEATURES = ("ship_real", "ship_sched", "sales")
CATEGORICAL_FEATURES = ("ship_mode", "category", "region")
LATE_RISK_COLUMNS = ("late", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)
LATE_RISK_INPUTS = ("order_id", *LATE_RISK_COLUMNS)


def late_risk_dataset(lines: DataFrame) -> DataFrame:
    """Label and features, without lines that lack any of them.

    ``order_id`` comes along for the split; a line without one is kept, and where there is no
    such column, no line has one.
    """
    require_columns(lines, LATE_RISK_COLUMNS, "late_risk_dataset")
    label_and_features = ["label", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    return lines.select(
        F.col("order_id") if "order_id" in lines.columns else F.lit(None).cast("string").alias("order_id"),
        F.col("late").cast("int").alias("label"),
        "ship_real", "ship_sched", "ship_mode", "category", "region",
        F.col("sales").cast("double").alias("sales"),
    ).na.drop(subset=label_and_features)


def split_side(key: Column, train_fraction: float = 0.8, seed: int = 42) -> Column:
    """'train' or 'test', decided by a hash of seed and key.

    All lines with one key fall on one side, and, other than with ``randomSplit``, on the
    same side however the data is partitioned or sorted.
    """
    if not 0 < train_fraction < 1:
        raise ValueError("train_fraction must lie between 0 and 1")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    bound = f"{int(train_fraction * 2**32):08x}"
    return F.when(F.substring(digest, 1, 8) < bound, "train").otherwise("test")


def with_split(dataset: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """``dataset`` with its side of the split, by order; a line without an order id goes by its other columns."""
    others = F.concat_ws("|", *[F.col(c).cast("string") for c in ("label", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)])
    key = F.coalesce(F.col("order_id").cast("string"), others)
    return dataset.withColumn("split", split_side(key, train_fraction, seed))


def split_counts(dataset: DataFrame) -> DataFrame:
    """Rows on each side of the split, in one pass; they add up to the data set."""
    return dataset.groupBy("split").agg(F.count("*").alias("row_count"))


def fit_features(
    dataset: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> PipelineModel:
    """Index and one-hot encode the categories, then assemble ``features``.

    The most frequent value has index 0, ties are in alphabetical order.  A value not
    seen in ``dataset`` is encoded as all zeros.

    The list of values goes to the driver and from there to every task, like the model, which has a
    coefficient for each of them.  Of ``dataset`` only the categories are read, once.
    """
    indexed = [f"{column}_idx" for column in categorical]
    encoded = [f"{column}_oh" for column in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features"),
    ]).fit(dataset)


def category_index(features: PipelineModel, dataset: DataFrame) -> DataFrame:
    """One row per feature and value with the index it was given."""
    indexer = features.stages[0]
    entries = [
        (column, value, float(index))
        for column, values in zip(indexer.getInputCols(), indexer.labelsArray)
        for index, value in enumerate(values)
    ]
    return dataset.sparkSession.createDataFrame(
        entries, "feature string, value string, category_index double"
    )


def predictions_of(scored: DataFrame) -> DataFrame:
    """Label, predicted label and the probability of being late, per line."""
    return scored.select(
        "order_id", "label", "prediction",
        vector_to_array("probability")[1].alias("late_probability"),
    )


@dataclass(frozen=True)
class LateRisk:
    """A fitted model with both sides of its data, which are stored until ``close``, or the end of a ``with`` block."""

    features: PipelineModel
    model: LogisticRegressionModel
    staged: DataFrame
    work: WorkArea

    @property
    def test(self) -> DataFrame:
        return self.staged.where(F.col("split") == "test")

    def score(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(self.features.transform(dataset))

    def predictions(self) -> DataFrame:
        return predictions_of(self.score(self.test))

    def split_counts(self) -> DataFrame:
        return split_counts(self.staged)

    def auc(self) -> DataFrame:
        """One row: area under the ROC curve on the test side."""
        area = BinaryClassificationEvaluator(labelCol="label").evaluate(self.score(self.test))
        return self.staged.sparkSession.createDataFrame(
            [("areaUnderROC", area)], "metric string, value double"
        )

    def save(self, path: str) -> None:
        """Write the feature pipeline and the regression below ``path``."""
        self.features.write().overwrite().save(f"{path.rstrip('/')}/features")
        self.model.write().overwrite().save(f"{path.rstrip('/')}/model")

    def close(self) -> None:
        """Delete the stored data; predictions must have been used by then."""
        self.work.close()

    def __enter__(self) -> LateRisk:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def train_late_risk(
    lines: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    train_fraction: float = 0.8,
    seed: int = 42,
) -> LateRisk:
    """Fit features and model on the train side.

    The data set is first written to the shared folder, one directory per side: fitting
    passes over it many times, and each pass, as well as the repair of a lost executor,
    is then a read of that side instead of a run of everything behind ``lines``.
    """
    work = WorkArea(lines.sparkSession, "late_risk")
    dataset = with_split(late_risk_dataset(lines), train_fraction, seed)
    staged = work.table(dataset.hint("rebalance", F.col("split")), "dataset", ("split",))
    train = staged.where(F.col("split") == "train")
    features = fit_features(train, numeric)
    model = LogisticRegression(labelCol="label", featuresCol="features").fit(
        features.transform(train).select("label", "features"))
    return LateRisk(features, model, staged, work)
