"""Row validation and batch scoring. Every step is a projection, so it also runs on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.rules import HOUSING_FIELDS, HOUSING_RULES, Rule, broken, violations
from .features import FeatureEngineer
from .models import PREDICTION, predict
from .preprocessing import DataPreprocessor

VIOLATIONS = "violations"


def validate(df: DataFrame, rules: Sequence[Rule] = HOUSING_RULES) -> DataFrame:
    """Add the array of broken rules of each row; texts are put together only for rows that break one."""
    none = F.array().cast("array<string>")
    return df.withColumn(VIOLATIONS, F.when(broken(rules, df.columns), violations(rules, df.columns)).otherwise(none))


def parted(df: DataFrame, rules: Sequence[Rule] = HOUSING_RULES) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all rules, and the others with the array of what they break."""
    bad = broken(rules, df.columns)
    return df.where(~bad), df.where(bad).withColumn(VIOLATIONS, violations(rules, df.columns))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def invalid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size(VIOLATIONS) > 0)


def request_columns(df: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Request fields in schema order as doubles, then the handed-through columns."""
    fields = [quoted(c).cast("double").alias(c) for c in HOUSING_FIELDS]
    return df.select(*fields, *[quoted(c) for c in passthrough])


class Scorer:
    """Loaded preprocessing, engineering and model, applied in this order.

    Both fitted parts have to be there: a model trained on prepared columns cannot score raw ones.
    Winsor limits are those of the training rows, whatever mode they were fitted in: the score of a
    row does not depend on the rows, or the micro-batch, it comes with.
    """

    def __init__(
        self, preprocessor: DataPreprocessor, engineer: FeatureEngineer | None, model: PipelineModel,
        model_name: str = "best_model", model_version: str = "1.0.0",
    ):
        if preprocessor is None or preprocessor.model_ is None:
            raise ValueError("the preprocessor is not loaded")
        self.preprocessor, self.engineer, self.model = preprocessor.with_fitted_limits(), engineer, model
        self.model_name, self.model_version = model_name, model_version

    @staticmethod
    def load(preprocessor_path: str, engineer_path: str | None, model_path: str, **names) -> Scorer:
        engineer = FeatureEngineer.load(engineer_path) if engineer_path else None
        return Scorer(DataPreprocessor.load(preprocessor_path), engineer, PipelineModel.load(model_path), **names)

    def preprocess(self, df: DataFrame) -> DataFrame:
        prepared = self.preprocessor.transform(df)
        return self.engineer.transform(prepared) if self.engineer else prepared

    def score(self, df: DataFrame, passthrough: Sequence[str] = (), allow_empty: bool = False) -> DataFrame:
        """The handed-through columns, predicted_price, model_name and model_version of every row."""
        if not (df.isStreaming or allow_empty) and df.isEmpty():
            raise ValueError("no rows to score")
        out = predict(self.model, self.preprocess(df))
        return out.select(
            *[quoted(c) for c in passthrough],
            F.col(PREDICTION).alias("predicted_price"),
            F.lit(self.model_name).alias("model_name"),
            F.lit(self.model_version).alias("model_version"),
        )
