"""Shared parts of the pyspark.ml stages.

A stage works on named feature columns and hands every other column (key, target, split) through.
Configuration and fitted state are JSON-able params, so stages save and load with the standard
pyspark.ml writer, alone or inside a PipelineModel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame

from ..functions.columns import quoted


class FeatureStage(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Params every stage has: its configuration, feature names in and out, fitted state."""

    config = Param(Params._dummy(), "config", "configuration of the stage", TypeConverters.identity)
    features_in = Param(Params._dummy(), "features_in", "feature columns read", TypeConverters.identity)
    features_out = Param(Params._dummy(), "features_out", "feature columns written", TypeConverters.identity)
    state = Param(Params._dummy(), "state", "fitted values", TypeConverters.identity)

    def __init__(self, config=None, features: Sequence[str] | None = None, **options):
        super().__init__()
        self._setDefault(config=None, features_in=None, features_out=None, state=None)
        self._set(config=config if config is not None else {})
        if features is not None:
            self._set(features_in=list(features))
        for name, value in options.items():
            self._set(**{name: value})

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    @property
    def feature_names_in(self) -> list[str]:
        return self.get("features_in")

    @property
    def feature_names_out(self) -> list[str]:
        """Feature names after the stage, in output order."""
        out = self.get("features_out")
        return list(out if out is not None else self.get("features_in"))

    def get_feature_names_out(self, input_features: Sequence[str] | None = None) -> list[str]:
        return self.feature_names_out


class FittedStage(FeatureStage, Model):
    """A fitted stage. Subclasses give the new value of the features they change or add."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return project(df, self.feature_names_in, self.feature_names_out, self.expressions(df))

    def transform_training(self, df: DataFrame) -> DataFrame:
        """The transform of the frame the stage was fitted on; it may use what fitting found out."""
        return self.transform(df)


def project(df: DataFrame, before: Sequence[str], after: Sequence[str], new: dict[str, Column]) -> DataFrame:
    """Features in output order, then the handed-through columns: one projection."""
    known, have = set(before) | set(after), set(df.columns)
    columns = [new[c].alias(c) if c in new else quoted(c) for c in after if c in new or c in have]
    return df.select(*columns, *[quoted(c) for c in df.columns if c not in known])


def column_changes(before: Sequence[str], after: Sequence[str]) -> tuple[list[str], list[str]]:
    """(removed, added) columns, each in its own order."""
    return [c for c in before if c not in set(after)], [c for c in after if c not in set(before)]


class FittableStage(FeatureStage, Estimator):
    """An unfitted stage; ``features`` defaults to all numeric columns."""

    model_class: type[FittedStage]

    def _features(self, df: DataFrame) -> list[str]:
        from ..functions.columns import numeric_columns

        wanted = self.get("features_in")
        return [c for c in wanted if c in df.columns] if wanted is not None else numeric_columns(df)

    def _model(self, features_in: Sequence[str], state=None, features_out: Sequence[str] | None = None) -> FittedStage:
        model = self.model_class(self.get("config"), features_in)
        self._copyValues(model)
        model._set(features_in=list(features_in), features_out=list(features_out if features_out is not None else features_in))
        if state is not None:
            model._set(state=state)
        return model


__all__ = ["FeatureStage", "FittableStage", "FittedStage", "column_changes", "project"]
