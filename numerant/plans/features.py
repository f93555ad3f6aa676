"""Feature engineering stages: interactions, housing features, polynomial terms, and their chain."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame

from ..functions.columns import as_double, numeric_columns
from ..functions.features import (
    INTERACTION_TYPES,
    available_domain_features,
    domain_feature,
    interaction,
    polynomial_term,
    polynomial_terms,
)
from .base import FittableStage, FittedStage
from .preprocessing import _loaded, feature_names_out

log = logging.getLogger(__name__)


class InteractionModel(FittedStage):
    """Adds one column per valid interaction; all of them read the columns as they came in."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {i["name"]: interaction(i["type"], *i["features"][:2]) for i in self.get("state")}


class InteractionFeatureCreator(FittableStage):
    """Interactions [{'type': 'product'|'ratio'|'diff'|'sum', 'features': [a, b], 'name': new}].

    An interaction with a missing column or an unknown type is left out with a warning.
    """

    model_class = InteractionModel

    def _fit(self, df: DataFrame) -> InteractionModel:
        features = self._features(df)
        valid = []
        for spec in self.get("config") or []:
            missing = [c for c in spec.get("features", []) if c not in df.columns]
            if missing:
                log.warning("interaction '%s' left out: missing columns %s", spec.get("name"), missing)
            elif spec.get("type") not in INTERACTION_TYPES:
                log.warning("interaction '%s' left out: unknown type '%s'", spec.get("name"), spec.get("type"))
            else:
                valid.append(spec)
        names = list(dict.fromkeys([*features, *[s["name"] for s in valid]]))
        return self._model(features, valid, names)


class _Domain(Params):
    mapping = Param(Params._dummy(), "mapping", "input name -> column of the frame", TypeConverters.identity)
    division = Param(Params._dummy(), "division", "'null', 'ieee' or 'zero' at a zero denominator", TypeConverters.toString)


class DomainFeatureModel(FittedStage, _Domain):
    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {n: domain_feature(n, self.get("mapping"), self.get("division")) for n in self.get("state")}


class DomainFeatures(FittableStage, _Domain):
    """The housing features whose inputs all exist."""

    model_class = DomainFeatureModel

    def __init__(self, features=None, mapping: Mapping[str, str] | None = None, division: str = "null"):
        super().__init__(None, features, mapping=dict(mapping or {}), division=division)

    def _fit(self, df: DataFrame) -> DomainFeatureModel:
        features = self._features(df)
        made = available_domain_features(df.columns, self.get("mapping"))
        return self._model(features, made, [*features, *[n for n in made if n not in features]])


class _Polynomial(Params):
    degree = Param(Params._dummy(), "degree", "largest degree of a term", TypeConverters.toInt)
    interaction_only = Param(Params._dummy(), "interaction_only", "no powers", TypeConverters.toBoolean)
    include_bias = Param(Params._dummy(), "include_bias", "constant column '1'", TypeConverters.toBoolean)
    subset = Param(Params._dummy(), "subset", "columns to expand", TypeConverters.identity)


class PolynomialModel(FittedStage, _Polynomial):
    """Untouched features first, then the terms; without valid columns nothing changes."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        out = {c: as_double(c) for c in self.feature_names_in if c in df.columns}
        out.update({name: polynomial_term(factors) for name, factors in self.get("state")})
        return out


class PolynomialFeatureCreator(FittableStage, _Polynomial):
    model_class = PolynomialModel

    def __init__(
        self, degree: int = 2, interaction_only: bool = False, include_bias: bool = False,
        features_to_transform: Sequence[str] | None = None, features=None,
    ):
        subset = list(features_to_transform) if features_to_transform else None
        super().__init__(
            None, features, degree=degree, interaction_only=interaction_only, include_bias=include_bias, subset=subset
        )

    def _fit(self, df: DataFrame) -> PolynomialModel:
        features, subset = self._features(df), self.get("subset")
        chosen = [c for c in subset if c in features] if subset else features
        if not chosen:
            log.warning("no column to expand")
            return self._model(features, [])
        terms = polynomial_terms(chosen, self.get("degree"), self.get("interaction_only"), self.get("include_bias"))
        others = [c for c in features if c not in chosen]
        return self._model(features, [[n, list(f)] for n, f in terms], [*others, *[n for n, _ in terms]])


class FeatureEngineer:
    """Interactions, housing features (on by default), polynomial terms (if configured).

    Config: {'interactions': [...], 'domain_features': bool,
    'polynomial': {'degree', 'interaction_only', 'features'}}.
    """

    def __init__(self, config: Mapping | None = None, passthrough: Sequence[str] = (), features: Sequence[str] | None = None, division: str = "null"):
        self.config = dict(config or {})
        self.passthrough = list(passthrough)
        self.features = list(features) if features is not None else None
        self.division = division
        self.model_: PipelineModel | None = None
        self.feature_names_in_: list[str] | None = None

    def fit(self, df: DataFrame) -> FeatureEngineer:
        """Reads the schema only; no job runs."""
        features = self.features or numeric_columns(df, self.passthrough)
        self.feature_names_in_ = list(features)
        stages, data, names = [], df.select(*features).limit(0), list(features)

        def add(stage: FittableStage) -> None:
            nonlocal data, names
            model = stage.fit(data)
            stages.append(model)
            data, names = model.transform(data), model.feature_names_out

        if self.config.get("interactions"):
            add(InteractionFeatureCreator(self.config["interactions"], names))
        if self.config.get("domain_features", True):
            add(DomainFeatures(names, division=self.division))
        if "polynomial" in self.config:
            poly = self.config["polynomial"] or {}
            add(
                PolynomialFeatureCreator(
                    poly.get("degree", 2), poly.get("interaction_only", False), False, poly.get("features"), names
                )
            )
        self.model_ = Pipeline(stages=stages).fit(df.limit(0)) if stages else PipelineModel([])
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model_ is None:
            raise ValueError("fit before transform")
        return self.model_.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def get_feature_names_out(self) -> list[str]:
        return feature_names_out(self.model_, self.feature_names_in_)

    def save(self, path: str) -> None:
        self.model_.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> FeatureEngineer:
        return _loaded(FeatureEngineer(), path)
