"""Preprocessing stages: missing values, outliers, column reduction, scaling, and their chain."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import affine, as_double, clip, log_magnitude, numeric_columns, quoted
from ..operators.order_stats import quantiles
from ..operators.stats import correlations, iqr_bounds, modes, moments, outlier_limits, total_missing, winsor_bounds
from ..session import cached
from .base import FittableStage, FittedStage, project

log = logging.getLogger(__name__)

# The strategies a configuration may name.
IMPUTE_STRATEGIES = ("mean", "median", "most_frequent")
OUTLIER_STRATEGIES = ("log_transform", "capping_iqr", "capping_winsor")
SCALERS = ("RobustScaler", "StandardScaler", "MinMaxScaler")


def _present(config: Mapping[str, Sequence[str]], strategy: str, features: Sequence[str]) -> list[str]:
    """The configured columns that exist; unknown names are passed over."""
    wanted = list(config.get(strategy) or [])
    found = [c for c in dict.fromkeys(wanted) if c in features]
    if wanted and not found:
        log.warning("strategy '%s': no configured column exists", strategy)
    return found


class _Method(Params):
    method = Param(Params._dummy(), "method", "'exact' or 'approx' quantiles", TypeConverters.toString)


class MissingValueModel(FittedStage, _Method):
    """Replaces NULL by the fitted value; other columns keep their NULLs."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        fill = self.get("state")
        return {c: F.coalesce(as_double(c), F.lit(fill[c])) if c in fill else as_double(c) for c in self.feature_names_in}

    def remaining_missing(self, df: DataFrame) -> int:
        """NULLs left outside the 'no_action' columns after the transform (runs a job)."""
        kept = set(self.get("config").get("no_action") or [])
        out = self.transform(df)
        return total_missing(out.select(*[c for c in self.feature_names_out if c not in kept]))


class MissingValueHandler(FittableStage, _Method):
    """Imputation by column: {'mean' | 'median' | 'most_frequent' | 'no_action': [columns]}."""

    model_class = MissingValueModel

    def __init__(self, config=None, features=None, method: str = "exact"):
        super().__init__(config, features, method=method)

    def _fit(self, df: DataFrame) -> MissingValueModel:
        config, features = self.get("config"), self._features(df)
        unknown = [s for s, cols in config.items() if cols and s not in (*IMPUTE_STRATEGIES, "no_action")]
        if unknown:
            raise ValueError(f"unknown imputation strategies {unknown}")
        fill: dict[str, float] = {}
        mean, median, mode = (_present(config, s, features) for s in IMPUTE_STRATEGIES)
        fill.update({c: m["mean"] for c, m in moments(df, mean).items()})
        if median:
            fill.update({c: q[0] for c, q in quantiles(df, [0.5], median, self.get("method")).items()})
        fill.update(modes(df, mode))
        empty = [c for c, v in fill.items() if v is None]
        if empty:
            raise ValueError(f"columns without any value cannot be imputed: {empty}")
        return self._model(features, fill)


class _Outliers(Params):
    iqr_factor = Param(Params._dummy(), "iqr_factor", "IQRs allowed outside the quartiles", TypeConverters.toFloat)
    winsor_limits = Param(Params._dummy(), "winsor_limits", "shares clipped at both ends", TypeConverters.toListFloat)
    winsor_mode = Param(Params._dummy(), "winsor_mode", "'per_batch' or 'fitted'", TypeConverters.toString)


def _log_and_cap(df: DataFrame, features: Sequence[str], logged: Sequence[str], bounds: Mapping[str, Mapping[str, float]]) -> dict[str, Column]:
    """Log first, then the bounds, which belong to the values before the log."""
    out = {}
    for c in features:
        value = as_double(c)
        if c in logged:
            value = log_magnitude(value)
        if c in bounds:
            value = clip(value, bounds[c]["lower"], bounds[c]["upper"])
        out[c] = value
    return out


class OutlierModel(FittedStage, _Outliers, _Method):
    """log, then IQR bounds, then winsorizing.

    In mode 'per_batch' the winsor limits are order statistics of the frame being transformed,
    computed by a job when ``transform`` is called; a single row stays as it is. In mode 'fitted'
    they are those of the training frame, as a stream needs.
    """

    def transform_training(self, df: DataFrame) -> DataFrame:
        """Fitting has already found the limits of this frame."""
        return project(df, self.feature_names_in, self.feature_names_out, self._expressions(df, per_batch=False))

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return self._expressions(df, self.get("winsor_mode") == "per_batch")

    def _expressions(self, df: DataFrame, per_batch: bool) -> dict[str, Column]:
        state = self.get("state")
        out = _log_and_cap(df, self.feature_names_in, state["log"], state["iqr"])
        winsor = [c for c in state["winsor"] if c in out]
        if winsor and per_batch:
            if df.isStreaming:
                raise ValueError("winsor_mode='per_batch' needs the whole frame; fit with winsor_mode='fitted' for streams")
            limits = winsor_bounds(df, winsor, tuple(self.get("winsor_limits")), {c: out[c] for c in winsor})
        else:
            limits = state["winsor_bounds"]
        for c in winsor:
            if limits.get(c):
                out[c] = clip(out[c], *limits[c])
        return out


class OutlierHandler(FittableStage, _Outliers, _Method):
    """Outlier treatment: {'log_transform' | 'capping_iqr' | 'capping_winsor' | ...: [columns]}.

    'remove' and 'no_action' are accepted and change nothing.
    """

    model_class = OutlierModel

    def __init__(
        self, config=None, features=None, iqr_factor: float = 1.5, winsor_limits=(0.05, 0.05),
        winsor_mode: str = "per_batch", method: str = "exact",
    ):
        if winsor_mode not in ("per_batch", "fitted"):
            raise ValueError(f"unknown winsor_mode '{winsor_mode}'")
        super().__init__(
            config, features, iqr_factor=float(iqr_factor), winsor_limits=list(winsor_limits),
            winsor_mode=winsor_mode, method=method,
        )

    def _fit(self, df: DataFrame) -> OutlierModel:
        config, features = self.get("config"), self._features(df)
        logged, capped, winsor = (_present(config, s, features) for s in OUTLIER_STRATEGIES)
        factor, shares = self.get("iqr_factor"), tuple(self.get("winsor_limits"))
        # limits of columns without IQR bounds come from the same passes as the bounds
        first = [c for c in winsor if c not in capped]
        if self.get("method") == "exact":
            bounds, limits = outlier_limits(df, capped, first, factor, shares, _log_and_cap(df, first, logged, {}))
        else:
            bounds = iqr_bounds(df, capped, factor, self.get("method")) if capped else {}
            limits = winsor_bounds(df, first, shares, _log_and_cap(df, first, logged, {}))
        bounds = {c: b for c, b in bounds.items() if b["lower"] is not None}
        both = [c for c in winsor if c in capped]
        if both:
            limits.update(winsor_bounds(df, both, shares, _log_and_cap(df, both, logged, bounds)))
        state = {"log": logged, "iqr": bounds, "winsor": winsor, "winsor_bounds": {c: list(b) for c, b in limits.items() if b}}
        return self._model(features, state)


class ColumnReducerModel(FittedStage):
    """Leaves out the configured columns."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {}

    def get_feature_names_out(self, input_features: Sequence[str] | None = None) -> list[str]:
        if input_features is None:
            return self.feature_names_out
        return [c for c in input_features if c not in set(self.get("state")["dropped"])]


class CorrelationReducer(FittableStage):
    """Drops the columns listed under 'remove'; unknown names are passed over.

    The list is the decision: no correlation threshold is applied. ``report`` gives the
    correlations of the listed columns for whoever writes that list.
    """

    model_class = ColumnReducerModel

    def _fit(self, df: DataFrame) -> ColumnReducerModel:
        features = self._features(df)
        dropped = _present(self.get("config"), "remove", features)
        return self._model(features, {"dropped": dropped}, [c for c in features if c not in dropped])

    def report(self, df: DataFrame) -> DataFrame:
        """(col_a, col_b, corr) of every column to be dropped with all features."""
        features = self._features(df)
        return correlations(df, features, against=_present(self.get("config"), "remove", features))


class _Scaler(Params):
    scaler_type = Param(Params._dummy(), "scaler_type", "which scaler", TypeConverters.toString)


class FeatureScalerModel(FittedStage, _Scaler):
    """(x - center) / scale for every feature."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        state = self.get("state")
        return {c: affine(as_double(c), *state[c]) for c in self.feature_names_in}


class FeatureScaler(FittableStage, _Scaler, _Method):
    """RobustScaler (median, IQR), StandardScaler (mean, population deviation) or MinMaxScaler."""

    model_class = FeatureScalerModel

    def __init__(self, scaler_type: str = "RobustScaler", features=None, method: str = "exact"):
        super().__init__(None, features, scaler_type=scaler_type, method=method)

    def _fit(self, df: DataFrame) -> FeatureScalerModel:
        kind, features = self.get("scaler_type"), self._features(df)
        if kind == "RobustScaler":
            marks = quantiles(df, [0.25, 0.5, 0.75], features, self.get("method"))
            stats = {c: (q[1], None if q[0] is None else q[2] - q[0], 1.0) for c, q in marks.items()}
        elif kind in ("StandardScaler", "MinMaxScaler"):
            seen = moments(df, features)
            if kind == "StandardScaler":
                stats = {c: (m["mean"], m["std_pop"], max(1.0, abs(m["mean"] or 0.0))) for c, m in seen.items()}
            else:
                stats = {c: (m["min"], None if m["min"] is None else m["max"] - m["min"], 1.0) for c, m in seen.items()}
        else:
            raise ValueError(f"scaler type '{kind}' is not supported, only {SCALERS}")
        empty = [c for c, s in stats.items() if s[0] is None]
        if empty:
            raise ValueError(f"columns without any value cannot be scaled: {empty}")
        # a scale of nothing but rounding counts as zero, and zero scales become 1
        tiny = 10 * 2.220446049250313e-16
        return self._model(features, {c: [m, 1.0 if s <= tiny * size else s] for c, (m, s, size) in stats.items()})


def _without_dropped(config: Mapping) -> Mapping:
    """Treatments of columns that are dropped later cannot show in the output: do not fit them."""
    gone = set((config.get("handling_correlated_features") or {}).get("remove") or [])
    out = dict(config)
    for key in ("handling_na", "handling_outliers"):
        if gone and config.get(key):
            out[key] = {s: [c for c in cols or [] if c not in gone] for s, cols in config[key].items()}
    return out


def preprocessing_stages(config: Mapping, features: Sequence[str], **options) -> list[FittableStage]:
    """The stages a configuration asks for, in their fixed order.

    A stage exists iff its key does: handling_na, handling_outliers,
    handling_correlated_features, scaler.
    """
    method = options.pop("method", "exact")
    stages: list[FittableStage] = []
    config = _without_dropped(config)
    if "handling_na" in config:
        stages.append(MissingValueHandler(config["handling_na"] or {}, features, method=method))
    if "handling_outliers" in config:
        stages.append(OutlierHandler(config["handling_outliers"] or {}, features, method=method, **options))
    if "handling_correlated_features" in config:
        stages.append(CorrelationReducer(config["handling_correlated_features"] or {}, features))
    if "scaler" in config:
        kept = features
        if "handling_correlated_features" in config:
            gone = set((config["handling_correlated_features"] or {}).get("remove") or [])
            kept = [c for c in features if c not in gone]
        stages.append(FeatureScaler(config["scaler"], kept, method=method))
    return stages


class DataPreprocessor:
    """The configured chain; every stage is fitted on the output of the one before.

    Features are all numeric columns but ``passthrough`` (key, target, split). Columns that the
    configuration drops anyway are left out of the fitting passes. ``fit`` makes a few passes over
    the features: leave ``cache`` on where they are computed (a join, a derivation), switch it off
    where they are columns of a written table.
    """

    def __init__(self, config: Mapping, passthrough: Sequence[str] = (), features: Sequence[str] | None = None, **options):
        self.config = dict(config)
        self.passthrough = list(passthrough)
        self.features = list(features) if features is not None else None
        self.options = options
        self.model_: PipelineModel | None = None
        self.feature_names_in_: list[str] | None = None

    def fit(self, df: DataFrame, cache: bool = True) -> DataPreprocessor:
        features = self.features or numeric_columns(df, self.passthrough)
        absent = [c for c in features if c not in df.columns]
        if absent:
            raise ValueError(f"feature columns not found: {absent}")
        self.feature_names_in_ = features
        gone = set((self.config.get("handling_correlated_features") or {}).get("remove") or [])
        needed = df.select(*[quoted(c) for c in features if c not in gone])
        with cached(needed, cache and df.storageLevel == StorageLevel.NONE) as data:
            # nothing is fitted on columns that are dropped: they take part as a name only
            data = data.withColumns({c: F.lit(None).cast("double") for c in features if c in gone})
            models = []
            for stage in preprocessing_stages(self.config, features, **self.options):
                models.append(stage.fit(data))
                data = models[-1].transform_training(data)
        self.model_ = PipelineModel(models)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model_ is None:
            raise ValueError("fit before transform")
        return self.model_.transform(df)

    def transform_training(self, df: DataFrame) -> DataFrame:
        """The transform of the very frame ``fit`` was given, without computing its limits again."""
        if self.model_ is None:
            raise ValueError("fit before transform")
        for model in self.model_.stages:
            df = model.transform_training(df)
        return df

    def with_fitted_limits(self) -> DataPreprocessor:
        """The same chain, whose winsor limits are those of the training rows: what serving needs."""
        if self.model_ is None:
            raise ValueError("fit before transform")
        stages = [s.copy() for s in self.model_.stages]
        for stage in stages:
            if stage.hasParam("winsor_mode"):
                stage._set(winsor_mode="fitted")
        out = DataPreprocessor(self.config, self.passthrough, self.features, **{**self.options, "winsor_mode": "fitted"})
        out.model_, out.feature_names_in_ = PipelineModel(stages), self.feature_names_in_
        return out

    def fit_transform(self, df: DataFrame, cache: bool = True) -> DataFrame:
        return self.fit(df, cache).transform_training(df)

    def get_feature_names_out(self) -> list[str]:
        return feature_names_out(self.model_, self.feature_names_in_)

    def save(self, path: str) -> None:
        self.model_.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> DataPreprocessor:
        return _loaded(DataPreprocessor({}), path)


def feature_names_out(model: PipelineModel, features: Sequence[str]) -> list[str]:
    return model.stages[-1].feature_names_out if model.stages else list(features)


def _loaded(holder, path: str):
    holder.model_ = PipelineModel.load(path)
    if holder.model_.stages:
        holder.feature_names_in_ = list(holder.model_.stages[0].feature_names_in)
    return holder
