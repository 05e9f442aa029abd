"""Imputation steps as pipeline stages.

Each learns a few scalars per column on the training rows and applies them to
any rows, so train, test and scoring data get the same values. The fitted
stages are saved inside the ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import MISSING, cap_and_fill, fill_outside_domain, fill_with_mode
from .stats import exact_quantiles, fences, modes


class IqrCapImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Pull outliers onto the fences, fill missing numbers with the median."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "IqrCapImputerModel":
        columns = self.getInputCols()
        found = exact_quantiles(df, columns)
        empty = [c for c in columns if found[c][0] is None]
        if empty:
            raise ValueError(f"no values to learn from in {', '.join(empty)}")
        limits = [fences(found[c][0], found[c][2]) for c in columns]
        return IqrCapImputerModel(
            inputCols=columns,
            lower=[low for low, _ in limits],
            median=[found[c][1] for c in columns],
            upper=[high for _, high in limits],
        )


class IqrCapImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    lower = Param(Params._dummy(), "lower", "lower fences", TypeConverters.toListFloat)
    median = Param(Params._dummy(), "median", "medians", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper fences", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=None, median=None, upper=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, low, mid, high = (self.getOrDefault(p) for p in ("inputCols", "lower", "median", "upper"))
        return df.withColumns({c: cap_and_fill(c, *limits) for c, *limits in zip(columns, low, mid, high)})


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing texts, and the sentinel, with the most frequent value."""

    sentinel = Param(Params._dummy(), "sentinel", "text of a missing value", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, sentinel: str = MISSING):
        super().__init__()
        self._setDefault(sentinel=MISSING)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        columns = self.getInputCols()
        sentinel = self.getOrDefault("sentinel")
        return ModeImputerModel(
            inputCols=columns,
            sentinel=sentinel,
            modes=_collect_modes(df, columns, exclude=("null", sentinel)),
        )


class ModeImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    sentinel = Param(Params._dummy(), "sentinel", "text of a missing value", TypeConverters.toString)
    modes = Param(Params._dummy(), "modes", "most frequent values", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, sentinel=MISSING, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        sentinel = [self.getOrDefault("sentinel")]
        pairs = zip(self.getInputCols(), self.getOrDefault("modes"))
        return df.withColumns({c: fill_with_mode(c, F.lit(mode), sentinel) for c, mode in pairs})


class DomainModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing and out-of-range whole numbers with the most frequent value.

    The most frequent value is taken over everything that is not NULL, inside
    the range or not.
    """

    lowest = Param(Params._dummy(), "lowest", "least valid value", TypeConverters.toInt)
    highest = Param(Params._dummy(), "highest", "greatest valid value", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, lowest: int = 0, highest: int = 8):
        super().__init__()
        self._setDefault(lowest=0, highest=8)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "DomainModeImputerModel":
        columns = self.getInputCols()
        return DomainModeImputerModel(
            inputCols=columns,
            lowest=self.getOrDefault("lowest"),
            highest=self.getOrDefault("highest"),
            modes=_collect_modes(df, columns, exclude=()),
        )


class DomainModeImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    lowest = Param(Params._dummy(), "lowest", "least valid value", TypeConverters.toInt)
    highest = Param(Params._dummy(), "highest", "greatest valid value", TypeConverters.toInt)
    modes = Param(Params._dummy(), "modes", "most frequent values", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, lowest=0, highest=8, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        low, high = self.getOrDefault("lowest"), self.getOrDefault("highest")
        types = {f.name: f.dataType for f in df.schema}
        pairs = zip(self.getInputCols(), self.getOrDefault("modes"))
        return df.withColumns(
            {c: fill_outside_domain(c, F.lit(mode).cast(types[c]), low, high) for c, mode in pairs}
        )


def _collect_modes(df: DataFrame, columns: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """One row per column reaches the driver."""
    found = {row["column"]: row["mode"] for row in modes(df, columns, exclude).collect()}
    empty = [c for c in columns if c not in found]
    if empty:
        raise ValueError(f"no values to learn from in {', '.join(empty)}")
    return [found[c] for c in columns]
