"""Category codes kept as a table, and all category facts from one counting pass.

A fitted coder is a Parquet table of (column, value, n, index) that is saved with
the model and applied by join. No list of categories passes through the driver or a
task closure, so a column may have any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import MISSING
from ..session import landed, shared_dir
from .encode import INDEXED, _label_order, number_by_ranges
from .impute import DomainModeImputerModel, ModeImputerModel
from .stats import value_frequencies

CODES = "value string, n long, index double, column string"
INVALID = ("error", "skip", "keep")


def write_codes(labels: DataFrame, order: str) -> str:
    """Number (column, value, n) within each column, and write it by column."""
    path = shared_dir(labels.sparkSession, "codes")
    number_by_ranges(labels, _label_order(order)).select("value", "n", "index", "column").write.partitionBy("column").parquet(path)
    return path


class _Writer(MLWriter):
    def __init__(self, model: "CategoryCoderModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        self.model.codes().write.partitionBy("column").parquet(f"{path}/codes")


class _Reader(MLReader):
    def load(self, path: str) -> "CategoryCoderModel":
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        out = CategoryCoderModel()
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out._set(path=f"{path}/codes")


class _Coding(HasInputCols):
    invalid = Param(Params._dummy(), "invalid", "what NULL and unseen categories do: error, skip or keep", TypeConverters.toString)

    def _checked(self):
        if self.getOrDefault("invalid") not in INVALID:
            raise ValueError(f"invalid must be one of {', '.join(INVALID)}, not {self.getOrDefault('invalid')!r}")
        return self


class CategoryCoder(Estimator, _Coding, DefaultParamsReadable, DefaultParamsWritable):
    """Number the categories of several columns in a stated order, as texts."""

    order = Param(Params._dummy(), "order", "order of the numbers", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, order: str = "alphabetDesc", invalid: str = "error"):
        super().__init__()
        self._setDefault(order="alphabetDesc", invalid="error")
        self._set(**self._input_kwargs)
        self._checked()

    def _fit(self, df: DataFrame) -> "CategoryCoderModel":
        columns = self.getInputCols()
        path = write_codes(value_frequencies(df, columns).where("value is not null"), self.getOrDefault("order"))
        sizes = {r["column"]: r["count"] for r in df.sparkSession.read.schema(CODES).parquet(path).groupBy("column").count().collect()}
        return CategoryCoderModel(inputCols=columns, invalid=self.getOrDefault("invalid"), path=path, sizes=[sizes.get(c, 0) for c in columns])


class CategoryCoderModel(Model, _Coding, MLWritable, MLReadable):
    """Adds ``<column>_num`` by one join for each column.

    The table is split by column, so Spark knows the size of each column's part: it
    broadcasts a part below its limit, and otherwise joins by shuffle, where adaptive
    execution splits the partitions of frequent categories. NULL and unseen categories
    raise, lose their row (``skip``), or get the next free number (``keep``). The new
    column is nominal, with its number of categories, so trees and one-hot vectors
    need no further pass.
    """

    path = Param(Params._dummy(), "path", "folder of the codes", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories of each column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, invalid="error", path=None, sizes=None):
        super().__init__()
        self._setDefault(invalid="error")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def codes(self) -> DataFrame:
        """(value, n, index, column)."""
        return SparkSession.active().read.schema(CODES).parquet(self.getOrDefault("path"))

    def codes_of(self, column: str) -> DataFrame:
        """(value, index) of one column."""
        return self.codes().where(F.col("column") == column).select("value", "index")

    def _transform(self, df: DataFrame) -> DataFrame:
        invalid = self._checked().getOrDefault("invalid")
        for column, size in zip(self.getInputCols(), self.getOrDefault("sizes")):
            target, text = column + INDEXED, F.col(f"`{column}`").cast("string")
            own = self.codes_of(column).select(F.col("value").alias("_value"), F.col("index").alias(target))
            df = df.join(own, text == F.col("_value"), "inner" if invalid == "skip" else "left").drop("_value")
            if invalid == "error":
                unseen = F.raise_error(F.concat(F.lit(f"unseen or missing category in {column}: "), F.coalesce(text, F.lit("NULL"))))
                df = df.withColumn(target, F.coalesce(F.col(f"`{target}`"), unseen.cast("double")))
            elif invalid == "keep":
                df = df.withColumn(target, F.coalesce(F.col(f"`{target}`"), F.lit(float(size))))
            kinds = size + (invalid == "keep")
            df = df.withMetadata(target, {"ml_attr": {"type": "nominal", "name": target, "num_vals": kinds}} if kinds else {})
        return df

    def texts(self, df: DataFrame, column: str, index: str, output: str) -> DataFrame:
        """``df`` with the category behind a number of ``column``; NULL for numbers that none has."""
        own = self.codes_of(column).select(F.col("index").alias("_index"), F.col("value").alias(output))
        return df.join(own, F.col(f"`{index}`") == F.col("_index"), "left").drop("_index")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _listed(name: str, doc: str, convert=TypeConverters.toListString) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class CategoryPreparation(Estimator, _Coding, DefaultParamsReadable, DefaultParamsWritable):
    """Modes, domain modes, codes and the order of the classes, all learned from one counting pass.

    Fits to a ``PipelineModel`` of the imputers, the coder and the class index, with the
    values each would learn alone, one after the other: the codes and their counts are
    those of the imputed columns, worked out from the counts of the raw ones.
    ``inputCols`` are coded; ``modeCols`` lose the sentinel and NULL to their mode;
    ``domainCols`` lose what lies outside their range (``lowest`` to ``highest``).
    """

    order = Param(Params._dummy(), "order", "order of the numbers", TypeConverters.toString)
    modeCols = _listed("modeCols", "columns imputed with their mode")
    domainCols = _listed("domainCols", "columns imputed with their mode outside a range")
    lowest = _listed("lowest", "least valid value of each domain column", TypeConverters.toListInt)
    highest = _listed("highest", "greatest valid value of each domain column", TypeConverters.toListInt)
    label = Param(Params._dummy(), "label", "class column, empty for none", TypeConverters.toString)
    labelOrder = Param(Params._dummy(), "labelOrder", "order of the classes", TypeConverters.toString)
    sentinel = Param(Params._dummy(), "sentinel", "text of a missing value", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=(), modeCols=(), domainCols=(), lowest=(), highest=(), label="", labelOrder="alphabetDesc", order="alphabetDesc", invalid="error", sentinel=MISSING):
        super().__init__()
        self._setDefault(inputCols=[], modeCols=[], domainCols=[], lowest=[], highest=[], label="", labelOrder="alphabetDesc", order="alphabetDesc", invalid="error", sentinel=MISSING)
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})
        self._checked()

    def _fit(self, df: DataFrame) -> PipelineModel:
        at = self.getOrDefault
        coded, moded, domains, label, sentinel = at("inputCols"), at("modeCols"), at("domainCols"), at("label"), at("sentinel")
        ranges = dict(zip(domains, zip(at("lowest"), at("highest"))))
        columns = list(dict.fromkeys([*coded, *moded, *domains, *([label] if label else [])]))
        counts = landed(value_frequencies(df, columns), "frequencies")

        value, n, column = F.col("value"), F.col("n"), F.col("column")
        stays = self._stays(moded, ranges, sentinel)
        rank = F.struct(-n, value)
        facts = counts.groupBy("column").agg(
            F.min_by(value, F.when(value.isNotNull() & ~value.isin("null", sentinel), rank)).alias("mode"),
            F.min_by(value, F.when(value.isNotNull(), rank)).alias("any_mode"),
            F.sum(F.when(~stays, n)).alias("filled"),
            F.count_if(stays & value.isNotNull()).alias("kinds"),
            # the classes of a label, few by nature; no other column's values
            F.collect_list(F.when((column == label) & value.isNotNull(), F.struct("value", "n"))).alias("classes"),
        )
        facts = {r["column"]: r for r in facts.collect()}
        mode = {c: getattr(facts.get(c), "mode", None) for c in moded}
        mode |= {c: getattr(facts.get(c), "any_mode", None) for c in domains if c not in mode}
        empty = [c for c in mode if mode[c] is None]
        if empty:
            raise ValueError(f"no values to learn from in {', '.join(empty)}")

        stages = []
        if moded:
            stages.append(ModeImputerModel(inputCols=moded, sentinel=sentinel, modes=[mode[c] for c in moded]))
        for low, high in dict.fromkeys(ranges.values()):
            own = [c for c in domains if ranges[c] == (low, high)]
            stages.append(DomainModeImputerModel(inputCols=own, lowest=low, highest=high, modes=[mode[c] for c in own]))
        if coded:
            sizes = {c: facts[c]["kinds"] for c in coded if c in facts}
            left = F.when(stays, n).otherwise(0)
            for c in mode:
                filled, own = facts[c]["filled"] or 0, (column == c) & (value == mode[c])
                left = left + F.when(own, filled).otherwise(0)
                if c in sizes and filled and self._lies_outside(mode[c], ranges.get(c)):
                    sizes[c] += 1  # a mode outside its own range is a category once it fills others
            labels = counts.where(column.isin(coded) & value.isNotNull()).select("column", "value", left.cast("long").alias("n")).where("n > 0")
            path = write_codes(labels, at("order"))
            stages.append(CategoryCoderModel(inputCols=coded, invalid=at("invalid"), path=path, sizes=[sizes.get(c, 0) for c in coded]))
        if label:
            classes = [(r["value"], r["n"]) for r in getattr(facts.get(label), "classes", ())]
            classes.sort()
            if at("labelOrder").startswith("frequency"):
                classes.sort(key=lambda c: c[1], reverse=at("labelOrder").endswith("Desc"))
            elif at("labelOrder").endswith("Desc"):
                classes.reverse()
            stages.append(StringIndexerModel.from_labels([c for c, _ in classes], inputCol=label, outputCol="label"))
        return PipelineModel(stages)

    @staticmethod
    def _lies_outside(mode: str, limits: tuple[int, int] | None) -> bool:
        return limits is not None and not limits[0] <= float(mode) <= limits[1]

    @staticmethod
    def _stays(moded: Sequence[str], ranges: dict[str, tuple[int, int]], sentinel: str) -> Column:
        """Whether a counted value is left alone by the imputers."""
        value, column = F.col("value"), F.col("column")
        kept = F.lit(True)
        if moded:
            kept = F.when(column.isin(list(moded)), F.coalesce(value != sentinel, F.lit(False))).otherwise(kept)
        for c, (low, high) in ranges.items():
            kept = F.when(column == c, F.coalesce(value.try_cast("double").between(low, high), F.lit(False))).otherwise(kept)
        return kept
