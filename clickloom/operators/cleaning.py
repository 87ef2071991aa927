"""Learned cleaning: drop useless columns, impute, collapse rare values, clip."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.functions.quantiles import (
    IN_MEMORY_VALUES,
    column_quantiles,
    exact_quantiles,
    top_values,
    value_counts,
)
from clickloom.session import stage

BRANDS_SCHEMA = "device_brand string, brand_median double"

OTHER = "other_collapsed"
QUARTILES = [0.25, 0.5, 0.75]


class _CleanerParams(Params):
    dropCols = Param(Params._dummy(), "dropCols", "columns to drop always", TypeConverters.toListString)
    numStrategy = Param(Params._dummy(), "numStrategy", "median or mean", TypeConverters.toString)
    catStrategy = Param(Params._dummy(), "catStrategy", "mode or unknown", TypeConverters.toString)
    outlierMethod = Param(Params._dummy(), "outlierMethod", "none, zscore or iqr", TypeConverters.toString)
    outlierThreshold = Param(Params._dummy(), "outlierThreshold", "width of the bounds", TypeConverters.toFloat)
    passThrough = Param(
        Params._dummy(), "passThrough", "keys and target: neither studied nor changed, always kept", TypeConverters.toListString
    )
    skipImputation = Param(Params._dummy(), "skipImputation", "columns left unfilled", TypeConverters.toListString)
    topCategories = Param(Params._dummy(), "topCategories", "values kept per column", TypeConverters.toInt)
    maxNullShare = Param(Params._dummy(), "maxNullShare", "a higher share drops a column", TypeConverters.toFloat)
    maxConstantShare = Param(Params._dummy(), "maxConstantShare", "a higher share drops a column", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(
            dropCols=list(C.SERVICE_COLUMNS),
            numStrategy="median",
            catStrategy="mode",
            outlierMethod="none",
            outlierThreshold=3.0,
            passThrough=[],
            skipImputation=[],
            topCategories=C.TOP_CATEGORIES,
            maxNullShare=C.MAX_NULL_SHARE,
            maxConstantShare=C.MAX_CONSTANT_SHARE,
        )

    def value(self, name: str):
        return self.getOrDefault(getattr(self, name))


def _lines(df: DataFrame, aggregates: dict[str, Column]) -> dict:
    """Run one aggregation over the frame and return its single row."""
    return df.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict() if aggregates else {}


class SessionCleaner(Estimator, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns from the training frame; a handful of aggregations, no rows reach the driver.

    What does reach it: per column a few numbers and at most ``topCategories``
    values. Medians per brand stay in a table, which is saved with the model.
    """

    @keyword_only
    def __init__(
        self,
        *,
        dropCols=None,
        numStrategy=None,
        catStrategy=None,
        outlierMethod=None,
        outlierThreshold=None,
        passThrough=None,
        skipImputation=None,
        topCategories=None,
        maxNullShare=None,
        maxConstantShare=None,
    ):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SessionCleanerModel:
        if self.value("outlierMethod") not in ("none", "zscore", "iqr"):
            raise ValueError(f"unknown outlier method: {self.value('outlierMethod')}")
        df = X.nan_to_null(dataset)
        through = set(self.value("passThrough"))
        technical = (set(self.value("dropCols")) | set(C.TECHNICAL_COLUMNS)) - through
        studied = [c for c in df.columns if c not in technical | through]
        numbers = [c for c in X.numeric_columns(df) if c in studied]
        texts = [c for c in studied if c not in numbers]

        basics = self._basics(df, studied, numbers)
        counts = self._category_counts(df, texts)
        details = self._details(df, numbers, basics)
        total = basics["rows"]
        null_share = {c: (total - basics[f"known:{c}"]) / total if total else 0.0 for c in studied}
        shares = self._top_shares(df, numbers, texts, basics, counts)
        sparse = [c for c in studied if null_share[c] > self.value("maxNullShare")]
        constant = [c for c in studied if max(shares[c], null_share[c]) > self.value("maxConstantShare")]
        dropped = sorted(technical | set(sparse) | set(constant))

        kept_texts = [c for c in texts if c not in dropped]
        kept_numbers = [c for c in numbers if c not in dropped]
        quantiles = self._quartiles(df, kept_numbers, details)
        skip = set(self.value("skipImputation"))
        fills: dict[str, float | str] = {}
        for c in kept_numbers:
            if c not in skip:
                learned = quantiles[c][1] if self.value("numStrategy") == "median" else basics[f"mean:{c}"]
                fills[c] = 0.0 if learned is None else float(learned)
        for c in kept_texts:
            if c not in skip:
                modal = counts.get(c, [])
                fills[c] = modal[0][0] if modal and self.value("catStrategy") == "mode" else "Unknown"

        limit = self.value("topCategories")
        state = {
            "inputs": df.columns,
            "dropped": dropped,
            "null_share": null_share,
            "top_share": {c: max(shares[c], null_share[c]) for c in studied},
            "top_categories": {c: [v for v, _ in counts.get(c, [])[:limit]] for c in kept_texts},
            "fills": fills,
            "bounds": self._bounds(kept_numbers, quantiles, basics),
            "screen_median": self._screen_median(df, details),
        }
        model = SessionCleanerModel()
        model.brands = self._brand_medians(df, details)
        self._copyValues(model)
        return model._set(state=json.dumps(state))

    def _basics(self, df: DataFrame, studied: list[str], numbers: list[str]) -> dict:
        """One pass: known values per column, and moments and the number of distinct values per number."""
        wanted = {"rows": F.count(F.lit(1))}
        for c in studied:
            wanted[f"known:{c}"] = F.count(F.col(c))
        spread = self.value("outlierMethod") == "zscore"
        means = spread or self.value("numStrategy") == "mean"
        for c in numbers:
            number = F.col(c).cast("double")
            if means:
                wanted[f"mean:{c}"] = F.avg(number)
            if spread:
                wanted[f"std:{c}"] = F.stddev_samp(number)
            wanted[f"distinct:{c}"] = F.approx_count_distinct(c)
        return _lines(df, wanted)

    def _category_counts(self, df: DataFrame, texts: list[str]) -> dict[str, list[tuple[str, int]]]:
        """Per column its most frequent values with their counts."""
        if not texts:
            return {}
        limit = max(1, self.value("topCategories"))
        found: dict[str, list[tuple[str, int]]] = {}
        for row in top_values(value_counts(df, texts), limit).orderBy("column_name", "place").collect():
            found.setdefault(row["column_name"], []).append((row["value"], row["n"]))
        return found

    def _needs_quartiles(self) -> bool:
        return self.value("numStrategy") == "median" or self.value("outlierMethod") == "iqr"

    def _details(self, df: DataFrame, numbers: list[str], basics: dict) -> dict:
        """Second pass: quartiles where few distinct values allow it."""
        wanted = {}
        ends = F.array(*[F.lit(s) for s in QUARTILES])
        for c in numbers:
            small = basics[f"distinct:{c}"] <= IN_MEMORY_VALUES
            if small and (self._needs_quartiles() or c == "screen_area"):
                wanted[f"quartiles:{c}"] = F.percentile(F.col(c).cast("double"), ends)
        return _lines(df, wanted)

    def _top_shares(self, df, numbers, texts, basics, counts) -> dict[str, float]:
        """Share of the most frequent known value per column."""
        total = basics["rows"] or 1
        best = top_values(value_counts(df, numbers), 1).collect() if numbers else []  # one row per column
        found = {r["column_name"]: r["n"] / total for r in best}
        return {c: counts[c][0][1] / total if counts.get(c) else 0.0 for c in texts} | {c: found.get(c, 0.0) for c in numbers}

    def _quartiles(self, df: DataFrame, numbers: list[str], details: dict) -> dict[str, list]:
        """Quartiles per number; the columns the second pass left out are done together."""
        found = {c: details.get(f"quartiles:{c}") for c in numbers}
        wide = [c for c in numbers if f"quartiles:{c}" not in details]
        if wide and self._needs_quartiles():
            found |= {r["column_name"]: r["quantiles"] for r in column_quantiles(df, wide, QUARTILES).collect()}
        return {c: found[c] or [None] * 3 for c in numbers}

    def _bounds(self, numbers, quantiles, basics) -> dict[str, list[float]]:
        method, width = self.value("outlierMethod"), self.value("outlierThreshold")
        bounds = {}
        for c in numbers:
            if method == "zscore":
                mean, std = basics[f"mean:{c}"], basics[f"std:{c}"]
                if std is not None and std > 0:
                    bounds[c] = [mean - width * std, mean + width * std]
            elif method == "iqr" and quantiles[c][0] is not None:
                low, _, high = quantiles[c]
                if high > low:
                    bounds[c] = [low - width * (high - low), high + width * (high - low)]
        return bounds

    def _screen_median(self, df: DataFrame, details: dict) -> float | None:
        """Median screen area overall."""
        if "screen_area" not in df.columns:
            return 0.0
        if "quartiles:screen_area" in details:
            return (details["quartiles:screen_area"] or [None] * 3)[1]
        row = exact_quantiles(df, [], "screen_area", [0.5]).first()
        return row["quantiles"][0] if row else None

    def _brand_medians(self, df: DataFrame, details: dict) -> DataFrame:
        """Median screen area per brand in a written table; empty without these columns."""
        if not {"screen_area", "device_brand"} <= set(df.columns):
            return df.sparkSession.createDataFrame([], BRANDS_SCHEMA)
        branded = df.filter("device_brand IS NOT NULL AND screen_area IS NOT NULL")
        if "quartiles:screen_area" in details:  # a brand holds no more distinct areas than all rows do
            medians = branded.groupBy("device_brand").agg(F.percentile("screen_area", 0.5).alias("brand_median"))
        else:
            medians = exact_quantiles(branded, ["device_brand"], "screen_area", [0.5]).select(
                "device_brand", F.col("quantiles")[0].alias("brand_median")
            )
        return stage(medians, "brand-medians")


class _CleanerWriter(DefaultParamsWriter):
    """Saves the parameters and, next to them, the table of brand medians."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.brands.write.mode("overwrite").parquet(f"{path}/brands")


class _CleanerReader(DefaultParamsReader):
    """Loads what ``_CleanerWriter`` saved, from the model folder alone."""

    def load(self, path: str) -> SessionCleanerModel:
        model = super().load(path)
        model.brands = self.sparkSession.read.schema(BRANDS_SCHEMA).parquet(f"{path}/brands")
        return model


class SessionCleanerModel(Model, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Applies what was learned: one projection, plus one join on the brand for screen areas."""

    state = Param(Params._dummy(), "state", "learned values as JSON", TypeConverters.toString)
    brands: DataFrame | None = None

    def __init__(self):
        super().__init__()
        self._defaults()
        self._setDefault(state="{}")

    def write(self) -> _CleanerWriter:
        return _CleanerWriter(self)

    @classmethod
    def read(cls) -> _CleanerReader:
        return _CleanerReader(cls)

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def report(self, spark: SparkSession) -> DataFrame:
        """What was learned, one row per column of the training frame.

        ``top_share`` is the share of the most frequent value, unknown included.
        """
        learned = self.learned
        rows = []
        for c in learned["inputs"]:
            fill = learned["fills"].get(c)
            low, high = learned["bounds"].get(c, (None, None))
            rows.append(
                (
                    c,
                    learned["null_share"].get(c),
                    learned["top_share"].get(c),
                    int(c in learned["dropped"]),
                    fill if isinstance(fill, float) else None,
                    fill if isinstance(fill, str) else None,
                    low,
                    high,
                    learned["top_categories"].get(c),
                )
            )
        return spark.createDataFrame(
            rows,
            "column_name string, null_share double, top_share double, dropped int, fill_number double, "
            "fill_text string, low double, high double, top_values array<string>",
        )

    def brand_report(self) -> DataFrame:
        """Learned screen medians per brand."""
        return self.brands

    def output_columns(self, inputs: list[str] | None = None) -> list[str]:
        learned = self.learned
        return [c for c in (inputs or learned["inputs"]) if c not in learned["dropped"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = self.learned
        if not learned:
            raise ValueError("the cleaner has learned nothing yet: fit it first")
        order = df.columns
        df = X.nan_to_null(df)
        if "device_brand" in order:
            df = df.withColumn("device_brand", F.coalesce("device_brand", F.lit("Unknown")))
        if "screen_area" in order:
            df = self._fill_screen_area(df, learned)
        if "device_os" in order and "device_category" in order:
            brand = F.col("device_brand") if "device_brand" in order else F.lit("Unknown")
            df = df.withColumn("device_os", X.imputed_os(F.col("device_os"), F.col("device_category"), brand))
        through = set(self.value("passThrough"))
        finished = []
        for c in order:
            if c in learned["dropped"]:
                continue
            value = F.col(c)
            if c in through:
                finished.append(value)
                continue
            if c in learned["top_categories"]:
                value = X.collapsed(value.cast("string"), learned["top_categories"][c], OTHER)
            if c in learned["fills"]:
                value = F.coalesce(value, F.lit(learned["fills"][c]))
            if c in learned["bounds"]:
                value = X.clipped(value, *learned["bounds"][c])
            finished.append(value.alias(c))
        return df.select(*finished)

    def _fill_screen_area(self, df: DataFrame, learned: dict) -> DataFrame:
        overall = F.lit(learned["screen_median"]).cast("double")
        if self.brands is None or "device_brand" not in df.columns:
            return df.withColumn("screen_area", F.coalesce("screen_area", overall))
        joined = df.join(self.brands, "device_brand", "left")
        return joined.withColumn("screen_area", F.coalesce("screen_area", "brand_median", overall)).drop("brand_median")
