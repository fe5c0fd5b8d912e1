"""Imputers and encoders as ``pyspark.ml`` stages that can be saved (CLN-7, CLN-8, MLD-4, ENC-5..7).

``fit`` runs one distributed aggregation; the model holds one value per column (imputers, scaler) or the
labels that name its columns (encoder), kept as a JSON parameter in the stage's metadata.  So stages
go into one ``PipelineModel`` folder, and a later window is transformed by the first window's values:
same means and modes, same columns in the same order.  Values not seen by ``fit`` take the extra slot.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.models.scale import apply_scaler, fit_scaler
from sparkmart.operators.clean import fit_means, fit_modes
from sparkmart.operators.encode import _path_exists, count_values


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    settings = Param(Params._dummy(), "settings", "columns and options, as JSON", TypeConverters.toString)
    values = Param(Params._dummy(), "values", "fitted values, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, settings=None, values=None):
        super().__init__()
        self._setDefault(settings="{}", values="{}")
        self._set(**{k: json.dumps(v) for k, v in self._input_kwargs.items() if v is not None})

    def get(self, param: str):
        return json.loads(self.getOrDefault(param))


class _Fitted(_Stage, Model):
    """A fitted stage: ``settings`` of its estimator and ``values`` from the data."""


class _Fitting(_Stage, Estimator):
    model: type

    def _fit(self, dataset: DataFrame):
        return self.model(settings=self.get("settings"), values=self._values(dataset, **self.get("settings")))


class MeanImputerModel(_Fitted):
    def _transform(self, df):
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")) for c, m in self.get("values").items()})


class MeanImputer(_Fitting):
    """CLN-7: null -> the column's mean over the rows of ``fit``, as double."""

    model = MeanImputerModel

    def _values(self, df, cols):
        return fit_means(df, cols)


class ModeImputerModel(_Fitted):
    def _transform(self, df):
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                               for c, v in self.get("values").items() if v is not None})


class ModeImputer(_Fitting):
    """CLN-8: null -> the column's most frequent value (the smallest on ties).  Modes are kept as text
    and cast to the column's type, so that wide whole numbers and decimals stay exact."""

    model = ModeImputerModel

    def _values(self, df, cols):
        return {c: None if v is None else str(v) for c, v in fit_modes(df, cols).items()}


class StandardScalerStageModel(_Fitted):
    def _transform(self, df):
        return apply_scaler(df, {c: tuple(v) for c, v in self.get("values").items()}, suffix=self.get("settings").get("suffix", ""))


class StandardScalerStage(_Fitting):
    """MLD-4: (x - mean) / population std of the rows of ``fit``; null becomes the mean."""

    model = StandardScalerStageModel

    def _values(self, df, cols, suffix=""):
        return fit_scaler(df, cols)


class CategoryEncoderModel(_Fitted):
    """``values``: the labels per column in slot order."""

    def columns(self, col: str) -> list[str]:
        s = self.get("settings")
        n = len(self.get("values")[col]) + (0 if s["drop_last"] else 1)
        return [s["names"].get(col, f"{col}_{{}}").format(i) for i in range(n)]

    def _transform(self, df):
        s, labels = self.get("settings"), self.get("values")
        value, slot = {}, {}
        for i, c in enumerate(s["cols"]):
            v, known = F.col(c).cast("string"), F.array(*map(F.lit, labels[c])).cast("array<string>")
            if c in s["top"]:  # only values with a label of their own are kept apart from the rest
                v = F.when(v.isin([x for x in labels[c] if x != s["other"]]), v).otherwise(F.lit(s["other"]))
            value[c] = v
            at = F.array_position(known, v)
            slot[f"_slot{i}"] = F.when(at > 0, at - 1).otherwise(F.lit(len(labels[c])))
        out = df.withColumns(slot)
        hot = {name: (F.col(f"_slot{i}") == k).cast("double") for i, c in enumerate(s["cols"]) for k, name in enumerate(self.columns(c))}
        return out.withColumns(hot).drop(*slot, *([] if s["keep_source"] else s["cols"]))


class CategoryEncoder(_Fitting):
    """ENC-5/6/7: one 0/1 column per value, by falling count, then by value.

    One scan counts all columns.  ``drop_last`` leaves out the extra slot of null and unseen values;
    ``top`` maps a column to the number of its most frequent values that stay apart from ``other``.
    Labels name the wide form's columns, so they are held by the driver; for vocabularies too large for a
    frame's width there is ``operators.encode.encode_sparse``.
    """

    model = CategoryEncoderModel

    @classmethod
    def over(cls, cols: Iterable[str], drop_last: bool = True, top: Mapping[str, int] | None = None, other: str = "OTHER",
             names: Mapping[str, str] | None = None, keep_source: bool = False):
        return cls(settings={"cols": list(cols), "drop_last": drop_last, "top": dict(top or {}), "other": other,
                             "names": dict(names or {}), "keep_source": keep_source})

    def _values(self, df, cols, top, other, **_):
        counts = count_values(df, cols, keep_empty=True)
        labels = {c: [] for c in cols}
        if top:  # the rest of a limited column is one label; null is part of it
            limits = F.create_map(*[F.lit(x) for c, k in top.items() for x in (c, k)])
            place = F.row_number().over(_by_count())
            ranked = counts.where(F.col("column").isin(list(top))).withColumn("rank", place)
            kept = F.when(F.col("rank") <= limits[F.col("column")], F.col("value")).otherwise(F.lit(other))
            whole = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in top]).first()
            missing = df.sparkSession.createDataFrame([(c, other, int(whole[c])) for c in top if whole[c]], "column string, value string, n long")
            limited = ranked.select("column", kept.alias("value"), "n").union(missing)
            counts = counts.where(~F.col("column").isin(list(top))).union(limited.groupBy("column", "value").agg(F.sum("n").alias("n")))
        for r in counts.collect():
            labels[r["column"]].append((-r["n"], r["value"]))
        return {c: [v for _, v in sorted(x)] for c, x in labels.items()}


def _by_count():
    from pyspark.sql import Window

    return Window.partitionBy("column").orderBy(F.desc("n"), "value")


def fit_or_load(spark: SparkSession, path: str | None, stages: list, df: DataFrame) -> PipelineModel:
    """The ``PipelineModel`` saved at ``path``, or the stages fitted on ``df`` and saved there.

    Stages are fitted side by side on ``df`` as it is (no stage reads another's output).
    """
    if path and _path_exists(spark, path):
        return PipelineModel.load(path)
    model = PipelineModel(stages=[s.fit(df) for s in stages])
    if path:
        model.write().save(path)
    return model
