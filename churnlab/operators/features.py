"""Feature preparation (C*): fills, dates, one-hot, scaling, imputation.

Stateless steps are DataFrame functions. Steps with fitted parameters are
``pyspark.ml`` Estimator / Model pairs so they compose in a ``Pipeline`` and
persist with it. A fit is one aggregate over the rows selected by
``fitWhere`` (the training split), so test rows never move a parameter; the
parameters themselves are a few numbers per column and are kept on the
model, like any MLlib model.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import weekday0
from .ordered import exact_quantiles, named, sql_text

# pandas' default missing-value tokens (read_csv na_values).
PANDAS_NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


# --- stateless steps (C1-C6, C9, C10, C16) -------------------------------------

def fill_constants(df: DataFrame, mapping: dict) -> DataFrame:
    return df.fillna(mapping)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def parse_date(col: str, strict: bool = True):
    """String or timestamp -> date. ``strict`` raises on bad text (ANSI);
    otherwise bad text becomes null."""
    c = F.col(col)
    if strict:
        return F.to_date(c)
    return F.try_to_timestamp(c.cast("string")).cast("date")


def date_features(df: DataFrame, col: str, prefix: str = "start", reference: str | None = None,
                  strict: bool = True, floor: bool = False, drop: bool = True,
                  names: dict | None = None) -> DataFrame:
    """Year, month, weekday (Monday = 0) and days since a reference date.

    ``reference=None``: the latest date of the table itself, evaluated once
    as a scalar subquery (no join, nothing collected). A stored reference
    date (deployment) can be floored at 0 days; null dates stay null.
    ``names`` overrides the output names (keys year, month, weekday, days).
    """
    nm = {k: f"{prefix}_{k}" for k in ("year", "month", "weekday", "days")}
    nm.update(names or {})
    d = "_d"
    out = df.withColumn(d, parse_date(col, strict))
    ref = F.lit(reference).cast("date") if reference else out.agg(F.max(d)).scalar()
    days = F.datediff(ref, F.col(d))
    if floor:
        days = F.when(days.isNull(), F.lit(None)).otherwise(F.greatest(days, F.lit(0)))
    out = (out.withColumn(nm["year"], F.year(d))
           .withColumn(nm["month"], F.month(d))
           .withColumn(nm["weekday"], weekday0(d))
           .withColumn(nm["days"], days))
    out = out.drop(d)
    return out.drop(col) if drop else out


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Coerce to double; text that is not a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def flag_equals(df: DataFrame, col: str, value: str, fill: str | None = None,
                name: str | None = None) -> DataFrame:
    """``(coalesce(col, fill) == value)`` as 0/1 (deployment two-flag encoding)."""
    c = F.col(col) if fill is None else F.coalesce(F.col(col), F.lit(fill))
    return df.withColumn(name or f"{col}_{value}", F.coalesce((c == value).cast("int"), F.lit(0)))


def to_xy(df: DataFrame, y: str, id_col: str | None = None) -> DataFrame:
    """Drop the id, cast the label to int and put it last."""
    feats = [c for c in df.columns if c not in (y, id_col)]
    return df.select(*feats, F.col(y).cast("int").alias(y))


def select_top_fraction(importance: DataFrame, fraction: float = 0.5,
                        feature: str = "feature", score: str = "importance") -> DataFrame:
    """Top ``floor(n * fraction)`` features by importance (ties by name).

    The importance table has one row per feature, so it is bounded by the
    schema width; the window over it is tiny.
    """
    from pyspark.sql import Window
    w = Window.orderBy(F.desc(score), F.asc(feature))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return (importance.select(feature, score, F.row_number().over(w).alias("rank"), n.alias("_n"))
            .filter(F.col("rank") <= F.floor(F.col("_n") * fraction))
            .drop("_n"))


# --- fitted steps ---------------------------------------------------------------

class _Shared(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    fitWhere = Param(Params._dummy(), "fitWhere", "SQL predicate of the rows to fit on",
                     TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted parameters (JSON)", TypeConverters.toString)

    def _cols(self):
        return self.getOrDefault(self.inputCols)

    def _fit_rows(self, df: DataFrame) -> DataFrame:
        w = self.getOrDefault(self.fitWhere) if self.isDefined(self.fitWhere) else ""
        return df.filter(F.expr(w)) if w else df

    def _state(self):
        return json.loads(self.getOrDefault(self.state))


class _StateModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, state=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        if state is not None:
            self._set(state=state)


class _StateEstimator(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    _model_cls = None

    def __init__(self, inputCols=None, fitWhere=""):
        super().__init__()
        self._setDefault(fitWhere="")
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(fitWhere=fitWhere or "")

    def _fit(self, df: DataFrame):
        return self._model_cls(inputCols=self._cols(), state=json.dumps(self._compute(df)))


# C7, C14 -- one-hot with sorted categories, first dropped or not ----------------

class OneHotFirstDropModel(_StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._state()
        new = {}
        for c in self._cols():
            for v in st["levels"][c][1 if st["drop_first"] else 0:]:
                new[f"{c}_{v}"] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
        return df.withColumns(new).drop(*self._cols())


class OneHotFirstDrop(_StateEstimator):
    """pandas ``get_dummies(drop_first=True)``: sorted levels, first dropped.

    Unseen values (and nulls) encode as all zeros, the same as the dropped
    baseline level. MLlib's ``OneHotEncoder`` drops the *last* level instead.
    ``maxLevels`` guards the fitted level list (categories, not values).
    """
    _model_cls = OneHotFirstDropModel

    def __init__(self, inputCols=None, dropFirst=True, fitWhere="", maxLevels=10000):
        super().__init__(inputCols, fitWhere)
        self._drop_first = dropFirst
        self._max = maxLevels

    def _compute(self, df):
        cols = self._cols()
        pairs = ", ".join(f"'{sql_text(c)}', `{c}`" for c in cols)
        values = (self._fit_rows(df).select(F.expr(f"stack({len(cols)}, {pairs}) as (feature, value)"))
                  .filter(F.col("value").isNotNull()).distinct())
        for r in values.groupBy("feature").count().collect():      # one row per column
            if r["count"] > self._max:
                raise ValueError(f"{r['feature']}: {r['count']} levels exceed maxLevels={self._max}")
        levels = {c: [] for c in cols}
        for r in values.collect():      # at most maxLevels rows per column, checked above
            levels[r["feature"]].append(r["value"])
        levels = {c: sorted(v) for c, v in levels.items()}
        return {"levels": levels, "drop_first": self._drop_first}


def encode_like(df: DataFrame, feature_names: Sequence[str], categorical: Sequence[str],
                space_suffix: Sequence[str] = ()) -> DataFrame:
    """Replay a stored dummy layout on new rows.

    A feature that is a column is copied; ``<cat>_<value>`` becomes
    ``(cat == value)`` as 0/1, with ``_`` in the value read as a space for the
    columns in ``space_suffix``. Unseen values give all zeros. A feature that
    matches neither raises. Output columns follow ``feature_names``.
    """
    cols = []
    for f in feature_names:
        if f in df.columns:
            cols.append(F.col(f))
            continue
        owner = next((c for c in sorted(categorical, key=len, reverse=True) if f.startswith(c + "_")), None)
        if owner is None:
            raise ValueError(f"unknown feature {f!r}")
        value = f[len(owner) + 1:]
        if owner in space_suffix:
            value = value.replace("_", " ")
        cols.append(F.coalesce((F.col(owner) == F.lit(value)).cast("int"), F.lit(0)).alias(f))
    return df.select(*cols)


# C11 -- standard scaling with population std ---------------------------------

class ExactStandardScalerModel(_StateModel):
    def _transform(self, df):
        st = self._state()
        return df.withColumns({c: (named(c) - F.lit(st[c][0])) / F.lit(st[c][1]) for c in self._cols()})


class ExactStandardScaler(_StateEstimator):
    """(v - mean) / population std, fit on ``fitWhere`` rows; std 0 -> 1.

    scikit-learn ``StandardScaler`` semantics; MLlib's uses the sample std.
    """
    _model_cls = ExactStandardScalerModel

    def _compute(self, df):
        cols = self._cols()
        r = self._fit_rows(df).agg(*[F.struct(F.avg(named(c)).alias("m"), F.stddev_pop(named(c)).alias("s")).alias(c)
                                     for c in cols]).first()
        return {c: [r[c]["m"], (r[c]["s"] or 1.0) if r[c]["s"] != 0 else 1.0] for c in cols}


# C12 -- robust scaling with exact quartiles --------------------------------------

class ExactRobustScalerModel(_StateModel):
    def _transform(self, df):
        st = self._state()
        return df.withColumns({c: (named(c) - F.lit(st[c][0])) / F.lit(st[c][1]) for c in self._cols()})


class ExactRobustScaler(_StateEstimator):
    """(v - median) / (Q3 - Q1), exact linear-interpolation quartiles; IQR 0 -> 1.

    MLlib's ``RobustScaler`` uses approximate quantiles.
    """
    _model_cls = ExactRobustScalerModel

    def _compute(self, df):
        cols = self._cols()
        q = exact_quantiles(self._fit_rows(df), cols, (0.25, 0.5, 0.75)).collect()
        got = {(r["feature"], r["prob"]): r["value"] for r in q}
        st = {}
        for c in cols:
            med, q1, q3 = got.get((c, 0.5)), got.get((c, 0.25)), got.get((c, 0.75))
            iqr = (q3 - q1) if q1 is not None and q3 is not None else 1.0
            st[c] = [med if med is not None else 0.0, iqr if iqr != 0 else 1.0]
        return st


# C13 -- median imputation with optional missing indicators -----------------------

class MedianImputerModel(_StateModel):
    def _transform(self, df):
        st = self._state()
        ind = {f"{c}_missing": F.col(c).isNull().cast("int") for c in st["indicate"]}
        out = df.withColumns(ind) if ind else df
        return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(st["median"][c]))
                                for c in self._cols()})


class MedianImputer(_StateEstimator):
    """Fill nulls with the exact median of the fit rows.

    With ``indicator`` a 0/1 column ``<c>_missing`` is added for each column
    that has nulls in the fit rows (scikit-learn ``add_indicator``).
    """
    _model_cls = MedianImputerModel

    def __init__(self, inputCols=None, indicator=False, fitWhere=""):
        super().__init__(inputCols, fitWhere)
        self._indicator = indicator

    def _compute(self, df):
        cols = self._cols()
        rows = self._fit_rows(df)
        med = {r["feature"]: r["value"] for r in exact_quantiles(rows, cols, (0.5,)).collect()}
        nulls = rows.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).first()
        return {"median": {c: med.get(c) for c in cols},
                "indicate": [c for c in cols if self._indicator and nulls[c] > 0]}


class ConstantImputer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls of string columns with a constant (``Missing``)."""
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    value = Param(Params._dummy(), "value", "fill value", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, value="Missing"):
        super().__init__()
        self._setDefault(value="Missing")
        self._set(**self._input_kwargs)

    def _transform(self, df):
        v = self.getOrDefault(self.value)
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c in self.getOrDefault(self.inputCols)})


class DeploymentFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Raw member inputs -> model features, as one persistable stage.

    * ``numericCols``: coerced to double (text that is not a number -> null);
    * ``dateCol``: parsed leniently; ``<prefix>_year`` and ``<prefix>_days``
      = days from the date to the stored ``referenceDate``, floored at 0,
      null stays null;
    * ``flags``: JSON list of ``[column, fill, value, name]`` -> ``name`` =
      ``coalesce(column, fill) == value`` as 0/1;
    * ``outputCols``: the feature order the model expects (missing -> error).

    Stateless (the reference date is a parameter), so it also runs on streams.
    """
    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    dateCol = Param(Params._dummy(), "dateCol", "date input", TypeConverters.toString)
    datePrefix = Param(Params._dummy(), "datePrefix", "date feature prefix", TypeConverters.toString)
    referenceDate = Param(Params._dummy(), "referenceDate", "stored reference date", TypeConverters.toString)
    flags = Param(Params._dummy(), "flags", "JSON list of [column, fill, value, name]", TypeConverters.toString)
    outputCols = Param(Params._dummy(), "outputCols", "feature order", TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through (ids)", TypeConverters.toListString)
    dateNames = Param(Params._dummy(), "dateNames", "JSON map of date feature names", TypeConverters.toString)

    @keyword_only
    def __init__(self, numericCols=None, dateCol=None, datePrefix="start", referenceDate=None, flags="[]",
                 outputCols=None, keepCols=None, dateNames="{}"):
        super().__init__()
        self._setDefault(datePrefix="start", flags="[]", keepCols=[], dateNames="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df):
        g = self.getOrDefault
        missing = [c for c in g(self.numericCols) + [g(self.dateCol)] + [f[0] for f in json.loads(g(self.flags))]
                   if c not in df.columns]
        if missing:
            raise ValueError(f"missing input columns: {missing}")
        out = to_numeric(df, g(self.numericCols))
        out = date_features(out, g(self.dateCol), prefix=g(self.datePrefix), reference=g(self.referenceDate),
                            strict=False, floor=True, drop=False, names=json.loads(g(self.dateNames)))
        for col, fill, value, name in json.loads(g(self.flags)):
            out = flag_equals(out, col, value, fill=fill, name=name)
        return out.select(*g(self.keepCols), *g(self.outputCols))


# The reference deployment model's raw inputs and its 11 features.
DEPLOYMENT_NUMERIC = ["Late_Payment_Count", "Monthly_Visits", "PT_Session_Count", "Group_Class_Attendance",
                      "Avg_Equipment_Wait_Time_Min", "Age", "Avg_Workout_Duration_Min"]
DEPLOYMENT_FEATURES = ["Late_Payment_Count", "Monthly_Visits", "PT_Session_Count", "Start_Year", "Membership_Days",
                       "Group_Class_Attendance", "Avg_Equipment_Wait_Time_Min", "Age",
                       "Supplement_Usage_No Protein Supplements", "Cardio_Preference_Rowing",
                       "Avg_Workout_Duration_Min"]


def deployment_stage(reference_date: str, keep=("Member_ID",)) -> DeploymentFeatures:
    """The deployment feature stage of the reference's final model, for a
    stored reference date (the latest start date of its training data)."""
    return DeploymentFeatures(
        numericCols=DEPLOYMENT_NUMERIC, dateCol="Membership_Start_Date", referenceDate=reference_date,
        dateNames=json.dumps({"year": "Start_Year", "days": "Membership_Days"}),
        flags=json.dumps([["Supplement_Usage", "No Protein Supplements", "No Protein Supplements",
                           "Supplement_Usage_No Protein Supplements"],
                          ["Cardio_Preference", "No Preference", "Rowing", "Cardio_Preference_Rowing"]]),
        outputCols=DEPLOYMENT_FEATURES, keepCols=list(keep))
