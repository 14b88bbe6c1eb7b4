"""Column transformer with scaling branches.

Every column goes to one branch: ``standard`` (median fill, then (v - mean) /
population deviation), ``robust`` (median fill, then (v - median) / (Q3 - Q1)),
``passthrough`` (median fill) or ``categorical`` (``Missing`` fill, one 0/1 column per
level, unseen levels all zeros). A numeric column with nulls among the fit rows also
gets ``<column>_missing``, which is scaled like its column, as in a pipeline of an
imputer with indicator and a scaler. Booleans count as numbers.

The fit is one aggregate (rows, nulls, moments), one read of the levels and the three
counting passes of ``selection`` for medians and quartiles of all columns. Statistics
of the *filled* column follow from those of its values: the fills are copies of the
median, so they move moments by a known amount, and a quartile's neighbours are
values at shifted ranks, or the median itself.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import named, sql_text
from .selection import _double, select_ranks

FILL = "Missing"


class _Branches(Params):
    standard = Param(Params._dummy(), "standard", "columns scaled by mean and deviation", TypeConverters.toListString)
    robust = Param(Params._dummy(), "robust", "columns scaled by median and quartiles", TypeConverters.toListString)
    passthrough = Param(Params._dummy(), "passthrough", "numeric columns filled only", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns encoded by level", TypeConverters.toListString)
    state = Param(Params._dummy(), "state", "fitted parameters (JSON)", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of all features, if set", TypeConverters.toString)
    fitWhere = Param(Params._dummy(), "fitWhere", "SQL predicate of the rows to fit on", TypeConverters.toString)

    def branch(self, name: str) -> list[str]:
        p = self.getParam(name)
        return list(self.getOrDefault(p)) if self.isDefined(p) else []

    @property
    def numeric(self) -> list[str]:
        return [c for b in ("standard", "robust", "passthrough") for c in self.branch(b)]


class ColumnTransformerModel(Model, _Branches, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted branches; keeps all other columns of the table."""

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def featureNames(self) -> list[str]:
        st = self.fitted
        out = []
        for b in ("standard", "robust", "passthrough"):
            out += self.branch(b) + [f"{c}_missing" for c in self.branch(b) if c in st["indicators"]]
        return out + [f"{c}_{v}" for c in self.branch("categorical") for v in st["levels"][c]]

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.fitted
        missing = [c for c in [*self.numeric, *self.branch("categorical")] if c not in df.columns]
        if missing:
            raise ValueError(f"columns needed by the transformer are missing: {missing}")
        new = {}
        for c, (center, scale) in st["indicators"].items():
            new[f"{c}_missing"] = (named(c).isNull().cast("double") - center) / scale
        for c, (median, center, scale) in st["numeric"].items():
            new[c] = (F.coalesce(named(c).cast("double"), F.lit(median)) - center) / scale
        for c, levels in st["levels"].items():
            for v in levels:
                new[f"{c}_{v}"] = (F.coalesce(named(c), F.lit(FILL)) == F.lit(v)).cast("double")
        keep = [named(c) for c in df.columns if c not in new and c not in st["levels"]]
        out = df.select(*keep, *[x.alias(n) for n, x in new.items()])
        if self.isDefined(self.outputCol):
            out = VectorAssembler(inputCols=self.featureNames, outputCol=self.getOrDefault(self.outputCol),
                                  handleInvalid="keep").transform(out)
        return out


class ColumnTransformer(Estimator, _Branches, DefaultParamsReadable, DefaultParamsWritable):
    """Fits all branches on the rows of ``fitWhere``. A column without a value among them
    is filled with 0; a deviation or quartile distance of 0 counts as 1."""

    @keyword_only
    def __init__(self, standard=None, robust=None, passthrough=None, categorical=None, fitWhere="", maxLevels=10000):
        super().__init__()
        kwargs = {k: list(v) if k != "fitWhere" else v for k, v in self._input_kwargs.items() if v and k != "maxLevels"}
        self._set(**kwargs)
        self._most = maxLevels

    def _fit(self, df: DataFrame) -> ColumnTransformerModel:
        where = self.getOrDefault(self.fitWhere) if self.isDefined(self.fitWhere) else ""
        rows = df.filter(F.expr(where)) if where else df
        cols = self.numeric
        clash = [c for c in cols if f"{c}_missing" in df.columns]
        if clash:
            raise ValueError(f"indicator names are taken: {clash}")
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(cols):
            x = named(c).cast("double")
            aggs += [F.count(x).alias(f"m{i}"), F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}")]
        got = rows.agg(*aggs).first()
        n = got["n"]
        values = self._order_statistics(rows, cols, n) if cols and n else {}
        st = {"numeric": {}, "indicators": {}, "levels": self._levels(rows)}
        for i, c in enumerate(cols):
            m = got[f"m{i}"]
            own = values.get(c, {})
            median = _between(0.5 * (m - 1), own) if m else 0.0
            center, scale = 0.0, 1.0
            k = n - m
            if c in self.branch("standard") and n:
                mean, var = (got[f"a{i}"], got[f"v{i}"]) if m else (0.0, 0.0)
                center = (m * mean + k * median) / n
                var = (m * (var + (mean - center) ** 2) + k * (median - center) ** 2) / n
                scale = math.sqrt(var) or 1.0
            elif c in self.branch("robust") and n:
                low, high = (_between(p * (n - 1), _Filled(own, m, k, median)) for p in (0.25, 0.75))
                center, scale = median, (high - low) or 1.0
            st["numeric"][c] = [median, center, scale]
            if k:
                st["indicators"][c] = _indicator(n, k, "standard" if c in self.branch("standard") else
                                                 "robust" if c in self.branch("robust") else "")
        model = ColumnTransformerModel()
        model._set(**{b: self.branch(b) for b in ("standard", "robust", "passthrough", "categorical") if self.branch(b)})
        if self.isDefined(self.outputCol):
            model._set(outputCol=self.getOrDefault(self.outputCol))
        return model._set(state=json.dumps(st))

    def _order_statistics(self, rows: DataFrame, cols: Sequence[str], n: int) -> dict[str, dict[int, float]]:
        """Values at the ranks that medians and quartiles of values and of filled columns need."""
        pairs = ", ".join(f"'{sql_text(c)}', cast(`{c.replace('`', '``')}` as double)" for c in cols)
        long = rows.select(F.expr(f"stack({len(cols)}, {pairs}) as (_f, _v)")).filter("_v is not null")
        q1, q3 = 0.25 * (n - 1), 0.75 * (n - 1)
        ranks = ["floor(0.5D * (m - 1))", "ceil(0.5D * (m - 1))"]
        ranks += [f"{f(q1)}L" for f in (math.floor, math.ceil)] + [f"m - {n - f(q3)}L" for f in (math.floor, math.ceil)]
        out: dict[str, dict[int, float]] = {}
        for x in select_ranks(long, ["_f"], F.expr(f"array_distinct(array({', '.join(f'cast({r} as bigint)' for r in ranks)}))")):
            out.setdefault(x["_f"], {})[x["r"]] = _double(x["key"])
        return out

    def _levels(self, rows: DataFrame) -> dict[str, list[str]]:
        cols = self.branch("categorical")
        if not cols:
            return {}
        pairs = ", ".join(f"'{sql_text(c)}', coalesce(cast(`{c.replace('`', '``')}` as string), '{FILL}')" for c in cols)
        seen = rows.select(F.expr(f"stack({len(cols)}, {pairs}) as (f, v)")).distinct()
        first = Window.partitionBy("f").orderBy("v")
        out: dict[str, list[str]] = {c: [] for c in cols}
        for r in seen.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= self._most + 1).collect():
            out[r.f].append(r.v)
        for c, v in out.items():
            if len(v) > self._most:
                raise ValueError(f"{c}: more than {self._most} levels")
        return {c: sorted(v) for c, v in out.items()}


class _Filled(dict):
    """Sorted filled column: ``m`` values at known ranks and ``k`` copies of their median."""

    def __init__(self, own: dict, m: int, k: int, median: float):
        super().__init__(own)
        self.m, self.k, self.median = m, k, median

    def __getitem__(self, i: int) -> float:
        if 2 * i < self.m + self.k:         # lower half: fills push larger values out
            return min(super().__getitem__(i), self.median) if i < self.m else self.median
        j = i - self.k
        return max(super().__getitem__(j), self.median) if j >= 0 else self.median


def _between(pos: float, at) -> float:
    low, high = at[math.floor(pos)], at[math.ceil(pos)]
    return low if low == high else low + (high - low) * (pos - math.floor(pos))


def _indicator(n: int, k: int, branch: str) -> list[float]:
    """Center and scale of a 0/1 column with ``k`` ones among ``n`` rows."""
    if branch == "standard":
        p = k / n
        return [p, math.sqrt(p * (1 - p)) or 1.0]
    if branch == "robust":
        class Ones(dict):
            def __getitem__(self, i):
                return 1.0 if i >= n - k else 0.0
        q1, median, q3 = (_between(p * (n - 1), Ones()) for p in (0.25, 0.5, 0.75))
        return [median, (q3 - q1) or 1.0]
    return [0.0, 1.0]
