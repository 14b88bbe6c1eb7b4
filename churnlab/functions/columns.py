"""Column-level helpers: plain ``pyspark.sql.functions`` expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk cut points and grade names used by the campaign pages
# (score >= 0.7 high risk, >= 0.4 caution, otherwise retained; left-closed).
RISK_CUTS = (0.4, 0.7)
RISK_LABELS = ("retain", "caution", "high_risk")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def risk_grade(col, cuts: Sequence[float] = RISK_CUTS,
               labels: Sequence[str] = RISK_LABELS) -> Column:
    """Left-closed range bucket: label i for cuts[i-1] <= v < cuts[i]."""
    v = _c(col)
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    expr = None
    for cut, label in zip(reversed(cuts), reversed(labels[1:])):
        expr = F.when(v >= cut, label) if expr is None else expr.when(v >= cut, label)
    return F.when(v.isNull(), F.lit(None)).otherwise(expr.otherwise(labels[0]))


def parse_key(col) -> Column:
    """Experiment key -> struct(model, dataset, excluded).

    ``<model>_<dataset>[_without_<feature>]``: the dataset is ``50`` when the
    base key ends in ``_50``, else ``full``; the model is the base key without
    its last ``_`` part.
    """
    k = _c(col)
    base = F.split(k, "_without_", 2).getItem(0)
    excluded = F.when(k.contains("_without_"), F.split(k, "_without_", 2).getItem(1))
    model = F.when(base.contains("_"), F.regexp_extract(base, r"^(.*)_[^_]*$", 1)).otherwise(base)
    dataset = F.when(base.endswith("_50"), F.lit("50")).otherwise(F.lit("full"))
    return F.struct(model.alias("model"), dataset.alias("dataset"), excluded.alias("excluded"))


def artifact_name(col) -> Column:
    """File name of a Windows or POSIX path."""
    return F.substring_index(F.regexp_replace(_c(col), r"\\", "/"), "/", -1)


def weekday0(col) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.weekday``)."""
    return F.weekday(_c(col))


def hash_hex(col, salt) -> Column:
    """md5 hex of ``id|salt`` -- a deterministic, partition-independent order."""
    return F.md5(F.concat(_c(col).cast("string"), F.lit(f"|{salt}")))


def hash_unit(col, salt) -> Column:
    """Uniform value in [0, 1) from the first 8 hex digits of md5(id|salt)."""
    return F.conv(F.substring(hash_hex(col, salt), 1, 8), 16, 10).cast("double") / 4294967296.0


def safe_div(num, den) -> Column:
    """num / den, 0 when den is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))
