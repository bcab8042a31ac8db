"""Reusable column expressions (all JVM-side, whole-stage-codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consult import schema as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 INT; a null comparison counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clamp_negative(c: Column) -> Column:
    """Negative to 0, null stays null (T4). ``greatest`` would turn null to 0."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def whole_days(end: Column, start: Column, end_type: T.DataType | None = None,
               start_type: T.DataType | None = None) -> Column:
    """Whole days from start to end, floored over 24 h (T5).

    DATE inputs use ``datediff``; TIMESTAMP inputs floor the microsecond
    difference so a sub-day gap is 0, not 1.
    """
    is_date = isinstance(end_type, T.DateType) and isinstance(start_type, T.DateType)
    if is_date or end_type is None:
        return F.datediff(end, start)
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def days_since(df: DataFrame, end: str = S.CONTACT_DATE, start: str = S.ACCIDENT_DATE) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return whole_days(F.col(end), F.col(start), types.get(end), types.get(start))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over pairwise-complete rows; null for a constant column.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant input; this form
    returns null instead and equals ``corr`` otherwise.
    """
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x)
    ys = F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def pct(num: Column, den: Column) -> Column:
    """100 * num / den, null when den is 0."""
    return F.try_divide(num.cast("double") * 100.0, den.cast("double"))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def r6(c: Column) -> Column:
    """Round a double to 6 digits for value-checked outputs."""
    return F.round(c.cast("double"), 6)


def confidence_level(p: Column) -> Column:
    """Band of |p - 0.5| * 2: high >= 0.7, medium >= 0.4, else low; null without a score."""
    score = F.abs(p - F.lit(0.5)) * F.lit(2.0)
    return (F.when(score >= S.CONFIDENCE_HIGH, F.lit("high"))
            .when(score >= S.CONFIDENCE_MEDIUM, F.lit("medium"))
            .when(score.isNotNull(), F.lit("low")))


def unpivot_long(df: DataFrame, cols: list[str], ids: list[str] | None = None,
                 var: str = "feature", val: str = "value", val_type: str = "double") -> DataFrame:
    """Wide to long for a fixed column list (one narrow ``Expand``, no shuffle)."""
    ids = ids or []
    casted = df.select(*ids, *[F.col(c).cast(val_type).alias(c) for c in cols])
    return casted.unpivot(ids, cols, var, val)
