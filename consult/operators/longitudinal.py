"""What a consultation says about the one before: intervals, consistency rules, trajectories.

All three read the previous rows of a patient through ``groupscan``, so a
patient of any size, and the null patient, is spread over tasks. The order of a
patient's consultations is that of the consultation number: contact date, then
every other column, nulls last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import days_since, r6, whole_days
from consult.functions.groupscan import scan_within

#: Days between two consultations from which a gap is reported.
LONG_GAP = 365


def _order(df: DataFrame, key: str) -> list[str]:
    date = [S.CONTACT_DATE]
    return date + [c for c in df.columns if c not in (key, *date)]


def _days(df: DataFrame, start: str, end: str, like: tuple[str, str]) -> Column:
    """Whole days between two columns that have the types of the columns ``like``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return whole_days(F.col(end), F.col(start), types[like[1]], types[like[0]])


def days_between_consultations(df: DataFrame, key: str = S.PSEUDO_ID, num_partitions: int | None = None) -> DataFrame:
    """(key, consultation_number, contact date, previous_contact_date, days_since_previous):
    whole days from the patient's previous consultation, null at the first one or
    where a date is missing."""
    out = scan_within(df, [key], _order(df, key), number="consultation_number",
                      previous={"previous_contact_date": S.CONTACT_DATE}, num_partitions=num_partitions)
    days = _days(df, "previous_contact_date", S.CONTACT_DATE, (S.CONTACT_DATE, S.CONTACT_DATE))
    return out.select(key, "consultation_number", S.CONTACT_DATE, "previous_contact_date", days.cast("int").alias("days_since_previous"))


def interval_stats(intervals: DataFrame) -> DataFrame:
    """Per consultation number: rows with an interval, its mean, least and greatest, and how many are of the same day."""
    d = F.col("days_since_previous")
    return intervals.where(d.isNotNull()).groupBy("consultation_number").agg(
        F.count(F.lit(1)).alias("n_intervals"), r6(F.avg(d)).alias("mean_days"), F.min(d).alias("min_days"),
        F.max(d).alias("max_days"), F.count_if(d == 0).alias("n_same_day"))


# ---------------------------------------------------------------------------
# Rules across rows
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """A rule over a row and the one before it (columns ``previous_<name>``).

    A row is checked where ``applies`` and breaks the rule where not ``holds``;
    ``observed`` and ``expected`` are what the report shows of it."""

    name: str
    category: str
    applies: Column
    holds: Column
    observed: Column
    expected: Column


def _status_rule(name: str, score: str, status: str) -> Rule:
    """A status says how the score moved: 0 worse (higher), 1 same, 2 better (lower)."""
    now, before = F.col(score), F.col(f"previous_{score}")
    moved = F.when(now < before, 2).when(now > before, 0).otherwise(1)
    return Rule(name, "logical", now.isNotNull() & before.isNotNull() & F.col(status).isin(0, 1, 2),
                F.col(status) == moved, F.col(status), moved)


def consistency_rules(df: DataFrame) -> list[Rule]:
    """Rules of one patient's rows, for the types that ``df`` has."""
    same = (S.CONTACT_DATE, S.CONTACT_DATE)
    gap = _days(df, f"previous_{S.CONTACT_DATE}", S.CONTACT_DATE, same)
    shift = _days(df, f"previous_{S.ACCIDENT_DATE}", S.ACCIDENT_DATE, (S.ACCIDENT_DATE, S.ACCIDENT_DATE))
    since = days_since(df)
    label, was = F.col(S.LABEL), F.col(f"previous_{S.LABEL}")
    return [
        _status_rule("pain_status_follows_score", "p_score", "p_status"),
        _status_rule("function_status_follows_score", "fl_score", "fl_status"),
        Rule("accident_date_constant", "patient", shift.isNotNull(), F.col(S.ACCIDENT_DATE) == F.col(f"previous_{S.ACCIDENT_DATE}"), shift, F.lit(0)),
        Rule("recovery_not_withdrawn", "patient", label.isin(0, 1) & was.isin(0, 1), ~((was == 1) & (label == 0)), label, was),
        Rule("contact_after_accident", "temporal", since.isNotNull(), F.col(S.CONTACT_DATE) >= F.col(S.ACCIDENT_DATE), since, F.lit(0)),
        Rule("one_contact_a_day", "temporal", gap.isNotNull(), gap > 0, gap, F.lit(1)),
        Rule("no_long_gap", "temporal", gap.isNotNull(), gap <= LONG_GAP, gap, F.lit(LONG_GAP)),
    ]


def _checked(df: DataFrame, key: str, rules: list[Rule] | None, num_partitions: int | None) -> DataFrame:
    """One row per row and rule that applies: key, consultation number, rule, category, broken, observed, expected."""
    rules = consistency_rules(df) if rules is None else rules
    own = [c for c in df.columns if c != key]
    seen = scan_within(df, [key], _order(df, key), number="consultation_number",
                       previous={f"previous_{c}": c for c in own}, num_partitions=num_partitions)
    found = F.array(*[F.when(F.coalesce(r.applies, F.lit(False)), F.struct(
        F.lit(r.name).alias("rule"), F.lit(r.category).alias("category"), (~F.coalesce(r.holds, F.lit(False))).alias("broken"),
        r.observed.cast("double").alias("observed"), r.expected.cast("double").alias("expected"))) for r in rules])
    return seen.select(key, "consultation_number", F.explode(F.array_compact(found)).alias("r")).select(key, "consultation_number", "r.*")


def consistency_violations(df: DataFrame, key: str = S.ID, rules: list[Rule] | None = None, num_partitions: int | None = None) -> DataFrame:
    """(key, consultation_number, rule, category, observed, expected) of every row that breaks a rule."""
    return _checked(df, key, rules, num_partitions).where("broken").drop("broken")


def consistency_summary(df: DataFrame, key: str = S.ID, rules: list[Rule] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Per rule: rows checked, rows and patients that break it, and their share of the rows checked."""
    # Rows collapse per (rule, patient) before patients are counted.
    per = _checked(df, key, rules, num_partitions).groupBy("rule", "category", key).agg(F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("bad"))
    return per.groupBy("rule", "category").agg(
        F.sum("n").alias("n_checked"), F.sum("bad").alias("n_violations"), F.count_if(F.col("bad") > 0).alias("n_patients"),
        r6(F.sum("bad") * 100.0 / F.sum("n")).alias("violation_pct"))


# ---------------------------------------------------------------------------
# Averages and trajectories
# ---------------------------------------------------------------------------

_SCORES = ("p_score", "fl_score")


def slope(n: Column, sx: Column, sy: Column, sxx: Column, sxy: Column) -> Column:
    """Least-squares slope from sums over pairs; null where x does not vary."""
    den = n * sxx - sx * sx
    return F.when(den != 0, (n * sxy - sx * sy).cast("double") / den.cast("double"))


def _pair_sums(x: Column, y: Column, name: str) -> dict[str, Column]:
    """The five sums of the pairs in which neither side is missing, as whole numbers."""
    both = x.isNotNull() & y.isNotNull()
    x, y = x.cast("bigint"), y.cast("bigint")
    return {f"{name}_{k}": F.when(both, v) for k, v in (("n", F.lit(1)), ("x", x), ("y", y), ("xx", x * x), ("xy", x * y))}


def patient_trajectory(df: DataFrame, key: str = S.PSEUDO_ID, num_partitions: int | None = None) -> DataFrame:
    """Per consultation: running mean of both scores and their least-squares slope
    per day since the accident, over the patient's consultations up to this one.

    Scores and days are whole numbers, so the running sums are exact in any order
    of partitions; a slope is null until the day varies."""
    x = days_since(df)
    sums: dict[str, Column] = {}
    for y in _SCORES:
        sums.update({f"__{y}_m": F.col(y).cast("bigint"), f"__{y}_c": F.col(y).isNotNull().cast("bigint"), **_pair_sums(x, F.col(y), f"__{y}")})
    out = scan_within(df, [key], _order(df, key), number="consultation_number", running=sums, num_partitions=num_partitions)
    means = [r6(F.try_divide(F.col(f"__{y}_m").cast("double"), F.col(f"__{y}_c"))).alias(f"mean_{y}") for y in _SCORES]
    slopes = [r6(slope(*[F.col(f"__{y}_{k}") for k in ("n", "x", "y", "xx", "xy")])).alias(f"{y}_slope") for y in _SCORES]
    return out.select(key, "consultation_number", *means, *slopes)


def patient_averages(df: DataFrame, key: str = S.PSEUDO_ID, num_partitions: int | None = None) -> DataFrame:
    """Per patient: consultations, mean scores, mean days between consultations,
    change of the scores from the first to the last consultation, and their slope per day.

    One scan numbers the rows; the rest is one aggregate with a map-side combine."""
    seen = scan_within(df, [key], _order(df, key), number="__k", previous={"__before": S.CONTACT_DATE}, num_partitions=num_partitions)
    seen = seen.withColumn("__gap", _days(df, "__before", S.CONTACT_DATE, (S.CONTACT_DATE, S.CONTACT_DATE)).cast("bigint"))
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_consultations"), r6(F.avg("__gap")).alias("mean_days_between")]
    for y in _SCORES:
        pairs = [F.coalesce(F.sum(v), F.lit(0)) for v in _pair_sums(days_since(df), F.col(y), y).values()]
        aggs += [r6(F.avg(y)).alias(f"mean_{y}"), (F.max_by(y, "__k") - F.min_by(y, "__k")).cast("int").alias(f"{y}_change"), r6(slope(*pairs)).alias(f"{y}_slope")]
    return seen.groupBy(key).agg(*aggs)
