"""Checks of summary tables as a table of rules, compiled into one aggregate.

A summary has a row for each run, hazard, threshold and unit; what was recorded when the run
was made has a row for each run, hazard and threshold. Every rule is a condition or a
comparison over sums of the summary, so that one pass with partial sums gives all of them:
a row for each run, hazard, threshold and rule, with status and value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapop.functions.scalar import dsum

KEYS = ("run_id", "hazard", "threshold")
#: Absolute tolerance of sums and the relative difference that is a warning.
SUM_TOLERANCE = {"flood": (1.0, 0.05), "violence": (1.0, 0.05), "drought": (1e-2, 0.005), "heat": (1e-2, 0.005)}
#: How far a percentage may leave 0 to 100, and a mean its record.
LOW, HIGH, MEAN_TOLERANCE, MEAN_WARNING = -1e-6, 100.0001, 1e-3, 0.05


@dataclass(frozen=True)
class Rule:
    """``measure`` is an aggregate over a unit's rows. With ``against``, a column of the record,
    the two are compared by tolerance (of the hazard, or ``within``); else the measure counts
    violations, and ``level`` is the status if there are any."""

    name: str
    measure: Column
    level: str = "FAIL"
    against: str | None = None
    within: tuple[float, float] | None = None


def rules() -> tuple[Rule, ...]:
    affected, pct = F.col("pop_affected"), F.col("pct_affected")
    return (
        Rule("non_negative", F.count_if(affected < LOW)),
        Rule("pct_bounds", F.count_if(~F.coalesce(pct.between(LOW, HIGH), F.lit(False)))),
        Rule("exposed_within_total", F.count_if(affected > F.col("pop_total") + 1e-6)),
        Rule("monotonic", F.count_if(affected + 1e-6 < F.col("stricter"))),
        Rule("zero_population", F.count_if(F.col("pop_total") <= 0), level="WARN"),
        Rule("table_vs_recorded_sum", dsum(affected), against="recorded_affected"),
        Rule("table_vs_recorded_total", dsum(F.col("pop_total")), against="recorded_total"),
        Rule("table_vs_recorded_share", F.try_divide(dsum(affected), dsum(F.col("pop_total"))), against="recorded_share", within=(MEAN_TOLERANCE, MEAN_WARNING)),
    )


def compared(a: Column, b: Column, absolute: Column, warning: Column) -> Column:
    """PASS within the absolute tolerance (or a billionth), WARN within the relative one."""
    gap = F.abs(a - b)
    return F.when(gap <= F.greatest(absolute, 1e-9 * F.greatest(F.abs(a), F.abs(b))), "PASS").when(gap / F.greatest(F.abs(b), F.lit(1.0)) <= warning, "WARN").otherwise("FAIL")


def check_table(summary: DataFrame, recorded: DataFrame, looser: dict[str, tuple[str, ...]]) -> DataFrame:
    """(run_id, hazard, threshold, name, status, value, recorded) of every rule.

    ``summary``: run_id, hazard, threshold, admin_id, pop_total, pop_affected, pct_affected;
    ``recorded``: run_id, hazard, threshold, recorded_total, recorded_affected. ``looser`` has
    the thresholds of each hazard from the loosest to the strictest; no unit may have more
    people at a stricter one. A comparison without a record is WARN.
    """
    every = rules()
    order = F.coalesce(*[F.when((F.col("hazard") == h) & (F.col("threshold") == t), F.lit(k)) for h, some in looser.items() for k, t in enumerate(some)], F.lit(None).cast("int"))
    nxt = F.lead(F.struct("rank", "pop_affected")).over(Window.partitionBy("run_id", "hazard", "admin_id").orderBy(F.col("rank").asc_nulls_last(), "threshold"))
    units = summary.withColumn("rank", order).withColumn("next", nxt).withColumn("stricter", F.when(F.col("rank") < F.col("next.rank"), F.col("next.pop_affected")))
    sums = units.groupBy(*KEYS).agg(*[r.measure.cast("double").alias(r.name) for r in every])
    met = sums.join(recorded, list(KEYS), "left").withColumn("recorded_share", F.try_divide("recorded_affected", "recorded_total"))
    by_hazard = lambda k: F.coalesce(*[F.when(F.col("hazard") == h, F.lit(v[k])) for h, v in SUM_TOLERANCE.items()], F.lit((1.0, 0.05)[k]))

    def row(r: Rule) -> Column:
        value = F.col(r.name)
        if r.against is None:
            status, record = F.when(value > 0, r.level).otherwise("PASS"), F.lit(None).cast("double")
        else:
            record = F.col(r.against)
            absolute, warning = map(F.lit, r.within) if r.within else (by_hazard(0), by_hazard(1))
            status = F.when(record.isNull() | value.isNull(), "WARN").otherwise(compared(value, record, absolute, warning))
        return F.struct(F.lit(r.name).alias("name"), status.alias("status"), value.alias("value"), record.alias("recorded"))

    return met.select(*KEYS, F.explode(F.array(*map(row, every))).alias("c")).select(*KEYS, "c.*")


def rolled_up(checks: DataFrame, by: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Failures, warnings and status of each run: FAIL if anything failed, else PASS."""
    fail, warn = F.count_if(F.col("status") == "FAIL"), F.count_if(F.col("status") == "WARN")
    return checks.groupBy(*by).agg(F.count("*").alias("checks"), fail.alias("failures"), warn.alias("warnings"), F.when(fail > 0, "FAIL").otherwise("PASS").alias("status"))


def row_flags(summary: DataFrame) -> DataFrame:
    """The flags of each unit's row: negative, zero, missing, below, above, exceeds, and any."""
    pct, total, affected = F.col("pct_affected"), F.col("pop_total"), F.col("pop_affected")
    flags = {"negative": (total < 0) | (affected < 0), "zero": total == 0, "missing": pct.isNull(), "below": F.coalesce(pct < 0, F.lit(False)), "above": F.coalesce(pct > 100, F.lit(False)), "exceeds": affected > total}
    return summary.select(*KEYS, "admin_id", *[c.alias(n) for n, c in flags.items()]).withColumn("any_flag", F.exists(F.array(*flags), lambda x: x))


def quality_rows(summary: DataFrame, recorded: DataFrame) -> DataFrame:
    """One row for each run, hazard and threshold: units, sums, their differences from the
    record in people and percent, least and greatest percentage."""
    sums = summary.groupBy(*KEYS).agg(F.count("*").alias("units"), dsum(F.col("pop_total")).alias("total"), dsum(F.col("pop_affected")).alias("affected"), F.round(F.min("pct_affected"), 6).alias("min_pct"), F.round(F.max("pct_affected"), 6).alias("max_pct"))
    met = sums.join(recorded, list(KEYS), "left")
    gap = F.col("affected") - F.col("recorded_affected")
    return met.select(*KEYS, "units", "total", "affected", "min_pct", "max_pct", F.round(gap, 4).alias("diff"), F.round(F.try_divide(100 * gap, F.col("recorded_affected")), 6).alias("diff_pct"))
