"""Data-quality checks.

Each check yields the rows that break it; the suite reports the number of those
rows per check. A repeated value counts once for ``unique`` and an unexpected
value once for ``accepted_values``, however many rows carry it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from contrail.functions import numeric

MAX_MINUTES = 1440
MAX_MILITARY_PCT = 20.0


# --- single checks: failing rows -----------------------------------------

def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.filter(_outside(column, low, high))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return (df.filter(_unexpected(column, values)).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))


def no_negative(df: DataFrame, column: str = "flight_duration_min") -> DataFrame:
    return df.filter(F.col(column) < 0)


def max_value(df: DataFrame, column: str = "flight_duration_min",
              limit: float = MAX_MINUTES) -> DataFrame:
    return df.filter(F.col(column) > limit)


def flag_ratio(df: DataFrame, flag: str = "is_military") -> DataFrame:
    """One row: rows, flagged rows, percentage."""
    counts = df.agg(F.count(F.lit(1)).alias("total_flights"),
                    numeric.count_if(F.col(flag)).alias("military_flights"))
    return counts.select(
        "total_flights", "military_flights",
        numeric.ratio(F.col("military_flights") * F.lit(100.0), F.col("total_flights"))
        .alias("military_pct"))


def max_ratio(df: DataFrame, flag: str = "is_military",
              limit: float = MAX_MILITARY_PCT) -> DataFrame:
    return flag_ratio(df, flag).filter(F.col("military_pct") > limit)


def _outside(column: str, low, high) -> Column:
    tests = []
    if low is not None:
        tests.append(F.col(column) < low)
    if high is not None:
        tests.append(F.col(column) > high)
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _unexpected(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


# --- the suite -----------------------------------------------------------

@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}.{self.column}"


def _checks(model: str, **columns) -> list[Check]:
    found = []
    for column, kinds in columns.items():
        for kind in kinds:
            kind, args = (kind, {}) if isinstance(kind, str) else kind
            found.append(Check(model, column, kind, args))
    return found


# The column checks of every model and the three assertions.
SUITE: tuple[Check, ...] = (
    *_checks("stg_flights", flight_id=["unique", "not_null"], icao24=["not_null"],
             first_seen_at=["not_null"], last_seen_at=["not_null"]),
    *_checks("stg_airports", airport_id=["unique", "not_null"], latitude=["not_null"],
             longitude=["not_null"]),
    *_checks("stg_ranges", range_start=["not_null"], range_end=["not_null"],
             country_code=["not_null"]),
    *_checks("flight_performance", origin_airport_id=["not_null"],
             destination_airport_id=["not_null"],
             total_flights=["not_null", ("accepted_range", {"low": 5})],
             avg_duration_min=[("accepted_range", {"low": 0, "high": MAX_MINUTES})]),
    *_checks("airport_network", airport_id=["unique", "not_null"],
             total_degree=[("accepted_range", {"low": 0})]),
    *_checks("military_activity", date_id=["not_null"], country_code=["not_null"],
             military_flight_count=["not_null", ("accepted_range", {"low": 0})]),
    *_checks("anomaly_flags", anomaly_level=[
        ("accepted_values", {"values": ("ELEVATED", "HIGH", "CRITICAL")})]),
    *_checks("anomaly_scores", date_id=["not_null"], country_code=["not_null"],
             anomaly_level=[("accepted_values",
                             {"values": ("NORMAL", "ELEVATED", "HIGH", "CRITICAL")})]),
    *_checks("airport_graph", airport_id=["unique", "not_null"],
             hub_rank=["unique", "not_null"],
             pagerank_score=[("accepted_range", {"low": 0, "high": 1})]),
    *_checks("flights_enriched", flight_duration_min=[
        "no_negative", ("max_value", {"limit": MAX_MINUTES})],
        is_military=[("max_ratio", {"limit": MAX_MILITARY_PCT})]),
)


def _failure_count(check: Check) -> Column:
    """Failures of a check as an aggregate, so all of a model need one pass."""
    col = F.col(check.column)
    if check.kind == "not_null":
        return numeric.count_if(col.isNull())
    if check.kind == "accepted_range":
        return numeric.count_if(_outside(check.column, check.args.get("low"),
                                         check.args.get("high")))
    if check.kind == "accepted_values":
        return F.countDistinct(F.when(_unexpected(check.column, check.args["values"]), col))
    if check.kind == "no_negative":
        return numeric.count_if(col < 0)
    if check.kind == "max_value":
        return numeric.count_if(col > check.args["limit"])
    if check.kind == "max_ratio":
        over = (numeric.count_if(col) * F.lit(100.0)
                > F.lit(check.args["limit"]) * F.count(F.lit(1)))
        return over.cast("bigint")
    raise ValueError(f"unknown check {check.kind}")


def run_suite(models: Mapping[str, DataFrame],
              suite: Sequence[Check] = SUITE) -> DataFrame:
    """One row per check: model, column, failures, passed.

    The row-level checks of a model share one aggregation; only ``unique``
    needs a grouping of its own.
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in suite):
        df = models[model]
        row_level = [c for c in suite if c.model == model and c.kind != "unique"]
        if row_level:
            results = [F.struct(*_labels(c), F.coalesce(_failure_count(c), F.lit(0))
                                .cast("bigint").alias("failures")) for c in row_level]
            parts.append(df.agg(F.array(*results).alias("results"))
                         .select(F.explode("results").alias("r")).select("r.*"))
        for c in suite:
            if c.model == model and c.kind == "unique":
                parts.append(unique(df, c.column).agg(
                    F.count(F.lit(1)).alias("failures")).select(*_labels(c), "failures"))
    report = reduce(DataFrame.unionByName, parts)
    return report.select("check", "model", "column", "failures",
                         (F.col("failures") == 0).alias("passed"))


class Watch:
    """The suite as a by-product of jobs that run anyway.

    ``add`` attaches a model's row-level checks to a DataFrame as observed metrics,
    which are counted while it is written or read by another write. ``report`` needs
    passes of its own only for ``unique``, for models that were not added, and to
    count unexpected values where there are any. A stage that runs again after the loss
    of an executor can be counted again: what passes does so all the same.
    """

    def __init__(self, suite: Sequence[Check] = SUITE) -> None:
        self.suite = suite
        self.observations: dict[str, Observation] = {}

    def add(self, model: str, df: DataFrame) -> DataFrame:
        counts = [_row_count(c).alias(c.name) for c in self.suite if c.model == model and c.kind != "unique"]
        if not counts:
            return df
        self.observations[model] = Observation()
        return df.observe(self.observations[model], *counts, F.count(F.lit(1)).alias("rows"))

    def report(self, models: Mapping[str, DataFrame]) -> DataFrame:
        """As ``run_suite``, after the jobs that read what was added."""
        known, rest = [], []
        for c in self.suite:
            if c.kind == "unique" or c.model not in self.observations:
                rest.append(c)
                continue
            # an input that is empty for certain is not counted at all
            seen = self.observations[c.model].get or {}
            failures = seen.get(c.name, 0) or 0
            if c.kind == "accepted_values" and failures:
                rest.append(c)
            elif c.kind == "max_ratio":
                known.append((c, int(failures * 100.0 > c.args["limit"] * seen.get("rows", 0))))
            else:
                known.append((c, failures))
        spark = next(iter(models.values())).sparkSession
        rows = spark.createDataFrame([(c.name, c.model, c.column, n, n == 0) for c, n in known],
                                     "check string, model string, column string, failures bigint, passed boolean")
        return rows.unionByName(run_suite(models, rest)) if rest else rows


def _row_count(check: Check) -> Column:
    """Rows that a check is about; observed metrics cannot count distinct values."""
    if check.kind == "accepted_values":
        return numeric.count_if(_unexpected(check.column, check.args["values"]))
    if check.kind == "max_ratio":
        return numeric.count_if(F.col(check.column))
    return _failure_count(check)


def _labels(check: Check) -> list[Column]:
    return [F.lit(check.name).alias("check"), F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column")]
