"""Ordered classification rules, all built from ``when`` chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Callsign prefixes in matching order.
CALLSIGN_PREFIXES = (
    ("RCH", "TRANSPORT"),
    ("RRR", "TRANSPORT"),
    ("GAF", "TRANSPORT"),
    ("PLF", "TRANSPORT"),
    ("CNV", "TRANSPORT"),
    ("LAGR", "TANKER"),
    ("TITAN", "TANKER"),
    ("VIPER", "TRAINING"),
    ("HAWK", "TRAINING"),
    ("VENOM", "FIGHTER"),
    ("RAGE", "FIGHTER"),
    ("HOMER", "SURVEILLANCE"),
    ("FORTE", "SURVEILLANCE"),
)

# Lower bounds and labels of the classes.
FREQUENCY_STEPS = ((100, "HIGH_FREQUENCY"), (20, "MEDIUM_FREQUENCY"))
ROUTE_TIER_STEPS = ((500, "TIER_1_MAJOR"), (100, "TIER_2_REGULAR"), (20, "TIER_3_MINOR"))
HUB_STEPS = ((100, "MAJOR_HUB"), (50, "REGIONAL_HUB"), (20, "MEDIUM_AIRPORT"),
             (5, "SMALL_AIRPORT"))
ANOMALY_STEPS = ((3.5, "CRITICAL"), (2.5, "HIGH"), (1.5, "ELEVATED"))
ANOMALY_LEVELS = ("NORMAL", "ELEVATED", "HIGH", "CRITICAL")
ANOMALY_EDGES = (1.5, 2.5, 3.5)


def ladder(col: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step (given from high to low) that ``col`` reaches."""
    chain = F
    for bound, label in steps:
        chain = chain.when(col >= bound, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def right_closed_bins(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(-inf, e0], (e0, e1], ..., (en, inf)``; null stays null."""
    chain = F
    for edge, label in zip(reversed(edges), reversed(labels[1:])):
        chain = chain.when(col > edge, F.lit(label))
    return chain.when(col.isNotNull(), F.lit(labels[0]))


def classify_prefix(col: Column, rules: Sequence[tuple[str, str]] = CALLSIGN_PREFIXES,
                    otherwise: str = "UNKNOWN") -> Column:
    """Label of the first rule whose prefix starts the text; null is ``otherwise``."""
    chain = F
    for prefix, label in rules:
        chain = chain.when(col.startswith(prefix), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def range_category(distance_km: Column) -> Column:
    return (F.when(distance_km.isNull(), F.lit("UNKNOWN"))
            .when(distance_km < 500, F.lit("SHORT_RANGE"))
            .when(distance_km < 2000, F.lit("MEDIUM_RANGE"))
            .otherwise(F.lit("LONG_RANGE")))


def route_type(origin_country: Column, destination_country: Column) -> Column:
    """An unknown country makes a route international."""
    return (F.when(origin_country == destination_country, F.lit("DOMESTIC"))
            .otherwise(F.lit("INTERNATIONAL")))


def anomaly_context(fighter: Column, transport: Column, surveillance: Column,
                    rolling_avg: Column) -> Column:
    return (F.when(fighter > rolling_avg * 0.3, F.lit("FIGHTER_SPIKE"))
            .when(transport > rolling_avg * 0.5, F.lit("TRANSPORT_SURGE"))
            .when(surveillance > 0, F.lit("SURVEILLANCE_ACTIVE"))
            .otherwise(F.lit("GENERAL_INCREASE")))
