"""Project variables, gathered in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Tunable values of the models; the defaults are the reference behaviour."""

    # a country-day below this many military flights is not scored
    min_flights_threshold: int = 3
    # z-score from which a day is flagged as an anomaly
    anomaly_zscore_threshold: float = 2.5
    # rows (not calendar days) in the long and the short rolling frame
    baseline_window_rows: int = 30
    smoothing_window_rows: int = 7
    # routes with fewer flights are left out of the performance mart
    min_route_flights: int = 5
    # graph metrics
    pagerank_alpha: float = 0.85
    pagerank_tol: float = 1e-6
    pagerank_max_iter: int = 100
    # exact unless a number of sources asks for an approximation
    betweenness_sources: int | None = None
    betweenness_seed: int = 42
    # catalog layout
    raw_schema: str = "raw"
    marts_schema: str = "marts"
