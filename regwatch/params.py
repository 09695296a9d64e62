"""Thresholds of the operators, in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # spike guard
    spike_ratio: float = 3.0
    spike_floor: int = 10
    spike_absolute: int = 150
    spike_history: int = 5
    trailing_rows: int = 28
    reissue_overlap: float = 0.5
    # matching
    dense_address: int = 5
    top_candidates: int = 5
    national_score: float = 0.9
    search_again_days: int = 30
    # classification
    score_high: float = 0.85
    score_medium: float = 0.6
    score_rescue: float = 0.95
    incorporation_days: int = 180
    incorporation_late_days: int = 90
    fallback_score: float = 0.9
    many_venues: int = 5
    recheck_days: int = 90
    name_edits: int = 2
    name_least: int = 4
    churn_days: int = 60
    # enrichment
    backfill_days: int = 30
    # monitoring
    stale_ratio: float = 3.0
    stale_least_days: int = 10
    cadence_history: int = 3
    stale_fallback_days: int = 30
    deviation_ratio: float = 0.5
    deviation_history: int = 5
    deviation_floor: int = 10
    skipped_ratio: float = 0.01
    # delivery
    complete_share: float = 0.9
    candidate_dates: int = 30


DEFAULT = Params()
