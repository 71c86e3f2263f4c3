"""Parameters shared by every plan."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Business thresholds.

    ``focus_pattern`` is a LIKE pattern; suppliers whose upper-cased raw name
    matches it are the "focus" side, everybody else is a competitor.
    """

    focus_pattern: str
    promo_threshold: float = 0.10
    min_quality_score: float = 70.0
    outlier_sigmas: float = 3.0

    def __post_init__(self) -> None:
        if not 0 < self.promo_threshold < 1:
            raise ValueError("promo_threshold must lie strictly between 0 and 1")

    @property
    def promo_threshold_pct(self) -> float:
        return round(self.promo_threshold * 100, 8)
