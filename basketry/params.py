"""Parameters of a run. Every one of them has the value of the daily job as its default."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values of the daily job.
MIN_SUPPORT = 0.0005
METRIC = "lift"
MIN_THRESHOLD = 1.0
FROM_DAYS = 60
TO_DAYS = 1
TOP_K = 30
BUSINESS_TYPE = 2
COUNTRIES = (
    "Uruguay",
    "Chile",
    "Argentina",
    "Perú",
    "Venezuela",
    "Panamá",
    "Ecuador",
    "Paraguay",
    "Costa Rica",
    "Bolivia",
    "República Dominicana",
    "El Salvador",
    "Nicaragua",
    "Guatemala",
    "Honduras",
)

ALGORITHMS = ("vertical", "levelwise", "fpgrowth")


@dataclass(frozen=True)
class RunWindow:
    """The half-open date range ``[run_date - from_days, run_date - to_days)``.

    With the defaults this is 59 days long and leaves out yesterday.
    """

    run_date: dt.date
    from_days: int = FROM_DAYS
    to_days: int = TO_DAYS

    def __post_init__(self) -> None:
        if self.from_days < self.to_days:
            raise ValueError("from_days must not be smaller than to_days")

    @property
    def start(self) -> dt.date:
        return self.run_date - dt.timedelta(days=self.from_days)

    @property
    def end(self) -> dt.date:
        return self.run_date - dt.timedelta(days=self.to_days)


@dataclass(frozen=True)
class OrderFilter:
    """Which orders count, besides the date range."""

    business_type: int = BUSINESS_TYPE
    countries: tuple[str, ...] = COUNTRIES


@dataclass(frozen=True)
class MiningParams:
    """Thresholds of frequent-itemset mining.

    ``min_support`` is relative to the baskets of each country. ``max_len`` (None: no limit) stops
    at itemsets of that size; ``min_count_floor`` raises the least count a country may come out with.
    ``wide_basket`` is the number of frequent items above which a basket is counted by joining it
    with candidates instead of expanding it (see ``operators.mining``); it changes no result. Nor does
    ``local_rows``, the number of orders up to which ``vertical`` and ``fpgrowth`` leave a node and item to one task;
    closed itemsets count different baskets.
    """

    min_support: float = MIN_SUPPORT
    max_len: int | None = None
    min_count_floor: int = 1
    algorithm: str = "vertical"
    wide_basket: int = 256
    local_rows: int = 1 << 16

    def __post_init__(self) -> None:
        if not 0.0 < self.min_support <= 1.0:
            raise ValueError("min_support must be in (0, 1]")
        if self.max_len is not None and self.max_len < 1:
            raise ValueError("max_len must be at least 1")
        if self.min_count_floor < 1:
            raise ValueError("min_count_floor must be at least 1")
        if self.algorithm not in ALGORITHMS:
            raise ValueError(f"algorithm must be one of {ALGORITHMS}, not {self.algorithm!r}")
        if self.wide_basket < 2:
            raise ValueError("wide_basket must be at least 2")
        if self.local_rows < 1:
            raise ValueError("local_rows must be at least 1")
