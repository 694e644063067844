"""Report parameters (one frozen dataclass instead of a command line)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Eligibility:
    """Which dispensations require a search (state mandatory-use rules, E2).

    ``None`` means "do not filter on this field".
    """

    ahfs_in: tuple[str, ...] | None = None
    include_refills: bool = True
    states: tuple[str, ...] | None = None
    max_days_supply: int | None = None
    min_days_supply: int | None = None
    excluded_roles: tuple[str, ...] | None = None
    excluded_locations: tuple[str, ...] | None = None
    excluded_treatment_types: tuple[str, ...] | None = None
    schedules: tuple[int, ...] | None = None


# AHFS class descriptions of the supplement extracts.
OPIOID_CLASSES = ("OPIOID AGONISTS", "OPIOID PARTIAL AGONISTS")
BENZO_CLASSES = ("BENZODIAZEPINES (ANTICONVULSANTS)", "BENZODIAZEPINES (ANXIOLYTIC, SEDATIV/HYP)")


@dataclass(frozen=True)
class ReportConfig:
    """All knobs of a mandatory-use report.

    Defaults are the reference program's defaults.  ``bucket_days`` and
    ``salt_buckets`` (split hot join groups) shape the interval joins (see
    ``rxlens.operators.intervals``); ``name_block`` is the number of rows from
    which a birth date's names are matched through an index (``rxlens.operators.patients``);
    ``split_rows`` is the size from which a group of the naive match is cut;
    ``max_broadcast_rows`` bounds the size-checked broadcasts of the
    prescriber-identity table.
    """

    first_date: dt.date = dt.date(2024, 4, 1)
    last_date: dt.date = dt.date(2024, 4, 30)
    ratio: float = 0.7
    partial_ratio: float = 0.5
    days_before: int = 7
    filter_vets: bool = True
    supplement: bool = True
    overlap_ratio: float = 0.9
    overlap_type: str = "last"
    naive_ratio: float = 0.7
    mme_threshold: float = 90
    report_lag_days: int = 1
    normalize_active_dea: bool = False
    opioid_pattern: str = "OPIOID"
    benzo_pattern: str = "BENZO"
    naive_days: int = 60
    eligibility: Eligibility = field(default_factory=Eligibility)
    bucket_days: int = 30
    salt_buckets: int = 1
    name_block: int = 4096
    split_rows: int = 20_000
    max_broadcast_rows: int = 2_000_000

    def __post_init__(self) -> None:
        if self.overlap_type not in {"last", "part", "both"}:
            raise ValueError(f"overlap_type must be last, part or both, not {self.overlap_type!r}")
        if self.first_date > self.last_date:
            raise ValueError("first_date is after last_date")
        if min(self.bucket_days, self.salt_buckets, self.name_block, self.split_rows) < 1:
            raise ValueError("bucket_days, salt_buckets, name_block and split_rows must be positive")

    @property
    def search_from(self) -> dt.date:
        return self.first_date - dt.timedelta(days=self.days_before)

    @property
    def search_to(self) -> dt.date:
        return self.last_date + dt.timedelta(days=1)

    def with_(self, **changes) -> "ReportConfig":
        return replace(self, **changes)


def report_period(today: dt.date | None = None, first: dt.date | None = None,
                  last: dt.date | None = None, auto: bool = True,
                  tz: str = "UTC") -> tuple[dt.date, dt.date]:
    """The previous full calendar month (auto), else the explicit dates."""
    if not auto:
        if first is None or last is None:
            raise ValueError("explicit period needs first and last")
        return first, last
    if today is None:
        from zoneinfo import ZoneInfo
        today = dt.datetime.now(tz=ZoneInfo(tz)).date()
    last_prev = today.replace(day=1) - dt.timedelta(days=1)
    return last_prev.replace(day=1), last_prev


def report_file_name(first: dt.date, last: dt.date, full: bool) -> str:
    """K1 file name: ``april2024_mandatory_use_full.csv`` or a month range.

    Unlike a month-name-only test, a range is detected on (year, month).
    """
    kind = "full" if full else "base"
    m1 = first.strftime("%B").lower()
    m2 = last.strftime("%B").lower()
    if (first.year, first.month) == (last.year, last.month):
        return f"{m1}{first.year}_mandatory_use_{kind}.csv"
    return f"{m1}{first.year}-{m2}{last.year}_mandatory_use_{kind}.csv"
