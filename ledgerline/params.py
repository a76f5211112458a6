"""Report parameters.  Every date a report depends on is an explicit value."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Branch:
    """A branch of the institution: number, category of the dividend report, and the journal report's
    (category, activity level, specialization, member density)."""

    number: str
    category: str
    journal: tuple[str, str, str, str]


@dataclass(frozen=True)
class Institution:
    """Names and branch labels of the one institution behind a single-tenant database."""

    # Part of the names of the institution's own entities, and the head office's whole name.
    name: str = "\0"
    head_office: str = "\0"
    # Printed for them.
    short_name: str = ""
    branches: tuple[Branch, ...] = ()


@dataclass(frozen=True)
class Params:
    # Anchor date that replaces current_date / CURDATE().
    as_of: dt.date = field(default_factory=dt.date.today)
    # First date of the GL activity scan (general-ledger trend).
    gl_start: dt.date = dt.date(2022, 1, 1)
    # Months of the GL grid and of the journal report.
    grid_months: int = 36
    # First date of the card-transaction report.
    cards_start: dt.date = dt.date(2025, 1, 1)
    # First date of the dividend report.
    dividend_start: dt.date = dt.date(2022, 1, 1)
    # Days of the "recently active" window.
    recent_days: int = 90
    # Opt-in repairs of suspicious literals in the reference text, e.g. {"D1", "D2"}.
    fix: frozenset = frozenset()
    # The institution of the single-tenant reports.
    institution: Institution = Institution()
    # Apply the report's ORDER BY (a global sort); callers writing to a sink may skip it.
    ordered: bool = True

    def fixed(self, defect: str) -> bool:
        return defect in self.fix


# Parameters matching the test fixture's data range (FIXTURES.md); the institution is invented.
FIXTURE_PARAMS = Params(
    as_of=dt.date(2001, 7, 15),
    gl_start=dt.date(1995, 1, 1),
    cards_start=dt.date(1995, 1, 1),
    dividend_start=dt.date(1995, 1, 1),
    institution=Institution(
        name="EXAMPLE VALLEY SAVERS", head_office="EXAMPLE VALLEY SAVERS - HEAD OFFICE", short_name="EXAMPLE VALLEY",
        branches=(
            Branch("0", "HEADQUARTERS", ("HEADQUARTERS/CORPORATE", "VERY_HIGH_ACTIVITY", "Corporate Members", "VERY_HIGH_DENSITY")),
            Branch("1", "MAIN_BRANCH", ("MAIN_BRANCH/PRIMARY", "HIGHEST_ACTIVITY", "General Membership", "HIGHEST_DENSITY")),
            Branch("2", "MARKET_SQUARE", ("MARKET_SQUARE/BUSINESS", "MINIMAL_ACTIVITY", "Business Services", "MINIMAL_DENSITY")),
            Branch("3", "WEST_SIDE", ("WEST_SIDE/COMMUNITY", "LOW_ACTIVITY", "Community Satellite", "LOW_DENSITY")),
            Branch("4", "HILL_TOP", ("HILL_TOP/HIGH_VOLUME", "HIGH_ACTIVITY", "Family Focused", "HIGH_DENSITY")),
            Branch("5", "HARBOUR", ("HARBOUR/MIXED", "MEDIUM_ACTIVITY", "Mixed Services", "MEDIUM_DENSITY")),
            Branch("6", "REMOTE_SERVICES", ("REMOTE_SERVICES/DIGITAL", "DIGITAL_ONLY", "Remote Services", "ULTRA_LOW_DENSITY")),
        )),
)
