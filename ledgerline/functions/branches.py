"""Branch and institution labels (C35 and the branch group of C32).

The single-tenant reports label the branches of one institution.  Names and
labels are the institution's own and come with ``Params.institution``; the
defaults here are what the reports print for anything unknown.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import case_map, col
from ledgerline.params import Institution

# Labels of a branch that the institution's table does not list.
OTHER_BRANCH = "OTHER_BRANCH"
JOURNAL_BRANCH_DEFAULTS = ("OTHER_BRANCH", "UNKNOWN_ACTIVITY", "Unknown Specialization", "UNKNOWN_DENSITY")
JOURNAL_BRANCH_COLUMNS = ("Branch_Category", "Branch_Activity_Level", "Branch_Specialization", "Branch_Member_Density")


def _named(n: Column, own: Column, inst: Institution) -> Column:
    return F.when(own, inst.short_name).when(n.isNull(), "Unknown Branch").otherwise(F.trim(n))


def branch_name(name, inst: Institution) -> Column:
    """Short label for the institution's own entity, 'Unknown Branch' when
    missing, else the trimmed name."""
    n = col(name)
    return _named(n, n.contains(inst.name), inst)


def journal_branch_name(name, inst: Institution) -> Column:
    """Head-office entity -> short label, missing -> 'Unknown Branch', else trimmed."""
    n = col(name)
    return _named(n, n == inst.head_office, inst)


def branch_category(number, inst: Institution) -> Column:
    """Branch number -> category label, else OTHER_BRANCH."""
    labels = {b.number: b.category for b in inst.branches}
    return case_map(col(number), labels, OTHER_BRANCH) if labels else F.lit(OTHER_BRANCH)


def journal_branch_labels(number, inst: Institution) -> dict[str, Column]:
    """The four branch label columns of the journal report."""
    out = {}
    for i, (name, default) in enumerate(zip(JOURNAL_BRANCH_COLUMNS, JOURNAL_BRANCH_DEFAULTS)):
        labels = {b.number: b.journal[i] for b in inst.branches}
        out[name] = case_map(col(number), labels, default) if labels else F.lit(default)
    return out
