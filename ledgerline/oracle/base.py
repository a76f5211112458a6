"""Oracle helpers: prefix a DuckDB report body with the logical-table CTEs."""

from __future__ import annotations

import re

from ledgerline.params import FIXTURE_PARAMS, Params
from ledgerline.sources import fixtures


# Code columns that a single-tenant database compares without case and trailing blanks.
ST_CODES = {
    "account": ("discriminator", "account_type", "access_control", "status"), "account_types": ("account_type", "category"),
    "gl_chart_of_accounts": ("account_type", "controlled"), "gl_history": ("status", "source", "entry_desc"),
    "transaction_history": ("tran_code",), "loan_app_status": ("description",), "eft_card_file": ("card_type", "reject_code"),
    "pd_xmaif": ("card_type", "credit_card", "debit_card", "atm_card"), "member": ("inactive_flag", "member_type"),
    "entity": ("gender",),
}


def _collated(name: str, sql: str) -> str:
    codes = ST_CODES.get(name, ())
    if not codes:
        return sql
    again = ", ".join(f"upper(rtrim({c})) AS {c}" for c in codes)
    stored = ", ".join(f"{c} AS stored_{c}" for c in codes)
    return f"SELECT * REPLACE ({again}), {stored} FROM (\n{sql}\n) s"


def with_tables(body: str, tenancy: str) -> str:
    """``WITH <logical tables the body names> SELECT * FROM (<body>) q``.

    The driver tables are pre-registered DuckDB views, so the logical tables
    are CTEs over them; the body may carry its own WITH clause.
    """
    names = [n for n in fixtures.COLUMNS if re.search(rf"\b{n}\b", body)]
    if tenancy == "st":
        names = [n for n in names if n != "fi_map"]
    build = fixtures.st_sql if tenancy == "st" else fixtures.logical_sql
    bound = {n: build(n, "duckdb") for n in names}
    if tenancy == "st":
        bound = {n: _collated(n, sql) for n, sql in bound.items()}
    ctes = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in bound.items())
    return f"WITH {ctes}\nSELECT * FROM (\n{body}\n) q"


def first_of(rules: list[tuple[str, str]], default: str) -> str:
    """The label of the first (condition, label) that holds."""
    return "coalesce(" + ", ".join(f"CASE WHEN {c} THEN '{lab}' END" for c, lab in rules) + f", '{default}')"


class Q:
    """Text snippets that differ between the MT and ST oracle statements."""

    def __init__(self, tenancy: str, p: Params = FIXTURE_PARAMS, bind: bool = True):
        self.mt = tenancy == "mt"
        self.tenancy = tenancy
        self.p = p
        # bind=False: the logical tables are already registered under their names.
        self.bind = bind

    def k(self, alias: str = "") -> str:
        """Tenant column followed by a comma (MT) or nothing (ST)."""
        a = f"{alias}." if alias else ""
        return f"{a}credit_union, " if self.mt else ""

    def on(self, a: str, b: str) -> str:
        """Extra tenant join condition."""
        return f" AND {a}.credit_union = {b}.credit_union" if self.mt else ""

    def stored(self, alias: str, c: str) -> str:
        """A code column's text as stored."""
        return f"{alias}.{c}" if self.mt else f"{alias}.stored_{c}"

    def norm(self, x: str) -> str:
        return f"upper(trim({x}))" if self.mt else x

    def d(self, value) -> str:
        return f"DATE '{value.isoformat()}'"

    @property
    def as_of(self) -> str:
        return self.d(self.p.as_of)

    def idfi(self, alias: str, key: str, exact: bool) -> str:
        """LEFT JOIN of the tenant map (MT only)."""
        if not self.mt:
            return ""
        if exact:
            return f"LEFT JOIN fi_map fi ON fi.tenant_code = {alias}.{key}"
        return f"LEFT JOIN fi_map fi ON lower(trim(fi.tenant_code)) = lower(trim({alias}.{key}))"

    def head(self, alias: str) -> str:
        """Leading output columns credit_union, idfi (MT only)."""
        return f"{alias}.credit_union, fi.idfi, " if self.mt else ""

    def wrap(self, body: str) -> str:
        return with_tables(body, self.tenancy) if self.bind else body
