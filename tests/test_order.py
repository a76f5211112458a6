"""ORDER BY of every ordered report: keys, directions and the dialect's place of nulls.

The multi-tenant engine puts nulls last in either direction; the single-tenant
one counts them as smallest (first ascending, last descending).
"""

import functools

import pytest

from ledgerline import registry
from ledgerline.params import FIXTURE_PARAMS
from ledgerline.sources.tables import Tables

RANK = {"SAVINGS": 1, "CHECKING": 2, "CERTIFICATES": 3, "SPECIAL": 4, "OTHER": 5}
TYPE = {"Balance Sheet": "B", "Income Statement": "I"}
# report -> its sort keys: a column, ``-column`` descending, or (column, values in sort order)
ORDER = {
    "gl_accounts_general": ["-Period_Date", ("GL_Category", TYPE), "GL_ID"],
    "gl_accruals_certificates": ["-entry_year", "-entry_month"],
    "gl_accruals_loans": ["-entry_year", "-entry_month"],
    "gl_accounts_transactions": ["-Effective_Date", "-Transaction_ID"],
    "member_profile": ["member_id"],
    "loans_applications": ["-application_date", "-application_id"],
    "loans_general": ["Member_ID", "Loan_ID"],
    "accounts_general": ["member_id", ("main_account_category", RANK), "-created_date"],
}
BY_KEY = {f"{t}_{r}": keys for r, keys in ORDER.items() for t in ("mt", "st")} | {
    "mt_member_transactions": ["credit_union", "member_number"],
    "mt_account_transactions": ["-month_year", "account_category", "account_number"],
    "st_accounts_transactions": ["-month_year", "account_category", "account_number"],
    "mt_cards_transactions": ["-idfi", "period"], "st_cards_transactions": ["-period", "general_card_type"],
    "mt_cards_general": ["credit_union", "member_id", "card_source", "card_type", "-creation_date"],
    "st_cards_general": ["member_id", "card_source", "card_type", "-creation_date"],
    "mt_products_overview": ["credit_union", "idfi", "id_member", "main_category", "category_product", "-product_is_active"],
    "st_products_overview": ["id_member", "main_category", "category_product", "-product_is_active"],
}
BY_KEY.pop("mt_gl_accounts_transactions")


def compare_rows(keys, nulls_last, a, b) -> int:
    for key in keys:
        values = None
        if isinstance(key, tuple):
            key, values = key
        down, name = key.startswith("-"), key.lstrip("-")
        x, y = a[name], b[name]
        if values:
            x, y = values[x], values[y]
        if x == y:
            continue
        if x is None or y is None:
            last = nulls_last or down
            return (1 if x is None else -1) if last else (-1 if x is None else 1)
        return (-1 if x < y else 1) * (-1 if down else 1)
    return 0


@pytest.mark.parametrize("key", sorted(BY_KEY))
def test_rows_come_in_order(spark, sf, key):
    plan, _, v = registry.report(key)
    rows = plan(Tables.from_dir(spark, sf, v.name), FIXTURE_PARAMS, v).collect()
    assert len(rows) > 1
    check = functools.partial(compare_rows, BY_KEY[key], v.mt)
    assert all(check(a, b) <= 0 for a, b in zip(rows, rows[1:]))


def test_every_ordered_report_is_listed(spark, sf):
    for key in registry.queries():
        plan, _, v = registry.report(key)
        text = plan(Tables.from_dir(spark, sf, v.name), FIXTURE_PARAMS, v)._jdf.queryExecution().optimizedPlan().toString()
        # the sort is on top, or below the copies that are made of its rows in place
        top = next(ln for ln in text.split("\n") if not ln.lstrip(" :+-").startswith(("Project", "Generate")))
        assert top.lstrip(" :+-").startswith("Sort [") == (key in BY_KEY), key
