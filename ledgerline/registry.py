"""Registry of report keys: Spark plan + DuckDB oracle per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.oracle import blocks as o_blocks
from ledgerline.oracle import cards as o_cards
from ledgerline.oracle import gl as o_gl
from ledgerline.oracle import loans as o_loans
from ledgerline.oracle import members as o_members
from ledgerline.oracle import products as o_products
from ledgerline.oracle.base import Q
from ledgerline.params import FIXTURE_PARAMS, Params
from ledgerline.plans import blocks, cards, gl, loans, members, products
from ledgerline.plans.variant import MT, ST, Variant
from ledgerline.sources.tables import Tables

# key -> (plan function taking (Tables, Params, Variant), oracle builder taking Q, tenancy)
_REPORTS: dict[str, tuple[Callable, Callable | None, Variant]] = {}


def _both(mt_key: str, st_key: str, plan: Callable, oracle: Callable | None) -> None:
    _REPORTS[mt_key] = (plan, oracle, MT)
    _REPORTS[st_key] = (plan, oracle, ST)


_both("mt_gl_accounts_general", "st_gl_accounts_general", gl.gl_accounts_general, o_gl.gl_accounts_general)
_both("mt_gl_accruals_certificates", "st_gl_accruals_certificates", gl.gl_accruals_certificates,
      o_gl.gl_accruals_certificates)
_both("mt_gl_accruals_loans", "st_gl_accruals_loans", gl.gl_accruals_loans, o_gl.gl_accruals_loans)
_both("mt_member_key_trends", "st_member_key_trends", members.member_key_trends, o_members.member_key_trends)
_both("mt_member_transactions", "st_member_transactions", members.member_transactions,
      o_members.member_transactions)
_both("mt_member_details", "st_member_details", members.member_details, o_members.member_details)
_both("mt_member_profile", "st_member_profile", members.member_profile, o_members.member_profile)
_both("mt_cards_transactions", "st_cards_transactions", cards.cards_transactions, o_cards.cards_transactions)
_both("mt_loans_applications", "st_loans_applications", loans.loans_applications, o_loans.loans_applications)
_both("mt_loans_general", "st_loans_general", loans.loans_general, o_loans.loans_general)
_both("mt_accounts_general", "st_accounts_general", products.accounts_general, o_products.accounts_general)
_both("mt_cards_general", "st_cards_general", cards.cards_general, o_cards.cards_general)
_REPORTS["st_gl_accounts_transactions"] = (gl.gl_accounts_transactions, o_gl.gl_accounts_transactions, ST)
_REPORTS["st_gl_dividends"] = (gl.gl_dividends, o_gl.gl_dividends, ST)
_both("mt_products_overview", "st_products_overview", products.products_overview,
      o_products.products_overview)
_both("mt_account_transactions", "st_accounts_transactions", products.account_transactions,
      o_products.account_transactions)


# Stand-alone operator keys (multi-tenant), one per reusable dataflow step.
for _name in ("gl_monthly_activity", "cert_accrual_months", "member_account_summary", "member_account_stats",
              "recent_account_activity", "member_card_rank", "card_portfolio", "member_product_counts",
              "member_status_dim"):
    _REPORTS[f"mt_{_name}"] = (getattr(blocks, _name), getattr(o_blocks, _name), MT)


def report(key: str) -> tuple[Callable, Callable | None, Variant]:
    """(plan, oracle builder, variant) of a report key."""
    return _REPORTS[key]


def run(spark: SparkSession, sf_dir: str, key: str, p: Params = FIXTURE_PARAMS) -> DataFrame:
    plan, _, v = _REPORTS[key]
    return plan(Tables.from_dir(spark, sf_dir, v.name), p, v)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, k=k: run(spark, sf_dir, k)) for k in _REPORTS}


def oracle_sql(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    return {k: o(Q(v.name, p)) for k, (_, o, v) in _REPORTS.items() if o is not None}
