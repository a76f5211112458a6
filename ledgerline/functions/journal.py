"""GL journal classifiers (C32): nature, impact, calendar, source, size, risk.

Ranges are read on the whole GL number as a number (single-tenant reading,
``functions.gl.gl_numeric``); a range test on a non-numeric number is false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import col


def _rng(t: Column, n: Column, kind: str, lo: int, hi: int) -> Column:
    return (t == kind) & n.between(lo, hi)


def nature_masks(t: Column, n: Column) -> tuple[Column, Column]:
    """(debit-nature, credit-nature): assets/expenses vs liabilities/equity/revenue."""
    debit = _rng(t, n, "B", 700, 899) | _rng(t, n, "I", 200, 399)
    credit = _rng(t, n, "B", 900, 999) | _rng(t, n, "I", 110, 199) | _rng(t, n, "I", 400, 499)
    return debit, credit


# Journal subcategories by (type, low, high), first match wins.
JOURNAL_SUBCATEGORY = [
    ("B", 700, 799, "ASSETS - Loans & Investments"), ("B", 800, 899, "ASSETS/LIABILITIES - Clearing & Payables"),
    ("B", 900, 999, "LIABILITIES - Deposits & Equity"), ("I", 110, 199, "INCOME - Interest & Fees"),
    ("I", 200, 299, "EXPENSES - Personnel & Operations"), ("I", 300, 399, "EXPENSES - Operations & Provisions"),
    ("I", 400, 499, "OTHER - Miscellaneous Income/Expense"),
]
# Nature label and description per range, first match wins.
NATURE = [
    ("B", 700, 899, "DEBIT_NATURE", "ASSETS (Increase with Debits, Decrease with Credits)"),
    ("I", 200, 399, "DEBIT_NATURE", "EXPENSES (Increase with Debits, Decrease with Credits)"),
    ("B", 900, 999, "CREDIT_NATURE", "LIABILITIES/EQUITY (Increase with Credits, Decrease with Debits)"),
    ("I", 110, 199, "CREDIT_NATURE", "REVENUE (Increase with Credits, Decrease with Debits)"),
    ("I", 400, 499, "CREDIT_NATURE", "OTHER REVENUE (Increase with Credits, Decrease with Debits)"),
]
# Simplified accounting category per range, first match wins.
ACCOUNTING_CATEGORY = [("B", 700, 899, "ASSETS"), ("B", 900, 999, "LIABILITIES_EQUITY"), ("I", 110, 199, "REVENUE"),
                       ("I", 200, 399, "EXPENSES"), ("I", 400, 499, "OTHER_INCOME")]
# Transaction source codes.
SOURCE_DESCRIPTION = {"CU": "Credit Union System (EOD Processing)", "JE": "Journal Entry (Manual/System)",
                      "CT": "Certificate/Time Deposit", "AP": "Accounts Payable", "FA": "Fixed Assets/Depreciation"}
# Description keywords (upper case, LIKE '%k%') -> transaction nature, first match wins.
NATURE_KEYWORDS = [
    (("DIVIDEND", "DIV-"), "Dividend Transaction"), (("INTEREST", "INT-"), "Interest Transaction"),
    (("FEE", "CHARGE"), "Fee Transaction"), (("SUMMARY",), "Summary/Aggregated Transaction"),
    (("ACCRUAL", "ACCR"), "Accrual Transaction"), (("REVERSAL", "REV"), "Reversal Transaction"),
    (("CORRECTION", "CORR"), "Correction Transaction"), (("ADJUSTMENT", "ADJ"), "Adjustment Transaction"),
]
# Absolute-amount size brackets (exclusive upper bound).
SIZE_BRACKETS = [(100, "Small (< $100)"), (1000, "Medium ($100 - $1K)"), (10000, "Large ($1K - $10K)"),
                 (100000, "Very Large ($10K - $100K)")]


def _first(rows, t, n, pick) -> Column:
    out = None
    for r in rows:
        cond = _rng(t, n, r[0], r[1], r[2])
        out = F.when(cond, pick(r)) if out is None else out.when(cond, pick(r))
    return out


def journal_subcategory(t: Column, n: Column) -> Column:
    return _first(JOURNAL_SUBCATEGORY, t, n, lambda r: r[3]).otherwise("OTHER")


def account_nature(t: Column, n: Column) -> Column:
    return _first(NATURE, t, n, lambda r: r[3]).otherwise("MIXED_NATURE")


def account_nature_description(t: Column, n: Column) -> Column:
    return _first(NATURE, t, n, lambda r: r[4]).otherwise("MIXED OR UNCLASSIFIED NATURE")


def accounting_category(t: Column, n: Column) -> Column:
    return _first(ACCOUNTING_CATEGORY, t, n, lambda r: r[3]).otherwise("UNCATEGORIZED")


def expected_activity_level(t: Column, n: Column) -> Column:
    high = _rng(t, n, "B", 860, 899) | _rng(t, n, "I", 110, 199)
    return F.when(high, "High Activity Account").otherwise("Standard Activity Account")


def account_impact(t: Column, n: Column, amount: Column) -> dict[str, Column]:
    """Impact and its description: debits raise debit-nature accounts, credits
    raise credit-nature accounts (GL convention: positive amount = debit)."""
    debit, credit = nature_masks(t, n)
    pos, neg = amount > 0, amount < 0
    dn = F.when(t == "B", "ASSET").otherwise("EXPENSE")
    cn = F.when(t == "B", "LIABILITY/EQUITY").otherwise("REVENUE")
    impact = (F.when(debit, F.when(pos, "INCREASE").when(neg, "DECREASE").otherwise("NO_CHANGE"))
              .when(credit, F.when(pos, "DECREASE").when(neg, "INCREASE").otherwise("NO_CHANGE"))
              .otherwise("UNKNOWN_IMPACT"))
    desc = (F.when(debit, F.when(pos, F.concat(F.lit("INCREASES "), dn, F.lit(" (Normal Debit)")))
                   .when(neg, F.concat(F.lit("DECREASES "), dn, F.lit(" (Contra Credit)"))).otherwise("NO CHANGE"))
            .when(credit, F.when(pos, F.concat(F.lit("DECREASES "), cn, F.lit(" (Contra Debit)")))
                  .when(neg, F.concat(F.lit("INCREASES "), cn, F.lit(" (Normal Credit)"))).otherwise("NO CHANGE"))
            .otherwise("IMPACT NOT DETERMINED"))
    normal = ((_rng(t, n, "B", 700, 899) & pos) | (_rng(t, n, "I", 200, 399) & pos) | (_rng(t, n, "B", 900, 999) & neg)
              | (_rng(t, n, "I", 110, 199) & neg) | (_rng(t, n, "I", 400, 499) & neg))
    contra = ((_rng(t, n, "B", 700, 899) & neg) | (_rng(t, n, "I", 200, 399) & neg) | (_rng(t, n, "B", 900, 999) & pos)
              | (_rng(t, n, "I", 110, 199) & pos) | (_rng(t, n, "I", 400, 499) & pos))
    pattern = F.when(normal, "NORMAL_PATTERN").when(contra, "CONTRA_PATTERN").otherwise("UNDEFINED_PATTERN")
    return {"Account_Impact": impact, "Account_Impact_Description": desc, "Transaction_Pattern": pattern}


def calendar_columns(d: Column) -> dict[str, Column]:
    """C32 calendar group (Monday = 1, ISO week, full month and day names)."""
    wd = F.weekday(d)  # Monday = 0
    day = F.dayofmonth(d)
    return {
        "YearMonth": F.date_format(d, "yyyy-MM"), "TransactionYear": F.year(d), "TransactionMonth": F.month(d),
        "MonthName": F.date_format(d, "MMMM"), "TransactionQuarter": F.quarter(d), "DayOfMonth": day,
        "DayOfWeek": F.date_format(d, "EEEE"), "DayOfWeekNumber": wd + 1, "ISOWeek": F.weekofyear(d),
        "DayOfYear": F.dayofyear(d),
        "BusinessDayType": F.when(wd.isin(5, 6), "Weekend").otherwise("Weekday"),
        "WeekOfMonth": (F.when(day <= 7, "First Week").when(day <= 14, "Second Week")
                        .when(day <= 21, "Third Week").otherwise("Fourth Week+")),
    }


def source_description(source, stored=None) -> Column:
    """``source`` is compared, ``stored`` (default: the same) printed where no code matches."""
    return _case_or(col(source), SOURCE_DESCRIPTION, F.concat(F.lit("Other: "), col(source if stored is None else stored)))


def _case_or(c: Column, mapping: dict, default: Column) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(default)


def entry_type_description(entry_desc, stored=None) -> Column:
    """``entry_desc`` in upper case is compared, ``stored`` (default: the same) is printed."""
    e, text = col(entry_desc), col(entry_desc if stored is None else stored)
    return (F.when(e == "EOD", "End of Day Processing")
            .when(e.like("%-%"), F.concat(F.lit("Manual Entry - User "), F.substr(text, F.lit(1), F.lit(2))))
            .when(e == "CERT ACCRUAL", "Certificate Interest Accrual").when(e == "INVOICE", "Invoice Payment/Processing")
            .when(e == "DEPRECIATION", "Asset Depreciation").when(e.like("ME LOAN%"), "Member Loan Accrual")
            .otherwise(text))


def transaction_nature(description) -> Column:
    u = F.upper(col(description))
    out = None
    for words, label in NATURE_KEYWORDS:
        cond = None
        for w in words:
            c = u.contains(w)
            cond = c if cond is None else cond | c
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("Regular Transaction")


def processing_type(source, entry_desc) -> Column:
    s, e = col(source), col(entry_desc)
    return (F.when((s == "CU") & (e == "EOD"), "Automated EOD").when((s == "JE") & e.like("%-%"), "Manual Entry")
            .when(s.isin("CT", "AP", "FA"), "System Generated").otherwise("Other Processing"))


def size_category(abs_amount: Column) -> Column:
    out = F.when(abs_amount == 0, "Zero Amount")
    for lim, lab in SIZE_BRACKETS:
        out = out.when(abs_amount < lim, lab)
    return out.otherwise("Exceptional ($100K+)")


def volume_indicator(abs_amount: Column) -> Column:
    return (F.when(abs_amount > 500000, "Exceptional Volume").when(abs_amount > 100000, "Very High Volume")
            .when(abs_amount > 10000, "High Volume").otherwise("Standard Volume"))


def risk_level(t: Column, n: Column, amount: Column, source: Column, entry_desc: Column,
               description: Column) -> Column:
    a = F.abs(amount)
    contra_bs = (_rng(t, n, "B", 700, 899) & (amount < 0)) | (_rng(t, n, "B", 900, 999) & (amount > 0))
    u = F.upper(description)
    return (F.when(amount == 0, "ZERO_RISK").when((a > 100000) & contra_bs, "HIGH_RISK_LARGE_CONTRA")
            .when((source == "JE") & entry_desc.like("%-%") & (a > 10000), "MEDIUM_RISK_MANUAL_LARGE")
            .when(u.contains("REVERSAL") | u.contains("CORRECTION"), "MEDIUM_RISK_ADJUSTMENT")
            .otherwise("LOW_RISK"))


def branch_patterns(branch_number: Column, amount: Column, source: Column) -> dict[str, Column]:
    a, b = F.abs(amount), branch_number
    pattern = (F.when((b == "0") & (a > 1000000), "HQ_LARGE_TRANSACTION")
               .when((b != "0") & (a > 100000), "BRANCH_LARGE_TRANSACTION")
               .when((b == "6") & (a > 1000), "REMOTE_UNUSUAL_AMOUNT").otherwise("NORMAL_BRANCH_TRANSACTION"))
    kind = (F.when((source == "JE") & (b != "0"), "BRANCH_MANUAL_ENTRY")
            .when((source == "CU") & (b == "0"), "HQ_SYSTEM_TRANSACTION")
            .when((source == "CU") & (b != "0"), "BRANCH_SYSTEM_TRANSACTION").otherwise("OTHER_BRANCH_TRANSACTION"))
    return {"Branch_Transaction_Pattern": pattern, "Branch_Transaction_Type": kind}
