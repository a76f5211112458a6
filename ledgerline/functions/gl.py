"""General-ledger classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import col

# Balance-sheet subcategories by GL number range and balance sign,
# first match wins (the 740-750 and 770-780 ranges are shadowed by 701-799).
GL_SUBCATEGORY_B = [
    (701, 799, ">", "ASSETS - Loans to Members"),
    (740, 750, ">", "ASSETS - Investments"),
    (770, 780, ">", "ASSETS - Property & Equipment"),
    (700, 799, "<", "CONTRA-ASSETS - Allowances/Provisions"),
    (800, 899, "<", "LIABILITIES - Accounts Payable"),
    (900, 989, "<", "LIABILITIES - Member Deposits"),
    (990, 999, "<", "EQUITY - Capital & Reserves"),
]
# Income-statement subcategories by GL number range.
GL_SUBCATEGORY_I = [
    (110, 199, "INCOME - Interest & Fees"),
    (200, 299, "EXPENSES - Personnel"),
    (300, 399, "EXPENSES - Operations"),
    (400, 499, "OTHER - Income/Expense"),
]


def gl_int_part(account_number) -> Column:
    """MT reading of a GL number: integer before the first dot (try_cast)."""
    return F.split_part(col(account_number), F.lit("."), F.lit(1)).try_cast("int")


def gl_numeric(account_number) -> Column:
    """ST reading of a GL number: the whole text as a number (799.5 is not <= 799)."""
    return col(account_number).try_cast("double")


def gl_category(account_type) -> Column:
    """C12."""
    t = col(account_type)
    return F.when(t == "B", "Balance Sheet").when(t == "I", "Income Statement").otherwise("Other")


def gl_subcategory(account_type, number: Column, balance) -> Column:
    """C13 (balance-signed form)."""
    t, b = col(account_type), col(balance)
    out = None
    for lo, hi, sign, label in GL_SUBCATEGORY_B:
        cond = (t == "B") & number.between(lo, hi) & ((b > 0) if sign == ">" else (b < 0))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    for lo, hi, label in GL_SUBCATEGORY_I:
        out = out.when((t == "I") & number.between(lo, hi), label)
    return out.otherwise("OTHER")


def asset_liability_type(account_type, coa_balance) -> Column:
    """C14."""
    t, b = col(account_type), col(coa_balance)
    return (F.when((t == "B") & (b > 0), "ASSET").when((t == "B") & (b < 0), "LIABILITY/EQUITY")
            .when((t == "B") & (b == 0), "ZERO BALANCE").when(t == "I", "INCOME/EXPENSE").otherwise("OTHER"))


def gl_activity_level(n) -> Column:
    """Monthly line count -> activity label."""
    n = col(n)
    return (F.when(F.coalesce(n, F.lit(0)) == 0, "No Activity").when(n <= 10, "Low Activity")
            .when(n <= 50, "Medium Activity").when(n <= 200, "High Activity").otherwise("Very High Activity"))


def yes_no(cond: Column) -> Column:
    return F.when(cond, "Yes").otherwise("No")


def gl_account_canon(x) -> Column:
    """Trim, strip leading zeros (an all-zero text becomes ''), null -> '0'."""
    return F.coalesce(F.regexp_replace(F.trim(col(x)), r"^0+", ""), F.lit("0"))


def period_columns(month: Column, prefix: str = "entry_") -> list[Column]:
    """Year, month, quarter (int) and 'yyyy-MM' of a month-start date."""
    return [F.year(month).alias(f"{prefix}year"), F.month(month).alias(f"{prefix}month"),
            F.quarter(month).alias(f"{prefix}quarter"), F.date_format(month, "yyyy-MM").alias("yearMonth")]


def accrual_alert(paid: Column, accrued: Column, variance: Column, paid_scale: Column) -> Column:
    """PAID_WITHOUT_ACCRUAL, ACCRUED_NOT_PAID, SIGNIFICANT_VARIANCE (over 5 % of
    ``paid_scale``), else NORMAL, first match wins."""
    return (F.when((paid > 0) & (accrued == 0), "PAID_WITHOUT_ACCRUAL")
            .when((paid == 0) & (accrued > 0), "ACCRUED_NOT_PAID")
            .when(F.abs(variance) > paid_scale * F.lit(0.05), "SIGNIFICANT_VARIANCE")
            .otherwise("NORMAL"))


def accrual_ratio_pct(paid: Column, accrued: Column) -> Column:
    """Paid / accrued x 100, 2 decimals, only when accrued > 0 (double)."""
    return F.when(accrued > 0, F.round(paid.cast("double") / accrued.cast("double") * 100, 2))


# Dividend tran codes -> transaction type.
DIVIDEND_TYPE = {"SHDV": "SHARE_DIVIDEND_TO_MEMBER", "CTDV": "CERTIFICATE_DIVIDEND"}


def dividend_type(code, stored=None) -> Column:
    """C33; ``stored`` (default: ``code``) is printed where no code matches."""
    c = col(code)
    out = None
    for k, v in DIVIDEND_TYPE.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(F.concat(F.lit("OTHER_DIVIDEND_"), col(code if stored is None else stored)))


# Fixed values: (discriminator, account type) -> deposit product name (dividend report).
DIVIDEND_PRODUCT_TYPE = [
    ("S", "PSAV", "Primary Savings"), ("S", "HYS", "High Yield Savings"), ("S", "MMA", "Money Market"),
    ("S", "SSAV", "Secondary Savings"), ("S", "CLUB", "Club Account"), ("S", "TISV", "Traditional IRA Savings"),
    ("S", "RISV", "Roth IRA Savings"), ("S", "YSAV", "Youth Savings"), ("S", "SPIS", "SEP IRA Savings"),
    ("C", "CERT", "Certificate of Deposit"), ("C", "TICD", "Traditional IRA Certificate"),
    ("C", "RICD", "Roth IRA Certificate"), ("C", "EICD", "Education IRA Certificate"),
    ("D", "CHK", "Checking Account"), ("D", "OTCK", "Overtime Checking"),
]


def dividend_product_type(disc, atype, stored_disc=None, stored_type=None) -> Column:
    """Product name by discriminator and type, else 'disc - type' as stored."""
    d, t = col(disc), col(atype)
    out = None
    for dd, tt, label in DIVIDEND_PRODUCT_TYPE:
        cond = (d == dd) & (t == tt)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.concat(col(disc if stored_disc is None else stored_disc), F.lit(" - "),
                                  col(atype if stored_type is None else stored_type)))


# GL number prefix -> GL account category, first match wins.
GL_PREFIX_CATEGORY = [("380.", "DIVIDEND_EXPENSE"), ("901.", "MEMBER_DEPOSIT_ACCOUNT"),
                      ("903.", "CERTIFICATE_ACCOUNT"), ("383.", "OTHER_DIVIDEND_EXPENSE"), ("151.", "CASH_ACCOUNT")]


def gl_prefix_category(number) -> Column:
    """C34."""
    n = col(number)
    out = None
    for pre, label in GL_PREFIX_CATEGORY:
        out = F.when(n.startswith(pre), label) if out is None else out.when(n.startswith(pre), label)
    return out.otherwise("OTHER_GL_ACCOUNT")


def business_category(code, disc) -> Column:
    """C33."""
    c, d = col(code), col(disc)
    return (F.when((c == "SHDV") & (d == "S"), "SAVINGS_DIVIDEND_PAYMENT")
            .when(c == "CTDV", "CERTIFICATE_DIVIDEND_PAYMENT").otherwise("OTHER_DIVIDEND_TRANSACTION"))


def estimated_rate(code, amount, balance, factor: int) -> Column:
    """|amount| / balance x factor, 4 decimals (exact decimal arithmetic),
    for share dividends paid out of a balance over 100."""
    c, a, b = col(code), col(amount), col(balance)
    rate = F.round(F.abs(a) / b * F.lit(factor), 4).cast("decimal(38,4)")
    return F.when((c == "SHDV") & (b > 100) & (a < 0), rate)
