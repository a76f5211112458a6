"""Loan classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import col


def text_true(x) -> Column:
    """MT: COALESCE(TRY_CAST(x AS boolean), false) with the strict accepted
    spellings 'true'/'t'/'1' (any case)."""
    return F.coalesce(F.lower(col(x)).isin("true", "t", "1"), F.lit(False))


def flag_set(x, mt: bool) -> Column:
    """A loan-status flag is set: boolean text (MT) or numeric 1 (ST)."""
    return text_true(x) if mt else F.coalesce(col(x) == "1", F.lit(False))


def application_status_category(mt: bool) -> Column:
    """APPROVED, DENIED, WITHDRAWN, INCOMPLETE, else PENDING."""
    return (F.when(flag_set("approved_flag", mt), "APPROVED").when(flag_set("adverse_action_flag", mt), "DENIED")
            .when(flag_set("withdrawn_flag", mt), "WITHDRAWN").when(flag_set("incomplete_flag", mt), "INCOMPLETE")
            .otherwise("PENDING"))


def application_status_reason(mt: bool) -> Column:
    """Denial reasons joined with '; ', else other text, else status wording."""
    desc = F.upper(F.trim("status_description")) if mt else F.col("status_description")
    reasons = F.concat_ws("; ", F.col("denial_reason1"), F.nullif(F.col("denial_reason2"), F.lit("")),
                          F.nullif(F.col("denial_reason3"), F.lit("")))
    return (F.when(F.col("denial_reason1").isNotNull(), reasons)
            .when(F.col("loan_app_denial_other").isNotNull(), F.col("loan_app_denial_other"))
            .when(flag_set("approved_flag", mt), "APPROVED")
            .when(desc == "PENDING", "UNDER REVIEW")
            .when(desc == "WITHDRAW", "MEMBER WITHDREW")
            .otherwise("NO REASON SPECIFIED"))


# User ids of the online channel.
ONLINE_USER_IDS = ["102", "103", "104", "105", "106", "107", "108", "109"]


def application_channel(userid, mt: bool) -> Column:
    """ONLINE / SYSTEM/AUTOMATED / IN-BRANCH (1-2 digit ids) / STAFF_ASSISTED / UNKNOWN."""
    raw = col(userid)
    u = F.trim(raw) if mt else raw
    return (F.when(u.isin(*ONLINE_USER_IDS), "ONLINE").when(u == "SYS", "SYSTEM/AUTOMATED")
            .when(u.rlike(r"^[0-9]{1,2}$"), "IN-BRANCH").when(raw.isNotNull(), "STAFF_ASSISTED")
            .otherwise("UNKNOWN"))


# Credit-bureau loan type code -> main category.
BUREAU_CATEGORY = {"00": "Auto Loans", "01": "Unsecured/Personal Loans", "02": "Share/CD Secured Loans",
                   "03": "Signature Secured Loans", "11": "Recreational Vehicle Loans", "15": "Overdraft Protection",
                   "18": "Credit Card", "26": "Real Estate/Mortgage Loans", "89": "Home Equity Loans"}


def bureau_category(code) -> Column:
    """Credit-bureau code -> loan main category, else Unclassified."""
    from ledgerline.functions.common import case_map
    return case_map(code, BUREAU_CATEGORY, "Unclassified")


def days_open(as_of) -> Column:
    """Days from opening to closing (or as_of when open)."""
    return F.datediff(F.coalesce(F.col("date_closed"), F.lit(as_of)), F.col("date_opened"))


def paid_installments(as_of) -> Column:
    """All installments when closed; else elapsed periods clamped to [0, n]."""
    n, ppy = F.col("number_of_payments"), F.col("payments_per_year")
    d = days_open(as_of)
    elapsed = F.when(ppy > 0, F.floor(d * ppy / F.lit(365.0))).otherwise(F.floor(d / F.lit(30.0)))
    return (F.when(F.col("date_closed").isNotNull(), n)
            .when(n.isNotNull() & (n > 0) & F.col("date_opened").isNotNull(),
                  F.greatest(F.lit(0), F.least(n, elapsed)))).cast("int")


def loan_status(as_of) -> Column:
    """CHARGED_OFF, DELINQUENT, PAID_OFF, CLOSED, else ACTIVE (first match)."""
    closed, bal, npd = F.col("date_closed"), F.col("current_balance"), F.col("next_payment_date")
    return (F.when(F.col("charge_off_date").isNotNull(), "CHARGED_OFF")
            .when(closed.isNull() & (bal > 0) & npd.isNotNull() & (npd < F.lit(as_of)), "DELINQUENT")
            .when((bal == 0) & closed.isNotNull() & F.col("charge_off_date").isNull() & (F.col("credit_limit") == 0)
                  & (F.col("credit_expiration") < F.lit(as_of)), "PAID_OFF")
            .when(closed.isNotNull(), "CLOSED").otherwise("ACTIVE"))


def days_past_due(next_payment_date, as_of) -> Column:
    """Days since a missed next payment, else 0."""
    npd = col(next_payment_date)
    return F.when(npd.isNotNull() & (npd < F.lit(as_of)), F.datediff(F.lit(as_of), npd)).otherwise(0)


def delinquency_bracket_loans(next_payment_date, as_of) -> Column:
    """C22 (loan wording): CURRENT, 1-30 ... 91-120 days, Over 120 days."""
    npd = col(next_payment_date)
    d = F.datediff(F.lit(as_of), npd)
    return (F.when(npd.isNull() | (npd >= F.lit(as_of)), "CURRENT").when(d.between(1, 30), "1-30 days")
            .when(d.between(31, 60), "31-60 days").when(d.between(61, 90), "61-90 days")
            .when(d.between(91, 120), "91-120 days").when(d > 120, "Over 120 days").otherwise("CURRENT"))


def zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def interest_columns(as_of) -> dict[str, Column]:
    """Earned interest, fees, revenue, yield, monthly rate, expected simple
    interest and performance ratio.  Ratios are doubles."""
    ytd, lytd, fy, fl = (zero(c) for c in ("interest_ytd", "interest_lytd", "late_fees_ytd", "late_fees_lytd"))
    ob, rate = F.col("opening_balance").cast("double"), F.col("interest_rate").cast("double")
    days = days_open(as_of)
    earned = (ytd + lytd)
    ok = F.col("date_opened").isNotNull() & (F.col("opening_balance") > 0) & (F.col("interest_rate") > 0)
    expected = ob * (rate / 100) * days / F.lit(365.0)
    expected_p = ob * (rate / 100) * (days / F.lit(365.0))
    return {
        "Total_Interest_Earned": earned.cast("decimal(38,2)"),
        "Total_Late_Fees_Earned": (fy + fl).cast("decimal(38,2)"),
        "Total_Revenue_Earned": (ytd + lytd + fy + fl).cast("decimal(38,2)"),
        "Interest_Yield_Percentage": F.when(F.col("opening_balance") > 0,
                                            F.round(earned.cast("double") / ob * 100, 3)).otherwise(F.lit(0.0)),
        "Monthly_Interest_Rate": F.round(rate / 12, 6),
        "Expected_Interest_Simple": F.when(ok, F.round(expected, 2)).otherwise(F.lit(0.0)),
        "Interest_Performance_Ratio": F.when(ok, F.round(earned.cast("double") / F.nullif(expected_p, F.lit(0.0))
                                                         * 100, 2)),
    }
