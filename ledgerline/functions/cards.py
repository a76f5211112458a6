"""Card classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import case_map, col

# Card-type rank labels (MT card-transaction report).
DEBIT_LABEL = {"D": "Debit", "DI": "Debit Instant", "A": "ATM"}
CREDIT_LABEL = {"PC": "Credit Platinum", "C": "Credit Gold"}


def member_card_rank(cards, keys: list[str]):
    """Per member, best debit card type (D > DI > A) and best credit card
    type (PC > C) held, from count_if cascades."""
    t = F.upper(F.trim("card_type"))

    def best(codes):
        out = None
        for c in codes:
            cond = F.count_if(t == c) > 0
            out = F.when(cond, c) if out is None else out.when(cond, c)
        return out

    return cards.groupBy(*keys, "member_number").agg(best(["D", "DI", "A"]).alias("debit_type"),
                                                      best(["PC", "C"]).alias("credit_type"))


def specific_card_type(prefix: Column, debit_type: Column, credit_type: Column, tlt: Column) -> Column:
    """C27 (MT): DRWD -> debit label by the member's best debit card, TLT ->
    credit label by best credit card, else Other."""
    return (F.when(prefix == "DRWD", case_map(debit_type, DEBIT_LABEL, "Debit (No Card)"))
            .when(tlt, case_map(credit_type, CREDIT_LABEL, "Credit (Unknown)"))
            .otherwise("Other"))


def unique_card_text(prefix: Column, account_id, member_id, tlt: Column) -> Column:
    """Composed card id text per transaction kind ('DEBIT_<account>_<member>',
    'CREDIT_<account>', 'ACCOUNT_<account>'), null when a part is null."""
    a, m = col(account_id).cast("string"), col(member_id).cast("string")
    return (F.when(prefix == "DRWD", F.concat(F.lit("DEBIT_"), a, F.lit("_"), m))
            .when(tlt, F.concat(F.lit("CREDIT_"), a))
            .otherwise(F.concat(F.lit("ACCOUNT_"), a)))


def unique_card_key(prefix: Column, account_id, member_id, tlt: Column) -> Column:
    """C41 as a compact key with the same identity and null rule as the text
    id: (kind, account, member) where member only counts for debit cards.
    Distinct-counting this struct avoids building a string per transaction."""
    a, m = col(account_id), col(member_id)
    debit = prefix == "DRWD"
    kind = F.when(debit, 0).when(tlt, 1).otherwise(2)
    member = F.when(debit, m.cast("bigint"))
    complete = a.isNotNull() & (~debit | m.isNotNull())
    return F.when(complete, F.struct(kind.alias("k"), a.alias("a"), member.alias("m")))


def general_card_type(tran_code) -> Column:
    """C27 (ST): ATM before DEBIT before CREDIT by tran-code prefix."""
    c = col(tran_code)
    return (F.when(c.startswith("DRWDA") | c.startswith("DRWDAC"), "ATM").when(c.startswith("DRWD"), "DEBIT")
            .when(c.startswith("TLTC"), "CREDIT").otherwise("OTHER"))


def physical_card_columns(as_of, mt: bool) -> dict[str, Column]:
    """Columns of a physical card joined to its card-type row."""
    cc, dc, ac = F.col("credit_card") == "Y", F.col("debit_card") == "Y", F.col("atm_card") == "Y"
    desc = F.col("x_description")
    rej = F.trim(F.col("reject_code").cast("string")) if mt else F.col("reject_code")
    if mt:
        lost = F.trim(F.coalesce(F.col("lost_or_stolen").cast("string"), F.lit(""))) != ""
    else:
        lost = (F.col("lost_or_stolen") != " ") & F.col("lost_or_stolen").isNotNull()
    zero = F.lit(0).cast("decimal(15,2)")
    return {
        "card_id": F.col("record_number").cast("string"),
        "last_4_digits": F.right(F.col("record_number").cast("string"), F.lit(4)),
        "card_type": (F.when(cc, F.concat(desc, F.lit(" Credit Card"))).when(dc, desc).when(ac, desc)
                      .otherwise(F.coalesce(desc, F.lit("Unknown Card")))),
        "card_brand": F.coalesce(F.col("card_issuer"), F.lit("Unknown")),
        "creation_date": F.col("issue_date"),
        "deleted_date": F.col("block_date"),
        "expiration_date": F.col("expire_date"),
        "balance_or_credit_limit": F.when(cc, zero).otherwise(
            F.coalesce(F.col("share_acct_bal"), F.col("draft_acct_bal"), F.lit(0))).cast("decimal(18,2)"),
        "credit_used": F.when(cc, zero).cast("decimal(18,2)"),
        "credit_used_percentage": F.when(cc, zero).cast("decimal(15,2)"),
        "status": (F.when(F.col("block_date").isNotNull(), "Blocked").when(rej.isin("34", "43"), "Fraud Block")
                   .when(rej.isin("36", "41"), "Lost/Stolen Block").when(rej == "07", "Special Handling")
                   .when(F.col("expire_date") < F.lit(as_of), "Expired")
                   .when(F.col("last_pin_used_date").isNotNull(), "Active")
                   .when(F.col("issue_date").isNotNull(), "Issued Not Used").otherwise("Unknown")),
        "delinquency_bracket": F.lit("N/A"),
        "activation_date": F.col("last_pin_used_date"),
        "is_activated": F.when(F.col("last_pin_used_date").isNotNull(), "True").otherwise("False"),
        "fraud_incident": F.when(rej.isin("34", "43"), "True").when(lost, "True").otherwise("False"),
        "last_activity_date": F.col("last_pin_used_date"),
        "card_source": (F.when(cc, "Physical Credit").when(dc, "Physical Debit").when(ac, "Physical ATM")
                        .otherwise("Physical Other")),
    }


def delinquency_bracket_cards(next_payment_date, as_of) -> Column:
    """C22 (card wording): Unknown, Current, 1-30 ... 91-120 Days, 120+ Days."""
    npd = col(next_payment_date)
    d = F.datediff(F.lit(as_of), npd)
    return (F.when(npd.isNull(), "Unknown").when(d <= 0, "Current").when(d.between(1, 30), "1-30 Days")
            .when(d.between(31, 60), "31-60 Days").when(d.between(61, 90), "61-90 Days")
            .when(d.between(91, 120), "91-120 Days").when(d > 120, "120+ Days").otherwise("Current"))


def credit_account_columns(as_of, mt: bool) -> dict[str, Column]:
    """Columns of a credit line (loan account with a credit limit)."""
    st = F.upper(F.trim("status")) if mt else F.col("status")
    npd = F.col("next_payment_date")
    start = F.coalesce(F.col("funded_date"), F.col("date_opened"))
    pct = F.expr("round(current_balance * 100.0 / credit_limit, 2)")
    return {
        "card_id": F.col("account_id").cast("string"),
        "last_4_digits": F.lit("****"),
        "card_type": F.lit("Credit Account"),
        "card_brand": F.lit("Unknown"),
        "creation_date": start,
        "deleted_date": F.col("date_closed"),
        "expiration_date": F.col("credit_expiration"),
        "balance_or_credit_limit": F.col("credit_limit").cast("decimal(18,2)"),
        "credit_used": F.col("current_balance").cast("decimal(18,2)"),
        "credit_used_percentage": F.when(F.col("credit_limit") > 0, pct).otherwise(F.lit(0)).cast("decimal(15,2)"),
        "status": (F.when(F.col("date_closed").isNotNull(), "Closed")
                   .when(F.col("charge_off_date").isNotNull(), "Charged Off")
                   .when(npd.isNotNull() & (F.datediff(F.lit(as_of), npd) > 30), "Delinquent")
                   .when(F.col("current_balance") > F.col("credit_limit"), "Over Limit")
                   .when(st == "ACTIVE", "Active").when(st == "CLOSED", "Closed").when(st == "FROZEN", "Frozen")
                   .otherwise("Active")),
        "delinquency_bracket": delinquency_bracket_cards(npd, as_of),
        "activation_date": start,
        "is_activated": F.when(start.isNotNull(), "True").otherwise("False"),
        "fraud_incident": (F.when(F.col("charge_off_date").isNotNull(), "True").when(st == "FRAUD", "True")
                           .otherwise("False")),
        "last_activity_date": F.col("last_payment_date"),
        "card_source": F.lit("Credit Account"),
    }


def inactivity_flag(last_activity, as_of, days: int = 90) -> Column:
    """C25: 'True' when never active or inactive for more than ``days``."""
    la = col(last_activity)
    return F.when(la.isNull(), "True").when(F.datediff(F.lit(as_of), la) > days, "True").otherwise("False")


def is_debit_source(source: Column) -> Column:
    return source.isin("Physical Debit", "Physical ATM")


def is_credit_source(source: Column) -> Column:
    return source.isin("Physical Credit", "Credit Account")


def portfolio_label(debit: Column, credit: Column) -> Column:
    """Label of a member that has debit and credit cards or not."""
    return F.when(debit & credit, "Both").when(debit, "Debit Only").when(credit, "Credit Only").otherwise("Unknown")


def card_portfolio(cards, keys: list[str]):
    """Both / Debit Only / Credit Only / Unknown per member."""
    src = F.col("card_source")
    return cards.groupBy(*keys, "member_id").agg(
        portfolio_label(F.count_if(is_debit_source(src)) > 0, F.count_if(is_credit_source(src)) > 0)
        .alias("member_card_portfolio"))
