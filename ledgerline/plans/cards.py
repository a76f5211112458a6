"""Card reports: card transactions (R23/R24) and cards general."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import cards as C
from ledgerline.functions.common import from_cents, to_cents
from ledgerline.operators.kpis import round_avg
from ledgerline.operators.skew import with_own_figures
from ledgerline.operators.tenant import tenant_enrich
from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def cards_transactions(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Card usage per month and card product.

    MT: DRWD*/TLT* transactions since ``cards_start``; the product comes from
    the best card type the account's member holds.  Accounts are joined to the
    per-member card ranks first (one row per account), then transactions join
    that on account_id, so no transaction-sized result is shuffled twice.
    The 4-character prefix is compared with 'TLT' (defect D3, literal unless
    ``fix`` has "D3").  ST: DRWD*/TLTC* by tran-code prefix, no join.
    """
    tx = t["transaction_history"].filter(F.col("date_actual") >= F.lit(p.cards_start))
    period = F.date_format("date_actual", "yyyy-MM").alias("period")
    amt = F.abs(to_cents("total_amount"))
    if not v.mt:
        code = F.col("tran_code")
        base = tx.filter(code.startswith("DRWD") | code.startswith("TLTC")).select(
            period, C.general_card_type(code).alias("general_card_type"), "member_id", "account_id",
            "transaction_history_id", amt.alias("amt"))
        df = base.groupBy("period", "general_card_type").agg(
            F.count_distinct("member_id").alias("unique_members"),
            F.count_distinct("account_id").alias("unique_accounts"),
            F.count(F.lit(1)).alias("total_transactions"),
            round_avg(F.sum("amt"), F.count("amt"), in_cents=True).alias("avg_transaction_amount"),
            from_cents(F.sum("amt")).alias("total_transaction_volume"))
        if p.ordered:
            df = df.orderBy(*v.order("-period", "general_card_type"))
        return df

    k = v.keys
    code = F.upper(F.trim("tran_code"))
    prefix = F.substr(code, F.lit(1), F.lit(4))
    f = tx.filter(code.startswith("DRWD") | code.startswith("TLT")).select(
        *k, "transaction_history_id", "account_id", "member_id", "total_amount", "date_actual",
        prefix.alias("tran_prefix"))
    ranks = C.member_card_rank(t["eft_card_file"], k)
    acct = (t["account"].select(*k, "account_id", "member_number")
            .join(ranks, k + ["member_number"], "left").drop("member_number"))
    j = f.join(acct, k + ["account_id"], "inner")
    pre = F.col("tran_prefix")
    tlt = pre.startswith("TLT") if p.fixed("D3") else (pre == "TLT")
    j = j.select("credit_union", period,
                 C.specific_card_type(pre, F.col("debit_type"), F.col("credit_type"), tlt).alias(
                     "specific_card_type"),
                 "member_id", C.unique_card_key(pre, "account_id", "member_id", tlt).alias("_card"),
                 "transaction_history_id", amt.alias("amt"))
    # The tenant map has one row per tenant: it joins the finished groups, not the transactions.
    df = j.groupBy("credit_union", "period", "specific_card_type").agg(
        F.count_distinct("member_id").alias("unique_members"),
        F.count_distinct("_card").alias("unique_cards"),
        F.count_distinct("transaction_history_id").alias("total_transactions"),
        round_avg(F.sum("amt"), F.count("amt"), in_cents=True).alias("avg_transaction_amount"),
        from_cents(F.sum("amt")).alias("total_transaction_volume"))
    df = tenant_enrich(df, t["fi_map"], exact=True)
    df = df.select("credit_union", "idfi", *[c for c in df.columns if c not in ("credit_union", "idfi")])
    if p.ordered:
        df = df.orderBy(*v.order("-idfi", "period"))
    return df


CARD_COLUMNS = ["card_id", "last_4_digits", "card_type", "card_brand", "creation_date", "deleted_date",
                "expiration_date", "balance_or_credit_limit", "credit_used", "credit_used_percentage", "status",
                "delinquency_bracket", "activation_date", "is_activated", "fraud_incident", "last_activity_date",
                "card_source"]


def unified_cards(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Physical cards of active card types and credit lines in one schema."""
    k = v.keys
    x = t["pd_xmaif"].select("card_type", F.col("description").alias("x_description"), "credit_card", "debit_card",
                             "atm_card", "card_issuer", "inactive_flag")
    # LEFT JOIN + WHERE x.inactive_flag = 0 in the text is an inner join.
    phys = t["eft_card_file"].join(x.filter(F.col("inactive_flag") == 0), ["card_type"], "inner")
    pc = C.physical_card_columns(p.as_of, v.mt)
    phys = phys.select(*k, F.col("member_number").alias("member_id"), *[pc[c].alias(c) for c in CARD_COLUMNS])
    acct = (t["account"].filter((F.col("member_number") > 0) & (v.norm("discriminator") == "L"))
            .select(*k, "account_id", "member_number", "date_opened", "date_closed", "charge_off_date",
                    "current_balance", "status"))
    al = t["account_loan"].filter(F.col("credit_limit") > 0)
    ca = C.credit_account_columns(p.as_of, v.mt)
    credit = (al.join(acct, k + ["account_id"], "inner")
              .select(*k, F.col("member_number").alias("member_id"), *[ca[c].alias(c) for c in CARD_COLUMNS]))
    return phys.unionByName(credit)


def cards_general(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Physical cards and credit lines with status, delinquency,
    activation, inactivity, fraud and the member's card portfolio.

    The union is built and shuffled once: the portfolio is summed from that
    exchange and joined back to it (``with_own_figures``).
    """
    k = v.keys
    uc = unified_cards(t, p, v)
    packed = uc.select(*k, "member_id", "card_id", F.array(F.struct(*CARD_COLUMNS)).alias("_rows"))
    kinds = {"_debit": C.is_debit_source, "_credit": C.is_credit_source}
    figures = {n: F.size(F.filter("_rows", lambda r: has(r["card_source"]))) for n, has in kinds.items()}
    j = with_own_figures(packed, ["member_id", *k], [F.col("card_id")], figures,
                         lambda sums: sums.select(*k, "member_id", "_parts", C.portfolio_label(F.col("_debit") > 0, F.col("_credit") > 0)
                                                  .alias("member_card_portfolio")))
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=True)
    cols = [c for c in CARD_COLUMNS if c not in ("fraud_incident", "last_activity_date", "card_source")]
    df = j.select(*(["credit_union", "idfi"] if v.mt else []), "member_id", *cols,
                  C.inactivity_flag("last_activity_date", p.as_of).alias("inactivity_flag"),
                  "fraud_incident", "card_source", "member_card_portfolio")
    if p.ordered:
        df = df.orderBy(*v.order(*k, "member_id", "card_source", "card_type", "-creation_date"))
    return df
