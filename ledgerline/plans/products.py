"""Account and product reports: account transactions (R17/R18), accounts general (R19/R20), products overview."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.accounts import account_category
from ledgerline.functions.common import MONEY_SUM, year_range
from ledgerline.operators.activity import rollback_balance, signed_distinct_activity
from ledgerline.operators.skew import repeated, salted_left_join, with_own_figures
from ledgerline.operators.tenant import tenant_enrich
from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def account_transactions(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Monthly movement of the current year per deposit account, with
    the balance rolled back to each month's start."""
    k = v.keys
    tx = (t["transaction_history"]
          .filter((F.col("void_flag") == 0) & year_range("date_effective", p.as_of.year))
          .select(*k, "account_id", "transaction_history_id", "total_amount",
                  F.trunc("date_effective", "month").alias("month_start")))
    monthly = signed_distinct_activity(tx, k + ["account_id", "month_start"], "transaction_history_id", "total_amount")
    monthly = rollback_balance(monthly, k + ["account_id"], "month_start", "net_change_for_month")

    acct = (t["account"]
            .filter((F.col("member_number") > 0) & v.norm("discriminator").isin("S", "D", "C", "U"))
            .select(*k, "account_id", "account_number", "member_number", v.stored("account_type").alias("account_type"),
                    "current_balance", account_category(v.norm("discriminator")).alias("account_category")))
    df = monthly.join(acct, k + ["account_id"], "inner")
    if v.mt:
        df = tenant_enrich(df, t["fi_map"], exact=True)
    df = df.select(
        *(["credit_union", "idfi"] if v.mt else []),
        F.date_format("month_start", "yyyy-MM").alias("month_year"),
        "account_number", "member_number", "account_category", "account_type", "current_balance",
        "Transactions", "Deposits", "Withdrawals", "total_credits", "total_debits", "net_change_for_month",
        F.round(F.col("current_balance") - F.coalesce("net_change_from_this_month_forward", F.lit(0)), 2)
        .cast(MONEY_SUM).alias("approximate_beginning_balance"),
        F.when(F.col("Transactions") > 0, "Active").otherwise("Inactive").alias("activity_status"))
    if p.ordered:
        df = df.orderBy(*v.order("-month_year", "account_category", "account_number"))
    return df


def accounts_general(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Deposit accounts (S/D/C/U of valid members) with channel, type
    description, status, recent activity and per-member counts.

    Recent activity joins on the account key; the per-member counts and the
    number of applications are brought to one row per member and join once,
    with the accounts of a member dealt to several parts.  Applications are
    not deduplicated: an account repeats once per application, as in the
    report text (so rows per member grow as accounts x applications); the
    copies are made last, in chunks behind the sort.  ST's one
    credit-union name (first by name, D12) is a scalar subquery, and an
    EXISTS filter keeps the cross join's "no name row, no rows" rule.
    """
    from ledgerline.functions import accounts as A
    from ledgerline.operators.accounts import member_account_stats, recently_active_accounts
    from ledgerline.operators.tenant import cu_name_scalar, cu_names

    k = v.keys
    disc = v.norm("discriminator")
    acc = t["account"].filter((F.col("member_number") > 0) & disc.isin("S", "D", "C", "U"))
    stats = member_account_stats(acc, k, p.as_of, p.recent_days)
    recent = recently_active_accounts(t["transaction_history"], k, p.as_of, p.recent_days)
    apps = (t["member_application"].where(F.col("member_number").isNotNull())
            .groupBy(*k, "member_number").agg(F.count(F.lit(1)).alias("_app")))
    j = salted_left_join(acc.join(recent, k + ["account_id"], "left"), stats.join(apps, k + ["member_number"], "left"),
                         k + ["member_number"], [F.col("account_id")])
    if v.mt:
        j = tenant_enrich(j.join(cu_names(t["credit_union_info"]), ["credit_union"], "left"), t["fi_map"], exact=True)
        cu = F.col("credit_union_name")
        user = F.trim("created_by_userid")
        access = F.upper(F.trim(F.coalesce(F.col("access_control"), F.lit(""))))
    else:
        cu = cu_name_scalar(t["credit_union_info"])
        user = F.col("created_by_userid")
        access = F.coalesce(F.col("access_control"), F.lit(""))
    rank = F.when(disc == "S", 1).when(disc == "D", 2).when(disc == "C", 3).when(disc == "U", 4).otherwise(5)
    df = j.select(
        *(["credit_union", "idfi"] if v.mt else []), F.col("member_number").alias("member_id"), cu.alias("cu_name"),
        A.account_channel(F.col("_app").isNotNull(), user).alias("estimated_channel"),
        A.account_type_description(disc, v.norm("account_type"), v.stored("discriminator"),
                                   v.stored("account_type")).alias("account_type_description"),
        A.main_account_category(disc).alias("main_account_category"),
        F.col("date_opened").alias("created_date"), F.col("date_closed").alias("deleted_date"),
        A.account_deleted_status(F.col("date_closed"), access).alias("deleted_status"),
        F.when(F.col("_recent").isNotNull(), "Active").otherwise("Inactive").alias("active_status_last_3_months"),
        "account_number", "current_balance",
        F.col("total_accounts_per_member").alias("number_of_accounts_per_member"), "has_multiple_accounts",
        F.col("deleted_accounts_per_member").alias("accounts_deleted_per_member"),
        F.col("inactive_accounts_per_member").alias("accounts_inactive_per_member"),
        rank.alias("_rank"), F.col("date_opened").alias("_opened"), "_app")
    if not v.mt:
        # The text crosses with a one-row name table: no name row, no output rows.
        df = df.where(t["credit_union_info"].exists())
    order = v.order("member_id", "_rank", "-_opened") if p.ordered else None
    return (repeated(df, F.col("_app"), [F.col("member_id"), F.col("account_number")], order)
            .drop("_rank", "_opened", "_app"))


def tagged_products(t: Tables, p: Params, v: Variant) -> DataFrame:
    """The 5-way union of products (accounts, loans, debit cards, credit cards,
    credit lines) as the member key, ``_id`` and ``_rows``, the products of one
    account or card; ``_counts`` in them marks active products for the per-member
    count (O16).

    ``account`` is read once for its three branches: it is joined to recent
    activity and, for loan accounts only (the discriminator is part of the
    join condition, so deposit rows never fan out), to ``account_loan``; the
    array holds the deposit, loan and credit-line products that apply.
    ``eft_card_file`` is read once for both card branches.
    """
    from ledgerline.functions import products as P
    from ledgerline.operators.accounts import recently_active_accounts

    k = v.keys
    disc = v.norm("discriminator")
    atype = v.norm("account_type")
    acc = t["account"]
    cards = t["eft_card_file"]
    if v.mt:
        acc = acc.filter(F.col("member_number") > 0)
        cards = cards.filter(F.col("member_number") > 0)
    recent = recently_active_accounts(t["transaction_history"], k, p.as_of, p.recent_days)
    acc = (acc.filter(disc.isin("S", "D", "C", "U", "L"))
           .select(*k, "account_id", "member_number", "account_number", "date_opened", "date_closed",
                   "charge_off_date", "access_control", disc.alias("_disc"), atype.alias("_type"))
           .join(recent, k + ["account_id"], "left"))
    al = t["account_loan"].select(*[F.col(c).alias(f"_al_{c}") for c in k], F.col("account_id").alias("_al_id"),
                                  F.col("credit_limit").alias("_limit"), F.lit(True).alias("_loan"))
    cond = (acc["account_id"] == al["_al_id"]) & (acc["_disc"] == "L")
    for c in k:
        cond = cond & (acc[c] == al[f"_al_{c}"])
    acc = acc.join(al, cond, "left")

    recent_acc = F.col("_recent").isNotNull()
    access = (F.upper(F.trim(F.coalesce(F.col("access_control"), F.lit("")))) if v.mt
              else F.coalesce(F.col("access_control"), F.lit("")))
    open_ = F.col("date_closed").isNull()
    open_nco = open_ & F.col("charge_off_date").isNull()
    non_card = ~F.col("_type").isin(*P.LOAN_CARD_TYPES)
    # ST lists every L account as a loan (defect D9, literal unless ``fix`` has "D9").
    loan_rows = non_card if (v.mt or p.fixed("D9")) else F.lit(True)
    is_loan = (F.col("_disc") == "L") & F.col("_loan").isNotNull()

    def row(id_product, main, category, number, opened, closed, active, recent, origin, counts):
        return F.struct(id_product.alias("id_product"), main.alias("main_category"), category.alias("category_product"),
                        number.alias("product_number"), opened.alias("date_opened_product"),
                        closed.alias("date_closed_product"), active.alias("product_is_active"), recent.alias("_recent"),
                        origin.alias("table_name_origin"), counts.alias("_counts"))

    def of_account(id_product, main, category, active, origin, counts):
        return row(id_product, F.lit(main), category, F.col("account_number"), F.col("date_opened"),
                   F.col("date_closed"), active, recent_acc, F.lit(origin), counts)

    loan_active = F.when(open_nco, "Active").otherwise("Inactive")
    branches = F.array(
        F.when(F.col("_disc").isin("S", "D", "C", "U"),
               of_account(F.col("account_number"), "Accounts", P.account_product(F.col("_disc")),
                          F.when(open_, "Active").otherwise("Inactive"), "account", open_ & ~access.isin("B", "R"))),
        F.when(is_loan & loan_rows,
               of_account(F.col("account_number"), "Loans", F.lit("Loan"), loan_active, "account_loan",
                          non_card & open_nco)),
        F.when(is_loan & (F.col("_limit") > 0),
               of_account(F.concat(F.col("account_number"), F.lit("_CREDIT_ACCOUNT")), "Cards",
                          F.lit("Credit Card Account"), loan_active, "account_loan_credit", open_nco)))
    acc_rows = (acc.select(*k, "member_number", F.col("account_id").alias("_id"), F.array_compact(branches).alias("_rows"))
                .where(F.size("_rows") > 0))

    ctype = F.upper(F.trim("card_type")) if v.mt else F.col("card_type")
    reject = F.trim(F.col("reject_code").cast("string")) if v.mt else F.col("reject_code")
    cards = cards.filter(ctype.isin(*P.DEBIT_TYPES, *P.CREDIT_TYPES)).withColumn("_ct", ctype)
    debit = F.col("_ct").isin(*P.DEBIT_TYPES)
    card = row(
        F.concat(F.col("member_number").cast("string"), F.when(debit, "_CARD_").otherwise("_CREDITCARD_"),
                 F.col("record_number").cast("string")),
        F.lit("Cards"),
        F.when(debit, P.debit_card_product(F.col("_ct"))).otherwise(P.credit_card_product(F.col("_ct"))),
        F.col("record_number").cast("string"), F.col("issue_date"), P.card_closed_date(p.as_of),
        P.card_is_active(p.as_of, reject),
        F.coalesce(F.col("last_pin_used_date") >= F.lit(p.as_of - dt.timedelta(days=p.recent_days)), F.lit(False)),
        F.when(debit, "eft_card_file_debit").otherwise("eft_card_file_credit"),
        P.card_counts_as_product(p.as_of, reject))
    return acc_rows.unionByName(cards.select(*k, "member_number", F.col("record_number").cast("bigint").alias("_id"), F.array(card).alias("_rows")))


def product_rows(t: Tables, p: Params, v: Variant) -> DataFrame:
    """The products of ``tagged_products``, one row each."""
    return tagged_products(t, p, v).select(*v.keys, "member_number", F.inline("_rows"))


def products_overview(t: Tables, p: Params, v: Variant) -> DataFrame:
    """One row per product with the member's active-product count,
    member status and kind, tenant name.

    The products are computed and shuffled once; that exchange feeds the
    counts and the join that brings them back (``with_own_figures``), with
    status and kind on the same one row per member.  The text joins status
    and kind separately, so n member rows of one number make n x n rows per
    product; ``member`` is read once, its rows counted per label combination,
    and the copies are made last, behind the sort.  MT keeps tenants that
    have a name row (inner join); ST's single name is a scalar subquery.
    """
    from ledgerline.functions import members as M
    from ledgerline.functions import products as P
    from ledgerline.operators.tenant import cu_name_scalar

    k = v.keys
    fc = M.member_filter_columns(code=v.stored("inactive_flag"))
    m = t["member"]
    labels = {"member_status": M.member_status_strict(),
              **{c: fc[c] for c in ("member_number_is_valid", "member_inactive_flag_status", "member_accounts_status",
                                    "member_inactive_flag_code", "member_all_accounts_closed_flag")}}
    # member rows hardly repeat: one shuffle by the key serves both sums
    by_label = (m.where(F.col("member_number").isNotNull()).repartition("member_number", *k)
                .groupBy(*k, "member_number", F.struct(*[c.alias(n) for n, c in labels.items()]).alias("_status"),
                         P.member_category("member_type").alias("_kind")).agg(F.count(F.lit(1)).alias("_n")))
    # a number has few label combinations, however many rows: every status with every kind, as often as both occur
    pairs = F.flatten(F.transform("_l", lambda a: F.transform("_l", lambda b: F.struct(
        a["_status"].alias("s"), b["_kind"].alias("k"), (a["_n"] * b["_n"]).alias("n")))))
    kinds = by_label.groupBy(*k, "member_number").agg(F.collect_list(F.struct("_status", "_kind", "_n")).alias("_l"))

    def finish(counted: DataFrame) -> DataFrame:
        n = F.col("_active")
        return (counted.join(kinds, k + ["member_number"], "left")
                .select(*k, "member_number", "_parts", F.when(n > 0, n).alias("number_of_products_for_member"),
                        pairs.alias("_pairs")))

    active = F.size(F.filter("_rows", lambda r: r["_counts"]))
    tagged = tagged_products(t, p, v)
    if v.mt:  # rows without a tenant have no name row
        tagged = tagged.where(F.col("credit_union").isNotNull())
    else:  # the text crosses with a one-row name table: no name row, no output rows
        tagged = tagged.where(t["credit_union_info"].exists())
    j = with_own_figures(tagged, ["member_number", *k], [F.col("_id")], {"_active": active}, finish,
                         nullable=[] if v.mt else ["member_number"])
    j = (j.select("*", F.explode_outer("_pairs").alias("_p"))
         .select("*", "_p.s.*", F.col("_p.k").alias("member_category"), F.col("_p.n").alias("_n")))
    if v.mt:
        fi = t["fi_map"].select(F.col("tenant_code").alias("_code"), "idfi")
        info = t["credit_union_info"].select("credit_union", "credit_union_name")
        ci = (info.join(fi, F.lower(F.trim(info["credit_union"])) == F.lower(F.trim(fi["_code"])), "left")
              .select("credit_union", "credit_union_name", "idfi").distinct())
        j = j.join(ci, ["credit_union"], "inner")
        cu = F.col("credit_union_name")
    else:
        cu = cu_name_scalar(t["credit_union_info"])
    df = j.select(*(["credit_union", "idfi"] if v.mt else []), F.col("member_number").alias("id_member"),
                  "id_product", "main_category", "category_product", cu.alias("cu_name"), "product_number",
                  "date_opened_product", "date_closed_product", "number_of_products_for_member",
                  "product_is_active", P.recent_label(F.col("_recent")).alias("recent_activity_status"),
                  "member_status", "table_name_origin", "member_category", "member_number_is_valid",
                  "member_inactive_flag_status", "member_accounts_status", "member_inactive_flag_code",
                  "member_all_accounts_closed_flag", "_n")
    order = v.order(*(["credit_union", "idfi"] if v.mt else []), "id_member", "main_category", "category_product",
                    "-product_is_active")
    return repeated(df, F.col("_n"), [F.col("id_member"), F.col("id_product")], order if p.ordered else None).drop("_n")
