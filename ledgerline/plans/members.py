"""Member reports: key trends (R09/R10), profile (R11/R12), transactions
(R13/R14), details (R15/R16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import members as M
from ledgerline.functions.common import from_cents, to_cents
from ledgerline.operators.tenant import tenant_enrich
from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def member_key_trends(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Per member, balances over its accounts plus filter columns.

    Accounts are aggregated per (tenant, member number) before the join (map-
    side combine keeps a member with very many accounts cheap); the member
    side then groups by the report's member columns, which collapses duplicate
    member rows exactly as the report's GROUP BY does.  MT joins accounts on
    member_id (defect D1, literal unless ``fix`` has "D1").
    """
    k = v.keys
    d = v.norm("discriminator")
    bal = to_cents("current_balance")
    acc = (t["account"].groupBy(*k, F.col("member_number").alias("_mk"))
           .agg(F.sum(bal).alias("_s"), F.count(bal).alias("_n"),
                F.sum(F.when(d.isin("S", "D", "C"), bal).otherwise(0)).alias("_dep"),
                F.sum(F.when(d == "L", bal).otherwise(0)).alias("_loan")))
    m = t["member"]
    mkey = "member_id" if (v.mt and not p.fixed("D1")) else "member_number"
    cond = m[mkey] == acc["_mk"]
    for c in k:
        cond = cond & (m[c] == acc[c])
    j = m.join(acc, cond, "left").drop(*[acc[c] for c in k])
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=False)
    keys = [*(["credit_union", "idfi"] if v.mt else []), "member_id", "member_number", "join_date", "inactive_flag",
            *([] if v.mt else ["stored_inactive_flag"]), "all_accounts_closed", "modified_timestamp"]
    g = j.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"),
                             F.sum(F.coalesce("_dep", F.lit(0))).alias("_dep"),
                             F.sum(F.coalesce("_loan", F.lit(0))).alias("_loan"))
    fc = M.member_filter_columns(code=v.stored("inactive_flag"))
    cols = [*(["credit_union", "idfi"] if v.mt else []), "member_id", "member_number",
            *[fc[c].alias(c) for c in ("member_number_is_valid", "member_inactive_flag_status",
                                       "member_accounts_status")]]
    if v.mt:
        cols.append(M.member_status_strict(require_type=False).alias("member_status"))
    cols += [fc["member_inactive_flag_code"].alias("member_inactive_flag_code"),
             fc["member_all_accounts_closed_flag"].alias("member_all_accounts_closed_flag"),
             F.col("join_date").cast("date").alias("join_date")]
    if v.mt:
        cols.append(F.col("all_accounts_closed").alias("closed_membership"))
    else:
        cols.append(F.when(F.col("all_accounts_closed") == 1, "Yes").otherwise("No").alias("Closed Membership"))
    cols += ["modified_timestamp",
             F.when(F.col("_n") > 0, from_cents("_s").cast("double") / F.col("_n")).alias("average_balance"),
             from_cents("_s").alias("total_balance"),
             from_cents("_dep").alias("total_deposits_balance"),
             from_cents("_loan").alias("total_loans_balance")]
    return g.select(*cols)


KPI_WINDOWS = ["lifetime", "mtd", "30d", "90d", "12m"]


def member_transactions(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Transaction KPIs per member for lifetime, MTD, 30/90 days and
    12 months, activity flags, volume class and score components.

    Transactions -> per-account partials -> join account (member number) and
    account types (credit-card flag) -> per-member sums.  MT counts credit-
    card rows as 12-month debits (defect D2, literal unless ``fix`` has "D2").
    """
    from ledgerline.operators.kpis import account_partials, kpi_windows, member_kpis

    k = v.keys
    part = account_partials(t["transaction_history"], k + ["account_id"], kpi_windows(p.as_of))
    acct = (t["account"].filter(F.col("member_number").isNotNull())
            .select(*k, "account_id", "member_number", v.norm("account_type").alias("_type")))
    types = t["account_types"].select(*k, v.norm("account_type").alias("_type"),
                                      (F.coalesce(F.col("credit_card").try_cast("int"), F.lit(0)) == 1).alias("_cc"))
    j = part.join(acct, k + ["account_id"], "inner").join(types, k + ["_type"], "left")
    keys = k + ["member_number"]
    g = member_kpis(j, keys, KPI_WINDOWS, F.coalesce(F.col("_cc"), F.lit(False)),
                    debit_12m_from_cc=v.mt and not p.fixed("D2"))
    if v.mt:
        g = tenant_enrich(g, t["fi_map"], exact=False)
    metric_cols = [c for c in g.columns if c not in ("credit_union", "idfi", "member_number", "first_d", "last_d",
                                                      "n_30d", "n_90d", "n_12m")]
    sc = M.transaction_scores("n_30d", "n_12m")
    df = g.select(
        *(["credit_union", "idfi", "member_number"] if v.mt else [F.col("member_number").alias("member_id")]),
        *metric_cols,
        M.active_label("n_30d").alias("transaction_activity_30d"),
        M.active_label("n_90d").alias("transaction_activity_90d"),
        M.transaction_volume_category("n_12m").alias("transaction_volume_category"),
        *[c.alias(n) for n, c in sc.items()],
        F.col("first_d").alias("first_transaction_date"),
        F.col("last_d").alias("last_transaction_date"),
        F.datediff(F.lit(p.as_of), F.col("last_d")).alias("days_since_last_transaction"),
        F.lit(p.as_of).alias("transaction_data_extract_date"))
    if p.ordered and v.mt:
        df = df.orderBy(*v.order("credit_union", "member_number"))
    return df


def member_details(t: Tables, p: Params, v: Variant) -> DataFrame:
    """One row per account with member and entity attributes.

    account LEFT JOIN (member LEFT JOIN entity): the member-entity join runs
    once per member, then one equi-join on (tenant, member number) attaches it
    to accounts.  Null member numbers cannot match; AQE's skew-join split
    keeps a large null or hot key from landing in one task.
    """
    from ledgerline.functions.accounts import account_open_columns, product_type

    k = v.keys
    ent = t["entity"].select(*k, F.col("entity_id").alias("member_entity_id"), "address1", "dob", "name_first",
                             "name_middle", "name_last")
    mem = (t["member"].select(*k, "member_id", "member_number", "member_entity_id", "member_type", "inactive_flag",
                              *([] if v.mt else ["stored_inactive_flag"]), "all_accounts_closed", "join_date",
                              "home_bank_date")
           .join(ent, k + ["member_entity_id"], "left"))
    a = t["account"]
    if v.mt:
        a = a.filter(F.col("account_id").isNotNull())
    a = a.select(*k, "account_id", "account_number", "description", "current_balance", "date_closed",
                 "date_opened", "discriminator", F.col("member_number").alias("_amn"))
    cond = a["_amn"] == mem["member_number"]
    for c in k:
        cond = cond & (a[c] == mem[c])
    j = a.join(mem, cond, "left").drop(*[mem[c] for c in k])
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=False)
    age = (M.age_completed_years("dob", p.as_of) if v.mt else M.age_year_difference("dob", p.as_of))
    fc = M.member_filter_columns(code=v.stored("inactive_flag"))
    oc = account_open_columns(F.col("date_closed"))
    disc = F.trim("discriminator") if v.mt else F.col("discriminator")
    mtype = F.trim("member_type") if v.mt else F.col("member_type")
    cols = [*(["credit_union", "idfi"] if v.mt else []), "account_id", "account_number",
            F.coalesce(F.col("description"), F.lit("")).alias("description"), "current_balance",
            oc["date_closed"].alias("date_closed"), "date_opened", oc["product_status"].alias("product_status"),
            product_type(disc).alias("product_type"), "member_id", "member_number",
            *[fc[c].alias(c) for c in ("member_number_is_valid", "member_inactive_flag_status",
                                       "member_accounts_status")]]
    if v.mt:
        cols.append(M.member_status_strict().alias("member_status"))
    cols += [fc["member_inactive_flag_code"].alias("member_inactive_flag_code"),
             fc["member_all_accounts_closed_flag"].alias("member_all_accounts_closed_flag"),
             "address1", age.alias("age"), M.age_group(age).alias("age_group"), M.full_name().alias("full_name"),
             F.col("join_date").cast("date").alias("join_date"),
             M.tenure_category(F.datediff(F.lit(p.as_of), F.col("join_date"))).alias("member_tenure_category"),
             M.member_type_label(mtype).alias("member_type"),
             M.online_banking_status().alias("online_banking_status")]
    return j.select(*cols)


def member_profile(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Member 360 view: names, demographics, address, tenure,
    activity, open-product counts, engagement score and attrition.

    One pass over ``account`` yields both the open-account counts and the
    latest close date; members join entity, eligibility group and that summary
    on their keys.  MT keeps members with a number and a type; the second
    ``member_status`` of the MT text is named ``member_status_strict`` (D5).
    """
    from ledgerline.operators.members import OPEN_COUNT_CODES, account_summary, closed_member_keys

    k = v.keys
    summ = account_summary(t["account"], k)
    # Closed keys come from every member row (the report's sub-select is unfiltered).
    closed = closed_member_keys(t["member"], k)
    m = t["member"]
    if v.mt:
        m = m.filter(F.col("member_number").isNotNull() & F.col("member_type").isNotNull())
    ent = t["entity"].withColumnRenamed("entity_id", "member_entity_id")
    eg = t["eligibility_group"].select(*k, "eligibility_group_id", F.col("description").alias("_eg_desc"))
    # Entity and eligibility first; the two member-number joins then share one partitioning.
    j = (m.join(ent, k + ["member_entity_id"], "left")
         .join(eg, k + ["eligibility_group_id"], "left")
         .join(summ, k + ["member_number"], "left")
         .join(closed, k + ["member_number"], "left")
         .withColumn("_any_all_closed", F.coalesce(F.col("_any_all_closed"), F.lit(False))))
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=False)
    age = M.age_year_difference("dob", p.as_of)
    counts = {c: F.col(name) for c, name in OPEN_COUNT_CODES.items()}
    rel = M.product_relationship(counts, F.col("total_account_count"))
    attr = F.when(F.col("_any_all_closed"), F.col("latest_account_closure_date"))
    lifespan = F.when((F.col("all_accounts_closed") == 1) & attr.isNotNull(), F.datediff(attr, F.col("join_date")))
    fc = M.member_filter_columns(code=v.stored("inactive_flag"))
    addr = M.address_columns()
    cols = [*(["credit_union", "idfi"] if v.mt else []), F.col("member_number").alias("member_id"),
            M.cap_name("name_first").alias("first_name"), M.cap_name("name_middle").alias("middle_name"),
            M._cap(F.col("name_last")).alias("last_name"), "preferred_name", M.full_name().alias("full_name"),
            age.alias("age"),
            F.when(F.col("inactive_flag") == "I", "Inactive").otherwise("Active").alias("member_status"),
            *[fc[c].alias(c) for c in ("member_number_is_valid", "member_inactive_flag_status",
                                       "member_accounts_status")]]
    if v.mt:
        cols.append(M.member_status_strict().alias("member_status_strict"))
    cols += [fc["member_inactive_flag_code"].alias("member_inactive_flag_code"),
             fc["member_all_accounts_closed_flag"].alias("member_all_accounts_closed_flag"),
             M.member_type_label(F.col("member_type")).alias("member_type"),
             F.col("join_date").cast("date").alias("join_date"), F.year("join_date").alias("join_year"),
             F.quarter("join_date").alias("join_quarter"), F.month("join_date").alias("join_month"),
             F.datediff(F.lit(p.as_of), F.col("join_date")).alias("member_tenure_days"),
             M.tenure_category(F.datediff(F.lit(p.as_of), F.col("join_date"))).alias("member_tenure_category"),
             M.gender_label().alias("gender"), M.age_group(age, lettered=False).alias("age_group"),
             age.alias("calculated_age"),
             *[c.alias(n) for n, c in addr.items()],
             F.col("branch_number").alias("branch"),
             F.coalesce(F.col("_eg_desc"), F.lit("Unknown")).alias("eligibility_group"),
             M.online_banking_status().alias("online_banking_status"),
             M.activity_within("last_nondiv_activity", p.as_of, 30).alias("activity_30_days"),
             M.activity_within("last_nondiv_activity", p.as_of, 90).alias("activity_90_days"),
             F.coalesce(F.col("total_account_count"), F.lit(0)).alias("total_account_count"),
             F.coalesce(F.col("share_count"), F.lit(0)).alias("savings_accounts_count"),
             F.coalesce(F.col("draft_count"), F.lit(0)).alias("checking_accounts_count"),
             F.coalesce(F.col("loan_count"), F.lit(0)).alias("loan_accounts_count"),
             F.coalesce(F.col("cert_count"), F.lit(0)).alias("certificate_accounts_count"),
             rel["has"]["S"].alias("has_savings"), rel["has"]["D"].alias("has_checking"),
             rel["has"]["L"].alias("has_loans"), rel["has"]["C"].alias("has_certificates"),
             rel["distinct_product_types_count"].alias("distinct_product_types_count"),
             rel["total_products_by_type"].alias("total_products_by_type"),
             rel["product_relationship_category"].alias("product_relationship_category"),
             M.engagement_score("home_bank_date", "last_nondiv_activity", F.col("total_account_count"),
                                p.as_of).alias("engagement_score"),
             F.col("last_nondiv_activity").alias("last_activity_date"),
             F.col("home_bank_date").alias("last_online_banking_date"),
             F.when(F.col("all_accounts_closed") == 1, "Yes").otherwise("No").alias(
                 "all_accounts_closed" if v.mt else "all_accounts_closed_legacy"),
             attr.alias("attrition_date"), lifespan.alias("member_lifespan_days"),
             F.when(lifespan.isNotNull(), M.attrition_category(lifespan)).alias("attrition_category"),
             F.lit(p.as_of).alias("data_extract_date")]
    df = j.select(*cols)
    if p.ordered:
        df = df.orderBy(*v.order("member_id"))
    return df
