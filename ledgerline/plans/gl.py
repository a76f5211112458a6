"""General-ledger reports: account trend (R01/R02), accrual matching
(R04-R07), journal (R03) and dividends (R08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.common import MONEY_SUM, from_cents, to_cents
from ledgerline.functions import gl as G
from ledgerline.operators.calendar import add_months, grid_window, zero_filled_grid
from ledgerline.operators.gl import monthly_gl_activity, running_balance
from ledgerline.operators.skew import SPREAD, salted_left_join
from ledgerline.operators.tenant import tenant_enrich
from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def gl_accounts_general(t: Tables, p: Params, v: Variant) -> DataFrame:
    """GL account x month of the look-back grid, zero-filled activity,
    running balance, change vs previous month and GL classification.

    ``fix`` with "D14" carries the net activity from ``gl_start`` up to the
    grid into the running balance (the text starts the balance at the grid).

    The monthly facts come to the chart as one row per account, months are
    generated after that join, and the window runs on its partitioning, so
    grid rows never cross the network.  The grid and the window carry only
    keys and integer-cent measures; the chart attributes join back on the
    window's own keys, as in the report text.  Only grid months can reach the output, so the journal scan
    is cut to the grid range.
    """
    k = v.keys
    first, last = grid_window(p.gl_start, p.as_of, p.grid_months)
    acct = (t["gl_chart_of_accounts"]
            .withColumn("account_type", v.norm("account_type"))
            .filter(F.col("account_type").isin("B", "I"))
            .select(*k, F.col("account_number").cast("string").alias("account_number"), "description",
                    "short_desc", "account_type", "inactive", "created_timestamp", "modified_timestamp",
                    "restricted", "controlled", "modified_by_userid",
                    F.col("balance").alias("current_balance_from_coa")))
    hist = t["gl_history"].filter((F.col("effective_date") >= F.lit(max(first, p.gl_start)))
                                  & (F.col("effective_date") < F.lit(add_months(last, 1))))
    stats = monthly_gl_activity(hist, k, cents=True)
    zero = F.lit(0).cast("bigint")
    grid = zero_filled_grid(acct.select(*k, "account_number"), first, last, stats, k + ["account_number"],
                            {"monthly_transactions": zero, "monthly_debits": zero, "monthly_credits": zero,
                             "monthly_net_activity": zero, "monthly_total_amount": zero})
    r = running_balance(grid, k + ["account_number"], "period_start", "monthly_net_activity")
    if p.fixed("D14") and max(first, p.gl_start) > p.gl_start:
        # Opt-in repair: carry net activity from gl_start up to the grid into the balance.
        before = (t["gl_history"].filter((F.col("effective_date") >= F.lit(p.gl_start))
                                         & (F.col("effective_date") < F.lit(first)))
                  .groupBy(*k, F.col("gl_account_number").cast("string").alias("account_number"))
                  .agg(F.sum(to_cents("amount")).alias("_opening")))
        r = (r.join(before, k + ["account_number"], "left")
             .withColumn("calculated_balance", F.col("calculated_balance") + F.coalesce("_opening", F.lit(0)))
             .drop("_opening"))
    r = r.join(acct, k + ["account_number"], "inner")
    if v.mt:
        r = tenant_enrich(r, t["fi_map"], exact=True)
    number = G.gl_int_part("account_number") if v.mt else G.gl_numeric("account_number")
    controlled = v.norm(F.col("controlled").cast("string")) == "Y"
    df = r.select(
        *(["credit_union", "idfi"] if v.mt else []),
        F.col("period_start").alias("Period_Date"),
        F.date_format("period_start", "yyyy-MM").alias("Period_Year_Month"),
        F.year("period_start").alias("Year"),
        F.month("period_start").alias("Month"),
        F.date_format("period_start", "MMMM").alias("Month_Name"),
        F.col("account_number").alias("GL_ID"),
        F.col("description").alias("GL_Name"),
        F.col("short_desc").alias("Short_Description"),
        G.gl_category("account_type").alias("GL_Category"),
        G.gl_subcategory("account_type", number, "calculated_balance").alias("GL_Subcategory"),
        G.asset_liability_type("account_type", "current_balance_from_coa").alias("Asset_Liability_Type"),
        F.when(F.col("inactive") == 0, "Active").otherwise("Inactive").alias("Status"),
        F.col("created_timestamp").alias("Open_Date"),
        F.when(F.col("inactive") == 1, F.col("modified_timestamp")).alias("Close_Date"),
        from_cents("calculated_balance").alias("Historical_Balance"),
        F.col("current_balance_from_coa").alias("Current_Balance_From_COA"),
        from_cents("period_change").alias("Period_Balance_Change"),
        F.col("monthly_transactions").alias("Monthly_Transaction_Count"),
        from_cents("monthly_debits").alias("Monthly_Debits"),
        from_cents("monthly_credits").alias("Monthly_Credits"),
        from_cents("monthly_net_activity").alias("Monthly_Net_Activity"),
        from_cents("monthly_total_amount").alias("Monthly_Total_Amount"),
        G.gl_activity_level("monthly_transactions").alias("Activity_Level"),
        G.yes_no(F.col("restricted") == 1).alias("Restricted"),
        G.yes_no(controlled).alias("Controlled"),
        F.col("modified_timestamp").alias("Last_Modified"),
        F.col("modified_by_userid").alias("Last_Modified_By"),
        F.col("account_type").alias("_type"))
    if p.ordered:
        df = df.orderBy(*v.order("-Period_Date", "_type", "GL_ID"))
    return df.drop("_type")


_ACCRUAL_COLUMNS = ["product_type", "transaction_type", "entry_year", "entry_month", "entry_quarter", "yearMonth",
                    "total_paid_amount", "total_accrued_amount", "variance_paid_vs_accrued",
                    "paid_to_accrued_ratio_pct", "paid_transaction_count", "accrued_transaction_count",
                    "paid_gl_entries", "accrued_gl_entries", "paid_earliest_date", "paid_latest_date",
                    "accrued_earliest_date", "accrued_latest_date", "alert_status", "days_between_accrual_and_payment"]


def _accruals(t: Tables, p: Params, v: Variant, category: str, product: str, kind: str, loans: bool) -> DataFrame:
    """Monthly paid vs accrued GL activity of one category.

    Certificates: paid = dividend/interest GL net of the accruals, and months
    with accruals but no payments are added (left match + anti rows, combined
    with a distinct UNION).  Loans: paid = sum of |amount|, left match only;
    ST also requires paid > 0.
    """
    from ledgerline.operators.gl import accrual_monthly

    k = v.keys
    m = accrual_monthly(t["account_types"], t["gl_history"], category, v.mt, paid_abs=loans)
    # A month row with a null key never matches the other side of the reference's join.
    joinable = F.col("_m").isNotNull()
    for c in k:
        joinable = joinable & F.col(c).isNotNull()
    acc = F.when(joinable, F.col("acc_sum"))
    acc0 = F.coalesce(acc, F.lit(0).cast(MONEY_SUM))
    if loans:
        paid = F.col("paid_sum")
        variance = paid - acc0
        alert = G.accrual_alert(paid, acc0, variance, paid)
    else:
        paid = F.col("paid_sum") - acc0
        variance = paid - acc0
        alert = G.accrual_alert(paid, acc0, variance, F.abs(paid))
    # Both row kinds come from the one monthly aggregate through a generator,
    # so the journal is scanned and aggregated once (a UNION of two selects
    # would plan the whole pipeline twice).
    main_ok = F.col("has_paid") & F.col("_m").isNotNull()
    if loans and not v.mt:
        main_ok = main_ok & (F.col("paid_sum") > 0)
    zero_n = F.lit(0).cast("bigint")
    no_date = F.lit(None).cast("date")
    main_row = F.struct(
        paid.cast(MONEY_SUM).alias("total_paid_amount"), acc0.alias("total_accrued_amount"),
        variance.cast(MONEY_SUM).alias("variance_paid_vs_accrued"),
        G.accrual_ratio_pct(paid, acc0).alias("paid_to_accrued_ratio_pct"),
        F.col("paid_batches").alias("paid_transaction_count"),
        F.coalesce(F.when(joinable, F.col("acc_batches")), zero_n).alias("accrued_transaction_count"),
        F.col("paid_lines").alias("paid_gl_entries"),
        F.coalesce(F.when(joinable, F.col("acc_lines")), zero_n).alias("accrued_gl_entries"),
        F.col("paid_earliest").alias("paid_earliest_date"), F.col("paid_latest").alias("paid_latest_date"),
        F.when(joinable, F.col("acc_earliest")).alias("accrued_earliest_date"),
        F.when(joinable, F.col("acc_latest")).alias("accrued_latest_date"),
        alert.alias("alert_status"),
        F.datediff(F.col("paid_latest"), F.when(joinable, F.col("acc_earliest"))).alias(
            "days_between_accrual_and_payment"))
    rows = [F.when(main_ok, main_row)]
    if not loans:
        a = F.col("acc_sum")
        only_ok = F.col("has_acc") & (~F.coalesce(F.col("has_paid"), F.lit(False)) | ~joinable) & (a != 0)
        only_row = F.struct(
            (F.lit(0) - a).cast(MONEY_SUM).alias("total_paid_amount"), a.alias("total_accrued_amount"),
            ((F.lit(0) - a) - a).cast(MONEY_SUM).alias("variance_paid_vs_accrued"),
            G.accrual_ratio_pct(F.lit(0) - a, a).alias("paid_to_accrued_ratio_pct"),
            zero_n.alias("paid_transaction_count"), F.col("acc_batches").alias("accrued_transaction_count"),
            zero_n.alias("paid_gl_entries"), F.col("acc_lines").alias("accrued_gl_entries"),
            no_date.alias("paid_earliest_date"), no_date.alias("paid_latest_date"),
            F.col("acc_earliest").alias("accrued_earliest_date"), F.col("acc_latest").alias("accrued_latest_date"),
            F.lit("ACCRUED_NOT_PAID").alias("alert_status"),
            F.lit(None).cast("int").alias("days_between_accrual_and_payment"))
        rows.append(F.when(only_ok, only_row))
    df = (m.select(*k, "_m", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("_r"))
          .select(*k, F.lit(product).alias("product_type"), F.lit(kind).alias("transaction_type"),
                  *G.period_columns(F.col("_m")), "_r.*"))
    if v.mt:
        df = tenant_enrich(df, t["fi_map"], exact=False)
    df = df.select(*(["credit_union", "idfi"] if v.mt else []), *_ACCRUAL_COLUMNS)
    if not loans:
        df = df.distinct()  # UNION (not UNION ALL) in the report text
    if p.ordered:
        df = df.orderBy(*v.order("-entry_year", "-entry_month"))
    return df


def gl_accruals_certificates(t: Tables, p: Params, v: Variant) -> DataFrame:
    return _accruals(t, p, v, "CERT", "CERT", "Dividend", loans=False)


def gl_accruals_loans(t: Tables, p: Params, v: Variant) -> DataFrame:
    return _accruals(t, p, v, "LOAN", "LOAN", "Interest", loans=True)


def dim_branch(branch_config: DataFrame, entity: DataFrame) -> DataFrame:
    """Branch config id -> branch number and the branch entity's name."""
    ent = entity.select(F.col("entity_id").alias("branch_entity_id"), F.col("name_last").alias("branch_name"))
    return (branch_config.select("branch_config_id", "branch_number", "branch_entity_id")
            .join(ent, ["branch_entity_id"], "left").drop("branch_entity_id"))


def with_branch(rows: DataFrame, t: Tables, by: list[str]) -> DataFrame:
    """``rows`` LEFT JOIN ``dim_branch`` on the branch config id.

    A shuffle by branch has as many parts with rows as there are branches, so
    a task would sort an eighth of all rows where eight occur, and more as the
    tables grow.  The rows of a branch (and those without one) are dealt by a
    hash of ``by``.
    """
    return salted_left_join(rows, dim_branch(t["branch_config"], t["entity"]), ["branch_config_id"],
                            [F.col(c) for c in by], SPREAD)


def gl_dividends(t: Tables, p: Params, v: Variant) -> DataFrame:
    """R08 (single tenant): share and certificate dividend postings since
    ``dividend_start`` with member, account, GL and branch attributes and
    estimated rates.

    The filter reaches the transaction scan; member and account are joined on
    their keys, GL accounts and branches are small lookups.
    """
    from ledgerline.functions.accounts import account_category
    from ledgerline.functions.branches import branch_category, branch_name

    tx = t["transaction_history"].filter(
        (F.col("date_effective") >= F.lit(p.dividend_start)) & F.col("tran_code").isin("SHDV", "CTDV")
        & (F.col("void_flag") == 0) & (F.col("total_amount") != 0))
    tx = tx.select("transaction_history_id", "batch_number", "tran_code", "stored_tran_code", "date_effective", "total_amount",
                   "member_id", "account_id", "gl_chart_of_account_id", "branch_config_id", "user_id",
                   F.col("description").alias("tx_description"), "created_timestamp", "modified_timestamp")
    mem = t["member"].select("member_id", "member_number")
    acc = t["account"].select("account_id", "account_number", "account_type", "discriminator", "current_balance",
                              "stored_account_type", "stored_discriminator", "stored_status")
    coa = t["gl_chart_of_accounts"].select(F.col("record_number").alias("gl_chart_of_account_id"),
                                           F.col("account_number").cast("string").alias("gl_number"),
                                           F.col("description").alias("gl_description"), "short_desc")
    j = (tx.join(mem, ["member_id"], "left").join(acc, ["account_id"], "left")
         .join(coa, ["gl_chart_of_account_id"], "left"))
    j = with_branch(j, t, ["transaction_history_id", "account_id", "date_effective"])
    d = F.col("date_effective")
    return j.select(
        F.concat(F.lit("TXN_"), F.col("stored_tran_code"), F.lit("_"), F.col("transaction_history_id").cast("string"))
        .alias("ID_Dividend_Transaction"),
        F.col("transaction_history_id").alias("Transaction_History_ID"), F.col("batch_number").alias("Batch_Number"),
        F.col("stored_tran_code").alias("Transaction_Code"),
        G.dividend_type("tran_code", "stored_tran_code").alias("Transaction_Type"),
        d.alias("Transaction_Date"), F.year(d).alias("Transaction_Year"), F.month(d).alias("Transaction_Month"),
        F.quarter(d).alias("Transaction_Quarter"), F.date_format(d, "yyyy-MM").alias("year_month"),
        F.col("total_amount").alias("Amount"), F.abs("total_amount").alias("Amount_Absolute"),
        F.col("member_id").alias("Member_ID"), F.col("member_number").alias("Member_Number"),
        F.col("account_id").alias("Account_ID"), F.col("account_number").alias("Account_Number"),
        F.col("stored_account_type").alias("Account_Type"), F.col("stored_discriminator").alias("Account_Discriminator"),
        account_category(F.col("discriminator")).alias("Account_Category"),
        F.col("current_balance").alias("Current_Account_Balance"), F.col("stored_status").alias("Account_Status"),
        G.dividend_product_type("discriminator", "account_type", "stored_discriminator", "stored_account_type")
        .alias("Product_Type"),
        F.col("gl_number").alias("GL_Account_Number"), F.col("gl_description").alias("GL_Account_Description"),
        F.col("short_desc").alias("GL_Account_Short_Desc"),
        G.gl_prefix_category("gl_number").alias("GL_Account_Category"),
        F.col("branch_config_id").alias("Branch_Config_ID"), F.col("branch_number").alias("Branch_Number"),
        branch_name("branch_name", p.institution).alias("Branch_Name"),
        branch_category("branch_number", p.institution).alias("Branch_Category"),
        G.business_category("tran_code", "discriminator").alias("Business_Category"),
        G.estimated_rate("tran_code", "total_amount", "current_balance", 100).alias("Estimated_Monthly_Rate_Percent"),
        G.estimated_rate("tran_code", "total_amount", "current_balance", 1200).alias("Estimated_Annual_Rate_Percent"),
        F.lit(0).alias("Is_Voided"), F.col("user_id").alias("User_ID"),
        F.col("tx_description").alias("Transaction_Description"),
        F.col("created_timestamp").alias("Created_Timestamp"), F.col("modified_timestamp").alias("Modified_Timestamp"))


def gl_accounts_transactions(t: Tables, p: Params, v: Variant) -> DataFrame:
    """R03 (single tenant): enriched GL journal lines of the last ``grid_months``
    months: branch labels, account nature, calendar, source, debit/credit
    split, accounting impact, size, risk and branch patterns.

    The date filter reaches the journal scan; journal lines join the chart of
    accounts (B/I types only, inner) and the small branch dimension.
    """
    from ledgerline.functions import journal as J
    from ledgerline.functions.branches import journal_branch_labels, journal_branch_name
    from ledgerline.operators.kpis import _minus_months

    start = _minus_months(p.as_of, p.grid_months)
    h = t["gl_history"].filter(F.col("effective_date") >= F.lit(start))
    coa = (t["gl_chart_of_accounts"].filter(F.col("account_type").isin("B", "I"))
           .select(F.col("account_number").alias("gl_account_number"), F.col("description").alias("gl_description"),
                   "short_desc", "account_type", "stored_account_type", "inactive", "restricted", "stored_controlled", "balance"))
    j = with_branch(h.join(coa, ["gl_account_number"], "inner"), t, ["record_number", "effective_date", "amount"])
    ty = F.col("account_type")
    n = G.gl_numeric("gl_account_number")
    amt = F.col("amount")
    ab = F.abs(amt)
    money = "decimal(18,2)"
    cal = J.calendar_columns(F.col("effective_date"))
    imp = J.account_impact(ty, n, amt)
    br = journal_branch_labels(F.col("branch_number"), p.institution)
    bp = J.branch_patterns(F.col("branch_number"), amt, F.col("source"))
    df = j.select(
        F.col("record_number").alias("Transaction_ID"), F.col("gl_account_number").cast("string").alias("GL_ID"),
        F.col("gl_description").alias("GL_Name"), F.col("short_desc").alias("GL_Short_Name"),
        F.col("description").alias("Transaction_Description"),
        F.concat(F.col("gl_account_number"), F.lit("-"), F.col("short_desc")).alias("GL_Account_Concat"),
        F.col("branch_config_id").alias("Branch_Config_ID"), F.col("branch_number").alias("Branch_Number"),
        journal_branch_name("branch_name", p.institution).alias("Branch_Name"), *[c.alias(k) for k, c in br.items()],
        F.col("stored_account_type").alias("Account_Type"), G.gl_category(ty).alias("Account_Category"),
        J.journal_subcategory(ty, n).alias("GL_Subcategory"), J.account_nature(ty, n).alias("Account_Nature"),
        J.account_nature_description(ty, n).alias("Account_Nature_Description"),
        F.col("effective_date").alias("Effective_Date"), F.col("reference_date").alias("Reference_Date"),
        F.col("actual_date").alias("Posting_Date"), *[c.alias(k) for k, c in cal.items()],
        F.col("stored_source").alias("Txn_Source"),
        J.source_description("source", "stored_source").alias("Txn_Source_Description"),
        F.col("stored_entry_desc").alias("Txn_Type"),
        J.entry_type_description("entry_desc", "stored_entry_desc").alias("Txn_Type_Description"),
        amt.alias("Amount"), ab.alias("Abs_Amount"),
        F.when(amt > 0, "Debit").when(amt < 0, "Credit").otherwise("Zero").alias("Debit_Credit"),
        F.when(amt > 0, amt).otherwise(0).cast(money).alias("Debit_Amount"),
        F.when(amt < 0, ab).otherwise(0).cast(money).alias("Credit_Amount"),
        imp["Account_Impact"].alias("Account_Impact"),
        imp["Account_Impact_Description"].alias("Account_Impact_Description"),
        J.size_category(ab).alias("Transaction_Size_Category"),
        F.col("batch_number").alias("Batch_Number"), F.col("group_id").alias("Group_ID"),
        F.col("group_seq").alias("Group_Sequence"), F.col("posted_by_user").alias("Posted_By_User"),
        J.transaction_nature("description").alias("Transaction_Nature"),
        J.processing_type("source", "entry_desc").alias("Processing_Type"),
        F.col("stored_status").alias("Record_Status"), F.col("modified").alias("Modified_Flag"),
        F.col("version").alias("Record_Version"), F.col("created_timestamp").alias("Record_Created"),
        F.col("created_by_userid").alias("Created_By_User"), F.col("modified_timestamp").alias("Record_Modified"),
        F.col("modified_by_userid").alias("Modified_By_User"), F.col("inactive").alias("Account_Inactive"),
        F.col("restricted").alias("Account_Restricted"), F.col("stored_controlled").alias("Account_Controlled"),
        F.col("balance").alias("Current_Account_Balance"), J.volume_indicator(ab).alias("Volume_Indicator"),
        J.expected_activity_level(ty, n).alias("Expected_Activity_Level"),
        imp["Transaction_Pattern"].alias("Transaction_Pattern"),
        J.risk_level(ty, n, amt, F.col("source"), F.col("entry_desc"), F.col("description")).alias("Risk_Level"),
        J.accounting_category(ty, n).alias("Accounting_Category"),
        *[c.alias(k) for k, c in bp.items()])
    if p.ordered:
        df = df.orderBy(*v.order("-Effective_Date", "-Transaction_ID"))
    return df
