"""Loan reports: applications (R25/R26) and loan book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import loans as L
from ledgerline.operators.tenant import tenant_enrich
from ledgerline.params import Params
from ledgerline.plans.variant import Variant
from ledgerline.sources.tables import Tables


def loans_applications(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Loan applications with decision category, reason, channel and
    days to decision; status and type are per-tenant lookups (left joins)."""
    k = v.keys
    las = t["loan_app_status"].select(*k, "loan_app_status_id", F.col("description").alias("status_description"),
                                      v.stored("description").alias("_status_text"),
                                      "approved_flag", "adverse_action_flag", "withdrawn_flag", "incomplete_flag")
    lt = t["loan_type"].select(*k, "loan_type_id", F.col("description").alias("loan_type"))
    j = (t["loan_application"].join(las, k + ["loan_app_status_id"], "left")
         .join(lt, k + ["loan_type_id"], "left"))
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=True)
        flags = [L.text_true(c).alias(n) for c, n in (("funded_flag", "is_funded"), ("closed_flag", "is_closed"),
                                                       ("auto_approved_flag", "auto_approved"))]
    else:
        flags = [F.col("funded_flag").alias("is_funded"), F.col("closed_flag").alias("is_closed"),
                 F.col("auto_approved_flag").alias("auto_approved")]
    df = j.select(
        *(["credit_union", "idfi"] if v.mt else []),
        F.col("loan_application_id").alias("application_id"), F.col("member_number").alias("member_id"),
        "application_date", F.col("action_date").alias("response_date"),
        F.col("_status_text").alias("application_status"),
        L.application_status_category(v.mt).alias("status_category"),
        L.application_status_reason(v.mt).alias("status_reason"),
        L.application_channel("created_by_userid", v.mt).alias("origination_channel"),
        F.col("account_id").alias("loan_id"), "loan_type", F.col("loan_amount").alias("requested_amount"),
        *flags,
        F.col("loan_officer_userid").alias("processing_officer"),
        F.col("approving_loan_officer_userid").alias("approving_officer"),
        F.datediff(F.coalesce(F.col("action_date"), F.lit(p.as_of)), F.col("application_date")).alias(
            "days_to_decision"),
        F.col("created_timestamp").alias("application_submitted_timestamp"),
        F.col("created_by_userid").alias("submitted_by_user"),
        F.col("loan_application_id").alias("_id"))
    if p.ordered:
        df = df.orderBy(*v.order("-application_date", "-_id"))
    return df.drop("_id")


def loans_general(t: Tables, p: Params, v: Variant) -> DataFrame:
    """Loan book (non-card loan accounts) with bureau class, paid
    installments, status, delinquency, income and yield columns.

    account (loans only, filter reaches the scan) JOIN account_loan on the
    account key; account types, tenant map and tenant names are small
    per-tenant lookups.  MT's undefined ``cu_info`` is the distinct tenant name
    table (D6).
    """
    from ledgerline.operators.tenant import cu_names

    k = v.keys
    a = t["account"].filter((v.norm("discriminator") == "L") & ~v.norm("account_type").isin("CC", "PCO", "PCCO"))
    a = a.select(*k, "account_id", "member_number", v.stored("account_type").alias("account_type"), "date_opened",
                 "date_closed", "charge_off_date", "current_balance", v.norm("account_type").alias("_type"))
    al = t["account_loan"]
    at = t["account_types"].select(*k, v.norm("account_type").alias("_type"),
                                   F.col("description").alias("_at_desc"), "cb_loan_type")
    j = a.join(al, k + ["account_id"], "inner").join(at, k + ["_type"], "left")
    if v.mt:
        j = tenant_enrich(j, t["fi_map"], exact=False).join(cu_names(t["credit_union_info"]), ["credit_union"],
                                                             "left")
    ic = L.interest_columns(p.as_of)
    money = "decimal(18,2)"
    df = j.select(
        *(["credit_union", "idfi"] if v.mt else []), F.col("member_number").alias("Member_ID"),
        *([F.col("credit_union_name").alias("CU_Name")] if v.mt else []),
        F.col("account_id").alias("Loan_ID"), F.col("cb_loan_type").alias("Credit_Bureau_Code"),
        L.bureau_category("cb_loan_type").alias("Loan_Main_Category"),
        F.coalesce(F.col("_at_desc"), F.col("account_type")).alias("Loan_Sub_Category"),
        F.col("account_type").alias("Account_Type_Code"),
        F.round("interest_rate", 3).cast("decimal(9,3)").alias("Interest_Rate"),
        F.col("number_of_payments").alias("Number_of_Installments"),
        L.paid_installments(p.as_of).alias("Number_of_Paid_Installments"),
        F.col("date_opened").alias("Creation_Date"), F.col("next_payment_date").alias("Next_Payment_Date"),
        F.col("date_closed").alias("Closure_Date"), F.col("credit_score").alias("Credit_Score"),
        L.loan_status(p.as_of).alias("Status"),
        L.days_past_due("next_payment_date", p.as_of).alias("Days_Past_Due"),
        L.delinquency_bracket_loans("next_payment_date", p.as_of).alias("Delinquency_Bracket"),
        (L.zero("delq_count_30") + L.zero("delq_count_60") + L.zero("delq_count_90") + L.zero("delq_count_120")
         + L.zero("delq_count_150") + L.zero("delq_count_180")).cast("int").alias("Total_Delinquency_Occurrences"),
        F.col("opening_balance").cast(money).alias("Initial_Balance"),
        F.col("current_balance").cast(money).alias("Current_Balance"),
        ic["Total_Interest_Earned"].alias("Total_Interest_Earned"),
        F.col("interest_ytd").cast(money).alias("Interest_Earned_YTD"),
        F.col("interest_lytd").cast(money).alias("Interest_Earned_LYTD"),
        ic["Total_Late_Fees_Earned"].alias("Total_Late_Fees_Earned"),
        F.col("late_fees_ytd").cast(money).alias("Late_Fees_YTD"),
        F.col("late_fees_lytd").cast(money).alias("Late_Fees_LYTD"),
        *[ic[c].alias(c) for c in ("Total_Revenue_Earned", "Interest_Yield_Percentage", "Monthly_Interest_Rate",
                                   "Expected_Interest_Simple", "Interest_Performance_Ratio")])
    if p.ordered:
        df = df.orderBy(*v.order("Member_ID", "Loan_ID"))
    return df
