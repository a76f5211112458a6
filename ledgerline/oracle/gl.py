"""DuckDB oracle statements of the general-ledger reports."""

from __future__ import annotations

from ledgerline.oracle.base import Q


def _subcat(q: Q, num: str, bal: str) -> str:
    b = [(701, 799, ">", "ASSETS - Loans to Members"), (740, 750, ">", "ASSETS - Investments"),
         (770, 780, ">", "ASSETS - Property & Equipment"), (700, 799, "<", "CONTRA-ASSETS - Allowances/Provisions"),
         (800, 899, "<", "LIABILITIES - Accounts Payable"), (900, 989, "<", "LIABILITIES - Member Deposits"),
         (990, 999, "<", "EQUITY - Capital & Reserves")]
    i = [(110, 199, "INCOME - Interest & Fees"), (200, 299, "EXPENSES - Personnel"),
         (300, 399, "EXPENSES - Operations"), (400, 499, "OTHER - Income/Expense")]
    parts = [f"WHEN a.account_type = 'B' AND {num} BETWEEN {lo} AND {hi} AND {bal} {s} 0 THEN '{lab}'"
             for lo, hi, s, lab in b]
    parts += [f"WHEN a.account_type = 'I' AND {num} BETWEEN {lo} AND {hi} THEN '{lab}'" for lo, hi, lab in i]
    return "CASE " + " ".join(parts) + " ELSE 'OTHER' END"


def gl_accounts_general(q: Q) -> str:
    last = f"CAST(date_trunc('month', {q.as_of}) AS DATE)"
    first = (f"CAST(greatest(date_trunc('month', {q.d(q.p.gl_start)}), "
             f"date_trunc('month', {q.as_of}) - INTERVAL {q.p.grid_months} MONTH) AS DATE)")
    num = ("TRY_CAST(split_part(a.account_number, '.', 1) AS INTEGER)" if q.mt
           else "TRY_CAST(a.account_number AS DOUBLE)")
    ctrl = "upper(trim(CAST(a.controlled AS VARCHAR)))" if q.mt else "a.controlled"
    return q.wrap(f"""
WITH a AS (
  SELECT {q.k()}CAST(account_number AS VARCHAR) AS account_number, description, short_desc,
         {q.norm('account_type')} AS account_type, inactive, created_timestamp, modified_timestamp, restricted,
         controlled, modified_by_userid, balance AS coa_balance
  FROM gl_chart_of_accounts WHERE {q.norm('account_type')} IN ('B', 'I')
), ms AS (
  SELECT {q.k()}CAST(gl_account_number AS VARCHAR) AS account_number,
         CAST(date_trunc('month', effective_date) AS DATE) AS period_start, count(*) AS n,
         sum(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS dr, sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS cr,
         sum(amount) AS net, sum(abs(amount)) AS tot
  FROM gl_history WHERE effective_date >= {q.d(q.p.gl_start)} GROUP BY ALL
), ag AS (
  SELECT {q.k()}account_number,
         CAST(unnest(generate_series({q.d(q.p.gl_start.replace(day=1))}, {last}, INTERVAL 1 MONTH)) AS DATE) AS period_start
  FROM a
), g AS (
  SELECT a.*, coalesce(ms.n, 0) AS n,
         CAST(coalesce(ms.dr, 0) AS DECIMAL(38,2)) AS dr, CAST(coalesce(ms.cr, 0) AS DECIMAL(38,2)) AS cr,
         CAST(coalesce(ms.net, 0) AS DECIMAL(38,2)) AS net, CAST(coalesce(ms.tot, 0) AS DECIMAL(38,2)) AS tot
  FROM ag a
  LEFT JOIN ms ON ms.account_number = a.account_number AND ms.period_start = a.period_start{q.on('ms', 'a')}
  WHERE a.period_start >= {first}
), r AS (
  SELECT *, CAST(sum(net) OVER (PARTITION BY {q.k()}account_number ORDER BY period_start
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS bal,
         row_number() OVER (PARTITION BY {q.k()}account_number ORDER BY period_start) AS nth
  FROM g
), months AS (
  SELECT *, CAST(bal - lag(bal) OVER (PARTITION BY {q.k()}account_number ORDER BY nth) AS DECIMAL(38,2)) AS change FROM r
), listed AS (
  -- a number that the chart lists m times has m rows per month, and each meets its m chart rows
  SELECT a.*, m.* EXCLUDE ({q.k()}account_number) FROM months m JOIN a ON a.account_number = m.account_number{q.on('a', 'm')}
)
SELECT {q.head('a')}a.period_start AS Period_Date, strftime(a.period_start, '%Y-%m') AS Period_Year_Month,
  CAST(year(a.period_start) AS INTEGER) AS Year, CAST(month(a.period_start) AS INTEGER) AS Month,
  strftime(a.period_start, '%B') AS Month_Name, a.account_number AS GL_ID, a.description AS GL_Name,
  a.short_desc AS Short_Description,
  CASE WHEN a.account_type = 'B' THEN 'Balance Sheet' WHEN a.account_type = 'I' THEN 'Income Statement' ELSE 'Other' END AS GL_Category,
  {_subcat(q, num, 'a.bal')} AS GL_Subcategory,
  CASE WHEN a.account_type = 'B' AND a.coa_balance > 0 THEN 'ASSET' WHEN a.account_type = 'B' AND a.coa_balance < 0 THEN 'LIABILITY/EQUITY'
       WHEN a.account_type = 'B' AND a.coa_balance = 0 THEN 'ZERO BALANCE' WHEN a.account_type = 'I' THEN 'INCOME/EXPENSE' ELSE 'OTHER' END AS Asset_Liability_Type,
  CASE WHEN a.inactive = 0 THEN 'Active' ELSE 'Inactive' END AS Status,
  a.created_timestamp AS Open_Date, CASE WHEN a.inactive = 1 THEN a.modified_timestamp END AS Close_Date,
  a.bal AS Historical_Balance, a.coa_balance AS Current_Balance_From_COA,
  a.change AS Period_Balance_Change,
  a.n AS Monthly_Transaction_Count, a.dr AS Monthly_Debits, a.cr AS Monthly_Credits, a.net AS Monthly_Net_Activity,
  a.tot AS Monthly_Total_Amount,
  CASE WHEN coalesce(a.n, 0) = 0 THEN 'No Activity' WHEN a.n <= 10 THEN 'Low Activity' WHEN a.n <= 50 THEN 'Medium Activity'
       WHEN a.n <= 200 THEN 'High Activity' ELSE 'Very High Activity' END AS Activity_Level,
  CASE WHEN a.restricted = 1 THEN 'Yes' ELSE 'No' END AS Restricted,
  CASE WHEN {ctrl} = 'Y' THEN 'Yes' ELSE 'No' END AS Controlled,
  a.modified_timestamp AS Last_Modified, a.modified_by_userid AS Last_Modified_By
FROM listed a
{q.idfi('a', 'credit_union', exact=True)}""")


def _accruals(q: Q, category: str, product: str, kind: str, loans: bool) -> str:
    if q.mt:
        canon = "coalesce(regexp_replace(trim(CAST({} AS VARCHAR)), '^0+', ''), '0')"
        cat = "upper(trim(category))"
        posted = "upper(trim(coalesce(status, 'P'))) = 'P'"
    else:
        canon = "coalesce(regexp_replace(trim(CAST({} AS VARCHAR)), '^0+', ''), '0')"
        cat = "category"
        posted = "status <> 'D'"

    # one pass: every posted line with its roles, one row per month with both sides
    sides = {"paid": "abs(amount)" if loans else "amount", "acc": "amount"}

    def side(role: str) -> str:
        f = f"FILTER (role = '{role}')"
        return (f"CAST(sum({sides[role]}) {f} AS DECIMAL(38,2)) AS {role}, count(DISTINCT batch_number) {f} AS {role}_batches, "
                f"count(*) {f} AS {role}_lines, min(effective_date) {f} AS {role}_lo, max(effective_date) {f} AS {role}_hi")

    joins = "mon IS NOT NULL" + (" AND credit_union IS NOT NULL" if q.mt else "")
    both = f"if({joins}, acc, NULL)"
    paid = "paid" if loans else f"(paid - coalesce({both}, 0))"
    scale = "paid" if loans else f"abs({paid})"
    wanted = "paid_lines > 0 AND mon IS NOT NULL" + (" AND paid > 0" if loans and not q.mt else "")

    def row(p: str, a: str, alert: str, lead: str, days: str, a_dates: str) -> str:
        n = lambda x, c: f"if({c}, {x}, 0)"
        there = "true" if lead == "NULL" else joins
        return f"""
  SELECT {q.k()}'{product}' AS product_type, '{kind}' AS transaction_type, CAST(year(mon) AS INTEGER) AS entry_year,
    CAST(month(mon) AS INTEGER) AS entry_month, CAST(quarter(mon) AS INTEGER) AS entry_quarter, strftime(mon, '%Y-%m') AS yearMonth,
    CAST({p} AS DECIMAL(38,2)) AS total_paid_amount, CAST({a} AS DECIMAL(38,2)) AS total_accrued_amount,
    CAST({p} - {a} AS DECIMAL(38,2)) AS variance_paid_vs_accrued,
    CASE WHEN {a} > 0 THEN round(CAST({p} AS DOUBLE) / CAST({a} AS DOUBLE) * 100, 2) END AS paid_to_accrued_ratio_pct,
    {'0' if lead == 'NULL' else 'paid_batches'} AS paid_transaction_count, {n('acc_batches', there)} AS accrued_transaction_count,
    {'0' if lead == 'NULL' else 'paid_lines'} AS paid_gl_entries, {n('acc_lines', there)} AS accrued_gl_entries,
    {lead if lead == 'NULL' else 'paid_lo'} AS paid_earliest_date, {lead if lead == 'NULL' else 'paid_hi'} AS paid_latest_date,
    {a_dates.format('acc_lo')} AS accrued_earliest_date, {a_dates.format('acc_hi')} AS accrued_latest_date,
    {alert} AS alert_status, {days} AS days_between_accrual_and_payment
  FROM g"""

    a0 = f"coalesce({both}, 0)"
    alert = (f"CASE WHEN {paid} > 0 AND {a0} = 0 THEN 'PAID_WITHOUT_ACCRUAL' WHEN {paid} = 0 AND {a0} > 0 THEN 'ACCRUED_NOT_PAID' "
             f"WHEN abs({paid} - {a0}) > {scale} * 0.05 THEN 'SIGNIFICANT_VARIANCE' ELSE 'NORMAL' END")
    dates = f"if({joins}, {{}}, NULL)"
    body = row(paid, a0, alert, "", f"CAST(date_diff('day', {dates.format('acc_lo')}, paid_hi) AS INTEGER)", dates) + f" WHERE {wanted}"
    if not loans:
        body += "\n  UNION\n" + row("(0 - acc)", "acc", "'ACCRUED_NOT_PAID'", "NULL", "NULL", "{}") + \
            f" WHERE acc_lines > 0 AND acc <> 0 AND (paid_lines = 0 OR NOT ({joins}))"
    return q.wrap(f"""
WITH roles AS (
  SELECT DISTINCT {q.k()}role, gl FROM (
    SELECT {q.k()}unnest([{{'role': 'paid', 'gl': div_int_acct}}, {{'role': 'acc', 'gl': accrual_acct}}], recursive := true)
    FROM (SELECT {q.k()}CASE WHEN div_int_acct IS NOT NULL THEN {canon.format('div_int_acct')} END AS div_int_acct,
            CASE WHEN accrual_acct IS NOT NULL THEN {canon.format('accrual_acct')} END AS accrual_acct
          FROM account_types WHERE {cat} = '{category}') t) u
  WHERE gl IS NOT NULL
), g AS (
  SELECT {q.k('h')}CAST(date_trunc('month', h.effective_date) AS DATE) AS mon, {side('paid')}, {side('acc')}
  FROM (SELECT *, {canon.format('gl_account_number')} AS gl FROM gl_history WHERE {posted}) h
  JOIN roles r ON r.gl = h.gl{q.on('r', 'h')} GROUP BY ALL
), r AS ({body})
SELECT {'r.credit_union, fi.idfi, ' if q.mt else ''}r.* {'EXCLUDE (credit_union)' if q.mt else ''}
FROM r {q.idfi('r', 'credit_union', exact=False)}""")


def gl_accruals_certificates(q: Q) -> str:
    return _accruals(q, "CERT", "CERT", "Dividend", loans=False)


def gl_accruals_loans(q: Q) -> str:
    return _accruals(q, "LOAN", "LOAN", "Interest", loans=True)


def exact_round_ratio(num: str, den: str, factor: int, scale: int) -> str:
    """round(num / den x factor, scale) for 2-decimal num >= 0 and den > 0,
    half away from zero, exact in integer arithmetic, as DECIMAL(38, scale)."""
    n = f"(CAST(round({num} * 100) AS HUGEINT) * {factor} * {10 ** scale})"
    d = f"CAST(round({den} * 100) AS HUGEINT)"
    q = f"((2 * {n} + {d}) // (2 * {d}))"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {1 / 10 ** scale:.{scale}f} AS DECIMAL(38,{scale}))"


def gl_dividends(q: Q) -> str:
    # Fixed values, stated here once more so that a wrong label in the library shows.
    products = {"S": {"PSAV": "Primary Savings", "HYS": "High Yield Savings", "MMA": "Money Market", "SSAV": "Secondary Savings",
                      "CLUB": "Club Account", "TISV": "Traditional IRA Savings", "RISV": "Roth IRA Savings",
                      "YSAV": "Youth Savings", "SPIS": "SEP IRA Savings"},
                "C": {"CERT": "Certificate of Deposit", "TICD": "Traditional IRA Certificate", "RICD": "Roth IRA Certificate",
                      "EICD": "Education IRA Certificate"},
                "D": {"CHK": "Checking Account", "OTCK": "Overtime Checking"}}
    prod = "CASE da.discriminator || '/' || da.account_type " + " ".join(
        f"WHEN '{d}/{t}' THEN '{lab}'" for d, types in products.items() for t, lab in types.items()) + \
        " ELSE da.stored_discriminator || ' - ' || da.stored_account_type END"
    glc = ("CASE left(CAST(gl.account_number AS VARCHAR), 4) WHEN '380.' THEN 'DIVIDEND_EXPENSE' WHEN '901.' THEN 'MEMBER_DEPOSIT_ACCOUNT' "
           "WHEN '903.' THEN 'CERTIFICATE_ACCOUNT' WHEN '383.' THEN 'OTHER_DIVIDEND_EXPENSE' WHEN '151.' THEN 'CASH_ACCOUNT' "
           "ELSE 'OTHER_GL_ACCOUNT' END")
    inst = q.p.institution
    brc = "CASE db.branch_number " + " ".join(f"WHEN '{b.number}' THEN '{b.category}'" for b in inst.branches) + \
        " ELSE 'OTHER_BRANCH' END"
    ok = "th.tran_code = 'SHDV' AND da.current_balance > 100 AND th.total_amount < 0"
    return q.wrap(f"""
WITH th AS (
  SELECT * FROM transaction_history
  WHERE date_effective >= {q.d(q.p.dividend_start)} AND tran_code IN ('SHDV', 'CTDV') AND void_flag = 0 AND total_amount <> 0
), db AS (
  SELECT bc.branch_config_id, bc.branch_number, be.name_last AS branch_name
  FROM branch_config bc LEFT JOIN entity be ON bc.branch_entity_id = be.entity_id
)
SELECT 'TXN_' || th.stored_tran_code || '_' || CAST(th.transaction_history_id AS VARCHAR) AS ID_Dividend_Transaction,
  th.transaction_history_id AS Transaction_History_ID, th.batch_number AS Batch_Number, th.stored_tran_code AS Transaction_Code,
  CASE WHEN th.tran_code = 'SHDV' THEN 'SHARE_DIVIDEND_TO_MEMBER' WHEN th.tran_code = 'CTDV' THEN 'CERTIFICATE_DIVIDEND'
       ELSE 'OTHER_DIVIDEND_' || th.stored_tran_code END AS Transaction_Type,
  th.date_effective AS Transaction_Date, CAST(year(th.date_effective) AS INTEGER) AS Transaction_Year,
  CAST(month(th.date_effective) AS INTEGER) AS Transaction_Month, CAST(quarter(th.date_effective) AS INTEGER) AS Transaction_Quarter,
  strftime(th.date_effective, '%Y-%m') AS year_month, th.total_amount AS Amount, abs(th.total_amount) AS Amount_Absolute,
  th.member_id AS Member_ID, dm.member_number AS Member_Number, th.account_id AS Account_ID,
  da.account_number AS Account_Number, da.stored_account_type AS Account_Type, da.stored_discriminator AS Account_Discriminator,
  CASE da.discriminator WHEN 'S' THEN 'SAVINGS' WHEN 'C' THEN 'CERTIFICATES' WHEN 'D' THEN 'CHECKING' WHEN 'L' THEN 'LOANS'
       WHEN 'U' THEN 'SPECIAL' ELSE 'OTHER' END AS Account_Category,
  da.current_balance AS Current_Account_Balance, da.stored_status AS Account_Status, {prod} AS Product_Type,
  CAST(gl.account_number AS VARCHAR) AS GL_Account_Number, gl.description AS GL_Account_Description,
  gl.short_desc AS GL_Account_Short_Desc, {glc} AS GL_Account_Category,
  th.branch_config_id AS Branch_Config_ID, db.branch_number AS Branch_Number,
  CASE WHEN db.branch_name LIKE '%{inst.name}%' THEN '{inst.short_name}'
       WHEN db.branch_name IS NULL THEN 'Unknown Branch' ELSE trim(db.branch_name) END AS Branch_Name,
  {brc} AS Branch_Category,
  CASE WHEN th.tran_code = 'SHDV' AND da.discriminator = 'S' THEN 'SAVINGS_DIVIDEND_PAYMENT'
       WHEN th.tran_code = 'CTDV' THEN 'CERTIFICATE_DIVIDEND_PAYMENT' ELSE 'OTHER_DIVIDEND_TRANSACTION' END AS Business_Category,
  CASE WHEN {ok} THEN {exact_round_ratio('abs(th.total_amount)', 'da.current_balance', 100, 4)} END AS Estimated_Monthly_Rate_Percent,
  CASE WHEN {ok} THEN {exact_round_ratio('abs(th.total_amount)', 'da.current_balance', 1200, 4)} END AS Estimated_Annual_Rate_Percent,
  0 AS Is_Voided, th.user_id AS User_ID, th.description AS Transaction_Description,
  th.created_timestamp AS Created_Timestamp, th.modified_timestamp AS Modified_Timestamp
FROM th
LEFT JOIN member dm ON th.member_id = dm.member_id
LEFT JOIN account da ON th.account_id = da.account_id
LEFT JOIN gl_chart_of_accounts gl ON th.gl_chart_of_account_id = gl.record_number
LEFT JOIN db ON th.branch_config_id = db.branch_config_id""")


def gl_accounts_transactions(q: Q) -> str:
    start = f"CAST({q.as_of} - INTERVAL {q.p.grid_months} MONTH AS DATE)"
    inst = q.p.institution
    n = "TRY_CAST(gl.account_number AS DOUBLE)"
    t = "gl.account_type"
    r = lambda k, lo, hi: f"({t} = '{k}' AND {n} BETWEEN {lo} AND {hi})"
    deb = f"({r('B', 700, 899)} OR {r('I', 200, 399)})"
    cre = f"({r('B', 900, 999)} OR {r('I', 110, 199)} OR {r('I', 400, 499)})"
    other = {"Branch_Category": "OTHER_BRANCH", "Branch_Activity_Level": "UNKNOWN_ACTIVITY",
             "Branch_Specialization": "Unknown Specialization", "Branch_Member_Density": "UNKNOWN_DENSITY"}
    brl = ", ".join("CASE bc.branch_number " + " ".join(f"WHEN '{b.number}' THEN '{b.journal[i]}'" for b in inst.branches)
                    + f" ELSE '{default}' END AS {nm}" for i, (nm, default) in enumerate(other.items()))
    u = "upper(h.description)"
    a = "h.amount"
    return q.wrap(f"""
SELECT h.record_number AS Transaction_ID, CAST(h.gl_account_number AS VARCHAR) AS GL_ID, gl.description AS GL_Name,
  gl.short_desc AS GL_Short_Name, h.description AS Transaction_Description,
  h.gl_account_number || '-' || gl.short_desc AS GL_Account_Concat, h.branch_config_id AS Branch_Config_ID,
  bc.branch_number AS Branch_Number,
  CASE WHEN be.name_last = '{inst.head_office}' THEN '{inst.short_name}'
       WHEN be.name_last IS NULL THEN 'Unknown Branch' ELSE trim(be.name_last) END AS Branch_Name, {brl},
  gl.stored_account_type AS Account_Type,
  CASE WHEN {t} = 'B' THEN 'Balance Sheet' WHEN {t} = 'I' THEN 'Income Statement' ELSE 'Other' END AS Account_Category,
  CASE WHEN {r('B', 700, 799)} THEN 'ASSETS - Loans & Investments' WHEN {r('B', 800, 899)} THEN 'ASSETS/LIABILITIES - Clearing & Payables'
       WHEN {r('B', 900, 999)} THEN 'LIABILITIES - Deposits & Equity' WHEN {r('I', 110, 199)} THEN 'INCOME - Interest & Fees'
       WHEN {r('I', 200, 299)} THEN 'EXPENSES - Personnel & Operations' WHEN {r('I', 300, 399)} THEN 'EXPENSES - Operations & Provisions'
       WHEN {r('I', 400, 499)} THEN 'OTHER - Miscellaneous Income/Expense' ELSE 'OTHER' END AS GL_Subcategory,
  CASE WHEN {deb} THEN 'DEBIT_NATURE' WHEN {cre} THEN 'CREDIT_NATURE' ELSE 'MIXED_NATURE' END AS Account_Nature,
  CASE WHEN {r('B', 700, 899)} THEN 'ASSETS (Increase with Debits, Decrease with Credits)'
       WHEN {r('I', 200, 399)} THEN 'EXPENSES (Increase with Debits, Decrease with Credits)'
       WHEN {r('B', 900, 999)} THEN 'LIABILITIES/EQUITY (Increase with Credits, Decrease with Debits)'
       WHEN {r('I', 110, 199)} THEN 'REVENUE (Increase with Credits, Decrease with Debits)'
       WHEN {r('I', 400, 499)} THEN 'OTHER REVENUE (Increase with Credits, Decrease with Debits)'
       ELSE 'MIXED OR UNCLASSIFIED NATURE' END AS Account_Nature_Description,
  h.effective_date AS Effective_Date, h.reference_date AS Reference_Date, h.actual_date AS Posting_Date,
  strftime(h.effective_date, '%Y-%m') AS YearMonth, CAST(year(h.effective_date) AS INTEGER) AS TransactionYear,
  CAST(month(h.effective_date) AS INTEGER) AS TransactionMonth, strftime(h.effective_date, '%B') AS MonthName,
  CAST(quarter(h.effective_date) AS INTEGER) AS TransactionQuarter, CAST(day(h.effective_date) AS INTEGER) AS DayOfMonth,
  strftime(h.effective_date, '%A') AS DayOfWeek, CAST(isodow(h.effective_date) AS INTEGER) AS DayOfWeekNumber,
  CAST(weekofyear(h.effective_date) AS INTEGER) AS ISOWeek, CAST(dayofyear(h.effective_date) AS INTEGER) AS DayOfYear,
  CASE WHEN isodow(h.effective_date) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS BusinessDayType,
  CASE WHEN day(h.effective_date) <= 7 THEN 'First Week' WHEN day(h.effective_date) <= 14 THEN 'Second Week'
       WHEN day(h.effective_date) <= 21 THEN 'Third Week' ELSE 'Fourth Week+' END AS WeekOfMonth,
  h.stored_source AS Txn_Source,
  CASE h.source WHEN 'CU' THEN 'Credit Union System (EOD Processing)' WHEN 'JE' THEN 'Journal Entry (Manual/System)'
       WHEN 'CT' THEN 'Certificate/Time Deposit' WHEN 'AP' THEN 'Accounts Payable' WHEN 'FA' THEN 'Fixed Assets/Depreciation'
       ELSE 'Other: ' || h.stored_source END AS Txn_Source_Description,
  h.stored_entry_desc AS Txn_Type,
  CASE WHEN h.entry_desc = 'EOD' THEN 'End of Day Processing'
       WHEN h.entry_desc LIKE '%-%' THEN 'Manual Entry - User ' || substr(h.stored_entry_desc, 1, 2)
       WHEN h.entry_desc = 'CERT ACCRUAL' THEN 'Certificate Interest Accrual' WHEN h.entry_desc = 'INVOICE' THEN 'Invoice Payment/Processing'
       WHEN h.entry_desc = 'DEPRECIATION' THEN 'Asset Depreciation' WHEN h.entry_desc LIKE 'ME LOAN%' THEN 'Member Loan Accrual'
       ELSE h.stored_entry_desc END AS Txn_Type_Description,
  {a} AS Amount, abs({a}) AS Abs_Amount,
  CASE WHEN {a} > 0 THEN 'Debit' WHEN {a} < 0 THEN 'Credit' ELSE 'Zero' END AS Debit_Credit,
  CAST(CASE WHEN {a} > 0 THEN {a} ELSE 0 END AS DECIMAL(18,2)) AS Debit_Amount,
  CAST(CASE WHEN {a} < 0 THEN abs({a}) ELSE 0 END AS DECIMAL(18,2)) AS Credit_Amount,
  CASE WHEN {deb} THEN CASE WHEN {a} > 0 THEN 'INCREASE' WHEN {a} < 0 THEN 'DECREASE' ELSE 'NO_CHANGE' END
       WHEN {cre} THEN CASE WHEN {a} > 0 THEN 'DECREASE' WHEN {a} < 0 THEN 'INCREASE' ELSE 'NO_CHANGE' END
       ELSE 'UNKNOWN_IMPACT' END AS Account_Impact,
  CASE WHEN {deb} THEN CASE WHEN {a} > 0 THEN 'INCREASES ' || CASE WHEN {t} = 'B' THEN 'ASSET' ELSE 'EXPENSE' END || ' (Normal Debit)'
                            WHEN {a} < 0 THEN 'DECREASES ' || CASE WHEN {t} = 'B' THEN 'ASSET' ELSE 'EXPENSE' END || ' (Contra Credit)'
                            ELSE 'NO CHANGE' END
       WHEN {cre} THEN CASE WHEN {a} > 0 THEN 'DECREASES ' || CASE WHEN {t} = 'B' THEN 'LIABILITY/EQUITY' ELSE 'REVENUE' END || ' (Contra Debit)'
                            WHEN {a} < 0 THEN 'INCREASES ' || CASE WHEN {t} = 'B' THEN 'LIABILITY/EQUITY' ELSE 'REVENUE' END || ' (Normal Credit)'
                            ELSE 'NO CHANGE' END
       ELSE 'IMPACT NOT DETERMINED' END AS Account_Impact_Description,
  CASE WHEN abs({a}) = 0 THEN 'Zero Amount' WHEN abs({a}) < 100 THEN 'Small (< $100)' WHEN abs({a}) < 1000 THEN 'Medium ($100 - $1K)'
       WHEN abs({a}) < 10000 THEN 'Large ($1K - $10K)' WHEN abs({a}) < 100000 THEN 'Very Large ($10K - $100K)'
       ELSE 'Exceptional ($100K+)' END AS Transaction_Size_Category,
  h.batch_number AS Batch_Number, h.group_id AS Group_ID, h.group_seq AS Group_Sequence, h.posted_by_user AS Posted_By_User,
  CASE WHEN {u} LIKE '%DIVIDEND%' OR {u} LIKE '%DIV-%' THEN 'Dividend Transaction'
       WHEN {u} LIKE '%INTEREST%' OR {u} LIKE '%INT-%' THEN 'Interest Transaction'
       WHEN {u} LIKE '%FEE%' OR {u} LIKE '%CHARGE%' THEN 'Fee Transaction'
       WHEN {u} LIKE '%SUMMARY%' THEN 'Summary/Aggregated Transaction'
       WHEN {u} LIKE '%ACCRUAL%' OR {u} LIKE '%ACCR%' THEN 'Accrual Transaction'
       WHEN {u} LIKE '%REVERSAL%' OR {u} LIKE '%REV%' THEN 'Reversal Transaction'
       WHEN {u} LIKE '%CORRECTION%' OR {u} LIKE '%CORR%' THEN 'Correction Transaction'
       WHEN {u} LIKE '%ADJUSTMENT%' OR {u} LIKE '%ADJ%' THEN 'Adjustment Transaction'
       ELSE 'Regular Transaction' END AS Transaction_Nature,
  CASE WHEN h.source = 'CU' AND h.entry_desc = 'EOD' THEN 'Automated EOD' WHEN h.source = 'JE' AND h.entry_desc LIKE '%-%' THEN 'Manual Entry'
       WHEN h.source IN ('CT', 'AP', 'FA') THEN 'System Generated' ELSE 'Other Processing' END AS Processing_Type,
  h.stored_status AS Record_Status, h.modified AS Modified_Flag, h.version AS Record_Version, h.created_timestamp AS Record_Created,
  h.created_by_userid AS Created_By_User, h.modified_timestamp AS Record_Modified, h.modified_by_userid AS Modified_By_User,
  gl.inactive AS Account_Inactive, gl.restricted AS Account_Restricted, gl.stored_controlled AS Account_Controlled,
  gl.balance AS Current_Account_Balance,
  CASE WHEN abs({a}) > 500000 THEN 'Exceptional Volume' WHEN abs({a}) > 100000 THEN 'Very High Volume'
       WHEN abs({a}) > 10000 THEN 'High Volume' ELSE 'Standard Volume' END AS Volume_Indicator,
  CASE WHEN {r('B', 860, 899)} OR {r('I', 110, 199)} THEN 'High Activity Account' ELSE 'Standard Activity Account' END AS Expected_Activity_Level,
  CASE WHEN ({r('B', 700, 899)} AND {a} > 0) OR ({r('I', 200, 399)} AND {a} > 0) OR ({r('B', 900, 999)} AND {a} < 0)
            OR ({r('I', 110, 199)} AND {a} < 0) OR ({r('I', 400, 499)} AND {a} < 0) THEN 'NORMAL_PATTERN'
       WHEN ({r('B', 700, 899)} AND {a} < 0) OR ({r('I', 200, 399)} AND {a} < 0) OR ({r('B', 900, 999)} AND {a} > 0)
            OR ({r('I', 110, 199)} AND {a} > 0) OR ({r('I', 400, 499)} AND {a} > 0) THEN 'CONTRA_PATTERN'
       ELSE 'UNDEFINED_PATTERN' END AS Transaction_Pattern,
  CASE WHEN {a} = 0 THEN 'ZERO_RISK'
       WHEN abs({a}) > 100000 AND (({r('B', 700, 899)} AND {a} < 0) OR ({r('B', 900, 999)} AND {a} > 0)) THEN 'HIGH_RISK_LARGE_CONTRA'
       WHEN h.source = 'JE' AND h.entry_desc LIKE '%-%' AND abs({a}) > 10000 THEN 'MEDIUM_RISK_MANUAL_LARGE'
       WHEN {u} LIKE '%REVERSAL%' OR {u} LIKE '%CORRECTION%' THEN 'MEDIUM_RISK_ADJUSTMENT' ELSE 'LOW_RISK' END AS Risk_Level,
  CASE WHEN {r('B', 700, 899)} THEN 'ASSETS' WHEN {r('B', 900, 999)} THEN 'LIABILITIES_EQUITY' WHEN {r('I', 110, 199)} THEN 'REVENUE'
       WHEN {r('I', 200, 399)} THEN 'EXPENSES' WHEN {r('I', 400, 499)} THEN 'OTHER_INCOME' ELSE 'UNCATEGORIZED' END AS Accounting_Category,
  CASE WHEN bc.branch_number = '0' AND abs({a}) > 1000000 THEN 'HQ_LARGE_TRANSACTION'
       WHEN bc.branch_number <> '0' AND abs({a}) > 100000 THEN 'BRANCH_LARGE_TRANSACTION'
       WHEN bc.branch_number = '6' AND abs({a}) > 1000 THEN 'REMOTE_UNUSUAL_AMOUNT' ELSE 'NORMAL_BRANCH_TRANSACTION' END AS Branch_Transaction_Pattern,
  CASE WHEN h.source = 'JE' AND bc.branch_number <> '0' THEN 'BRANCH_MANUAL_ENTRY'
       WHEN h.source = 'CU' AND bc.branch_number = '0' THEN 'HQ_SYSTEM_TRANSACTION'
       WHEN h.source = 'CU' AND bc.branch_number <> '0' THEN 'BRANCH_SYSTEM_TRANSACTION' ELSE 'OTHER_BRANCH_TRANSACTION' END AS Branch_Transaction_Type
FROM gl_history h
JOIN gl_chart_of_accounts gl ON gl.account_number = h.gl_account_number
LEFT JOIN branch_config bc ON h.branch_config_id = bc.branch_config_id
LEFT JOIN entity be ON bc.branch_entity_id = be.entity_id
WHERE h.effective_date >= {start} AND gl.account_type IN ('B', 'I')""")
