"""Test binding of the 18 logical tables onto the driver's parquet tables.

Each logical table is one SELECT over the driver tables (see FIXTURES.md).
The same text runs in Spark (driver tables passed as DataFrames) and in
DuckDB (driver tables pre-registered as views), so both engines see the
same rows.  Driver-table names are written as ``{name}`` placeholders.

Rows that the fixture multiplies by a short constant list are produced
with a generator (``explode`` / ``unnest``) over that list rather than a
join, so no relation is ever crossed with another.
"""

from __future__ import annotations

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The single-tenant binding reads the rows of all tenants as one institution's; of the code tables,
# which the multi-tenant tables repeat per tenant, it has the one copy of this tenant.
ST_CODE_TABLES = ("account_types", "loan_app_status", "loan_type")
ST_CODE_TENANT = "cu0"

# Logical table -> column names in order (types are fixed by the SQL below).
COLUMNS: dict[str, tuple[str, ...]] = {
    "fi_map": ("tenant_code", "idfi"),
    "credit_union_info": ("credit_union", "credit_union_name"),
    "member": ("credit_union", "member_id", "member_number", "member_entity_id", "member_type", "inactive_flag",
               "all_accounts_closed", "join_date", "home_bank_date", "last_nondiv_activity", "branch_number",
               "eligibility_group_id", "modified_timestamp"),
    "entity": ("credit_union", "entity_id", "name_first", "name_middle", "name_last", "preferred_name", "dob", "gender",
               "foreign_address", "address1", "address2", "city", "state", "zip", "country", "physical_address1",
               "physical_address2", "physical_city", "physical_state", "physical_zip", "physical_country"),
    "eligibility_group": ("credit_union", "eligibility_group_id", "description"),
    "account": ("credit_union", "account_id", "account_number", "member_number", "discriminator", "account_type",
                "description", "current_balance", "date_opened", "date_closed", "charge_off_date", "last_activity",
                "access_control", "status", "created_by_userid"),
    "account_loan": ("credit_union", "account_id", "credit_limit", "credit_expiration", "funded_date",
                     "next_payment_date", "last_payment_date", "opening_balance", "interest_rate",
                     "number_of_payments", "payments_per_year", "credit_score", "delq_count_30", "delq_count_60",
                     "delq_count_90", "delq_count_120", "delq_count_150", "delq_count_180", "interest_ytd",
                     "interest_lytd", "late_fees_ytd", "late_fees_lytd"),
    "transaction_history": ("credit_union", "transaction_history_id", "account_id", "member_id", "batch_number",
                            "tran_code", "date_effective", "date_actual", "total_amount", "void_flag",
                            "gl_chart_of_account_id", "branch_config_id", "user_id", "description",
                            "created_timestamp", "modified_timestamp"),
    "gl_chart_of_accounts": ("credit_union", "record_number", "account_number", "description", "short_desc",
                             "account_type", "inactive", "restricted", "controlled", "balance", "created_timestamp",
                             "modified_timestamp", "modified_by_userid"),
    "gl_history": ("credit_union", "record_number", "gl_account_number", "effective_date", "amount", "batch_number",
                   "status", "source", "entry_desc", "description", "branch_config_id", "reference_date",
                   "actual_date", "group_id", "group_seq", "posted_by_user", "modified", "version",
                   "created_timestamp", "created_by_userid", "modified_timestamp", "modified_by_userid"),
    "account_types": ("credit_union", "account_type", "category", "description", "div_int_acct", "accrual_acct",
                      "credit_card", "cb_loan_type"),
    "branch_config": ("credit_union", "branch_config_id", "branch_number", "branch_entity_id"),
    "pd_xmaif": ("card_type", "description", "credit_card", "debit_card", "atm_card", "card_issuer", "inactive_flag"),
    "eft_card_file": ("credit_union", "member_number", "record_number", "card_type", "issue_date", "block_date",
                      "expire_date", "share_acct_bal", "draft_acct_bal", "reject_code", "lost_or_stolen",
                      "last_pin_used_date"),
    "member_application": ("credit_union", "member_number", "application_seq"),
    "loan_application": ("credit_union", "loan_application_id", "member_number", "application_date", "action_date",
                         "loan_app_status_id", "loan_type_id", "denial_reason1", "denial_reason2", "denial_reason3",
                         "loan_app_denial_other", "created_by_userid", "account_id", "loan_amount", "funded_flag",
                         "closed_flag", "auto_approved_flag", "loan_officer_userid",
                         "approving_loan_officer_userid", "created_timestamp"),
    "loan_app_status": ("credit_union", "loan_app_status_id", "description", "approved_flag", "adverse_action_flag",
                        "withdrawn_flag", "incomplete_flag"),
    "loan_type": ("credit_union", "loan_type_id", "description"),
}

def _const_rows(dialect: str, fields: tuple[str, ...], rows: list[tuple]) -> str:
    """A list literal of structs, one per row, for explode/unnest."""
    def lit(v):
        if v is None:
            return "CAST(NULL AS VARCHAR)" if dialect == "duckdb" else "CAST(NULL AS STRING)"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    if dialect == "duckdb":
        items = ["{" + ", ".join(f"'{f}': {lit(v)}" for f, v in zip(fields, r)) + "}" for r in rows]
        return "unnest([" + ", ".join(items) + "])"
    items = ["named_struct(" + ", ".join(f"'{f}', {lit(v)}" for f, v in zip(fields, r)) + ")" for r in rows]
    return "explode(array(" + ", ".join(items) + "))"


# Fixed values of the fixture (FIXTURES.md): loan statuses and loan types.
_STATUS_FIELDS = ("k", "description", "approved_flag", "adverse_action_flag", "withdrawn_flag", "incomplete_flag")
_STATUS_ROWS = [
    (0, "APPROVED", "1", "0", "0", "0"),
    (1, "DENIED", "0", "true", "0", "0"),
    (2, " withdraw", "0", "0", "1", "0"),
    (3, "INCOMPLETE", "bad", None, None, "1"),
    (4, "Pending ", "0", "0", "0", "0"),
]
_LOAN_TYPE_FIELDS = ("loan_type_id", "description")
_LOAN_TYPE_ROWS = [(0, "Auto"), (1, "Personal"), (2, "Mortgage")]


_SQL: dict[str, str] = {
    "fi_map": """
SELECT CASE WHEN r_regionkey % 3 = 0 THEN concat('cu', cast(r_regionkey as string))
            ELSE concat(' CU', cast(r_regionkey as string), ' ') END AS tenant_code,
       100 + r_regionkey AS idfi
FROM {region} WHERE r_regionkey < 4""",
    "credit_union_info": """
SELECT concat('cu', cast(r_regionkey as string)) AS credit_union, r_name AS credit_union_name FROM {region}""",
    "member": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, CASE WHEN c_custkey % 4 = 0 THEN c_custkey ELSE c_custkey + 1000000 END AS member_id,
 CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN -c_custkey ELSE c_custkey END AS member_number,
 c_custkey AS member_entity_id,
 CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'P' WHEN 'BUILDING' THEN 'P' WHEN 'MACHINERY' THEN 'B' WHEN 'FURNITURE' THEN 'C' ELSE NULL END AS member_type,
 CASE WHEN c_custkey % 7 = 0 THEN 'I' WHEN c_custkey % 11 = 0 THEN NULL ELSE 'A' END AS inactive_flag,
 CASE WHEN c_custkey % 5 = 0 THEN 1 WHEN c_custkey % 13 = 0 THEN NULL ELSE 0 END AS all_accounts_closed,
 DATE '1990-01-01' + cast(c_custkey * 37 % 4200 as int) AS join_date,
 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE DATE '2001-01-01' + cast(c_custkey % 180 as int) END AS home_bank_date,
 CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE DATE '2001-07-15' - cast(c_custkey % 200 as int) END AS last_nondiv_activity,
 c_nationkey % 7 AS branch_number, c_nationkey AS eligibility_group_id,
 TIMESTAMP '2001-07-01 00:00:00' AS modified_timestamp
FROM {customer}""",
    "entity": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, c_custkey AS entity_id,
 CASE WHEN c_custkey % 19 = 0 THEN '[NULL]' WHEN c_custkey % 23 = 0 THEN NULL ELSE lower(c_mktsegment) END AS name_first,
 CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[NULL]' ELSE 'mIDdle' END AS name_middle,
 c_name AS name_last, CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS preferred_name,
 CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE DATE '1905-01-01' + cast(c_custkey * 23 % 35000 as int) END AS dob,
 CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'N' WHEN 3 THEN 'O' WHEN 4 THEN 'X' ELSE NULL END AS gender,
 cast(CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END as int) AS foreign_address,
 concat(' ', c_name, ' st ') AS address1, cast(NULL as string) AS address2,
 CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE concat('city', cast(c_nationkey as string)) END AS city,
 concat('s', cast(c_nationkey % 5 as string)) AS state, cast(10000 + c_custkey as string) AS zip, 'us' AS country,
 concat('phys ', c_name) AS physical_address1, cast(NULL as string) AS physical_address2,
 concat('pcity', cast(c_nationkey as string)) AS physical_city,
 cast(NULL as string) AS physical_state, '99999' AS physical_zip, ' mx ' AS physical_country
FROM {customer}
UNION ALL
SELECT 'cu0' AS credit_union, 9000000 + s_suppkey AS entity_id, cast(NULL as string) AS name_first,
 cast(NULL as string) AS name_middle, CASE s_suppkey WHEN 1 THEN 'EXAMPLE VALLEY SAVERS - HEAD OFFICE' WHEN 2 THEN 'Branch of EXAMPLE VALLEY SAVERS' ELSE concat(' ', s_name, ' ') END AS name_last, cast(NULL as string) AS preferred_name,
 cast(NULL as date) AS dob, cast(NULL as string) AS gender, cast(0 as int) AS foreign_address,
 cast(NULL as string) AS address1, cast(NULL as string) AS address2, cast(NULL as string) AS city,
 cast(NULL as string) AS state, cast(NULL as string) AS zip, cast(NULL as string) AS country,
 cast(NULL as string) AS physical_address1, cast(NULL as string) AS physical_address2,
 cast(NULL as string) AS physical_city, cast(NULL as string) AS physical_state, cast(NULL as string) AS physical_zip,
 cast(NULL as string) AS physical_country
FROM {supplier} WHERE s_suppkey < 7""",
    "eligibility_group": """
SELECT concat('cu', cast(n_nationkey % 5 as string)) AS credit_union, n_nationkey AS eligibility_group_id,
 n_name AS description FROM {nation} WHERE n_nationkey <> 24""",
    "account": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, o_orderkey AS account_id,
 concat('A', cast(o_orderkey as string)) AS account_number,
 CASE WHEN o_custkey % 53 = 0 THEN NULL WHEN o_custkey % 41 = 0 THEN -o_custkey ELSE o_custkey END AS member_number,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'D' WHEN '3-MEDIUM' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'C ' END WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'L' ELSE 'l' END ELSE 'U' END AS discriminator,
 CASE WHEN o_orderpriority = '1-URGENT' THEN CASE o_orderkey % 4 WHEN 0 THEN 'PSAV' WHEN 1 THEN 'SSAV' WHEN 2 THEN 'MMA' ELSE ' hys ' END
 WHEN o_orderpriority = '2-HIGH' THEN CASE o_orderkey % 2 WHEN 0 THEN 'CHK' ELSE 'OTCK' END
 WHEN o_orderpriority = '3-MEDIUM' THEN CASE o_orderkey % 3 WHEN 0 THEN 'CERT' WHEN 1 THEN 'TICD' ELSE 'RICD' END
 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CASE o_orderkey % 4 WHEN 0 THEN 'AUTO' WHEN 1 THEN 'CC' WHEN 2 THEN 'pers' ELSE 'HELC' END
 WHEN o_orderkey % 3 = 0 THEN concat('T', cast(12 + o_orderkey % 25 as string)) ELSE 'SPEC' END AS account_type,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS description,
 cast(CASE WHEN o_orderkey % 16 = 0 THEN 0 WHEN o_orderkey % 16 = 2 THEN 500 ELSE o_totalprice END as decimal(18,2)) AS current_balance,
 cast(o_orderdate as date) AS date_opened,
 CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate as date) + cast(o_orderkey % 900 as int) ELSE NULL END AS date_closed,
 CASE WHEN o_orderkey % 37 = 0 THEN cast(o_orderdate as date) + 400 ELSE NULL END AS charge_off_date,
 CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE cast(o_orderdate as date) + cast(o_orderkey % 2000 as int) END AS last_activity,
 CASE o_orderkey % 12 WHEN 0 THEN 'b' WHEN 1 THEN 'R' WHEN 2 THEN NULL ELSE 'N' END AS access_control,
 CASE o_orderkey % 8 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'closed' WHEN 2 THEN 'Frozen ' WHEN 3 THEN 'FRAUD' ELSE NULL END AS status,
 CASE o_orderkey % 10 WHEN 0 THEN '88' WHEN 1 THEN 'XXZ' WHEN 2 THEN 'PCN' WHEN 3 THEN NULL WHEN 4 THEN 'web' ELSE cast(o_orderkey % 110 as string) END AS created_by_userid
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "account_loan": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, o_orderkey AS account_id,
 cast(CASE o_orderkey % 3 WHEN 0 THEN 0 ELSE 1000 + o_orderkey % 4000 END as decimal(18,2)) AS credit_limit,
 DATE '2001-01-01' + cast(o_orderkey % 400 as int) AS credit_expiration,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_orderdate as date) + 7 END AS funded_date,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE DATE '2001-07-15' - cast(o_orderkey % 160 as int) + 20 END AS next_payment_date,
 CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE DATE '2001-07-15' - cast(o_orderkey % 200 as int) END AS last_payment_date,
 cast(o_totalprice as decimal(18,2)) AS opening_balance,
 cast(cast(o_orderkey % 1800 as decimal(18,3)) / 100 as decimal(9,3)) AS interest_rate,
 cast(o_orderkey % 72 as int) AS number_of_payments, cast(CASE o_orderkey % 3 WHEN 0 THEN 0 ELSE 12 END as int) AS payments_per_year,
 cast(600 + o_orderkey % 250 as int) AS credit_score,
 cast(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 3 END as int) AS delq_count_30,
 cast(o_orderkey % 2 as int) AS delq_count_60, 0 AS delq_count_90, 0 AS delq_count_120, 0 AS delq_count_150,
 cast(NULL as int) AS delq_count_180,
 cast(floor(o_totalprice / 10) as decimal(18,2)) AS interest_ytd,
 cast(CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE floor(o_totalprice / 9) END as decimal(18,2)) AS interest_lytd,
 cast(o_orderkey % 40 as decimal(18,2)) AS late_fees_ytd, cast(NULL as decimal(18,2)) AS late_fees_lytd
FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "transaction_history": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, (l_orderkey * 10 + l_linenumber) * 100 + k AS transaction_history_id,
 l_orderkey AS account_id, CASE WHEN o_custkey % 4 = 0 THEN o_custkey ELSE o_custkey + 1000000 END AS member_id, l_suppkey AS batch_number,
 CASE l_suppkey % 6 WHEN 0 THEN 'DRWDA1' WHEN 1 THEN ' drwd' WHEN 2 THEN 'TLTC' WHEN 3 THEN 'SHDV' WHEN 4 THEN 'CTDV' ELSE 'TLT' END AS tran_code,
 cast(l_shipdate as date) + cast(3 * (k - 1) as int) AS date_effective, cast(l_shipdate as date) + cast(3 * (k - 1) + 1 as int) AS date_actual,
 cast(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 0 ELSE l_extendedprice END as decimal(18,2)) AS total_amount,
 cast(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END as int) AS void_flag, l_partkey AS gl_chart_of_account_id,
 l_suppkey % 8 AS branch_config_id, cast(l_suppkey as string) AS user_id, l_linestatus AS description,
 l_shipdate AS created_timestamp, l_shipdate AS modified_timestamp
FROM (SELECT *, {repeats} AS k FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey) r""",
    "gl_chart_of_accounts": """
SELECT concat('cu', cast(p_partkey % 5 as string)) AS credit_union, p_partkey AS record_number,
 concat(cast(100 + p_partkey % 900 as string), '.', cast(cast(floor(p_partkey / 900) as int) as string)) AS account_number,
 p_name AS description, p_brand AS short_desc,
 CASE WHEN p_partkey % 29 = 0 THEN 'X' WHEN p_partkey % 3 = 0 THEN 'I' WHEN p_partkey % 3 = 1 THEN 'B' ELSE ' b ' END AS account_type,
 cast(CASE WHEN p_size > 40 THEN 1 ELSE 0 END as int) AS inactive,
 cast(CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END as int) AS restricted,
 CASE p_size % 3 WHEN 0 THEN 'y' WHEN 1 THEN 'N' ELSE NULL END AS controlled,
 cast(CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN p_retailprice ELSE -p_retailprice END as decimal(18,2)) AS balance,
 TIMESTAMP '1995-01-01 00:00:00' AS created_timestamp, TIMESTAMP '2001-01-01 00:00:00' AS modified_timestamp,
 cast(p_size as string) AS modified_by_userid
FROM {part}""",
    "gl_history": """
SELECT concat('cu', cast(p % 5 as string)) AS credit_union, l_orderkey * 10 + l_linenumber AS record_number,
 concat(cast(100 + p % 900 as string), '.', cast(cast(floor(p / 900) as int) as string)) AS gl_account_number,
 cast(l_shipdate as date) AS effective_date,
 cast(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END as decimal(18,2)) AS amount,
 l_suppkey AS batch_number, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'D' WHEN 3 THEN ' p' ELSE 'P' END AS status,
 CASE l_suppkey % 6 WHEN 0 THEN 'CU' WHEN 1 THEN 'JE' WHEN 2 THEN 'CT' WHEN 3 THEN 'AP' WHEN 4 THEN 'FA' ELSE 'ZZ' END AS source,
 CASE l_partkey % 6 WHEN 0 THEN 'eod ' WHEN 1 THEN '12-adj' WHEN 2 THEN 'CERT ACCRUAL' WHEN 3 THEN 'INVOICE' WHEN 4 THEN 'Depreciation' ELSE 'ME Loan x' END AS entry_desc,
 CASE l_orderkey % 9 WHEN 0 THEN 'dividend' WHEN 1 THEN 'INT-1' WHEN 2 THEN 'late fee' WHEN 3 THEN 'Summary' WHEN 4 THEN 'accrual' WHEN 5 THEN 'reversal' WHEN 6 THEN 'correction' WHEN 7 THEN 'adj' ELSE 'other' END AS description,
 l_suppkey % 8 AS branch_config_id, cast(l_shipdate as date) + 1 AS reference_date, cast(l_shipdate as date) + 2 AS actual_date,
 l_suppkey AS group_id, l_linenumber AS group_seq, cast(l_suppkey as string) AS posted_by_user,
 cast(l_linenumber % 2 as int) AS modified, 1 AS version, l_shipdate AS created_timestamp, 'u1' AS created_by_userid,
 l_shipdate AS modified_timestamp, 'u2' AS modified_by_userid
FROM (SELECT *, CASE WHEN l_linenumber <= 2 THEN 4 WHEN l_linenumber = 5 THEN 7 WHEN l_linenumber = 7 AND l_suppkey % 4 = 0 THEN 10
                     ELSE l_partkey END AS p FROM {lineitem}) g""",
    "account_types": """
SELECT concat('cu', cast(p_partkey % 5 as string)) AS credit_union,
 CASE WHEN p_partkey >= 60 THEN concat('T', cast(cast(floor(p_partkey / 5) as int) as string)) ELSE CASE cast(floor(p_partkey / 5) as int) WHEN 0 THEN 'PSAV' WHEN 1 THEN 'ssav' WHEN 2 THEN 'MMA' WHEN 3 THEN 'HYS' WHEN 4 THEN 'CHK' WHEN 5 THEN 'CERT' WHEN 6 THEN 'TICD' WHEN 7 THEN 'RICD' WHEN 8 THEN 'AUTO' WHEN 9 THEN 'CC' WHEN 10 THEN 'PERS' ELSE 'HELC' END END AS account_type,
 CASE WHEN p_partkey >= 60 THEN CASE p_partkey % 3 WHEN 0 THEN 'Share' WHEN 1 THEN 'CERT' ELSE 'loan ' END WHEN p_partkey < 25 THEN 'SHARE' WHEN p_partkey < 40 THEN 'cert ' ELSE 'LOAN' END AS category, p_name AS description,
 CASE WHEN p_partkey % 7 = 6 THEN NULL ELSE concat('00', concat(cast(100 + p_partkey % 900 as string), '.', cast(cast(floor(p_partkey / 900) as int) as string))) END AS div_int_acct,
 concat(' ', concat(cast(100 + (p_partkey + 60) % 900 as string), '.', cast(cast(floor((p_partkey + 60) / 900) as int) as string))) AS accrual_acct,
 CASE WHEN p_partkey >= 45 AND p_partkey < 50 THEN '1' WHEN p_partkey < 5 THEN 'x' ELSE '0' END AS credit_card,
 CASE cast(floor(p_partkey / 5) as int) WHEN 8 THEN '00' WHEN 9 THEN '18' WHEN 10 THEN '01' WHEN 11 THEN '89' ELSE NULL END AS cb_loan_type
FROM {part}""",
    "branch_config": """
SELECT 'cu0' AS credit_union, s_suppkey AS branch_config_id, cast(s_suppkey as string) AS branch_number,
 CASE WHEN s_suppkey = 6 THEN NULL ELSE 9000000 + s_suppkey END AS branch_entity_id
FROM {supplier} WHERE s_suppkey < 7""",
    "pd_xmaif": """
SELECT CASE r_regionkey WHEN 0 THEN 'D' WHEN 1 THEN 'DI' WHEN 2 THEN 'A' WHEN 3 THEN 'C' ELSE 'PC' END AS card_type,
 r_name AS description, CASE WHEN r_regionkey >= 3 THEN 'Y' ELSE 'N' END AS credit_card,
 CASE WHEN r_regionkey < 2 THEN 'Y' ELSE 'N' END AS debit_card, CASE WHEN r_regionkey = 2 THEN 'Y' ELSE 'N' END AS atm_card,
 CASE WHEN r_regionkey = 1 THEN NULL ELSE 'VISA' END AS card_issuer,
 cast(CASE WHEN r_regionkey = 1 THEN 1 ELSE 0 END as int) AS inactive_flag
FROM {region}""",
    "eft_card_file": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union,
 CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN -c_custkey ELSE c_custkey END AS member_number,
 c_custkey * 7919 AS record_number,
 CASE c_custkey % 6 WHEN 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 'D' ELSE 'd ' END WHEN 1 THEN 'DI' WHEN 2 THEN 'A' WHEN 3 THEN 'C' WHEN 4 THEN 'PC' ELSE 'ZZ' END AS card_type,
 DATE '1999-01-01' + cast(c_custkey % 700 as int) AS issue_date,
 CASE WHEN c_custkey % 8 = 0 THEN DATE '2001-02-01' ELSE NULL END AS block_date,
 DATE '2001-01-01' + cast(c_custkey * 13 % 800 as int) AS expire_date,
 cast(c_acctbal as decimal(18,2)) AS share_acct_bal, cast(NULL as decimal(18,2)) AS draft_acct_bal,
 CASE c_custkey % 21 WHEN 0 THEN '34' WHEN 1 THEN '36' WHEN 2 THEN '07' WHEN 3 THEN NULL ELSE '00' END AS reject_code,
 CASE c_custkey % 25 WHEN 0 THEN 'L' WHEN 1 THEN NULL ELSE ' ' END AS lost_or_stolen,
 CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE DATE '2001-07-15' - cast(c_custkey % 150 as int) END AS last_pin_used_date
FROM {customer}""",
    # Two application rows per selected member (the fixture's fan-out).
    "member_application": """
SELECT DISTINCT credit_union, member_number, cast(k as int) AS application_seq FROM (
 SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, c_custkey AS member_number, {seq12} AS k
 FROM {customer} WHERE c_custkey % 10 = 3) s""",
    "loan_application": """
SELECT concat('cu', cast(c_nationkey % 5 as string)) AS credit_union, event_id AS loan_application_id,
 CASE WHEN user_id % 53 = 0 THEN NULL WHEN user_id % 41 = 0 THEN -user_id ELSE user_id END AS member_number,
 cast(ts as date) AS application_date,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE cast(ts as date) + cast(event_id % 30 as int) END AS action_date,
 cast(event_id % 6 as int) AS loan_app_status_id, cast(event_id % 5 as int) AS loan_type_id,
 CASE WHEN event_type = 'error' THEN concat('r', cast(event_id % 3 as string)) ELSE NULL END AS denial_reason1,
 CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'low score' ELSE NULL END AS denial_reason2,
 CASE event_id % 2 WHEN 0 THEN '' ELSE 'dti' END AS denial_reason3,
 CASE WHEN event_id % 17 = 0 THEN 'other' ELSE NULL END AS loan_app_denial_other,
 CASE event_id % 7 WHEN 0 THEN '105' WHEN 1 THEN 'SYS' WHEN 2 THEN '42' WHEN 3 THEN NULL ELSE 'abc' END AS created_by_userid,
 event_id AS account_id, cast(value as decimal(18,2)) AS loan_amount,
 CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN 'false' ELSE 'bad' END AS funded_flag, '0' AS closed_flag,
 cast(NULL as string) AS auto_approved_flag, 'o1' AS loan_officer_userid, 'o2' AS approving_loan_officer_userid,
 ts AS created_timestamp
FROM {events} JOIN {customer} ON user_id = c_custkey""",
    "loan_app_status": """
SELECT credit_union, s.k AS loan_app_status_id, s.description, s.approved_flag, s.adverse_action_flag,
 s.withdrawn_flag, s.incomplete_flag FROM (
 SELECT concat('cu', cast(r_regionkey as string)) AS credit_union, {status_rows} AS s FROM {region}) g""",
    "loan_type": """
SELECT credit_union, s.loan_type_id, s.description FROM (
 SELECT concat('cu', cast(r_regionkey as string)) AS credit_union, {loan_type_rows} AS s FROM {region}) g""",
}


def logical_sql(name: str, dialect: str, table_ref=lambda t: t) -> str:
    """SQL text of one logical table for ``dialect`` ('spark' or 'duckdb').

    ``table_ref`` maps a driver-table name to the text put in its place.
    """
    subs = {t: table_ref(t) for t in DRIVER_TABLES}
    # Copies of the movements of a few busy members (two ids in every 500).
    busy = "CASE WHEN o_custkey % 500 = 7 THEN {many} WHEN o_custkey % 500 = 8 THEN {some} ELSE {one} END"
    lists = {n: ", ".join(map(str, range(1, k + 1))) for n, k in (("many", 60), ("some", 15), ("one", 1))}
    make = "[{}]" if dialect == "duckdb" else "array({})"
    subs["repeats"] = ("unnest({})" if dialect == "duckdb" else "explode({})").format(
        busy.format(**{n: make.format(v) for n, v in lists.items()}))
    subs["seq12"] = "unnest([1, 2])" if dialect == "duckdb" else "explode(array(1, 2))"
    subs["status_rows"] = _const_rows(dialect, _STATUS_FIELDS, _STATUS_ROWS)
    subs["loan_type_rows"] = _const_rows(dialect, _LOAN_TYPE_FIELDS, _LOAN_TYPE_ROWS)
    sql = _SQL[name].strip().format(**subs)
    if dialect == "spark":
        # Literal timestamps stay zone-less, like the ones read from parquet.
        sql = sql.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return sql


def st_sql(name: str, dialect: str, table_ref=lambda t: t) -> str:
    """SQL text of the single-tenant binding of ``name``: no tenant column, codes as stored."""
    inner = logical_sql(name, dialect, table_ref)
    columns = ", ".join(c for c in COLUMNS[name] if c != "credit_union")
    where = f" WHERE credit_union = '{ST_CODE_TENANT}'" if name in ST_CODE_TABLES else ""
    return f"SELECT {columns} FROM ({inner}) b{where}"
