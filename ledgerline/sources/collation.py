"""How a single-tenant database compares codes.

The single-tenant reports compare code columns bare and rely on the
database's collation.  The rule for every column in ``CODES``: upper and lower
case are equal and trailing blanks do not count; a leading blank does.  GL
numbers compare as numbers in that database (blanks and leading zeros do not
count); the plans read them through ``functions.gl``.

``st_view`` replaces a code column by its comparison form and keeps the stored
text, which is what the reports print, under ``stored_<column>``.  Every
``Tables`` constructor applies it to the tables of tenancy "st".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

STORED = "stored_"

# Logical table -> code columns that the single-tenant reports compare.
CODES: dict[str, tuple[str, ...]] = {
    "account": ("discriminator", "account_type", "access_control", "status"),
    "account_types": ("account_type", "category"),
    "gl_chart_of_accounts": ("account_type", "controlled"),
    "gl_history": ("status", "source", "entry_desc"),
    "transaction_history": ("tran_code",),
    "loan_app_status": ("description",),
    "eft_card_file": ("card_type", "reject_code"),
    "pd_xmaif": ("card_type", "credit_card", "debit_card", "atm_card"),
    "member": ("inactive_flag", "member_type"),
    "entity": ("gender",),
}


def st_view(name: str, df: DataFrame) -> DataFrame:
    """Comparison forms for the code columns of table ``name``, stored texts beside them (idempotent)."""
    codes = [c for c in CODES.get(name, ()) if c in df.columns and f"{STORED}{c}" not in df.columns]
    if not codes:
        return df
    text = [c for c in codes if isinstance(df.schema[c].dataType, StringType)]
    return df.select(*[F.upper(F.rtrim(F.col(c))).alias(c) if c in text else F.col(c) for c in df.columns],
                     *[F.col(c).alias(f"{STORED}{c}") for c in codes])
