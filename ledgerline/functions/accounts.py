"""Account classifiers."""

from __future__ import annotations

from pyspark.sql import Column

from ledgerline.functions.common import case_map

# Discriminator -> upper-case category label.
ACCOUNT_CATEGORY = {"S": "SAVINGS", "D": "CHECKING", "C": "CERTIFICATES", "L": "LOANS", "U": "SPECIAL"}


def account_category(discriminator: Column) -> Column:
    """C20: discriminator code -> SAVINGS/CHECKING/CERTIFICATES/LOANS/SPECIAL, else OTHER."""
    return case_map(discriminator, ACCOUNT_CATEGORY, "OTHER")


# Discriminator -> product type label (member details).
PRODUCT_TYPE = {"S": "Savings", "D": "Checkings", "L": "Loan", "C": "Certificate", "U": "Custom"}


def product_type(discriminator: Column) -> Column:
    """C17: product type label, null for other codes."""
    return case_map(discriminator, PRODUCT_TYPE)


def account_open_columns(date_closed: Column) -> dict[str, Column]:
    """C17: 'Still Open' or the close date as yyyy-MM-dd text; Active/Closed."""
    from pyspark.sql import functions as F
    return {"date_closed": F.when(date_closed.isNull(), "Still Open")
            .otherwise(F.date_format(date_closed, "yyyy-MM-dd")),
            "product_status": F.when(date_closed.isNull(), "Active").otherwise("Closed")}


# Creator ids of automated processes.
AUTOMATED_USER_IDS = ["88", "87", "92", "95", "XXZ"]


def account_channel(has_application: Column, userid: Column) -> Column:
    """Online Application / Automated Process / Staff-Assisted (numeric id) /
    Migration ('PCN') / Unknown."""
    from pyspark.sql import functions as F
    return (F.when(has_application, "Online Application").when(userid.isin(*AUTOMATED_USER_IDS), "Automated Process")
            .when(userid.rlike(r"^[0-9]+$"), "Staff-Assisted").when(userid == "PCN", "Migration")
            .otherwise("Unknown"))


# Fixed values: (discriminator, account type or None for any) -> description, first match wins.
ACCOUNT_TYPE_DESCRIPTION = [
    ("S", "PSAV", "Savings"), ("S", "SSAV", "Savings"), ("S", "MMA", "Money Market"),
    ("S", "CCO", "Share Certificate"), ("S", "CLUB", "Club Savings"), ("S", "HYS", "High Yield Savings"),
    ("S", "YSAV", "Youth Savings"), ("S", "SCO", "Share Certificate"), ("S", None, "Other Savings"),
    ("D", "CHK", "Checking"), ("D", None, "Other Checking"),
    ("C", "CERT", "Certificate"), ("C", "TICD", "Term Certificate"), ("C", "RICD", "IRA Certificate"),
    ("C", None, "Other Certificate"), ("U", None, "Special Account"),
]


def account_type_description(disc: Column, atype: Column, raw_disc: Column, raw_type: Column) -> Column:
    """Description by discriminator and type; else 'disc-type' text."""
    from pyspark.sql import functions as F
    out = None
    for d, t, label in ACCOUNT_TYPE_DESCRIPTION:
        cond = (disc == d) if t is None else ((disc == d) & (atype == t))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.concat(raw_disc.cast("string"), F.lit("-"), raw_type.cast("string")))


# Discriminator -> main category of deposit accounts.
MAIN_ACCOUNT_CATEGORY = {"S": "SAVINGS", "D": "CHECKING", "C": "CERTIFICATES", "U": "SPECIAL"}


def main_account_category(disc: Column) -> Column:
    """C20 (deposit form): SAVINGS/CHECKING/CERTIFICATES/SPECIAL, else OTHER."""
    return case_map(disc, MAIN_ACCOUNT_CATEGORY, "OTHER")


def account_deleted_status(date_closed: Column, access: Column) -> Column:
    """Deleted (closed), Blocked (access B/R), else Enabled."""
    from pyspark.sql import functions as F
    return (F.when(date_closed.isNotNull(), "Deleted").when(access.isin("B", "R"), "Blocked")
            .otherwise("Enabled"))
