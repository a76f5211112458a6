"""Member classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.common import col


def member_filter_columns(member_number="member_number", inactive_flag="inactive_flag",
                          all_closed="all_accounts_closed", code: Column | None = None) -> dict[str, Column]:
    """The dashboard filter columns shared by member and product reports.

    ``code`` is the inactive flag as printed (default: as compared).
    """
    n, f, c = col(member_number), col(inactive_flag), col(all_closed)
    return {
        "member_number_is_valid": F.when(n > 0, "Valid").otherwise("Invalid"),
        "member_inactive_flag_status": F.when(f == "I", "Inactive Flag").otherwise("Active Flag"),
        "member_accounts_status": (F.when(c == 1, "All Closed").when(c == 0, "Has Open Accounts")
                                   .otherwise("Unknown/NULL")),
        "member_inactive_flag_code": f if code is None else code,
        "member_all_accounts_closed_flag": c,
    }


def member_status_strict(member_number="member_number", inactive_flag="inactive_flag",
                         all_closed="all_accounts_closed", member_type="member_type",
                         require_type: bool = True) -> Column:
    """Active when the number is set, (the type is set,) some account is open
    and the flag is not 'I'; else Inactive."""
    cond = col(member_number).isNotNull()
    if require_type:
        cond = cond & col(member_type).isNotNull()
    cond = cond & (col(all_closed) == 0) & (col(inactive_flag) != "I")
    return F.when(cond, "Active").otherwise("Inactive")


def transaction_volume_category(n12) -> Column:
    """Yearly transaction count -> volume label (fixed label texts)."""
    n = col(n12)
    return (F.when(n == 0, "No Transactions").when(n <= 12, "Low Volume (≤12/year)")
            .when(n <= 52, "Medium Volume (13-52/year)").when(n <= 156, "High Volume (53-156/year)")
            .otherwise("Very High Volume (>156/year)"))


def transaction_scores(n30, n12) -> dict[str, Column]:
    """Engagement points from 30-day and yearly counts."""
    return {"transaction_score_30d": F.when(col(n30) > 0, 20).otherwise(0),
            "transaction_score_volume": F.when(col(n30) > 5, 10).otherwise(0),
            "transaction_score_annual": F.when(col(n12) > 52, 20).otherwise(0)}


def active_label(n) -> Column:
    return F.when(col(n) > 0, "Active").otherwise("Inactive")


def _cap(x: Column) -> Column:
    """Upper first letter, lower the rest (null in, null out)."""
    return F.concat(F.upper(F.substr(x, F.lit(1), F.lit(1))), F.lower(F.substr(x, F.lit(2))))


def full_name(first="name_first", middle="name_middle", last="name_last") -> Column:
    """Capitalized 'First [Middle] Last'; '[NULL]' means missing; a null part
    makes the whole name null (CONCAT semantics)."""
    f, m, la = col(first), col(middle), col(last)
    return (F.when(f.isNull() | (f == "[NULL]"), _cap(la))
            .when(m.isNotNull() & (m != "[NULL]") & (m != ""),
                  F.concat(_cap(f), F.lit(" "), _cap(m), F.lit(" "), _cap(la)))
            .otherwise(F.concat(_cap(f), F.lit(" "), _cap(la))))


def age_completed_years(dob, as_of) -> Column:
    """C4 (MT details): whole years between dob and as_of."""
    return F.timestamp_diff("YEAR", col(dob), F.lit(as_of)).cast("int")


def age_year_difference(dob, as_of) -> Column:
    """C4 (profile, ST): year(as_of) - year(dob)."""
    return (F.lit(as_of.year) - F.year(col(dob))).cast("int")


# Age brackets (lower, upper, lettered label, plain label); over 85 and unknown last.
AGE_BRACKETS = [
    (0, 17, "A. 0-17", "0-17"), (18, 25, "B. 18-25", "18-25"), (26, 35, "C. 26-35", "26-35"),
    (36, 45, "D. 36-45", "36-45"), (46, 55, "E. 46-55", "46-55"), (56, 65, "F. 56-65", "56-65"),
    (66, 75, "G. 66-75", "66-75"), (76, 85, "H. 76-85", "76-85"),
]
AGE_OVER_85 = ("I. 85+", "85+")


def age_group(age: Column, lettered: bool = True) -> Column:
    """C4: age bracket label, 'Unknown' when age is null or negative."""
    pick = 2 if lettered else 3
    out = None
    for b in AGE_BRACKETS:
        cond = age.between(b[0], b[1])
        out = F.when(cond, b[pick]) if out is None else out.when(cond, b[pick])
    return out.when(age > 85, AGE_OVER_85[pick - 2]).otherwise("Unknown")


def member_type_label(member_type: Column, corporate: str = "Corporate Member") -> Column:
    """P/B/C member type label."""
    return (F.when(member_type == "P", "Personal").when(member_type == "B", "Business")
            .when(member_type == "C", corporate).otherwise("Unknown"))


# Tenure brackets in days (exclusive upper bound) and labels.
TENURE_BRACKETS = [(183, "1. Recent (0-6 months)"), (365, "2. New (6-12 months)"),
                   (1095, "3. Established (1-3 years)"), (1825, "4. Mature (3-5 years)")]
TENURE_LAST = "5. Veteran (5+ years)"


def tenure_category(days: Column) -> Column:
    """Days since joining -> tenure label (null days -> veteran, as the text's ELSE)."""
    out = None
    for lim, lab in TENURE_BRACKETS:
        out = F.when(days < lim, lab) if out is None else out.when(days < lim, lab)
    return out.otherwise(TENURE_LAST)


def online_banking_status(home_bank_date="home_bank_date") -> Column:
    """C7."""
    return F.when(col(home_bank_date).isNotNull(), "Active").otherwise("Inactive")


def cap_name(x) -> Column:
    """Capitalized single name part, null for missing or '[NULL]'."""
    x = col(x)
    return F.when(x.isNull() | (x == "[NULL]"), F.lit(None).cast("string")).otherwise(_cap(x))


def gender_label(g="gender") -> Column:
    """C8."""
    g = col(g)
    return (F.when(g == "F", "Female").when(g == "M", "Male").when(g == "N", "Non-Binary")
            .when(g == "O", "Opt Out").otherwise("Unknown"))


def address_columns() -> dict[str, Column]:
    """Physical address for foreign members, else mailing; upper(trim());
    missing city/state/zip/country -> 'Unknown'."""
    foreign = F.col("foreign_address") == 1

    def pick(mail: str, phys: str, unknown: bool) -> Column:
        m, p = F.upper(F.trim(mail)), F.upper(F.trim(phys))
        if unknown:
            m, p = F.coalesce(m, F.lit("Unknown")), F.coalesce(p, F.lit("Unknown"))
        return F.when(foreign, p).otherwise(m)

    city, state = pick("city", "physical_city", True), pick("state", "physical_state", True)
    return {"address1": pick("address1", "physical_address1", False),
            "address2": pick("address2", "physical_address2", False),
            "city": city, "state": state,
            "zip_code": pick("zip", "physical_zip", True),
            "country": pick("country", "physical_country", True),
            "city_state": F.concat(city, F.lit(", "), state),
            "address_type_used": F.when(foreign, "Physical").otherwise("Mailing")}


def activity_within(last_activity, as_of, days: int) -> Column:
    """Active within ``days`` of as_of, Inactive if older, Unknown if null."""
    import datetime as dt
    la = col(last_activity)
    return (F.when(la >= F.lit(as_of - dt.timedelta(days=days)), "Active")
            .when(la.isNotNull(), "Inactive").otherwise("Unknown"))


def product_relationship(counts: dict[str, Column], total: Column) -> dict[str, Column]:
    """has_* flags (0/1), number of product types held, sum of counts and
    the relationship category (No Products / Single / Full / Multi / Unknown)."""
    has = {k: F.when(F.coalesce(c, F.lit(0)) > 0, 1).otherwise(0) for k, c in counts.items()}
    n_types = None
    for h in has.values():
        n_types = h if n_types is None else n_types + h
    total_by_type = None
    for c in counts.values():
        c0 = F.coalesce(c, F.lit(0))
        total_by_type = c0 if total_by_type is None else total_by_type + c0
    cat = (F.when(F.coalesce(total, F.lit(0)) == 0, "No Products").when(n_types == 1, "Single Product")
           .when(n_types == 4, "Full Relationship").when(n_types.between(2, 3), "Multi Product")
           .otherwise("Unknown"))
    return {"has": has, "distinct_product_types_count": n_types, "total_products_by_type": total_by_type,
            "product_relationship_category": cat}


def engagement_score(home_bank_date, last_activity, total_accounts: Column, as_of) -> Column:
    """C11: 40 online banking + 30 active in 30 days + 20 active in 90 days +
    10 more than one open account (the 30 and 20 both apply to recent activity)."""
    import datetime as dt
    la = col(last_activity)
    return (F.when(col(home_bank_date).isNotNull(), 40).otherwise(0)
            + F.when(la >= F.lit(as_of - dt.timedelta(days=30)), 30).otherwise(0)
            + F.when(la >= F.lit(as_of - dt.timedelta(days=90)), 20).otherwise(0)
            + F.when(F.coalesce(total_accounts, F.lit(0)) > 1, 10).otherwise(0))


# Member lifespan brackets in days (exclusive upper bound) and labels.
LIFESPAN_BRACKETS = [(90, "Early (0-3 months)"), (365, "Short (3-12 months)"), (1095, "Medium (1-3 years)"),
                     (1825, "Long (3-5 years)")]
LIFESPAN_LAST = "Very Long (5+ years)"


def attrition_category(lifespan: Column) -> Column:
    """C11: lifespan bracket (callers null it when the member did not attrite)."""
    out = None
    for lim, lab in LIFESPAN_BRACKETS:
        out = F.when(lifespan < lim, lab) if out is None else out.when(lifespan < lim, lab)
    return out.otherwise(LIFESPAN_LAST)
