"""Money stays exact: cents for two decimals, and nothing else is bound."""

from decimal import Decimal

import pytest

from ledgerline.functions.common import from_cents, to_cents
from ledgerline.sources.tables import MONEY, Tables


def bind(spark, kind, name="gl_history", column="amount"):
    return Tables.from_frames({name: spark.createDataFrame([], f"{column} {kind}")}, "mt")[name]


@pytest.mark.parametrize("kind", ["double", "float", "decimal(18,4)", "string"])
def test_types_that_cents_cannot_hold_are_refused(spark, kind):
    for name, columns in MONEY.items():
        with pytest.raises(TypeError, match=columns[0]):
            bind(spark, kind, name, columns[0])


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(10,0)", "decimal(9,1)", "bigint"])
def test_exact_types_are_bound(spark, kind):
    assert bind(spark, kind).columns == ["amount"]


def test_cents_of_two_decimals(spark):
    values = [Decimal("0.29"), Decimal("1.15"), Decimal("-0.29"), Decimal("-1.15"), Decimal("0.00"), Decimal("9999999999999999.99"), None]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(18,2)")
    assert [r[0] for r in df.select(to_cents("x")).collect()] == [None if v is None else int(v * 100) for v in values]
    assert [r[0] for r in df.select(from_cents(to_cents("x"))).collect()] == values
