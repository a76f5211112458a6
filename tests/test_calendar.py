"""Month calendar and grid window (O1, O3 bounds)."""

import datetime as dt

from ledgerline.operators.calendar import add_months, grid_window, month_calendar
from ledgerline.operators.kpis import _minus_months


def test_month_calendar_bounds(spark):
    rows = [r[0] for r in month_calendar(spark, dt.date(2000, 11, 20), dt.date(2001, 2, 3)).collect()]
    assert rows == [dt.date(2000, 11, 1), dt.date(2000, 12, 1), dt.date(2001, 1, 1), dt.date(2001, 2, 1)]
    assert month_calendar(spark, dt.date(2001, 3, 1), dt.date(2001, 2, 1)).count() == 0


def test_grid_window_clipped_by_start():
    # 36 months back from July 2001 is July 1998 (37 months inclusive) ...
    assert grid_window(dt.date(1995, 1, 1), dt.date(2001, 7, 15), 36) == (dt.date(1998, 7, 1), dt.date(2001, 7, 1))
    # ... unless the GL start date is later.
    assert grid_window(dt.date(2000, 3, 9), dt.date(2001, 7, 15), 36) == (dt.date(2000, 3, 1), dt.date(2001, 7, 1))


def test_month_arithmetic():
    assert add_months(dt.date(2001, 1, 1), -1) == dt.date(2000, 12, 1)
    assert add_months(dt.date(2001, 12, 1), 1) == dt.date(2002, 1, 1)
    assert _minus_months(dt.date(2001, 3, 31), 1) == dt.date(2001, 2, 28)
    assert _minus_months(dt.date(2000, 7, 15), 12) == dt.date(1999, 7, 15)
