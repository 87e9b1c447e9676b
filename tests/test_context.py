from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st

from daybook.context import RunContext


@pytest.mark.parametrize(
    "run_date, txn_date, month_start, month_end, month, gate",
    [
        ("2021-03-01", "2021-02-28", "2021-02-01", "2021-03-01", "2021-02", True),
        ("2020-03-01", "2020-02-29", "2020-02-01", "2020-03-01", "2020-02", True),
        ("2021-01-01", "2020-12-31", "2020-12-01", "2021-01-01", "2020-12", True),
        ("2021-03-31", "2021-03-30", "2021-02-01", "2021-03-01", "2021-02", False),
    ],
)
def test_periods(run_date, txn_date, month_start, month_end, month, gate):
    ctx = RunContext(date.fromisoformat(run_date))
    assert ctx.txn_date == txn_date
    assert ctx.month_start.isoformat() == month_start
    assert ctx.month_end_excl.isoformat() == month_end
    assert ctx.txn_month == month
    assert ctx.is_month_start is gate


@given(st.dates(date(1990, 1, 1), date(2100, 1, 1)), st.integers(0, 90))
def test_periods_are_consistent(run_date, lag):
    ctx = RunContext(run_date, lag)
    assert (run_date - ctx.txn_day).days == lag
    assert ctx.month_start.day == ctx.month_end_excl.day == 1
    assert 28 <= (ctx.month_end_excl - ctx.month_start).days <= 31
    assert ctx.month_end_excl <= run_date
    assert ctx.txn_month == ctx.month_start.strftime("%Y-%m")
