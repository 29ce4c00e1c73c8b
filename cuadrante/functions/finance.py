"""Loan arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEVER_SETTLED = 99
MINIMUM_SHARE = 0.0125


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)


def instalment(principal, monthly_rate, term) -> Column:
    """Constant instalment of a loan (French amortisation); P/n at a zero rate."""
    p, r, n = _col(principal), _col(monthly_rate), _col(term)
    growth = F.lit(1.0) - F.pow(F.lit(1.0) + r, -n)
    return F.when(r == 0, F.try_divide(p.cast("double"), n)).otherwise(F.try_divide(p * r, growth))


def months_to_settle(balance, payment, monthly_rate) -> Column:
    """Months until the balance is paid at this payment.

    0 when nothing is owed, 99 when the payment does not exceed the interest or
    the formula has no value (zero rate), else the number of periods up to 99.
    """
    b, p, r = _col(balance), _col(payment), _col(monthly_rate)
    interest = b * r
    periods = F.try_divide(F.ln(F.try_divide(p, p - interest)), F.ln(F.lit(1.0) + r))
    return (
        F.when(b <= 0, F.lit(0))
        .when(p <= interest, F.lit(NEVER_SETTLED))
        .otherwise(F.coalesce(F.least(F.ceil(periods), F.lit(NEVER_SETTLED)), F.lit(NEVER_SETTLED)))
        .cast("int")
    )


def minimum_payment(balance, monthly_rate) -> Column:
    """Least payment on revolving credit: the interest plus 1.25 % of the balance."""
    b, r = _col(balance), _col(monthly_rate)
    return F.when(b > 0, b * r + b * F.lit(MINIMUM_SHARE)).otherwise(F.lit(0.0))


def flat_instalment(principal, annual_rate, term) -> Column:
    """Instalment with the whole year's interest added up front: P (1 + annual) / n."""
    p, a, n = _col(principal), _col(annual_rate), _col(term)
    return F.try_divide(p * (F.lit(1.0) + a), n)


def debt_to_income(expense, income) -> Column:
    """Monthly expense over yearly income; null at zero income."""
    return F.try_divide(_col(expense), _col(income) * F.lit(12.0))
