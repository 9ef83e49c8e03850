"""Tolerant casts and the sales amount / price repair (Column -> Column).

Repair rules, applied in order to text columns sales ``s``, quantity ``q``
and price ``p``:

1. amount: ``q * |p|`` when ``s`` is null, ``s <= 0`` or ``s`` fails the
   consistency check; otherwise ``s``.
   * ``rule="ratio"`` checks ``s == q * |s / q|`` in IEEE doubles, exactly
     as the source system does (for q > 0 this only fires through float
     rounding, e.g. s=1, q=49).
   * ``rule="price"`` checks ``s == q * |p|`` as its documentation promises.
2. price: ``s' / q`` when ``p`` is null or ``p <= 0`` and ``q != 0``.
3. price: ``s' / q`` whenever it differs from the price of step 2.

The amount is read as a 32-bit float and widened to double, the quantity is
a 32-bit float, the price a double: the same types the source system
produces. Division uses ``try_divide`` so a zero quantity gives null instead
of an error; text that does not parse is null instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.util import as_col


def tolerant_cast(c: Column | str, dtype: str) -> Column:
    """Cast that yields null for unreadable values instead of raising."""
    return as_col(c).try_cast(dtype)


def repaired_amount(sales: Column | str, quantity: Column | str, price: Column | str,
                    rule: str = "ratio") -> Column:
    s = tolerant_cast(sales, "float").cast("double")
    q = tolerant_cast(quantity, "double")
    p = tolerant_cast(price, "double")
    if rule == "ratio":
        consistent = s == q * F.abs(F.try_divide(s, q))
    elif rule == "price":
        consistent = s == q * F.abs(p)
    else:
        raise ValueError(f"unknown amount rule {rule!r}")
    bad = s.isNull() | (s <= 0) | ~consistent
    return F.when(bad, q * F.abs(p)).otherwise(s)


def repaired_price(amount: Column | str, quantity: Column | str, price: Column | str) -> Column:
    """``amount`` is the repaired (double) amount; ``quantity`` and
    ``price`` are raw text."""
    s = as_col(amount)
    q = tolerant_cast(quantity, "float")
    p = tolerant_cast(price, "double")
    ratio = F.try_divide(s, q)
    first = F.when((p.isNull() | (p <= 0)) & (q != 0), ratio).otherwise(p)
    return F.when(ratio != first, ratio).otherwise(first)


def repair_sales_columns(sales: str = "sls_sales", quantity: str = "sls_quantity",
                         price: str = "sls_price", rule: str = "ratio") -> dict[str, Column]:
    """The three repaired columns, ready for ``withColumns``."""
    amount = repaired_amount(sales, quantity, price, rule)
    return {
        sales: amount,
        quantity: tolerant_cast(quantity, "float"),
        price: repaired_price(amount, quantity, price),
    }
