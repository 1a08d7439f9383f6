"""Array maths as Column expressions (higher-order functions run in the JVM).

A small vector lives in one ``ArrayType`` cell; a long one is a column of a
table (``spark.range`` or any table column), where elementwise maths is just
column arithmetic.  Positions follow the reference: 0-based, end-exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(a: Column | str) -> Column:
    return F.col(a) if isinstance(a, str) else a


def as_double(a: Column | str) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def add(a: Column | str, b: Column | str, strict: bool = True) -> Column:
    """Elementwise sum; integers stay integers.  ``zip_with`` pads the shorter array with NULL;
    ``strict`` raises instead, as the reference does on unequal shapes."""
    a, b = _c(a), _c(b)
    out = F.zip_with(a, b, lambda x, y: x + y)
    if not strict:
        return out
    return F.when(F.size(a) == F.size(b), out).otherwise(
        F.raise_error(F.lit("operands could not be broadcast together: unequal lengths")))


def scale(a: Column | str, k: int | float) -> Column:
    """Elementwise product with a scalar; integers times an integer stay integers."""
    return F.transform(_c(a), lambda x: x * F.lit(k))


def square(c: Column | str) -> Column:
    """``x ** 2`` as ``x * x``: stays integral for integral input."""
    c = _c(c)
    return c * c


def element(a: Column | str, i: int, strict: bool = True) -> Column:
    """``a[i]`` (0-based); out of range raises when strict, else NULL."""
    a = _c(a)
    if strict:
        return F.element_at(a, i + 1) if i >= 0 else F.element_at(a, i)
    return F.get(a, i)


def slice0(a: Column | str, start: int, stop: int) -> Column:
    """``a[start:stop]``, 0-based and end-exclusive."""
    return F.slice(_c(a), start + 1, max(0, stop - start))


def reverse(a: Column | str) -> Column:
    """``a[::-1]``."""
    return F.reverse(_c(a))


def _row_numbers(a: Column, n_cols: int) -> Column:
    """0, 1, ... for each row of a row-major array; sizes that ``n_cols`` does not divide raise."""
    if n_cols < 1:
        raise ValueError(f"cannot reshape into rows of {n_cols}")
    size = F.size(a)
    uneven = F.raise_error(F.concat(F.lit("cannot reshape array of size "), size, F.lit(f" into rows of {n_cols}")))
    n_rows = F.when(size % n_cols != 0, uneven.cast("int")).otherwise(F.floor(size / n_cols).cast("int"))
    return F.slice(F.sequence(F.lit(0), n_rows), 1, n_rows)


def reshape(a: Column | str, n_cols: int) -> Column:
    """1-D array to rows of ``n_cols`` (row-major), e.g. pixels x channels; no rows for an empty array."""
    a = _c(a)
    return F.transform(_row_numbers(a, n_cols), lambda i: F.slice(a, i * n_cols + 1, n_cols))


def axis_mean(a: Column | str, n_cols: int) -> Column:
    """Mean over the last axis of a row-major (rows x n_cols) array, e.g. the
    grey level of every pixel from its channels; empty for an empty array."""
    a = _c(a)
    return F.transform(
        _row_numbers(a, n_cols),
        lambda i: F.aggregate(F.slice(a, i * n_cols + 1, n_cols), F.lit(0.0),
                              lambda acc, x: acc + x.cast("double")) / F.lit(float(n_cols)))


def zeros(n: Column | int) -> Column:
    return F.array_repeat(F.lit(0.0), n if isinstance(n, Column) else F.lit(n))


def ones(n_rows: Column | int, n_cols: Column | int) -> Column:
    r = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    c = n_cols if isinstance(n_cols, Column) else F.lit(n_cols)
    return F.array_repeat(F.array_repeat(F.lit(1.0), c), r)


def arange(start: Column | int, stop: Column | int, step: int = 1) -> Column:
    """Integers ``start, start+step, ...`` below ``stop`` (end-exclusive, step > 0)."""
    s = start if isinstance(start, Column) else F.lit(start)
    e = stop if isinstance(stop, Column) else F.lit(stop)
    s, e = s.cast("long"), e.cast("long")
    return F.when(e > s, F.sequence(s, e - 1, F.lit(step).cast("long"))).otherwise(
        F.array().cast("array<bigint>"))


def float_grid(n: int, step_num: int, step_den: int) -> Column:
    """``k * step_num / step_den`` for k in 0..n-1 as doubles: never accumulated,
    so every point equals its closed form (``np.arange(0, x, 0.02)``); none for n <= 0."""
    if n <= 0:
        return F.array().cast("array<double>")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda k: (k * step_num) / F.lit(float(step_den)))


def coin(key: Column, seed: int, sides: int = 2) -> Column:
    """A seeded draw in ``0..sides-1`` from a row key: the last hex digit of
    ``md5('<seed>:<key>')`` modulo ``sides`` (uniform for ``sides`` dividing 16).

    It depends on the key only, so it is the same on every partitioning and
    after any retry, unlike ``rand(seed)``.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    digit = F.conv(F.substring(h, 32, 1), 16, 10).cast("int")
    return (digit % sides).cast("int")


def randint(key: Column, low: int, high: int, seed: int) -> Column:
    """``randint(low, high)`` per row (high exclusive) from a row key: 60 bits
    of ``md5('<seed>:<key>')`` modulo the range — reproducible on any
    partitioning and after retries."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    bits = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    return (F.lit(low) + F.pmod(bits, F.lit(high - low))).cast("long")
