"""Pure ``Column -> Column`` builders.

All of these compile to Catalyst expressions (whole-stage codegen, no Python
worker) and are null-safe under ANSI mode: text is parsed with ``try_cast``
and ratios with ``try_divide``, so malformed input yields NULL, never a
failed task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohort_features.functions.catalog import (
    AGE_CAP_ABOVE,
    AGE_CAP_VALUE,
    CODE_GROUP_LETTERS,
    CODE_GROUP_RANGES,
    MALE_CODE,
)

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_numeric(c: Column | str) -> Column:
    """Text (or number) to double; malformed text -> NULL."""
    return _col(c).try_cast("double")


def code_group(code: Column | str) -> Column:
    """Diagnosis code -> chapter 1..20 from its first three characters.

    Letter prefixes map directly; otherwise the three characters are read as an
    integer and looked up in the inclusive range table. Gaps, malformed text,
    empty strings and NULL give NULL. (A flat CASE chain: a balanced CASE tree
    was faster in isolation but slower once fused with the 20-way count
    aggregate into one generated method.)
    """
    code = _col(code)
    head = F.substring(code, 1, 1)
    number = F.substring(code, 1, 3).try_cast("int")
    out = None
    for letter, group in CODE_GROUP_LETTERS:
        cond = head == F.lit(letter)
        out = F.when(cond, F.lit(group)) if out is None else out.when(cond, F.lit(group))
    for lo, hi, group in CODE_GROUP_RANGES:
        out = out.when(number.between(lo, hi), F.lit(group))
    return out


def truthy(c: Column | str) -> Column:
    """Non-null and non-zero (zero counts as missing)."""
    c = _col(c)
    return c.isNotNull() & (c != 0)


def fahrenheit_to_celsius(f: Column | str) -> Column:
    """(f - 32) * 5 / 9, with 0 and NULL treated as missing."""
    f = _col(f)
    return F.when(truthy(f), (f - 32) * 5 / 9)


def merge_truthy(a: Column | str, b: Column | str) -> Column:
    """Both truthy -> their average; else ``a`` if truthy; else ``b``."""
    a, b = _col(a), _col(b)
    return F.when(truthy(a) & truthy(b), (a + b) / 2).when(truthy(a), a).otherwise(b)


def round_half_up(x: Column | str, digits: int) -> Column:
    """Round a double to ``digits`` decimals, ties away from zero.

    The tie is judged on the double's shortest decimal text (1.005 -> 1.01),
    which is what Spark's ``round`` does.
    """
    return F.round(_col(x), digits)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den; NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(_col(num), _col(den))


def age_years(at: Column | str, born: Column | str) -> Column:
    """Whole years between two timestamps, birthday-exact, capped (E5).

    year difference, minus one when (month, day) of ``at`` is before that of
    ``born``; ages above 86 become 87. NULL if either side is NULL.
    """
    at, born = _col(at), _col(born)
    md_at = F.month(at) * 100 + F.dayofmonth(at)
    md_born = F.month(born) * 100 + F.dayofmonth(born)
    age = F.year(at) - F.year(born) - (md_at < md_born).cast("int")
    return F.when(age > AGE_CAP_ABOVE, F.lit(AGE_CAP_VALUE)).otherwise(age)


def binary_code(sex: Column | str, one_of: str = MALE_CODE) -> Column:
    """``one_of`` -> 0, anything else including NULL -> 1."""
    return F.when(_col(sex) == F.lit(one_of), F.lit(0)).otherwise(F.lit(1))


def mean(v: Column | str, scale: int | None = None) -> Column:
    """Aggregate: mean of the non-NULL values; NULL if there are none.

    By default Spark's ``avg`` over doubles: every value counts, NaN and
    infinities as IEEE arithmetic has them. With ``scale`` (for columns
    declared to hold at most that many decimals, such as money) the values are
    summed exactly as DECIMAL, so the mean is the same double on every
    partitioning, retry and engine; a value with no DECIMAL(28, scale) form
    (NaN, infinite, 10^(28-scale) or more) fails the query instead of leaving
    the mean.
    """
    v = _col(v)
    if scale is None:
        return F.avg(v.cast("double"))
    no_form = F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(float("inf")))
    exact = F.when(no_form, F.raise_error(F.lit("NaN or infinite value in a column with a declared scale"))).otherwise(v.cast(f"decimal(28,{scale})"))
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))


def array_slots(arr: Column | str, n: int, prefix: str, start: int = 0) -> list[Column]:
    """First ``n`` elements of an array column as ``prefix{i}`` columns (P6);
    NULL for slots that a shorter array does not have."""
    arr = _col(arr)
    return [F.get(arr, F.lit(i)).alias(f"{prefix}{i + start}") for i in range(n)]


def one_hot(c: Column | str, categories: list, prefix: str) -> list[Column]:
    """One 0/1 column per category value (E11); NULL input -> all zeros."""
    c = _col(c)
    return [
        F.when(c == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(f"{prefix}{v}")
        for v in categories
    ]


def key_bucket(key: Column | str, buckets: int = 100, salt: str = "") -> Column:
    """Deterministic bucket 0..buckets-1 from a key's MD5.

    The same key lands in the same bucket on every run, partitioning and
    engine, so splits built on it are reproducible and keep an entity whole.
    """
    text = F.concat(F.lit(salt), _col(key).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
