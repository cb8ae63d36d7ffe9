"""Keys, guarded arithmetic, formatting and argument checks."""

from __future__ import annotations

from numbers import Real

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "__dbt_null__"  # fixed value: NULL marker inside surrogate keys


def surrogate_key(*cols: Column) -> Column:
    """md5 over the text form of the columns, NULLs marked, joined by ``||``."""
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN))
                                     for c in cols]))


def padded(number: Column, width: int) -> Column:
    """Zero-padded text that grows past ``width`` instead of being cut."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def safe_div(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den`` for positive denominators, ``default`` otherwise."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def rounded(value: Column, digits: int) -> Column:
    """Round half up on the decimal value, so that 55.85 held as 55.849999999999994 gives 55.9
    whatever the order in which a sum was formed."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def count_when(condition: Column) -> Column:
    """Number of rows for which the condition holds, as a mergeable sum."""
    return F.count(F.when(condition, F.lit(1)))


def compact_number(value: Column) -> Column:
    """Short text for a figure: 1.2K, 3.4M, otherwise grouped digits; NULL becomes N/A."""
    v = value.cast("double")
    return (
        F.when(v.isNull(), F.lit("N/A"))
        .when(v >= 1e6, F.concat(F.format_string("%.1f", v / 1e6), F.lit("M")))
        .when(v >= 1e3, F.concat(F.format_string("%.1f", v / 1e3), F.lit("K")))
        .when(v == F.floor(v), F.format_number(v, 0))
        .otherwise(F.format_number(v, 1))
    )


def _reject(name: str, wanted: str) -> None:
    raise ValueError(f"{name} must be {wanted}")


def _is_int(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _is_real(value: object) -> bool:
    return isinstance(value, Real) and not isinstance(value, bool)


def require_positive_int(value: int, name: str) -> int:
    return value if _is_int(value) and value > 0 else _reject(name, "a positive integer")


def require_non_negative_int(value: int, name: str) -> int:
    return value if _is_int(value) and value >= 0 else _reject(name, "a non-negative integer")


def require_positive_number(value: Real, name: str) -> float:
    return float(value) if _is_real(value) and value > 0 else _reject(name, "a positive number")


def require_non_negative_number(value: Real, name: str) -> float:
    return float(value) if _is_real(value) and value >= 0 \
        else _reject(name, "a non-negative number")


def require_ratio(value: Real, name: str) -> float:
    return float(value) if _is_real(value) and 0 <= value <= 1 \
        else _reject(name, "between 0 and 1")
