"""Column expressions shared by the operators. All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhawk.schemas import OPEN_END


def open_end() -> Column:
    return F.lit(OPEN_END)


def time_of_day(ts: str | Column) -> Column:
    """Time of day as ``HH:mm:ss`` text (stands in for a TIME(0) column)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "HH:mm:ss")


def decimal_comma(text: str | Column, precision: int = 30, scale: int = 2) -> Column:
    """Parse ``1234,56`` into a decimal; NULL for text that is not a number."""
    c = F.col(text) if isinstance(text, str) else text
    cleaned = F.regexp_replace(F.trim(c), ",", ".")
    return cleaned.try_cast(f"decimal({precision},{scale})")


def day_from_name(path: str | Column) -> Column:
    """Business day from a file name ending in ``_DDMMYYYY.<ext>``."""
    c = F.col(path) if isinstance(path, str) else path
    digits = F.regexp_extract(c, r"_(\d{8})\.[^./]+$", 1)
    return F.when(digits != "", F.try_to_timestamp(digits, F.lit("ddMMyyyy")).cast("date"))


def full_name(last: str, first: str, patronymic: str) -> Column:
    """``last || ' ' || first || ' ' || patronymic``: NULL if any part is NULL."""
    return F.concat(F.col(last), F.lit(" "), F.col(first), F.lit(" "), F.col(patronymic))
