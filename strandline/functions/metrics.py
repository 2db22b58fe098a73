"""Report-line expressions: field extraction and unit stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_field(line: Column | str, n: int, delim: str = " ") -> Column:
    """``cut -d <delim> -f <n>``: the n-th field (1-based); every delimiter
    separates, so repeated blanks give empty fields; beyond the last field
    gives ``''``; a line without the delimiter is returned whole."""
    line = _col(line)
    return F.when(F.instr(line, delim) == 0, line).otherwise(
        F.split_part(line, F.lit(delim), F.lit(n)))


def strip_unit(value: Column, unit: str) -> Column:
    """Remove every occurrence of ``unit`` (``sed s/MB//g``)."""
    return F.replace(value, F.lit(unit), F.lit(""))


def report_value(line: Column | str, n: int, unit: str, to_type: str = "bigint") -> Column:
    """Field ``n`` of a report line without its unit, as a number (NULL if not one)."""
    return strip_unit(cut_field(line, n), unit).try_cast(to_type)
