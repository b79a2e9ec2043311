"""Code and label expressions of encounter tables (all built-in expressions)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age brackets in order.
AGE_BRACKETS = (
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
)

# ICD-9 chapters as (label, low, high, extra whole code), tested in this order.
ICD9_CHAPTERS = (
    ("Diabetes", None, None, 250),
    ("Circulatory", 390, 459, 785),
    ("Respiratory", 460, 519, 786),
    ("Digestive", 520, 579, 787),
    ("Injury", 800, 999, None),
    ("Musculoskeletal", 710, 739, None),
    ("Genitourinary", 580, 629, 788),
    ("Neoplasms", 140, 239, None),
)

# Code groups of the admission, discharge and source columns.
ADMISSION_GROUPS = {"emergency_or_trauma": ("1", "7"), "urgent": ("2",), "elective": ("3",), "newborn": ("4",)}
DISCHARGE_GROUPS = {
    "home": ("1", "6", "8"),
    "transfer": ("2", "3", "4", "5", "10", "15", "22", "23", "24", "27", "28", "29", "30"),
    "expired": ("11", "19", "20", "21"),
    "hospice": ("13", "14"),
    "left_ama": ("7",),
    "inpatient": ("9",),
}
SOURCE_GROUPS = {
    "er": ("7",),
    "referral": ("1", "2", "3"),
    "transfer": ("4", "5", "6", "10", "18", "22", "25", "26"),
    "newborn": ("11", "12", "13", "14", "23", "24"),
    "home_health_readmit": ("19",),
}


_NUMERIC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _number(text: Column) -> Column:
    """Double of a plain decimal text, else null. The pattern keeps failing casts (slow) off the hot path."""
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def _bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once per row, however often ``fn`` mentions it."""
    return F.transform(F.array(value), fn)[0]


def normalise_code(code: Column) -> Column:
    """``' 7.0 '`` -> ``'7'``; text that is no number is only trimmed."""
    text = F.trim(code.cast("string"))
    return F.coalesce(_number(text).try_cast("bigint").cast("string"), text)


def icd9_group(code: Column) -> Column:
    """One of nine diagnosis groups; anything not numeric or in no chapter is Other."""
    text = F.trim(code.cast("string"))
    return F.coalesce(_bind(_number(text), _chapter), F.lit("Other"))


def _chapter(x: Column) -> Column:
    out = F.lit("Other")
    for label, low, high, extra in reversed(ICD9_CHAPTERS):
        hit = F.lit(False)
        if low is not None:
            hit |= (x >= low) & (x <= high)
        if extra is not None:
            hit |= (x >= extra) & (x < extra + 1)  # any decimals of that whole code
        out = F.when(hit, label).otherwise(out)
    return out


def age_ordinal(age: Column) -> Column:
    """1..10 for the ten brackets, 0 for anything else."""
    pairs = [F.lit(x) for i, a in enumerate(AGE_BRACKETS, 1) for x in (a, i)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), age.cast("string")), F.lit(0))


def code_group(code: Column, groups: Mapping[str, Sequence[str]], default: str = "other") -> Column:
    """First group whose code set holds the trimmed code."""
    text = F.trim(code.cast("string"))
    out = F.lit(default)
    for label, codes in reversed(list(groups.items())):
        out = F.when(text.isin(list(codes)), label).otherwise(out)
    return out
