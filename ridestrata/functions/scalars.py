"""Small column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The countries whose holidays the date dimension labels.
COUNTRY_LABELS = {
    "ET": "Ethiopia",
    "ER": "Eritrea",
    "SV": "El Salvador",
    "CN": "China",
    "IN": "India",
    "PK": "Pakistan",
    "BD": "Bangladesh",
    "VN": "Vietnam",
    "US": "United States",
    "CA": "Canada",
}


def blank(text: Column) -> Column:
    """True for NULL and for text of nothing but spaces (tabs count as text). What sorts
    behind the blank is not, and need not be trimmed."""
    return F.coalesce((text < "!") & (F.trim(text) == ""), F.lit(True))


def rounded(value: Column, digits: int) -> Column:
    """Decimal rounding of the shortest form of a number, halves away from zero.

    Eighteen digits keep the column a plain 64-bit integer in Parquet."""
    return value.cast(f"decimal(18,{digits})")


def whole_number(value: Column) -> Column:
    """DOUBLE to INT by rounding (a plain cast would cut the fraction off)."""
    return F.rint(value).cast("int")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def labelled(code: Column, labels: dict[str, str]) -> Column:
    """Replace known codes by their label and leave the others as they are."""
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)


def share_percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """100 * part / whole, 0 when there is nothing to share."""
    ratio = 100 * part.cast("double") / F.nullif(whole, F.lit(0))
    return F.coalesce(F.round(ratio, digits), F.lit(0.0))
