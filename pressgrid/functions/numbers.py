"""Lenient numeric expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgrid.functions.text import let, strip

# Decimal notation only: a bare cast would also read "1.0d" and "2f".
_NUMBER = r"^[+-]?(\d+(_\d+)*([.](\d+(_\d+)*)?)?|[.]\d+(_\d+)*)([eE][+-]?\d+)?$"
_SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"


def to_number(col: Column) -> Column:
    """The text as a double, or null when it is empty or not a number."""

    def parse(text: Column) -> Column:
        plain = F.replace(text, F.lit("_"), F.lit(""))
        return F.when(
            text.rlike(_NUMBER) | text.rlike(_SPECIAL),
            F.regexp_replace(plain, r"(?i)^[+-](?=nan)", "").try_cast("double"),
        )

    return let(strip(col), parse)


def first_number(*cols: Column) -> Column:
    """The first column that holds a number; unparseable values fall through to the next."""
    return F.coalesce(*map(to_number, cols))
