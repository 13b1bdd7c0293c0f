"""Key normalisation shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The blanks around keys that do not belong to them.
BLANKS = " \t\n"


def strip_key(column: Column | str) -> Column:
    """The key without surrounding space, tab or newline; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.trim(column, F.lit(BLANKS))


def hex32_uuid(column: Column | str) -> Column:
    """The last 32 hexadecimal digits in lower-case 8-4-4-4-12 form.

    Braces, hyphens, blanks and a ``urn:uuid:`` prefix are notation only. A text
    with fewer than 32 digits has no identifier and gives null.
    """
    column = F.col(column) if isinstance(column, str) else column
    bare = F.lower(F.regexp_replace(column, r"[\s{}\-]", ""))
    digits = F.regexp_extract(bare, r"([0-9a-f]{32})$", 1)
    dashed = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(digits != "", dashed)
