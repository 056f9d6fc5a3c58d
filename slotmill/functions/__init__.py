"""Column expressions. Everything here stays inside the JVM."""

from slotmill.functions.dates import display_date, strict_date, tolerant_date
from slotmill.functions.names import (
    base_name,
    file_date,
    file_id,
    file_stem,
    file_version,
    parent_name,
    plain_name,
)
from slotmill.functions.numbers import lenient_double, lenient_number, lenient_text, strict_int
from slotmill.functions.text import field_count, is_nonblank, null_text

__all__ = [
    "base_name",
    "display_date",
    "field_count",
    "file_date",
    "file_id",
    "file_stem",
    "file_version",
    "is_nonblank",
    "lenient_double",
    "lenient_number",
    "lenient_text",
    "null_text",
    "parent_name",
    "plain_name",
    "strict_date",
    "strict_int",
    "tolerant_date",
]
