"""Text helpers used by the document loaders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters the original menu loader strips from product text.
MENU_STRIP = r"[()\]]"


def strip_brackets(text: Column) -> Column:
    return F.regexp_replace(text, MENU_STRIP, "")
