"""Text helpers that must agree with Python's ``str.strip``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Python's str.strip() removes every Unicode whitespace character and the
# information separators U+001C..U+001F; SQL trim() only removes spaces.
STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip_unicode(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, STRIP_PATTERN, "")
