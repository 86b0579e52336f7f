"""Repair of names that were UTF-8 bytes decoded as ISO-8859-1 ("MaÃ¯s" → "Maïs").

Rule: a name is re-decoded only when every character fits in one ISO-8859-1
byte (otherwise it cannot be such mojibake) and the bytes form valid UTF-8;
in every other case the name is kept as it is. ``try_validate_utf8`` gives
NULL instead of raising on invalid bytes, so no ANSI error and no U+FFFD.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LATIN1_ONLY = r"^[\x00-\xFF]*$"


def repair_mojibake(c) -> Column:
    name = F.col(c) if isinstance(c, str) else c
    redecoded = F.try_validate_utf8(F.encode(name, "ISO-8859-1"))
    return F.when(name.rlike(_LATIN1_ONLY), F.coalesce(redecoded, name)).otherwise(name)


def make_mojibake(c) -> Column:
    """The inverse damage: UTF-8 bytes read as ISO-8859-1 (used to test the repair)."""
    name = F.col(c) if isinstance(c, str) else c
    return F.decode(F.encode(name, "UTF-8"), "ISO-8859-1")
