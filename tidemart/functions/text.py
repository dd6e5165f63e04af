"""Names made safe for use as identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.scalar import ColumnOrName, column

# Fixed values: (pattern, replacement), applied in order to the lower-cased text.
_SLUG_RULES = [
    (r"[ -]+", "_"),
    (r"[^a-z0-9_]+", ""),
    (r"^([0-9])", r"_\1"),
]


def slugify(c: ColumnOrName) -> Column:
    out = F.lower(column(c))
    for pattern, replacement in _SLUG_RULES:
        out = F.regexp_replace(out, pattern, replacement.replace("\\", "$"))
    return out


def slugify_name(name: str) -> str:
    """The same rules for one name known while the query is written."""
    name = name.lower()
    for pattern, replacement in _SLUG_RULES:
        name = re.sub(pattern, replacement, name)
    return name
