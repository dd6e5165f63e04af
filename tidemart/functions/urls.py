"""Parts of a URL held as text; works without a scheme, unlike ``parse_url``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.scalar import ColumnOrName, column

# The schemes each function removes, wherever they occur.
HOST_SCHEMES = ["android-app://", "http://", "https://"]
PATH_SCHEMES = ["http://", "https://"]


def _without(c: Column, texts: list[str]) -> Column:
    for text in texts:
        c = F.replace(c, F.lit(text), F.lit(""))
    return c


def _before(c: Column, delimiter: str) -> Column:
    return F.substring_index(c, delimiter, 1)


def url_host(c: ColumnOrName) -> Column:
    return _before(_before(_without(column(c), HOST_SCHEMES), "/"), "?")


def url_path(c: ColumnOrName) -> Column:
    """Text after the first slash up to ``?``.

    Without a slash the cut is just before ``?``, which leaves an empty path;
    with neither, the whole text is the path.
    """
    bare = _without(column(c), PATH_SCHEMES)
    slash, query = F.instr(bare, "/"), F.instr(bare, "?")
    cut = F.when(slash > 0, slash).when(query > 0, query - 1).otherwise(F.lit(-1))
    return _before(F.substr(bare, F.greatest(cut, F.lit(0)) + 1), "?")


def url_parameter(c: ColumnOrName, name: str) -> Column:
    """Value after the first ``name=``; NULL if missing or empty."""
    after = F.split_part(column(c), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(after, "&"), F.lit(""))
