"""List-valued text (amenities) as Spark arrays, with higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabforge.functions.common import as_col

# Column-name slug rule for a vocabulary token.
SLUG_STRIP = r"[^a-z0-9]+"
SLUG_PREFIX = "amenity_"
SLUG_EMPTY = "amenity_other"
WHITE = " \t\n\x0b\f\r"   # white space around a text or item


def _clean_items(arr: Column) -> Column:
    """trim, strip surrounding double then single quotes, lower, drop empties, distinct, sort."""
    def one(x):
        for outer in (WHITE, '"', "'"):
            x = F.btrim(x, F.lit(outer))
        return F.lower(x)
    cleaned = F.transform(arr, one)
    kept = F.filter(cleaned, lambda x: x.isNotNull() & (F.length(x) > 0))
    return F.sort_array(F.array_distinct(kept))   # no item is null; array_sort compares by an interpreted lambda


def parse_list_text(c, single: bool = False) -> Column:
    """List-valued text -> sorted distinct lowercase tokens (never null).

    Accepts JSON arrays, Python-style single-quoted lists, brace sets and bare
    comma lists.  With ``single=True`` (serving variant) text that does not start
    with '[' or '{' is one item and text that does not parse is an empty list.
    """
    text = F.btrim(as_col(c).cast("string"), F.lit(WHITE))
    candidate = F.translate(text, "{}", "[]")
    parsed = F.from_json(candidate, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    if single:
        bracketed = text.startswith("[") | text.startswith("{")
        items = (F.when(bracketed, F.coalesce(parsed, F.array().cast("array<string>")))
                 .otherwise(F.array(text)))
    else:
        bare = F.split(F.regexp_replace(candidate, r"^[\[\]]+|[\[\]]+$", ""), ",")
        items = F.coalesce(parsed, bare)
    out = _clean_items(items)
    return F.when(text.isNull() | (F.length(text) == 0), F.array().cast("array<string>")).otherwise(
        F.coalesce(out, F.array().cast("array<string>")))


def amenity_slug(c) -> Column:
    """Token -> column name; empty slug -> 'amenity_other'."""
    slug = F.regexp_replace(F.regexp_replace(as_col(c), SLUG_STRIP, "_"), r"^_+|_+$", "")
    return F.when(F.length(slug) == 0, F.lit(SLUG_EMPTY)).otherwise(F.concat(F.lit(SLUG_PREFIX), slug))
