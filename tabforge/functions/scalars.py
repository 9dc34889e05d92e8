"""Column-level cleaning expressions.

Every function returns a ``Column`` built from Spark built-ins, so the whole
cleaning chain stays inside whole-stage codegen.  Parsing uses ``try_cast`` so
bad text becomes null instead of failing under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabforge.functions.common import as_col
from tabforge.functions.nulls import normalize_missing

# Parsing patterns and vocabularies that results depend on.
CURRENCY_CHARS = r"[€$£,]"                # C4: characters removed before parsing a signed price
NON_PRICE_CHARS = r"[^0-9.]"              # C5: everything but digits and dot (loses the sign)
NON_NUMERIC_CHARS = r"[^0-9.\-]"          # C6: everything but digits, dot and minus
NON_PERCENT_CHARS = r"[^0-9.]+"           # C7
FIRST_NUMBER = r"([0-9]*\.?[0-9]+)"       # C19: first number in a bathrooms text
FIRST_DECIMAL = r"([0-9]+(?:\.[0-9]+)?)"  # C20: first number after the half-bath rewrite
TRUE_WORDS = ("t", "yes", "true", "1")
FALSE_WORDS = ("f", "no", "false", "0")
RESPONSE_TIME_LEVELS = ("within an hour", "within a few hours", "within a day", "a few days or more")
NOT_DEFINED = "not-defined"


def _num(c) -> Column:
    return as_col(c)


# --- dates ----------------------------------------------------------------

def parse_date(c) -> Column:
    """text/timestamp -> DATE, unparsable -> null."""
    return as_col(c).cast("string").try_cast("date")


def parse_timestamp(c) -> Column:
    return F.try_to_timestamp(as_col(c).cast("string"))


def day_gap(end, start) -> Column:
    """Whole days elapsed from ``start`` to ``end`` (floor of elapsed time)."""
    return F.datediff(as_col(end), as_col(start))


# --- numbers from text ----------------------------------------------------

def price_signed(c) -> Column:
    """C4: strip currency marks and thousands separators, keep the sign."""
    cleaned = F.trim(F.regexp_replace(normalize_missing(c).cast("string"), CURRENCY_CHARS, ""))
    return cleaned.try_cast("double")


def price_digits(c) -> Column:
    """Keep digits and dot only (the cleaning job's parser; '-' is dropped)."""
    cleaned = F.regexp_replace(normalize_missing(c).cast("string"), NON_PRICE_CHARS + "+", "")   # a run at a time
    return F.nullif(cleaned, F.lit("")).try_cast("double")


def numeric_coerce(c) -> Column:
    """Keep digits, dot and minus; parse, else null."""
    cleaned = F.regexp_replace(as_col(c).cast("string"), NON_NUMERIC_CHARS + "+", "")   # a run at a time
    return F.nullif(cleaned, F.lit("")).try_cast("double")


def clean_percent(c) -> Column:
    """C7: '95%' -> 0.95."""
    cleaned = F.regexp_replace(as_col(c).cast("string"), NON_PERCENT_CHARS, "")
    return F.nullif(cleaned, F.lit("")).try_cast("double") / F.lit(100.0)


# --- booleans ---------------------------------------------------------------

def bool_yes_no(c, fill=None) -> Column:
    """t/true -> 'yes', f/false -> 'no', anything else unchanged; optional null fill."""
    s = as_col(c).cast("string")
    out = (F.when(s.isin("t", "true", "True"), F.lit("yes"))
           .when(s.isin("f", "false", "False"), F.lit("no"))
           .otherwise(s))
    return F.coalesce(out, F.lit(fill)) if fill is not None else out


def bool_to_int(c) -> Column:
    """t/yes/true/1 -> 1, f/no/false/0 -> 0, other -> null."""
    s = F.lower(F.trim(as_col(c).cast("string")))
    return (F.when(s.isin(*TRUE_WORDS), F.lit(1))
            .when(s.isin(*FALSE_WORDS), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def infer_availability(c, availability_cols) -> Column:
    """Null flag -> 't' when the availability counts sum to non-zero, else 'f'."""
    total = F.lit(0.0)
    for a in availability_cols:
        total = total + F.coalesce(as_col(a).cast("double"), F.lit(0.0))
    return F.coalesce(as_col(c), F.when(total != 0, F.lit("t")).otherwise(F.lit("f")))


def was_evaluated_flag(c) -> Column:
    """C11: 1 when present (taken before any fill)."""
    return as_col(c).isNotNull().cast("int")


# --- categories / text --------------------------------------------------------

def coalesce_columns(a, b) -> Column:
    """C12."""
    return F.coalesce(as_col(a), as_col(b))


def blank_to_default(c, default: str = NOT_DEFINED) -> Column:
    """Blank or null -> ``default``."""
    s = as_col(c).cast("string")
    return F.coalesce(F.when(s.rlike(r"^\s*$"), F.lit(None)).otherwise(s), F.lit(default))


def text_length(c) -> Column:
    """Length of the whitespace-trimmed text, null counted as ''."""
    return F.length(F.regexp_replace(F.coalesce(as_col(c).cast("string"), F.lit("")), r"^\s+|\s+$", ""))


def ordinal_encode(c, levels=RESPONSE_TIME_LEVELS) -> Column:
    """lower(trim(text)) -> position in ``levels`` (0-based); unknown -> null."""
    key = F.lower(F.trim(as_col(c).cast("string")))
    mapping = F.create_map(*[x for i, lv in enumerate(levels) for x in (F.lit(lv), F.lit(i))])
    return mapping[key]


# --- reviews ------------------------------------------------------------------

def has_reviews_flag(n_reviews=None, first=None, last=None, per_month=None) -> Column:
    """C14: any review evidence -> 1 else 0 (absent inputs are skipped)."""
    preds = []
    if n_reviews is not None:
        preds.append(F.coalesce(as_col(n_reviews) > 0, F.lit(False)))
    if first is not None:
        preds.append(as_col(first).isNotNull())
    if last is not None:
        preds.append(as_col(last).isNotNull())
    if per_month is not None:
        preds.append(F.coalesce(as_col(per_month), F.lit(0.0)) > 0)
    out = F.lit(False)
    for p in preds:
        out = out | p
    return out.cast("int")


def zero_review_score(c, flag) -> Column:
    """Numeric-coerced score, 0 when the listing has no reviews."""
    return F.when(as_col(flag) == 0, F.lit(0.0)).otherwise(as_col(c).cast("string").try_cast("double"))


def days_since(scrape, date, flag) -> Column:
    """Days from ``date`` to ``scrape`` when reviewed; -1 otherwise; clipped at -1."""
    gap = F.when(as_col(flag) == 1, day_gap(scrape, date))
    return F.greatest(F.coalesce(gap, F.lit(-1)), F.lit(-1)).cast("int")


def fill_reviews_per_month(c, flag) -> Column:
    """C17: null -> 0 for listings without reviews."""
    c = as_col(c)
    return F.when((as_col(flag) == 0) & c.isNull(), F.lit(0.0)).otherwise(c)


def host_days_active(scrape, since) -> Column:
    """Days since the host joined, -1 when unknown."""
    return F.coalesce(day_gap(scrape, since), F.lit(-1)).cast("int")


def host_is_new(days) -> Column:
    """0 <= days < 90."""
    d = as_col(days)
    return F.coalesce((d >= 0) & (d < 90), F.lit(False)).cast("int")


# --- bathrooms ------------------------------------------------------------------

def parse_bathrooms(c) -> Column:
    """First number found in the text."""
    found = F.regexp_extract(F.coalesce(as_col(c).cast("string"), F.lit("")), FIRST_NUMBER, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def parse_half_bath(c) -> Column:
    """C20: 'half-bath' counts as 0.5, then the first number."""
    text = F.replace(F.lower(F.coalesce(as_col(c).cast("string"), F.lit(""))), F.lit("half-bath"), F.lit("0.5 bath"))
    return F.nullif(F.regexp_extract(text, FIRST_DECIMAL, 1), F.lit("")).try_cast("double")


# --- numeric hygiene ------------------------------------------------------------

def nonfinite_to_null(c) -> Column:
    """NaN and +-inf -> null."""
    c = as_col(c)
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(None)).otherwise(c)


def log1p_positive(c) -> Column:
    """log1p over positive values, null elsewhere."""
    c = as_col(c)
    return F.when(c > 0, F.log1p(c))


def clip(c, lo=None, hi=None) -> Column:
    """Null-preserving clip (``greatest``/``least`` skip nulls, so guard them)."""
    c = as_col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def occupancy_rate(days) -> Column:
    """Numeric-coerced days / 365 clipped to [0, 1]."""
    return clip(numeric_coerce(days) / F.lit(365.0), 0.0, 1.0)


def availability_proxy(avail) -> Column:
    """1 - availability_365 / 365."""
    return F.lit(1.0) - as_col(avail).cast("double") / F.lit(365.0)


def price_per_person(price, accommodates) -> Column:
    """Price divided by capacity (0 or null capacity counts as 1)."""
    acc = as_col(accommodates).cast("double")
    acc = F.when(acc.isNull() | (acc == 0), F.lit(1.0)).otherwise(acc)
    return nonfinite_to_null(as_col(price) / acc)
