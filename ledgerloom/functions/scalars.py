"""Column builders: text, money, dates, keys, JSON and question parsing. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the words that say only what kind a company is, as a pattern.
COMPANY_WORDS = "inc|llc|ltd|corp|co|company|incorporated|limited|corporation"


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- text ------------------------------------------------------------------------------------------------------------


#: What separates the words of a name: anything but letters and digits, and company words between such.
_APART = rf"(?:[^a-z0-9]|(?<![a-z0-9])(?:{COMPANY_WORDS})(?![a-z0-9]))+"


def norm_name(x: str | Column) -> Column:
    """Lower case, letters a-z, digits and single spaces only, without company suffix words; NULL becomes ''.

    One pass: each run of separators and company words becomes a space, and spaces at the ends go.
    """
    return F.coalesce(F.btrim(F.regexp_replace(F.lower(col(x).cast("string")), _APART, " ")), F.lit(""))


def similarity(a: str | Column, b: str | Column) -> Column:
    """1 - edit distance over the longer length; 1 for two empty strings."""
    return F.lit(1.0) - F.levenshtein(col(a), col(b)) / F.greatest(F.length(col(a)), F.length(col(b)), F.lit(1))


def similarity_or_null(a: str | Column, b: str | Column) -> Column:
    """similarity, but NULL if either side is blank."""
    return F.when((F.length(col(a)) > 0) & (F.length(col(b)) > 0), similarity(a, b))


def email_company(x: str | Column) -> Column:
    """The last label but one of an e-mail address's domain, upper case; NULL without one."""
    label = F.regexp_extract(F.upper(col(x)), r"@(?:[A-Z0-9.-]*\.)?([A-Z0-9-]+)\.[A-Z0-9-]*(?![A-Z0-9.-])", 1)
    return F.nullif(label, F.lit(""))


def same_prefix(a: str | Column, b: str | Column, n: int = 8) -> Column:
    return (F.length(col(a)) > 0) & (F.substring(col(a), 1, n) == F.substring(col(b), 1, n))


def richness(name: str | Column, address: str | Column) -> Column:
    """How much a header tells: 2 for a name, 1 for an address, and a little for their lengths."""
    n, a = F.length(col(name)), F.length(col(address))
    return (n > 0).cast("int") * 2 + (a > 0).cast("int") + n * 0.001 + a * 0.0001


def labelled_text(fields: dict[str, str | Column], most: int | None = None) -> Column:
    """'label: value' lines of the fields that aren't blank."""
    lines = [F.when(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))) != "", F.concat(F.lit(f"{k}: "), col(c).cast("string"))) for k, c in fields.items()]
    text = F.concat_ws("\n", *lines)
    return F.substring(text, 1, most) if most else text


def flat_lines(x: str | Column) -> Column:
    """Without carriage returns and line feeds."""
    return F.regexp_replace(col(x), "[\r\n]", "")


def clipped(x: str | Column, n: int = 140) -> Column:
    return F.substring(F.coalesce(col(x).cast("string"), F.lit("")), 1, n)


# --- money -----------------------------------------------------------------------------------------------------------


def money(x: str | Column) -> Column:
    """A number from text such as '$1,234.50'; NULL if it isn't one."""
    return F.regexp_replace(F.trim(col(x).cast("string")), "[$,]", "").try_cast("double")


def cents(x: str | Column) -> Column:
    """Whole cents, half up."""
    return F.round(col(x).cast("double") * 100).cast("long")


def tolerance(amount_cents: str | Column, pct: float, floor_cents: int = 0) -> Column:
    return F.greatest(F.lit(floor_cents).cast("long"), F.round(F.abs(col(amount_cents).cast("double")) * pct).cast("long"))


def amount_bucket(amount_cents: str | Column, width: int = 500) -> Column:
    return F.floor(col(amount_cents) / width).cast("long")


def tolerance_buckets(tolerance_cents: str | Column, width: int = 500) -> Column:
    return F.ceil(col(tolerance_cents).cast("double") / width).cast("long")


def amount_band(amount_cents: str | Column, pct: float, floor_cents: int = 0) -> Column:
    """Numbered bands of amounts: two whose distance is within pct of either's size plus floor_cents, rounded, are in one
    band or in neighbouring ones. Bands are even on a log scale that is linear about zero, so they serve both signs and
    are as many as the range of amounts has steps of pct."""
    if pct <= 0:
        return F.floor(col(amount_cents) / max(1, floor_cents)).cast("long")
    near_zero, width = (floor_cents + 0.5) / pct, -math.log1p(-pct) * (1 + 1e-9)
    v = col(amount_cents).cast("double")
    return F.floor(F.signum(v) * F.log1p(F.abs(v) / near_zero) / width).cast("long")


def amount_ok(got: str | Column, want: str | Column, absolute: float = 0.01, relative: float = 0.02) -> Column:
    """Within an absolute tolerance, or one relative to the wanted amount; false if either is NULL."""
    got, want = (col(x).cast("double") for x in (got, want))
    d = F.abs(got - want)
    return F.coalesce((d <= absolute) | (d <= F.abs(want) * relative), F.lit(False))


def amount_close(got: str | Column, want: str | Column, absolute: float = 0.01, relative: float = 0.002) -> Column:
    got, want = (col(x).cast("double") for x in (got, want))
    return F.coalesce(F.abs(got - want) <= F.greatest(F.lit(absolute), F.abs(want) * relative), F.lit(False))


def amount_decay(difference_cents: str | Column, scale: float = 500.0) -> Column:
    d = col(difference_cents)
    return F.when(d == 0, F.lit(1.0)).otherwise(F.exp(-d / F.lit(scale)))


def amount_closeness(a: str | Column, b: str | Column) -> Column:
    """1 - |a - b| over a's size (1 at least), within 0 and 1."""
    return clamp(F.lit(1.0) - F.abs(col(a) - col(b)) / F.greatest(F.lit(1.0), F.abs(col(a))))


def clamp(x: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(col(x), F.lit(low)), F.lit(high))


# --- dates -----------------------------------------------------------------------------------------------------------

DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy", "yyyy/MM/dd", "M/d/yyyy", "yyyyMMdd")


def parse_date(x: str | Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The date under the first format that fits; NULL if none does."""
    s = F.trim(col(x).cast("string"))
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def parse_timestamp(x: str | Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(F.trim(col(x).cast("string")), r"\s+GMT$", ""), F.lit("yyyy-MM-dd HH:mm:ss"))


def week(x: str | Column) -> Column:
    return F.floor(F.datediff(col(x), F.lit("1970-01-01").cast("date")) / 7).cast("int")


def days_apart(a: str | Column, b: str | Column) -> Column:
    return F.abs(F.datediff(col(a), col(b)))


def date_decay(days: str | Column, scale: float = 7.0) -> Column:
    return F.exp(-col(days) / F.lit(scale))


def soft_dates(invoice_days: str | Column, due_days: str | Column) -> Column:
    """Half by the invoice's date (scale 30), half by its due date (45); a missing one counts as far."""
    a, b = (F.coalesce(col(x), F.lit(9999)) for x in (invoice_days, due_days))
    return 0.5 * F.exp(-a / F.lit(30.0)) + 0.5 * F.exp(-b / F.lit(45.0))


def date_closeness(days: str | Column, most: int = 365) -> Column:
    return F.lit(1.0) - F.least(F.coalesce(col(days), F.lit(most)), F.lit(most)) / F.lit(float(most))


def date_ok(a: str | Column, b: str | Column, window: int) -> Column:
    """Within the window; a missing date is no objection."""
    return F.coalesce(days_apart(a, b) <= window, F.lit(True))


def batch_time(x: str | Column, unit: str = "day") -> Column:
    if unit not in ("hour", "day", "month"):
        raise ValueError(unit)
    return F.date_trunc(unit, col(x))


def month_of(x: str | Column) -> Column:
    return F.date_format(col(x), "yyyy-MM")


# --- currencies ------------------------------------------------------------------------------------------------------


def currency_ok(a: str | Column, b: str | Column, how: str = "tolerant", default: str = "USD") -> Column:
    """'strict': equal; 'tolerant': equal or one missing; 'default': equal after a default for missing ones."""
    a, b = F.upper(F.trim(col(a))), F.upper(F.trim(col(b)))
    if how == "strict":
        return F.coalesce(a == b, F.lit(False))
    if how == "tolerant":
        return F.coalesce(a == b, F.lit(True))
    if how == "default":
        return F.coalesce(a, F.lit(default)) == F.coalesce(b, F.lit(default))
    raise ValueError(how)


# --- keys ------------------------------------------------------------------------------------------------------------


def hash_key(*columns: str | Column) -> Column:
    """SHA-256 of the values with '||' between; NULL counts as '', so columns keep their places."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]), 256)


def pipe_key(*columns: str | Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])


def unit_vector(x: str | Column) -> Column:
    """An array divided by its Euclidean length."""
    v = col(x).cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, y: a + y * y)) + F.lit(1e-12)
    return F.transform(v, lambda y: y / length)


# --- JSON ------------------------------------------------------------------------------------------------------------


def salvaged_json(x: str | Column, schema: str) -> Column:
    """from_json of the text, or of what stands between its first { and last }."""
    s = col(x)
    inner = F.regexp_extract(s, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.from_json(F.when(F.trim(s).startswith("{"), s), schema), F.from_json(F.when(inner != "", inner), schema))


# --- questions -------------------------------------------------------------------------------------------------------

TICKET = r"\b(IN\d{8,})\b"
# What questions are told apart by.
DAYS = r"(?:last|past)\s+(\d+)\s+day"
STALE = r"(?i)no updates?|stale"
STILL_OPEN = r"(?i)not closed|open|not resolved"
ASSIGNEE = r"(?i)assigned\s+to\s+(.+?)(?:\?|$)"


def asked_ticket(x: str | Column) -> Column:
    return F.nullif(F.regexp_extract(F.upper(col(x)), TICKET, 1), F.lit(""))


def asked_days(x: str | Column, default: int = 7) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(col(x)), DAYS, 1).try_cast("int"), F.lit(default))
