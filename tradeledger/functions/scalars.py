"""Scalar expressions: dates, keys, pseudonyms and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- dates and durations -------------------------------------------------


def days_between(start: Column | str, end: Column | str) -> Column:
    """Signed duration end - start in fractional days."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(MICROS_PER_DAY)


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Number of calendar-day boundaries between two timestamps."""
    return F.datediff(col(end), col(start))


def month_key(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def month_key_from_parts(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM`` from two numeric or text columns; unreadable parts count as 0."""
    y = F.coalesce(F.try_to_number(col(year).cast("string"), F.lit("9999")).cast("int"), F.lit(0))
    m = F.coalesce(F.try_to_number(col(month).cast("string"), F.lit("99")).cast("int"), F.lit(0))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))


def month_offset(first: Column | str, ts: Column | str) -> Column:
    first, ts = col(first), col(ts)
    return (F.year(ts) - F.year(first)) * 12 + F.month(ts) - F.month(first)


def date_key(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def later_than(left: Column | str, right: Column | str) -> Column:
    """left > right, false when either side is missing."""
    return F.coalesce(col(left) > col(right), F.lit(False))


# ---- numbers -------------------------------------------------------------


def plus_null_as_zero(left: Column | str, right: Column | str) -> Column:
    return F.coalesce(col(left), F.lit(0.0)) + F.coalesce(col(right), F.lit(0.0))


def ratio_if_positive(numerator: Column | str, denominator: Column | str) -> Column:
    d = col(denominator)
    return F.when(d > 0, col(numerator) / F.when(d > 0, d))


def try_number(c: Column | str, kind: str = "double") -> Column:
    """Numeric reading of any column, null where it is not a number."""
    return col(c).try_cast(kind)


# ---- labels --------------------------------------------------------------


def display_label(c: Column | str) -> Column:
    return F.initcap(F.replace(col(c), F.lit("_"), F.lit(" ")))


def mapped(c: Column | str, groups: dict[str, str], default: str = "Other") -> Column:
    """Value to group name through a small fixed table."""
    value = col(c)
    result = F.lit(default)
    for name in sorted(set(groups.values())):
        members = [key for key, group in groups.items() if group == name]
        result = F.when(value.isin(members), F.lit(name)).otherwise(result)
    return result


def bins(c: Column | str, bounds: tuple[float, ...], labels: tuple[str, ...]) -> Column:
    """Right-closed bins: the first label whose bound is >= the value, else the last label."""
    value = col(c)
    result = F.lit(labels[-1])
    for bound, label in reversed(list(zip(bounds, labels))):
        result = F.when(value <= bound, F.lit(label)).otherwise(result)
    return F.when(value.isNotNull(), result)


# ---- pseudonyms, hashes and masks ----------------------------------------


def pseudonym(c: Column | str, prefix: str) -> Column:
    """``prefix_`` + the first 16 hex digits of sha256("prefix:value"); null stays null."""
    digest = F.sha2(F.concat(F.lit(prefix + ":"), col(c).cast("string")), 256)
    return F.concat(F.lit(prefix + "_"), F.substring(digest, 1, 16))


def hashed(c: Column | str) -> Column:
    """Full sha256; a missing value hashes like the empty text."""
    return F.sha2(F.coalesce(col(c).cast("string"), F.lit("")), 256)


def md5_key(c: Column | str) -> Column:
    return F.md5(col(c).cast("string"))


def _text(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def _digits(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), r"\D", "")


def mask_email(c: Column | str) -> Column:
    text = _text(c)
    at = F.instr(text, "@")
    domain = F.substring(text, at + 1, F.length(text))
    shown = F.when(at > 1, F.concat(F.substring(text, 1, 1), F.lit("***"))).otherwise("***")
    return F.when(at > 0, F.concat(shown, F.lit("@"), domain)).otherwise("***")


def mask_cpf(c: Column | str) -> Column:
    digits = _digits(c)
    return F.concat(
        F.lit("***.***.***-"), F.when(F.length(digits) >= 11, F.right(digits, F.lit(2))).otherwise("**")
    )


def mask_cnpj(c: Column | str) -> Column:
    digits = _digits(c)
    return F.concat(
        F.lit("**.***.***/****-"), F.when(F.length(digits) >= 14, F.right(digits, F.lit(2))).otherwise("**")
    )


def mask_phone(c: Column | str) -> Column:
    digits = _digits(c)
    hidden = F.repeat(F.lit("*"), F.greatest(F.length(digits) - 4, F.lit(0)))
    return F.when(F.length(digits) >= 4, F.concat(hidden, F.right(digits, F.lit(4)))).otherwise("****")


def year_only(c: Column | str) -> Column:
    """Year of a date as text, ``unknown_year`` when it cannot be read."""
    year = F.year(F.try_to_timestamp(col(c).cast("string")))
    return F.coalesce(year.cast("string"), F.lit("unknown_year"))
