"""Column expressions used across the layers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text ---------------------------------------------------------------


def normalize_text(c: ColumnOrName) -> Column:
    """``lower(trim(x))`` — the join key for names typed by people.
    ``trim`` removes spaces only, as in the source system."""
    return F.lower(F.trim(_c(c)))


def md5_key(c: ColumnOrName) -> Column:
    """Surrogate key: md5 hex of the value's text form; NULL stays NULL."""
    return F.md5(_c(c).cast("string"))


def concat_key(prefix: str, c: ColumnOrName) -> Column:
    """``prefix || code`` — NULL code gives a NULL key, so it never joins."""
    return F.concat(F.lit(prefix), _c(c).cast("string"))


# --- flags and casts ----------------------------------------------------


def decode_flag(c: ColumnOrName, true_token: str = "t", false_token: str = "f") -> Column:
    """'t' -> TRUE, 'f' -> FALSE, anything else (incl. 'T', '') -> NULL."""
    c = _c(c)
    return F.when(c == true_token, F.lit(True)).when(c == false_token, F.lit(False))


def is_true(c: ColumnOrName) -> Column:
    """Three-valued flag as a predicate: NULL is not true (F8)."""
    return F.coalesce(_c(c), F.lit(False))


def nullif_zero(c: ColumnOrName) -> Column:
    """``nullif(x, 0)`` — mandatory under ANSI, where x/0 raises."""
    return F.nullif(_c(c), F.lit(0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / nullif(den, 0)`` evaluated in DOUBLE."""
    return _c(num).cast("double") / nullif_zero(den).cast("double")


def percent(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part * 100.0 / nullif(total, 0)`` in DOUBLE."""
    return (_c(part).cast("double") * F.lit(100.0)) / nullif_zero(total).cast("double")


def pct_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """``(cur - prev) * 100.0 / nullif(prev, 0)`` in DOUBLE."""
    return ((_c(cur) - _c(prev)).cast("double") * F.lit(100.0)) / nullif_zero(prev).cast("double")


# --- dates --------------------------------------------------------------


def year_of(c: ColumnOrName) -> Column:
    return F.year(_c(c)).cast("long")


def month_of(c: ColumnOrName) -> Column:
    return F.month(_c(c)).cast("long")


def months_before(c: ColumnOrName, months: int) -> Column:
    """``d - interval 'n months'`` with month-end clamping."""
    return F.add_months(_c(c), -months)


# --- rental measures (F3) and the three meanings of "active" (Q6) ------

STAY_NIGHTS = 30


def stays(availability: ColumnOrName = "availability_30") -> Column:
    """Booked nights in the 30-day window: ``30 - availability_30``."""
    return F.lit(STAY_NIGHTS) - _c(availability)


def revenue(
    availability: ColumnOrName = "availability_30", price: ColumnOrName = "price"
) -> Column:
    """Estimated monthly revenue, exact decimal: ``(30 - availability_30) * price``."""
    return stays(availability) * _c(price)


def active_available(availability: ColumnOrName = "availability_30") -> Column:
    """Marts and question e: the listing has free nights (``availability_30 > 0``)."""
    return _c(availability) > 0


def active_booked(availability: ColumnOrName = "availability_30") -> Column:
    """Questions a-c: the listing had at least one stay (``availability_30 < 30``)."""
    return _c(availability) < STAY_NIGHTS


def active_flagged(flag: ColumnOrName = "has_availability") -> Column:
    """Question d: the listing's own availability flag is TRUE."""
    return is_true(flag)


# --- date text from the load job (S5 / X14) ----------------------------

DMY_PATTERN = r"^\s*\d{1,2}/\d{1,2}/\d{4}\s*$"


def normalize_dmy_date(c: ColumnOrName) -> Column:
    """Rewrite a ``d/m/Y`` date string to ISO ``Y-m-d``.

    Only strings that contain ``/`` are touched; they are stripped and parsed
    day-first; text that does not parse (``31/02/2020``, two-digit years,
    trailing words) is returned unchanged.
    """
    c = _c(c)
    parsed = F.date_format(F.try_to_date(F.trim(c), "d/M/yyyy"), "yyyy-MM-dd")
    return F.when(c.contains("/") & c.rlike(DMY_PATTERN), F.coalesce(parsed, c)).otherwise(c)
