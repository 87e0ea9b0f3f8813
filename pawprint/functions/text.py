"""String column functions (Column -> Column), all JVM-side expressions.

Every function takes a column name or ``Column`` and returns a ``Column`` so
Catalyst can fuse them into one whole-stage-codegen projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's for identical results.
# Age units, checked in this priority order, and their length in days.
AGE_UNIT_DAYS = (("year", 365.0), ("month", 30.0), ("week", 7.0), ("day", 1.0))
# Labels of the derived categorical features.
OTHER = "Other"
UNKNOWN = "Unknown"
NEUTERED_SPAYED = "Neutered/Spayed"
INTACT = "Intact"
MALE, FEMALE = "Male", "Female"
MIXED, PUREBRED = "Mixed", "Purebred"
MULTICOLOR, SINGLE_COLOR = "Multicolor", "Single Color"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace (tabs and newlines too, unlike ``trim``)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def age_in_days(c: ColumnOrName) -> Column:
    """Age text such as ``'2 years'`` -> days as double.

    First run of digits times the unit found by priority (year > month >
    week > day, substring match on the lower-cased text). No digits, no unit
    or null -> null. ``regexp_substr`` yields null on no match, and
    ``try_cast`` never raises under ANSI mode.
    """
    text = F.lower(_col(c))
    number = F.regexp_substr(_col(c), F.lit("[0-9]+")).try_cast("double")
    unit = None
    for token, days in AGE_UNIT_DAYS:
        cond = text.contains(token)
        unit = F.when(cond, F.lit(days)) if unit is None else unit.when(cond, F.lit(days))
    return number * unit


def primary_color(c: ColumnOrName) -> Column:
    """Text before the first ``/``, stripped."""
    return strip(F.substring_index(_col(c), "/", 1))


def primary_breed(c: ColumnOrName) -> Column:
    """Text before the first ``/`` without a trailing ``Mix`` (any case), stripped."""
    first = F.substring_index(_col(c), "/", 1)
    return strip(F.regexp_replace(first, r"(?i)\s+Mix$", ""))


def is_mix(c: ColumnOrName) -> Column:
    """1 when the raw breed mentions ``mix`` (any case) or holds a ``/``; null -> 0."""
    cond = _col(c).rlike("(?i)mix") | _col(c).contains("/")
    return F.coalesce(cond, F.lit(False)).cast("int")


def contains_ci(c: ColumnOrName, pattern: str) -> Column:
    """Case-insensitive regex search, null -> false."""
    return F.coalesce(_col(c).rlike(f"(?i){pattern}"), F.lit(False))


def ends_with(c: ColumnOrName, suffix: str) -> Column:
    """Case-sensitive suffix test, null -> false."""
    return F.coalesce(_col(c).endswith(suffix), F.lit(False))


def reproductive_status(c: ColumnOrName, default: str | None = UNKNOWN) -> Column:
    """``Neutered/Spayed`` beats ``Intact``; anything else -> ``default``.

    ``default=None`` gives the exploration variant where unmatched is null.
    """
    expr = (F.when(contains_ci(c, "neutered|spayed"), F.lit(NEUTERED_SPAYED))
            .when(contains_ci(c, "intact"), F.lit(INTACT)))
    return expr if default is None else expr.otherwise(F.lit(default))


def gender(c: ColumnOrName) -> Column:
    """``Male`` / ``Female`` from the suffix, else null. ``Female`` does not end in ``Male``."""
    return (F.when(ends_with(c, MALE), F.lit(MALE))
            .when(ends_with(c, FEMALE), F.lit(FEMALE)))


def has_name(c: ColumnOrName, unknown_is_missing: bool = True) -> Column:
    """1 when the stripped name is non-empty (and not ``unknown`` in any case)."""
    s = strip(F.coalesce(_col(c), F.lit("")))
    cond = F.length(s) > 0
    if unknown_is_missing:
        cond = cond & (F.lower(s) != F.lit("unknown"))
    return cond.cast("int")


def breed_type(c: ColumnOrName) -> Column:
    """``Mixed`` when the breed is a mix (see ``is_mix``) else ``Purebred``."""
    return F.when(is_mix(c) == 1, F.lit(MIXED)).otherwise(F.lit(PUREBRED))


def color_kind(c: ColumnOrName) -> Column:
    """``Multicolor`` when the colour holds a ``/`` else ``Single Color``."""
    return (F.when(F.coalesce(_col(c).contains("/"), F.lit(False)), F.lit(MULTICOLOR))
            .otherwise(F.lit(SINGLE_COLOR)))


def keep_or_other(c: ColumnOrName, keep: Column) -> Column:
    """Value when ``keep`` holds or the value is null, else ``Other``."""
    return F.when(keep | _col(c).isNull(), _col(c)).otherwise(F.lit(OTHER))
