"""Scalar column expressions. All of them stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.schema import CITY_TEXTS, NULL_TOKENS, STATIONS, UNITS

# Text that counts as a number. Spark alone would also take '5d', '5f', 'nan'
# and hexadecimal floats.
_NUMBER = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity))\s*$"
)

# Grammar of offsets.
_STRICT_OFFSET = r"^PT([0-9]+)H$"
_LOOSE_OFFSET = r"PT(?:([0-9]+)H)?(?:([0-9]+)M)?"


def nan_to_null(c: Column) -> Column:
    """One missing marker: NaN becomes NULL."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Text to double; text that is not a number becomes NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def number_column(df: DataFrame, name: str = "value") -> Column:
    """``name`` of ``df`` as double with NULL for anything that is not a number.

    Picks the expression from the column type, so a numeric column skips the
    text guard.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_number(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name).cast("double"))
    return F.col(name).cast("double")


def null_tokens_to_null(c: Column) -> Column:
    """Text tokens that a delimited scan treats as missing become NULL."""
    return F.when(~c.isin(NULL_TOKENS), c)


def to_utc_timestamp(c: Column) -> Column:
    """ISO text to an instant, NULL when it does not parse.

    Text without a zone is read in the session zone, which is UTC here.
    """
    return F.try_to_timestamp(c)


def offset_hours_strict(c: Column) -> Column:
    """Hours of ``PT<n>H`` (whole text), else NULL."""
    hours = F.regexp_extract(c, _STRICT_OFFSET, 1)
    return F.when(hours != "", hours.try_cast("bigint"))


def _offset_part(c: Column, group: int) -> Column:
    return F.coalesce(
        F.nullif(F.regexp_extract(c, _LOOSE_OFFSET, group), F.lit("")).try_cast("int"),
        F.lit(0),
    )


def offset_hours(c: Column) -> Column:
    """Hours of an offset such as ``PT6H30M``; an absent part is 0."""
    return _offset_part(c, 1)


def offset_minutes(c: Column) -> Column:
    """Minutes of an offset such as ``PT6H30M``; an absent part is 0."""
    return _offset_part(c, 2)


def format_offset(instant: Column) -> Column:
    """Hour and minute of an instant as ``PT<h>H[<m>M]``."""
    minute = F.minute(instant)
    return F.concat(
        F.lit("PT"), F.hour(instant).cast("string"), F.lit("H"),
        F.when(minute > 0, F.concat(minute.cast("string"), F.lit("M")))
        .otherwise(F.lit("")),
    )


def observation_instant(time: Column, offset: Column) -> Column:
    """Reference time plus its offset."""
    return time + F.make_dt_interval(
        F.lit(0), offset_hours(offset), offset_minutes(offset), F.lit(0)
    )


def _first_fitting(text: Column, table: dict[str, str], otherwise: Column) -> Column:
    """Value of the first key of ``table`` that ``text`` contains."""
    result = None
    for part, value in table.items():
        holds = text.contains(part)
        result = F.when(holds, value) if result is None else result.when(holds, value)
    return otherwise if result is None else result.otherwise(otherwise)


def unit_of(element: Column, units: dict[str, str] | None = None) -> Column:
    """Unit implied by the element name, empty text when none is."""
    return _first_fitting(element, UNITS if units is None else units, F.lit(""))


def source_of(text: Column, strict: bool = True,
              cities: dict[str, str] | None = None) -> Column:
    """Station named by a path or city text; ``cities`` maps part of it to a station.

    Text naming no known city fails the query when ``strict``, else gives NULL.
    """
    if cities is None:
        cities = {part: STATIONS[slug] for part, slug in CITY_TEXTS.items()}
    unknown = (
        F.raise_error(F.concat(F.lit("no station in text: "), text)).cast("string")
        if strict else F.lit(None).cast("string")
    )
    return _first_fitting(F.lower(text), cities, unknown)


def year_month(c: Column) -> Column:
    """``YYYY-MM`` of an instant."""
    return F.date_format(c, "yyyy-MM")


def month_abbr(c: Column) -> Column:
    """English month abbreviation of an instant or date."""
    return F.date_format(c, "MMM")


def month_name(c: Column) -> Column:
    """English month name of an instant or date."""
    return F.date_format(c, "MMMM")


def month_label(c: Column) -> Column:
    """``Mon YYYY`` of an instant or date."""
    return F.date_format(c, "MMM yyyy")


def date_part_text(c: Column) -> Column:
    """First ten characters of an ISO text."""
    return F.substring(c, 1, 10)


def iso_format(c: Column) -> Column:
    """Instant as ``YYYY-MM-DDTHH:MM:SS.000Z``."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'.000Z'")


def city_slug(c: Column) -> Column:
    """City name as lower-case ASCII."""
    slug = F.lower(c)
    # Letter replacements.
    for letter, ascii_text in (("ø", "o"), ("æ", "ae"), ("å", "a")):
        slug = F.replace(slug, F.lit(letter), F.lit(ascii_text))
    return slug


def city_label(c: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(
        F.upper(F.substring(c, 1, 1)),
        F.lower(c.substr(F.lit(2), F.length(c))),
    )


def round_n(c: Column, digits: int) -> Column:
    """Round half up to ``digits`` decimals.

    Sums differ in the last bits with the order in which tasks are combined.
    Rounding to nine decimals first keeps that from deciding a tie, so repeated
    runs agree.
    """
    return F.round(F.round(c, 9), digits) if digits < 9 else F.round(c, digits)


def percentage(part: Column, total: Column, digits: int = 1) -> Column:
    """``100 * part / total``; 0 when the total is 0."""
    share = F.try_divide(F.lit(100.0) * part, total.cast("double"))
    return round_n(F.coalesce(share, F.lit(0.0)), digits)
