"""Date, time and timespan columns. Every result is a UTC timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.fixed import REQUEST_TIMESPAN_PATTERN
from broadsheet.functions.expr import let
from broadsheet.functions.text import strip

# Seconds per timespan unit ("m" is a month of thirty days, "min" a minute).
UNIT_SECONDS = {
    "min": 60, "h": 3600, "hour": 3600, "hours": 3600, "d": 86400, "day": 86400, "days": 86400,
    "w": 604800, "week": 604800, "weeks": 604800, "m": 2592000, "month": 2592000, "months": 2592000,
}

# Named mail-date zones in hours from UTC.
ZONE_HOURS = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}

_ISO = (
    r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:[Zz]|[+-]\d{2}:\d{2})?|[Tt])?$"
)
# What none of the rewrites below would change.
_PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?$"
_MAIL = (
    r"^\s*(?:[A-Za-z]{3,9}\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{4}|\d{2})\s+"
    r"(\d{1,2}:\d{2}:\d{2})\s*([A-Za-z]{1,5}|[+-]\d{4})?\s*(?:\(.*\))?\s*$"
)


def iso_time(c: Column) -> Column:
    """ISO-8601 text to UTC; text without a zone counts as UTC; anything else gives null."""
    given = strip(c)
    text = given
    for pattern, replacement in (
        (r"^(\d{4})(\d{2})(\d{2})(?=\D|$|\d{6})", "$1-$2-$3T"),       # compact date
        (r"T[Tt]?(\d{2})(\d{2})(\d{2})(?!\d)", "T$1:$2:$3"),          # compact clock
        (r"([Tt ]\d{2})(?=$|[Zz+-])", "$1:00"),                       # hour only
        (r"(:\d{2})[.,](\d{1,6})\d*", "$1.$2"),                       # micros at most
        (r"(:[\d.]+[+-]\d{2}):?(\d{2})$", "$1:$2"),                   # zone without a colon
        (r"(:[\d.]+[+-]\d{2})$", "$1:00"),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    rewritten = let(text, lambda t: F.when(t.rlike(_ISO), t.try_cast("timestamp")))
    return F.when(given.rlike(_PLAIN_ISO), given.try_cast("timestamp")).otherwise(rewritten)


def api_time(c: Column) -> Column:
    """Search-API dates: compact with or without ``T``/``Z``, or ISO-8601."""
    return iso_time(c)


def mail_time(c: Column) -> Column:
    """RFC-822 style dates, weekday optional; unknown zone names count as UTC."""
    timed = F.regexp_replace(c, r"(\s\d{1,2}:\d{2})(?![:\d])", "$1:00")
    zones = F.create_map(*[F.lit(v) for z, h in ZONE_HOURS.items() for v in (z, f"-{-h:02d}00")])

    def parse(text: Column) -> Column:
        clock = F.regexp_replace(text, _MAIL, "$1 $2 $3 $4")
        clock = F.regexp_replace(clock, r"^(\d+ \w+) ([0-5]\d|6[0-8]) ", "$1 20$2 ")
        clock = F.regexp_replace(clock, r"^(\d+ \w+) (69|[7-9]\d) ", "$1 19$2 ")
        zone = F.upper(F.regexp_extract(text, _MAIL, 5))
        offset = F.when(zone.rlike(r"^[+-]"), zone).otherwise(
            F.coalesce(F.try_element_at(zones, zone), F.lit("+0000"))
        )
        stamp = F.concat(F.initcap(clock), F.lit(" "), offset)
        return F.when(text.rlike(_MAIL), F.try_to_timestamp(stamp, F.lit("d MMM yyyy H:mm:ss Z")))

    return let(timed, parse)


def feed_time(*candidates: Column) -> Column:
    """First candidate that parses, each tried as a mail date and then as ISO-8601."""
    return F.coalesce(*[F.coalesce(mail_time(c), iso_time(c)) for c in candidates])


def normalize_timespan(c: Column) -> Column:
    """Trimmed lower-case timespan text."""
    return F.lower(strip(c))


def valid_request_timespan(c: Column) -> Column:
    """Whether a request may use this timespan (singular unit names are refused)."""
    return F.coalesce(normalize_timespan(c).rlike(REQUEST_TIMESPAN_PATTERN), F.lit(False))


def timespan_seconds(c: Column) -> Column:
    """Length of a timespan in seconds, null when unsupported."""
    text = normalize_timespan(c)
    pattern = r"^\s*\+?(\d+)\s*(min|hours|hour|h|days|day|d|weeks|week|w|months|month|m)$"
    unit = F.regexp_extract(text, pattern, 2)
    seconds = F.coalesce(*[F.when(unit == name, F.lit(s)) for name, s in UNIT_SECONDS.items()])
    return F.when(
        text.rlike(pattern), F.regexp_extract(text, pattern, 1).try_cast("bigint") * seconds
    )


def iso_text(ts: Column) -> Column:
    """UTC ISO text of a timestamp, with microseconds only where there are some."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    return F.when(F.unix_micros(ts) % 1000000 == 0, whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def utc_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded partition columns of a timestamp (session clock is UTC)."""
    return {
        "year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"), "hour": F.date_format(ts, "HH"),
    }
