"""Publication times, epoch columns, labels and the reporting calendar."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

# Label formats of the keyword tables.
LABEL_FORMATS = {
    "hour": "yyyy-MM-dd HH",
    "day": "yyyy-MM-dd HH:mm:ss",
    "month": "yyyy-MM",
}
PYTHON_FORMATS = {
    "hour": "%Y-%m-%d %H",
    "day": "%Y-%m-%d %H:%M:%S",
    "month": "%Y-%m",
}

# The two spellings of a publication time that feeds use.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}|$)"
MAIL_SHAPE = r"^[A-Za-z]{3}, \d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{2}:?\d{2}$"
MAIL_FORMAT = "d MMM yyyy HH:mm:ss [xxx][xx]"
ZONE_AT_END = r"[+-]\d{2}:?\d{2}$"
LABEL_ENDS = ("start", "end")


def _spelled_out(published: Column) -> Column:
    """Zone names become offsets: ``Z`` and ``GMT`` both mean UTC."""
    offsets = F.replace(published, F.lit("Z"), F.lit("+00:00"))
    return F.replace(offsets, F.lit("GMT"), F.lit("+0000"))


def parse_published(published: Column) -> Column:
    """The instant a feed's date text names, or null. Text without a zone is UTC."""
    text = _spelled_out(published)
    after_weekday = F.substr(text, F.lit(6))
    return (
        F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))
        .when(text.rlike(MAIL_SHAPE), F.try_to_timestamp(after_weekday, F.lit(MAIL_FORMAT)))
    )


def published_millis(published: Column) -> Column:
    """Epoch milliseconds of a feed's date text, or null."""
    return F.unix_millis(parse_published(published))


def iso_utc(ts: Column) -> Column:
    """``2023-11-13T23:43:15Z``, with the fraction only where there is one."""
    return F.when(
        F.unix_micros(ts) % 1_000_000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def published_iso(published: Column, wall_clock: bool = False) -> Column:
    """The date text as ISO-8601 with ``Z``.

    ``wall_clock=True`` keeps the clock reading and ignores its zone, so a time given
    in another zone than UTC comes out shifted; it exists for parity with old messages.
    """
    if not wall_clock:
        return iso_utc(parse_published(published))
    bare = F.regexp_replace(_spelled_out(published), ZONE_AT_END, "+00:00")
    return F.when(parse_published(published).isNotNull(), iso_utc(parse_published(bare)))


def utc(moment: datetime) -> datetime:
    """``moment`` in UTC; one without a zone is UTC, whatever the machine's zone."""
    return (moment.astimezone(timezone.utc) if moment.tzinfo
            else moment.replace(tzinfo=timezone.utc))


def instant(moment: datetime) -> Column:
    """A literal of ``moment``, built from its microseconds so that no zone is involved."""
    since = utc(moment) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(since // timedelta(microseconds=1)))


def from_epoch(value: Column, unit: str = "ms") -> Column:
    """Epoch milliseconds (``ms``) or seconds (``s``) as a timestamp."""
    return {"ms": F.timestamp_millis, "s": F.timestamp_seconds}[unit](value)


def as_instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC; event-time windows need this."""
    return ts.cast("timestamp")


def unit_start(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts)


def unit_end(ts: Column, unit: str) -> Column:
    step = {
        "hour": F.expr("INTERVAL 1 HOUR"),
        "day": F.expr("INTERVAL 1 DAY"),
        "month": F.expr("INTERVAL 1 MONTH"),
    }[unit]
    return F.date_trunc(unit, ts) + step


def label(ts: Column, unit: str = "hour", label_at: str = "start") -> Column:
    """Text label of the hour, day or month holding ``ts``.

    ``label_at="end"`` names the period by the instant it is over, as a job does that
    stamps an interval with the clock when it writes.
    """
    if label_at not in LABEL_ENDS:
        raise ValueError(f"label_at must be one of {LABEL_ENDS}")
    edge = unit_start if label_at == "start" else unit_end
    return F.date_format(edge(ts, unit), LABEL_FORMATS[unit])


def label_start(text: Column, unit: str = "hour", label_at: str = "start") -> Column:
    """First instant of the period a label names."""
    ts = F.to_timestamp(text, LABEL_FORMATS[unit])
    if label_at == "start":
        return ts
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH"}[unit]
    return ts - F.expr(step)


def calendar(as_of: Column) -> dict[str, Column]:
    """The labels a rollup run at ``as_of`` works with."""
    month = F.date_trunc("month", as_of)
    return {
        "today": F.date_format(F.date_trunc("day", as_of), LABEL_FORMATS["day"]),
        "yesterday": F.date_format(as_of - F.expr("INTERVAL 1 DAY"), LABEL_FORMATS["day"]),
        "month": F.date_format(month, LABEL_FORMATS["month"]),
        "previous_month": F.date_format(F.add_months(month, -1), LABEL_FORMATS["month"]),
        "next_month": F.date_format(F.add_months(month, 1), LABEL_FORMATS["month"]),
        "first_of_month": F.dayofmonth(as_of) == 1,
    }


def period_before(as_of: datetime, unit: str) -> tuple[datetime, datetime]:
    """The last whole day or month before ``as_of``, half open."""
    midnight = utc(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    if unit == "day":
        return midnight - timedelta(days=1), midnight
    if unit == "month":
        end = midnight.replace(day=1)
        return (end - timedelta(days=1)).replace(day=1), end
    raise ValueError("unit must be day or month")


def whole_periods(start: datetime, end: datetime, unit: str) -> tuple[datetime, datetime]:
    """The bounds of the whole days or months between two moments, half open."""
    first = period_before(start, unit)[1]
    if first < utc(start):
        step = first + timedelta(days=1 if unit == "day" else 32)
        first = period_before(step, unit)[1]
    return first, period_before(end, unit)[1]


def blank_to(text: Column, default: int) -> Column:
    """Text as a long; blank and null become ``default``, anything else unreadable null."""
    trimmed = F.trim(text)
    return F.when(text.isNull() | (trimmed == ""), F.lit(default).cast("long")).otherwise(
        trimmed.try_cast("long"))
