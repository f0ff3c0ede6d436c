"""Parsing and building of names, tokens, intervals and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Surrounding control characters and blanks are dropped, as a string trim on the JVM does.
_WHOLE_NUMBER = r"^[\x00-\x20]*([+-]?[0-9]+)[\x00-\x20]*$"


def _extract(text: Column, pattern: str) -> Column:
    """First group of ``pattern``, null where it does not match."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found)


def machine_family(sku_description: Column) -> Column:
    return _extract(sku_description, r"^(\S+) Instance")


def instance_type(usage_type: Column) -> Column:
    return _extract(usage_type, r"^[^:]+:(.*)$")


def decode_token(token: Column, size: Column) -> Column:
    """Feed offset named by a resume token; anything unusable restarts at 0.

    An offset equal to ``size`` is kept: it names the empty page after the last one.
    """
    offset = _extract(token, _WHOLE_NUMBER).try_cast("bigint")
    return F.coalesce(F.when(offset.between(F.lit(0), size), offset), F.lit(0).cast("bigint"))


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def interval_bounds(interval: Column) -> tuple[Column, Column]:
    """Start and end of a ``start/end`` string; null where a side is missing or malformed."""
    parts = F.split(interval, "/")
    return F.try_to_timestamp(F.get(parts, F.lit(0))), F.try_to_timestamp(F.get(parts, F.lit(1)))


def vendor_time(time: Column) -> Column:
    """ISO text of a UTC time, as both vendors write it."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def elapsed_millis(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)


def topic_name(prefix: str, family: Column) -> Column:
    return F.concat(F.lit(prefix + "."), family)


def reservation_id(arn: Column) -> Column:
    return _extract(arn, r"/(ri-[^/]+)$")


def commitment_id(name: Column) -> Column:
    return _extract(name, r"/commitments/(cud-[^/]+)$")


def commitment_project(name: Column) -> Column:
    return _extract(name, r"^projects/([^/]+)/")


def content_id(*columns: Column) -> Column:
    """Event id that a replay reproduces: a digest of the event's own content.

    Each part carries its length, so that shifted parts give another id; null differs from empty.
    """
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def not_blank(column: Column) -> Column:
    return F.coalesce(column.rlike(r"\S"), F.lit(False))
