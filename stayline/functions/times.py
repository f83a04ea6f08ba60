"""Timestamps fixed on the driver, independent of any time zone setting."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def utc_literal(at: datetime) -> Column:
    """``at`` as a timestamp without time zone, in UTC; a naive value is UTC already."""
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
