"""What a retention purge keeps."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed


def cutoff_time(now: datetime, years: int) -> datetime:
    """``years`` of 365 days before ``now``."""
    return now - timedelta(days=years * fixed.RETENTION_DAYS_PER_YEAR)


def cutoff_text(now: datetime, years: int) -> str:
    return cutoff_time(now, years).astimezone(UTC).isoformat()


def cutoff_ms(now: datetime, years: int) -> int:
    return int(cutoff_time(now, years).timestamp() * 1000)


def kept_by_text(column: str, cutoff: str) -> Column:
    """Keep text dates not below the cutoff; null dates stay."""
    return F.coalesce(F.col(column) >= F.lit(cutoff), F.lit(True))


def kept_by_time(column: str, cutoff: str) -> Column:
    """As :func:`kept_by_text`, comparing instants; unreadable dates stay."""
    parsed = F.coalesce(
        F.try_to_timestamp(F.col(column)), F.try_to_timestamp(F.col(column), F.lit("yyyy-MM-dd HH:mm:ss"))
    )
    return F.coalesce(parsed >= F.to_timestamp(F.lit(cutoff)), F.lit(True))


def kept_by_ms(column: str, cutoff: int) -> Column:
    """Keep epoch milliseconds not below the cutoff; null stays."""
    return F.coalesce(F.col(column) >= F.lit(cutoff), F.lit(True))
