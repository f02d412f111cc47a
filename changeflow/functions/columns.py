"""Scalar building blocks shared by refine, late-data and injection jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event time text is e.g. 2026-08-17T15:02:17.471Z: exactly three fraction
# digits. ``XXX`` reads the trailing Z as UTC itself, so the result does not
# depend on the session zone (a quoted 'Z' would be read in the session zone).
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Fixed values (must equal the reference's report): delay buckets around the
# 30 s watermark, half-open on the right; NULL and anything >= 60 s fall in
# the last one.
DELAY_BUCKETS = (
    (5, "a) <5s"),
    (15, "b) 5-15s"),
    (30, "c) 15-30s"),
    (45, "d) 30-45s"),
    (60, "e) 45-60s"),
)
DELAY_BUCKET_LAST = "f) >60s"


def event_time(text: Column | str) -> Column:
    """ISO text -> TIMESTAMP; NULL (never an error) when it does not parse."""
    col = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(col, F.lit(EVENT_TIME_PATTERN))


def ingest_delay(later: Column | str, earlier: Column | str) -> Column:
    """Seconds with fraction between two timestamps (later - earlier)."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return a.cast("double") - b.cast("double")


def delay_bucket(delay: Column | str, null_bucket: str | None = None) -> Column:
    """Label of the delay bucket. ``null_bucket`` gives NULL delays their own
    label instead of the last bucket."""
    d = F.col(delay) if isinstance(delay, str) else delay
    expr = None
    if null_bucket is not None:
        expr = F.when(d.isNull(), F.lit(null_bucket))
    for edge, label in DELAY_BUCKETS:
        expr = F.when(d < edge, F.lit(label)) if expr is None else expr.when(d < edge, F.lit(label))
    return expr.otherwise(F.lit(DELAY_BUCKET_LAST))


def partition_key(wiki: Column | str, title: Column | str) -> Column:
    """Queue key ``wiki|title``: all changes of one page land in one queue
    partition and keep their order. A missing part becomes ``?``."""
    w = F.col(wiki) if isinstance(wiki, str) else wiki
    t = F.col(title) if isinstance(title, str) else title
    return F.concat(F.coalesce(w, F.lit("?")), F.lit("|"), F.coalesce(t, F.lit("?")))


# Deterministic draws for fault injection: the first 48 bits of the MD5 of
# "key:seed:stream", so any SQL engine computes the same value, keys of any
# size draw without a period, and draws of different streams are independent.
_DRAW_BITS, _DRAW_DIGITS = 48, 12


def seeded_unit(key: Column | str, seed: int, stream: int = 0) -> Column:
    """Uniform value in [0, 1) from a key.

    ``stream`` gives independent draws for the same key and seed.
    """
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(":%d:%d" % (seed, stream))))
    return F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("double") / F.lit(float(1 << _DRAW_BITS))


def seeded_unit_sql(key: str, seed: int, stream: int = 0) -> str:
    """The same draw as SQL text (used by the oracles)."""
    digest = "md5(CAST(%s AS VARCHAR) || ':%d:%d')" % (key, seed, stream)
    return ("(CAST(CAST('0x' || substr(%s, 1, %d) AS BIGINT) AS DOUBLE) / %d.0)"
            % (digest, _DRAW_DIGITS, 1 << _DRAW_BITS))


# The source profile reads event times with up to six fraction digits; the
# refine step keeps to the three that the live stream sends.
PROFILE_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def profile_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(PROFILE_TIME_PATTERN))
