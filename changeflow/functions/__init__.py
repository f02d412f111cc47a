"""Column-level helpers: every function takes and returns a ``Column``."""

from changeflow.functions.columns import (  # noqa: F401
    DELAY_BUCKETS,
    EVENT_TIME_PATTERN,
    delay_bucket,
    event_time,
    ingest_delay,
    partition_key,
    seeded_unit,
)
