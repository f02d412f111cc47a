"""Parameters of the fault-injection scenario the registered late-data
queries run on the test log (the reference's test used late and duplicate
shares of this order, delays up to minutes, a 30 s watermark and a 10 s
trigger)."""

LATE = {
    "late_pct": 25.0,
    "lo_s": 1.0,
    "hi_s": 300.0,
    "dup_pct": 10.0,
    "seed": 42,
}

# The streamed scenario: the log re-timed to ``span_s`` seconds, queue delays
# of 0 to 90 s, ``dup_pct`` % of the messages delivered again ``redelivery_s``
# later, and one queue file (one micro-batch) per ``file_s`` seconds of queue
# time; silver runs behind a 30 s watermark.
STREAM = {
    "span_s": 240,
    "file_s": 20,
    "redelivery_s": 12,
    "dup_pct": 10.0,
    "seed": 42,
    "lateness_s": 30,
}
