"""Command line for the jobs (spark-submit or python -m changeflow.cli).

    bronze   --source kafka --brokers B --topic T  (or --queue-path P) --warehouse W
    silver   --warehouse W [--lateness "30 seconds"]
    gold     --warehouse W [--exact] [--fold-counts]
    report   --warehouse W [--since "2026-08-17 00:00:00"]
    verify   --warehouse W [--source kinesis]      exit code 0 = no loss, no duplicates
    late     --warehouse W [--tag "evento sintetico"]
    profile  --capture PATH [--warehouse W]            source profile of capture files
    compact  --warehouse W --layer L --to DIR          closed days into files of the target size

Common: --seconds N (0 = run until stopped), --trigger "10 seconds",
--available-now (drain what is there and stop), --checkpoints DIR.
"""

from __future__ import annotations

import argparse
import sys


def _args(argv):
    p = argparse.ArgumentParser(prog="changeflow")
    p.add_argument("job", choices=["bronze", "silver", "gold", "report", "verify", "late", "profile", "compact"])
    p.add_argument("--warehouse", default="")
    p.add_argument("--capture")
    p.add_argument("--layer", default="bronze")
    p.add_argument("--to")
    p.add_argument("--checkpoints")
    p.add_argument("--source")
    p.add_argument("--brokers")
    p.add_argument("--topic")
    p.add_argument("--stream")
    p.add_argument("--region")
    p.add_argument("--queue-path")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--state-partitions", type=int)
    p.add_argument("--seconds", type=float, default=0)
    p.add_argument("--trigger")
    p.add_argument("--lateness", default="30 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--exact", action="store_true")
    p.add_argument("--fold-counts", action="store_true")
    p.add_argument("--since")
    p.add_argument("--format", choices=["parquet", "iceberg"], default="parquet")
    p.add_argument("--database", default="changeflow")
    p.add_argument("--tag", default="evento sintetico")
    return p.parse_args(argv)


def _print_all(df) -> None:
    """Every row, streamed partition by partition."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join(str(v) for v in row))


def main(argv=None) -> int:
    a = _args(argv if argv is not None else sys.argv[1:])
    from changeflow.operators import integrity, lateness, serving
    from changeflow.session import get_session
    from changeflow.sources import queue
    from changeflow.sources.tables import compact_closed_days, ensure_tables, read_table
    from changeflow.streaming import chain
    from changeflow.streaming.run import run_available, run_group, say_progress

    from pyspark.sql import functions as F

    spark = get_session(app="changeflow-" + a.job)
    cfg = chain.ChainConfig(warehouse=a.warehouse, checkpoints=a.checkpoints, lateness=a.lateness,
                            available_now=a.available_now, exact_editors=a.exact,
                            state_partitions=a.state_partitions, fold_counts=a.fold_counts,
                            fmt=a.format, database=a.database)
    if a.trigger:
        cfg.bronze_trigger = cfg.silver_trigger = cfg.gold_trigger = a.trigger

    if a.job in ("bronze", "silver", "gold"):
        ensure_tables(spark, a.warehouse, a.database, a.format)
        if a.job == "bronze":
            src = (queue.read_envelope_files(spark, a.queue_path) if a.queue_path else
                   queue.read_queue(spark, a.source, brokers=a.brokers, topic=a.topic,
                                    stream=a.stream, region=a.region,
                                    max_offsets_per_trigger=a.max_offsets_per_trigger))
            qs = [chain.start_bronze(spark, src, cfg)]
        elif a.job == "silver":
            qs = [chain.start_silver(spark, cfg)]
        else:
            qs = chain.start_gold(spark, cfg)
        if a.available_now:
            run_available(qs)
        else:
            run_group(spark, qs, a.seconds, tell=say_progress)
        return 0

    if a.job == "report":
        for name, df in serving.report(spark, a.warehouse, exact=a.exact, since=a.since,
                                       silver_checkpoint=cfg.ckpt("silver"), table=cfg.table).items():
            print("== %s" % name)
            _print_all(df)
        return 0

    if a.job == "verify":
        from changeflow.streaming.commits import table_commits
        bronze = read_table(spark, cfg.table("bronze"), layer="bronze")
        contiguous = queue.offsets_consecutive(a.source)
        if contiguous:  # one pass for verdict, continuity and missing ranges, per origin and partition
            keys = ("origen", "particion")
            bitmaps = integrity.offset_bitmaps(bronze, keys).persist()
            v = integrity.verdict_from_bitmaps(bitmaps, keys)
            _print_all(v)
            _print_all(integrity.continuity_from_bitmaps(bitmaps, keys).orderBy(*keys))
            _print_all(integrity.gap_ranges(bitmaps, keys).orderBy(*keys, "desde"))
        else:
            v = integrity.verdict(bronze, contiguous=False)
            _print_all(v)
        _print_all(table_commits(spark, cfg.table("bronze"), cfg.ckpt("bronze")))
        return 0 if v.first()["ok"] else 1

    if a.job == "compact":
        for day, n in compact_closed_days(spark, cfg.table(a.layer), a.to, a.layer):
            print("%s: %d files" % (day, n))
        return 0

    if a.job == "profile":
        from changeflow.operators import profile
        from changeflow.sources.capture import read_capture
        cap = read_capture(spark, a.capture)
        shapes = profile.shape_counts(cap)  # one pass for both schema reports
        for name, df in [("throughput", profile.throughput(cap)),
                         ("rate", profile.rate_percentiles(cap)),
                         ("sizes", profile.size_profile(cap)),
                         ("values", profile.top_values_of(cap, profile.REPORTED).orderBy(
                             "campo", F.col("eventos").desc(), "valor")),
                         ("duplicates", profile.duplicate_report(cap)),
                         ("disorder", profile.disorder(cap)),
                         ("latency", profile.arrival_latency(cap)),
                         ("schema", profile.schema_profile(cap, shapes)),
                         ("type_fields", profile.type_fields(cap, shapes=shapes)),
                         ("examples", profile.examples(cap))]:
            print("== %s" % name)
            _print_all(df)
        return 0

    # late
    raw = read_table(spark, cfg.table("bronze"), layer="bronze")
    silver = read_table(spark, cfg.table("silver"), layer="silver")
    batch = lateness.tagged(raw, a.tag)
    _print_all(lateness.injected_duplicates(batch))
    _print_all(lateness.survival(batch, silver))
    _print_all(lateness.dedup_proof(silver))
    return 0


if __name__ == "__main__":
    # run as a file (spark-submit changeflow/cli.py ...): make the package importable
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(main())
