"""Jobs: build a mart and load it into a sink.

    python -m touchline.plans.jobs performance --input data.csv --output mart
    python -m touchline.plans.jobs gold --input folder --output mart
    python -m touchline.plans.jobs files --input folder --output landing
    python -m touchline.plans.jobs panel --input mart --panel country_table --max-age 32

Without --output the marts go to, and without --input the panels come from, the
database named by the PG_* environment variables.
"""

from __future__ import annotations

import argparse
import logging
import time
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.operators.quality import validate
from touchline.operators.reconcile import orphans
from touchline.plans import gold, panels, performance
from touchline.session import build_session, scratch_path
from touchline.sources import files, sinks, tables
from touchline.streaming import feeds

log = logging.getLogger(__name__)


def run_timestamp(moment: datetime | None = None) -> Column:
    """One audit time for all rows of a run."""
    return F.lit(moment or datetime.now(timezone.utc))


def run_performance(
    spark: SparkSession, path: str, sink: sinks.Sink, run_ts: Column | None = None,
    date_id: int = fv.PERFORMANCE_DATE_ID,
) -> dict[str, int]:
    """Player file to star schema; quality failures warn and do not stop the run."""
    run_ts = run_timestamp() if run_ts is None else run_ts
    raw = tables.read_csv(spark, path, fv.PLAYER_SCHEMA)
    if not validate(raw):
        log.warning("data quality issues found, continuing")
    made: list[str] = []
    try:
        return _load_performance(spark, tables.stored(performance.clean_players(raw), "clean_players", made), sink, run_ts, date_id)
    finally:
        files.remove_folders(spark, made)


def _load_performance(
    spark: SparkSession, clean: DataFrame, sink: sinks.Sink, run_ts: Column, date_id: int
) -> dict[str, int]:
    players = performance.dim_player(clean, run_ts)
    countries = performance.dim_country(clean, run_ts)
    positions = performance.dim_position(clean, run_ts)
    fact = performance.fact_performance(clean, run_ts, date_id)
    return sinks.load_tables(
        {
            "dim_player": players,
            "dim_country": countries,
            "dim_position": positions,
            "dim_date": performance.dim_date(spark),
            "fact_performance": fact,
            "agg_country_performance": performance.agg_country(fact, countries, run_ts),
            "agg_position_performance": performance.agg_position(fact, positions, run_ts),
            "agg_top_performers": performance.top_performers(fact, players, countries, run_ts),
        },
        sink,
    )


def run_gold(spark: SparkSession, folder: str, sink: sinks.Sink, all_snapshots: bool = False, prefix: str = fv.GOLD_PREFIX, asof: bool = False) -> dict[str, int]:
    """Gold inputs to the gold mart; the sink is tried before any work."""
    sinks.smoke_test(spark, sink)
    inputs = tables.read_gold_inputs(spark, folder, prefix)
    tables.require(inputs)
    made: list[str] = []
    try:
        typed = {n: tables.stored(df, n, made) if df is not None else None for n, df in inputs.items()}
        return sinks.load_tables(gold.build(spark, typed, all_snapshots, made, asof), sink)
    finally:
        files.remove_folders(spark, made)


def run_files(
    spark: SparkSession, folder: str, target: str, cleanup: bool = False, state: str | None = None,
    timeout_s: float | None = None, dead_letters: str | None = None, batch_files: int = 64,
    servers: str | None = None, topic: str = fv.FILES_TOPIC, batch_messages: int = 10_000,
) -> int:
    """Copy files through the message feed; ``cleanup`` first removes stale top-level files.

    Messages go through the Kafka ``topic`` at ``servers``, at most ``batch_messages`` in a micro-batch, else
    through a folder in ``state``, ``batch_files`` at a time. ``state`` also holds how far the feed has come;
    with ``servers`` it must be given and keeps the offsets, so that the next run begins where this one ended
    and lands no message twice. When ``timeout_s`` strikes,
    ``Unfinished`` is raised; the same call goes on where that one stopped, without
    sending the files again. Rejected messages go to ``dead_letters``.
    """
    if timeout_s and not state:
        raise ValueError("a time limit needs a state folder, else the rest could not be landed later")
    if servers and not state:
        raise ValueError("messages from servers need a state folder, else old ones would be landed again")
    if cleanup:
        made: list[str] = []
        stale = orphans(
            files.list_files(spark, target, made=made).where("is_top_level"),
            files.list_files(spark, folder, made=made), ["rel_path"],
        )
        log.info("deleted %d stale files", files.delete_files(stale, target, folder).where("deleted").count())
        files.remove_folders(spark, made)
    state = state or scratch_path(spark, topic)
    sent, offsets = f"{state}/messages", f"{state}/offsets"
    if not files.exists(spark, f"{state}/sent/_SUCCESS"):
        now_ms = int(time.time() * 1000)
        messages = files.envelopes(files.list_files(spark, folder, content=True), F.col("content"), F.lit(now_ms))
        done = files.done_message(spark, now_ms)
        if servers:
            feeds.publish_kafka(messages, servers, topic)
            feeds.publish_kafka(done, servers, topic)
        else:
            messages.select("value").write.mode("overwrite").text(sent)
            done.select("value").write.mode("append").text(sent)
        spark.range(1).write.mode("overwrite").parquet(f"{state}/sent")
    feed = feeds.kafka_feed(spark, servers, topic, batch_messages) if servers else feeds.file_feed(spark, sent, batch_files)
    landed = feeds.land_envelopes(feed, target, offsets, timeout_s, dead_letters or f"{target.rstrip('/')}_rejected")
    files.remove_folders(spark, [f"{state}/sent" if servers else state])
    return landed


def run_panel(
    spark: SparkSession, name: str, folder: str | None = None, variables: panels.Variables = panels.DEFAULTS
) -> DataFrame:
    """One dashboard panel over the loaded star."""

    def read(table: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{table}") if folder else sinks.read_jdbc(spark, table)

    return panels.PANELS[name](performance.stored_view(read), variables)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["performance", "gold", "files", "panel"])
    parser.add_argument("--input")
    parser.add_argument("--output")
    parser.add_argument("--cleanup", action="store_true", help="files: remove stale targets first")
    parser.add_argument("--state", help="files: folder that keeps how far the feed has come")
    parser.add_argument("--timeout", type=float, help="files: stop after so many seconds; needs --state")
    parser.add_argument("--dead-letters", help="files: folder for rejected messages")
    parser.add_argument("--servers", help="files: Kafka servers to send through")
    parser.add_argument("--topic", default=fv.FILES_TOPIC, help="files: Kafka topic")
    parser.add_argument("--prefix", default=fv.GOLD_PREFIX, help="gold: what the names of tournament files begin with")
    parser.add_argument("--all-snapshots", action="store_true", help="gold: keep every KPI snapshot")
    parser.add_argument("--asof", action="store_true", help="gold: KPIs as they stood on the day of a match")
    parser.add_argument("--panel", choices=sorted(panels.PANELS), default="country_table")
    parser.add_argument("--position", default=fv.DEFAULT_POSITION)
    parser.add_argument("--max-age", type=int, default=fv.DEFAULT_MAX_AGE)
    parser.add_argument("--min-rating", type=float, default=fv.DEFAULT_MIN_RATING)
    args = parser.parse_args(argv)
    if args.job != "panel" and not args.input:
        parser.error("--input is required")
    if args.job == "files" and not args.output:
        parser.error("--output is required")
    if (args.timeout or args.servers) and not args.state:
        parser.error("--timeout and --servers need --state")
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"touchline-{args.job}")
    sink = sinks.parquet_sink(args.output) if args.output else sinks.jdbc_sink()
    if args.job == "performance":
        run_performance(spark, args.input, sink)
    elif args.job == "gold":
        run_gold(spark, args.input, sink, args.all_snapshots, args.prefix, args.asof)
    elif args.job == "files":
        landed = run_files(
            spark, args.input, args.output, args.cleanup, args.state, args.timeout, args.dead_letters,
            servers=args.servers, topic=args.topic,
        )
        log.info("landed %d files", landed)
    else:
        variables = panels.Variables(args.position, args.max_age, args.min_rating)
        run_panel(spark, args.panel, args.input, variables).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
