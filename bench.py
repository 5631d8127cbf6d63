"""Times the headline queries and the live path; prints one JSON line.

The messages of the source table are landed once, outside the clock, as the files a stream would leave: several per core.
``from_messages`` queries read these: messages are checked, parsed, deduplicated and aggregated each time.  ``stored`` queries read the
tables of a lake that a replay has filled, which is how dashboards use them.  The live path reads the same files as a stream in
several micro-batches through ``Pipeline.start``, with all checking and refreshing inside the clock.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from contextlib import redirect_stdout
from sys import stderr

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
LIVE_BATCHES = 3

FROM_MESSAGES = [
    "s02_json_validity", "s03_message_key", "s08b_typed_messages", "r1_keep_latest_silver", "g1_hourly_stats",
    "g2_users_daily", "g3_pages_hourly", "g4_languages_hourly", "q05_silver_overview", "q08_top_human_users",
    "q11_largest_growth", "q15_errors_by_type", "q24b_bot_share", "w2_busiest_users_per_day",
]


def session(folder: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", folder)
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def timed(action) -> float:
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> dict:
    from ripplelake.plans import catalogue as c
    from ripplelake.plans import lakes, maintain, registry
    from ripplelake.plans import medallion as m
    from ripplelake.plans.oracle import AS_OF
    from ripplelake.schema import HOURLY_STATS, LANGUAGES, SILVER, TOP_PAGES, TOP_USERS
    from ripplelake.session import scratch
    from ripplelake.sources import recent_changes, typed
    from ripplelake.sources.lake import Lake
    from ripplelake.streaming.pipeline import Pipeline

    spark = session(tempfile.mkdtemp(prefix="bench-"))
    folder, times = scratch(spark, "landed"), {}
    landed = {}
    for name, messages in (
        ("stamped", recent_changes.recent_changes(spark, SF_DIR)),
        ("lines", recent_changes.framed_lines(spark, SF_DIR)),
        ("typed", recent_changes.typed_changes(spark, SF_DIR)),
    ):
        messages.repartition(LIVE_BATCHES * int(CPUS)).write.parquet(f"{folder}/{name}")
        landed[name] = spark.read.parquet(f"{folder}/{name}")

    def inputs() -> registry.Inputs:
        """The same queries with the landed files as their messages."""
        made = registry.Inputs(spark, SF_DIR)
        made.__dict__.update(stamped=landed["stamped"], lines=landed["lines"], typed=typed.typed_messages(landed["typed"]))
        return made

    for name in FROM_MESSAGES:
        times[name] = timed(lambda: run(registry.TABLE[name](inputs())))
        print(name, times[name], file=stderr, flush=True)

    start = time.perf_counter()
    lake = lakes.replayed(spark, SF_DIR)
    times["replay_twice"] = round(time.perf_counter() - start, 3)

    silver, stats = lake.read(SILVER), lake.read(HOURLY_STATS)
    users, pages, languages = lake.read(TOP_USERS), lake.read(TOP_PAGES), lake.read(LANGUAGES)
    stored = {
        "q04": lambda: c.total(silver), "q05": lambda: c.silver_overview(silver),
        "q06": lambda: c.language_distribution(silver), "q07": lambda: c.type_distribution(silver),
        "q08": lambda: c.top_human_users(silver), "q09": lambda: c.top_wikis(silver),
        "q10": lambda: c.author_mix(silver), "q11": lambda: c.largest_growth(silver),
        "q12": lambda: c.latest_hours(silver), "q13": lambda: c.latest_changes(silver),
        "q17": lambda: c.hourly_authors(stats, AS_OF), "q18": lambda: c.hourly_edits(stats, AS_OF),
        "q19": lambda: c.top_human_users_daily(users), "q20": lambda: c.language_share(languages, AS_OF),
        "q21": lambda: c.top_pages(pages, AS_OF),
        "g1": lambda: m.hourly_stats(m.activity(silver)), "g2": lambda: m.users_daily(m.activity(silver)),
        "g3": lambda: m.pages_hourly(m.activity(silver)), "g4": lambda: m.languages_hourly(m.activity(silver)),
        "sizes": lambda: maintain.table_sizes(lake, [SILVER, HOURLY_STATS, TOP_USERS, TOP_PAGES, LANGUAGES]),
    }
    for name, make in stored.items():
        times[f"stored_{name}"] = timed(lambda: run(make()))
        print(name, times[f"stored_{name}"], file=stderr, flush=True)

    live = Lake(spark, scratch(spark, "bench-live"), grain="day")
    count = landed["stamped"].count()
    stream = spark.readStream.schema(landed["stamped"].schema).option("maxFilesPerTrigger", int(CPUS)).parquet(f"{folder}/stamped")
    start = time.perf_counter()
    query = Pipeline(live).start(stream, scratch(spark, "bench-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    seconds = time.perf_counter() - start
    batches = [p["batchDuration"] / 1000 for p in query.recentProgress if p["numInputRows"]]
    times["live_batches"] = round(seconds, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "live_rows_per_second": round(count / seconds, 1),
        "live_seconds_per_batch": [round(b, 1) for b in batches],
    }
    spark.stop()
    return result


if __name__ == "__main__":
    with redirect_stdout(stderr):
        outcome = main()
    print(json.dumps(outcome))
