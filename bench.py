"""Times the headline queries and prints one JSON line.

The eleven input tables are derived from ``$BENCH_SF_DIR`` and stored as Parquet first (``prepare``
in the output), since the report starts from such tables; jobs are laid out by start time. Each
query is then planned and run in full, its rows going to a sink that drops them; after one run of
the report to warm up, the better of ``$BENCH_REPEATS`` (2) runs counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from dataclasses import fields

from checks.compare import local_session
from checks.queries import on_tables
from sitecharge.plans.session import configure
from sitecharge.sources.fixtures import sample_tables
from sitecharge.sources.tables import Tables, tables_from_path

HEADLINE = [
    "site_report",
    "site_rollup",
    "turned_on_dates",
    "job_facts",
    "scenario_charges",
    "merged_jobs",
    "site_upper_bound",
    "outlier_flags",
    "job_charges",
    "custom_charges",
]


def prepare(spark, sf_dir: str, cpus: int, folder: str) -> Tables:
    derived = sample_tables(spark, sf_dir)
    for field in fields(Tables):
        df = getattr(derived, field.name)
        if field.name == "jobs":
            df = df.repartitionByRange(cpus, "actual_start_at")
        elif field.name in ("work_orders", "scenario_charges", "custom_per_unit_charges"):
            df = df.repartition(cpus)
        df.write.parquet(f"{folder}/{field.name}")
    return tables_from_path(spark, folder)


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = configure(local_session(cpus))
    folder = tempfile.mkdtemp(prefix="bench-")
    made: list[Tables] = []
    preparation = timed(lambda: made.append(prepare(spark, sf_dir, cpus, folder)))
    tables = made[0]

    def run(name: str) -> None:
        on_tables(name, spark, tables).write.format("noop").mode("overwrite").save()

    first = timed(lambda: run("site_report"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    queries = {
        name: min(timed(lambda n=name: run(n)) for _ in range(repeats)) for name in HEADLINE
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf") or 0),
                "prepare": preparation,
                "site_report_first_run": first,
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()
