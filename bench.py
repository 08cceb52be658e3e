"""Headline timings on one machine: prints one JSON line.

Operators start from stored inputs (long observations, wide matrices, table files,
workbook grids, all derived from the tables at ``$BENCH_SF_DIR`` beforehand), the
way a build starts from stored files; queries of the second group start from the
tables themselves.  Everything is built and run to the end twice, and the second run
counts, so JVM start-up and code generation are left out.  ``mart_build`` goes from
stored observations to the written star with all 25 projections.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import analytics, geo, mart, matrix, quality, reshape, tidy
from tallymart.plans import REGISTRY, inputs, market
from tallymart.session import build_session
from tallymart.sources import sinks

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FROM_TABLES = (
    "annual_totals", "gate_duplicate_keys", "filter_diagnosis", "pending_jobs", "log_latency", "html_links", "place_lookup",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    action()
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def stored(name: str, df: DataFrame) -> DataFrame:
        """As many files as cores: stored tables come in more than one."""
        df.repartition(int(CPUS)).write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    obs = stored("obs", inputs.obs(spark, SF_DIR))
    multi = stored("multi", inputs.obs_multi(spark, SF_DIR))
    wide = stored("wide", inputs.wide(spark, SF_DIR).drop("province"))
    files = stored("files", inputs.files(spark, SF_DIR))
    grid, books = inputs.workbook(spark, SF_DIR)
    grid = stored("grid", grid)
    clean = stored("clean", inputs.market(spark, SF_DIR))
    directory = stored("directory", market.directory(spark, SF_DIR))
    table_map, metrics = market.table_map(spark), market.metric_table(spark)

    def fact() -> DataFrame:
        return mart.shape_fact(mart.place_fact(clean, table_map, directory))

    fact_table = stored("fact", fact())
    places = stored("places", geo.geography_dimension(fact_table, directory, province=F.lit("Home")))
    spec = next(p for p in mart.projections() if p.name == "average_rent_by_bedroom")

    operators = {
        "star_fact": fact,
        "geo_dim": lambda: geo.geography_dimension(fact_table, directory, province=F.lit("Home")),
        "star_query": lambda: mart.star(fact_table, metrics, places),
        "metric_table_average_rent_by_bedroom": lambda: mart.project_metric(mart.star(fact_table, metrics, places), spec),
        "all_metric_tables": lambda: mart.all_projections(mart.star(fact_table, metrics, places)),
        "wide_to_long": lambda: reshape.wide_to_long(
            wide, "sub_geography", is_code=lambda c: c.endswith(" code"), keep=("geography", "period")),
        "tidy_long": lambda: tidy.tidy_files(files, inputs.FILE_KEYS),
        "matrix_long": lambda: matrix.matrix_long(grid, books),
        "latest_per_group": lambda: analytics.latest_per_group(
            obs, ["sub_geography", "category"], ["value", "reliability", "geography"]),
        "dedup_row_number": lambda: analytics.dedup_paths(multi, ["geography", "sub_geography", "period", "category"]),
        "gate_null_category": lambda: quality.null_category_gate(obs, "sub_geography"),
    }
    seconds = {name: timed(lambda make=make: drain(make())) for name, make in operators.items()}
    seconds["mart_build"] = timed(lambda: sinks.write_mart(
        spark, clean, f"{work}/mart", metrics=metrics, table_map=table_map, directory=directory, province=F.lit("Home")))
    for name in FROM_TABLES:
        seconds[name] = timed(lambda q=REGISTRY[name]: drain(q.run(spark, SF_DIR)))

    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "rows": {"fact": fact_table.count(), "obs": obs.count(), "files": files.count(), "grid": grid.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
