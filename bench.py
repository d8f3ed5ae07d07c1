"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is computed whole into the noop sink.  Rendering the tables as
transfer files happens once, before, and is listed as its own entry.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from basketlens.plans import registry, shop  # noqa: E402

HEADLINE = [
    "scan_order_typed", "scan_line_typed", "object_counts", "operation_mix", "residual_json", "values_wildcard",
    "values_of_basket", "bag_rows", "bag_sizes", "structure_json", "association_join", "association_arith",
    "segment_revenue", "lines_per_order", "edit_audit", "edit_apply", "edit_conflict", "write_scan_roundtrip",
    "incremental_ingest", "catalog_transfer_order", "quality_multiplicity", "quality_reference", "quality_duplicate",
    "quality_summary", "geometry_points", "geometry_length", "geometry_area", "geometry_wkb", "geometry_arc_stroke",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Long generated methods are not compiled by the JVM; split them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    started = time.time()
    for name in ("sales", "stock", "tracks", "tracks24"):
        shop.folder(spark, sf_dir, name)
    times["render_transfers"] = round(time.time() - started, 2)
    for name in HEADLINE:
        started = time.time()
        registry.QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.time() - started, 2)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 2), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
