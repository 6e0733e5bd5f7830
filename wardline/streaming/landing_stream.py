"""Structured Streaming over the landing folder (SS-1, SS-2, SS-3).

The file source detects newly landed CSV files; every micro-batch reloads the
*complete* extraction dates it touched with the batch loader (checks, gate,
dynamic partition overwrite). A late file for an older date therefore just
replaces that date again, and the final state does not depend on arrival
order. ``trigger(availableNow=True)`` processes what has landed and stops, which
is how a scheduled daily run uses it; the checkpoint (under the cluster's
``spark.checkpoint.dir``) records which files were already seen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.registry import TableSpec
from wardline.sinks import files
from wardline.sinks.landing_io import PART_COL, load, read_source


def stream_load(
    spark: SparkSession,
    landing_root: str,
    target_root: str,
    spec: TableSpec,
    checkpoint: str | None = None,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Run the landing stream until everything available is loaded; return the
    concatenated load reports of all micro-batches (read back from disk)."""
    checkpoint = checkpoint or files.fresh_dir(spark, f"stream-ckpt-{spec.name}")
    reports = f"{target_root}/_load_reports/{spec.name}"
    # the stream only says which dates have new files: it lists them and reads no content
    src = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(f"{landing_root}/{spec.name}/*")
        .select(F.regexp_extract(F.col("path"), f"{PART_COL}=([0-9-]+)", 1).alias("_date"))
    )

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # dates touched by this batch: one row per date, bounded by the listing
        dates = [dt.date.fromisoformat(r["_date"]) for r in batch.select("_date").distinct().collect() if r["_date"]]
        if not dates:
            return
        # a batch that is run again after a failure finds its commit and replaces its own report
        report = load(spark, landing_root, target_root, spec, dates, key=checkpoint, epoch=epoch_id)
        report.write.mode("overwrite").parquet(f"{reports}/epoch_id={epoch_id}")

    q = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(reports)


def data_reference_date(spark: SparkSession, target_root: str, specs: list[TableSpec]) -> dt.date | None:
    """SS-3: the latest extraction date loaded into any source table (never the clock)."""
    best = None
    for spec in specs:
        d = read_source(spark, target_root, spec).select(F.max("path_date")).first()[0]
        if d is not None and (best is None or d > best):
            best = d
    return best
