"""Run history and the conditions worth an alert, as DataFrame jobs.

A history frame has one row per run and table: ``run_id`` (rising), ``run_date``, ``table``,
``rows_fetched``, ``rows_inserted``, ``rows_updated``, ``text_fallback_columns``,
``last_value``, ``error``.

Windows run per table over its runs, so a partition holds one row per run of one table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scan import union_all


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Row counts and greatest watermarks on both sides, per table.

    ``pairs`` maps a table to (source frame, target frame, watermark column). Everything is
    one job of column-pruned aggregates.
    """

    def side(table, df, watermark, name):
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col(watermark)).cast("string").alias("newest")
        ).select(F.lit(table).alias("table"), F.lit(name).alias("side"), "n", "newest")

    sides = [
        side(table, frame, watermark, name)
        for table, (source, target, watermark) in pairs.items()
        for name, frame in (("source", source), ("target", target))
    ]
    value = lambda name, c: F.max(F.when(F.col("side") == name, F.col(c)))
    return (
        union_all(sides)
        .groupBy("table")
        .agg(
            value("source", "n").alias("source_rows"),
            value("target", "n").alias("target_rows"),
            value("source", "newest").alias("source_newest"),
            value("target", "newest").alias("target_newest"),
        )
        .withColumn("missing_rows", F.col("source_rows") - F.col("target_rows"))
        .withColumn("in_step", F.col("source_newest").eqNullSafe(F.col("target_newest")))
    )


def append_history(report: DataFrame, history_uri: str, run_id: int) -> None:
    """Adds one run's report to the history, in a folder per day and run.

    A run that is reported again replaces its earlier report and keeps that one's day, so a report may be repeated.
    """
    spark = report.sparkSession
    day = F.current_date()
    try:
        known = spark.read.parquet(history_uri)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:  # reads folder names only
        before = known.where(F.col("run_id") == run_id).select(F.min("run_date")).first()[0] if "run_id" in known.columns else None
        day = F.lit(before).cast("date") if before is not None else day
    stamped = report.withColumn("run_id", F.lit(run_id).cast("long")).withColumn("run_date", day)
    overwrite = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    overwrite.partitionBy("run_date", "run_id").parquet(history_uri)


def silent_streaks(history: DataFrame) -> DataFrame:
    """Runs in a row without a fetched row: ``table, first_run, last_run, runs`` for each such streak.

    Table ``*`` stands for all tables of a run together. A streak ends where a run fetched something; runs that a
    table took no part in do not break it. Failed runs, which have no count, neither make nor break a streak.
    """
    counted = history.where("rows_fetched IS NOT NULL").select("table", "run_id", "rows_fetched")
    whole = counted.groupBy("run_id").agg(F.sum("rows_fetched").alias("rows_fetched")).select(F.lit("*").alias("table"), "run_id", "rows_fetched")
    silent = F.col("rows_fetched") == 0
    # a run's place among all runs less its place among its like stays the same through a streak
    alike = Window.partitionBy("table", silent).orderBy("run_id")
    streak = F.row_number().over(_runs()) - F.row_number().over(alike)
    marked = counted.unionByName(whole).withColumns({"__streak": streak})
    found = marked.where(silent).groupBy("table", "__streak")
    return found.agg(F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run"), F.count(F.lit(1)).alias("runs")).drop("__streak")


def _runs() -> Window:
    return Window.partitionBy("table").orderBy("run_id")


def stalled_checkpoints(history: DataFrame, runs: int) -> DataFrame:
    """Runs at which a table's checkpoint had not moved for ``runs`` runs."""
    before = F.lag("last_value", runs).over(_runs())
    seen = F.row_number().over(_runs())
    flagged = history.withColumns({"__before": before, "__seen": seen})
    still = F.col("last_value").eqNullSafe(F.col("__before")) & (F.col("__seen") > runs)
    return flagged.where(still).select("table", "run_id", "last_value")


def unusual_volume(history: DataFrame, runs: int, deviations: float = 3.0) -> DataFrame:
    """Runs that fetched far more than the ``runs`` runs before them."""
    before = _runs().rowsBetween(-runs, -1)
    scored = history.withColumns(
        {
            "mean_fetched": F.avg("rows_fetched").over(before),
            "sd_fetched": F.stddev_pop("rows_fetched").over(before),
            "__n": F.count("rows_fetched").over(before),
        }
    )
    high = F.col("rows_fetched") > F.col("mean_fetched") + F.lit(deviations) * F.col("sd_fetched")
    return scored.where((F.col("__n") == runs) & high).select("table", "run_id", "rows_fetched", "mean_fetched")


def silent_runs(history: DataFrame, runs: int) -> DataFrame:
    """Runs at which no table had fetched a row in its last ``runs`` runs.

    Each table looks back over its own runs, then the tables of a run are put together; no
    window goes over the whole history.
    """
    recent = _runs().rowsBetween(1 - runs, 0)
    quiet = history.select(
        "run_id", F.sum("rows_fetched").over(recent).alias("__sum"), F.count(F.lit(1)).over(recent).alias("__n")
    )
    return (
        quiet.groupBy("run_id")
        .agg(F.max("__sum").alias("__sum"), F.min("__n").alias("__n"), F.count(F.lit(1)).alias("tables"))
        .where((F.col("__sum") == 0) & (F.col("__n") == runs))
        .select("run_id", "tables")
    )


def new_text_fallbacks(history: DataFrame) -> DataFrame:
    """Columns that became text since the table's previous run."""
    before = F.lag("text_fallback_columns").over(_runs())
    added = F.array_except("text_fallback_columns", "__before")
    return (
        history.withColumn("__before", before)
        .where(F.col("__before").isNotNull())
        .withColumn("new_fallbacks", added)
        .where(F.size("new_fallbacks") > 0)
        .select("table", "run_id", "new_fallbacks")
    )


def update_heavy_tables(history: DataFrame, ratio: float = 10.0) -> DataFrame:
    """Tables whose updates outnumber their inserts by more than ``ratio`` over the history."""
    sums = history.groupBy("table").agg(
        F.sum("rows_inserted").alias("rows_inserted"), F.sum("rows_updated").alias("rows_updated")
    )
    return sums.where(F.col("rows_updated") > F.lit(ratio) * F.greatest(F.col("rows_inserted"), F.lit(1)))
