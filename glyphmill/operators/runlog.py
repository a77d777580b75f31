"""Run counters, progress and error rows."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions.metrics import percent


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` counting itself while another job reads it; no job of its own."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def figures_of(seen: Observation, **nothing: object) -> dict[str, object]:
    """What was observed; ``nothing`` where the plan was known to have no rows, so that none was ever counted."""
    try:
        return dict(seen.get) or dict(nothing)
    except Py4JJavaError:
        return dict(nothing)


def run_counters(rows: DataFrame, effective: DataFrame, blocks: DataFrame, megabytes: DataFrame) -> DataFrame:
    """One row: rows, effective rows, chunks, output MB; each counted on its own table."""

    def figure(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("name"), "value")

    figures = (
        figure(rows, "rows", F.count("*"))
        .unionByName(figure(effective, "effective_rows", F.count("*")))
        .unionByName(figure(blocks, "chunks", F.count("*")))
        .unionByName(figure(megabytes, "output_mb", F.max("megabytes")))
    )
    wide = figures.groupBy().pivot("name", ["rows", "effective_rows", "chunks", "output_mb"])
    return wide.agg(F.first("value")).select(
        F.col("rows").cast("long").alias("rows"),
        F.col("effective_rows").cast("long").alias("effective_rows"),
        F.col("chunks").cast("long").alias("chunks"),
        "output_mb",
    )


def progress_line(current_row: Column, total_rows: Column, effective: Column, chunks: Column, mb: Column) -> Column:
    """The progress text of a run, without its clock."""
    return F.concat(
        F.lit("PROGRESS: "),
        percent(current_row / total_rows, 1),
        F.format_string(" | Row: %d/%d | Effective: %d | Chunks: %d", current_row, total_rows, effective, chunks),
        F.format_string(" | Output: %.1fMB", mb),
    )


def _one_line(text: Column) -> Column:
    return F.left(F.regexp_replace(text, r"[\r\n]", " "), F.lit(500))


def command_text(effects: Column) -> Column:
    """The effects of a manifest row as one line of at most 500 characters: each name and its arguments."""
    return _one_line(F.array_join(F.transform(effects, lambda e: F.concat_ws(" ", e["op"], e["args"])), " "))


def error_rows(df: DataFrame, key: str, stage: str, error: Column, effects: Column | None = None) -> DataFrame:
    """Failures of a stage as ``key, stage, error``, and ``command`` for what was to be drawn: one line each."""
    told = [F.col(key).cast("string").alias("key"), F.lit(stage).alias("stage"), _one_line(error).alias("error")]
    return df.select(*told, *([] if effects is None else [command_text(effects).alias("command")]))


@contextmanager
def logged_progress(spark: SparkSession, log_file: str | None, every: float = 5.0) -> Iterator[None]:
    """While the block runs, a line in ``log_file`` each time the tasks done of a running stage changed."""
    if not log_file:
        yield
        return
    done, tracker, told = threading.Event(), spark.sparkContext.statusTracker(), {}

    def watch() -> None:
        while not done.wait(every):
            lines = []
            for stage in tracker.getActiveStageIds():
                info = tracker.getStageInfo(stage)
                if info is not None and told.get(stage) != info.numCompletedTasks:
                    told[stage] = info.numCompletedTasks
                    share = 100 * info.numCompletedTasks / max(info.numTasks, 1)
                    lines.append(f"PROGRESS: stage {stage} | {share:.1f}% | Tasks: {info.numCompletedTasks}/{info.numTasks}\n")
            if lines:
                with open(log_file, "a", encoding="utf-8") as log:
                    log.writelines(lines)

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        done.set()
        watcher.join()
