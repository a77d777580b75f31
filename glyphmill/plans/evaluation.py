"""Records or predictions to scores, summary and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import evaluate as E
from glyphmill.session import materialize
from glyphmill.sources.records import read_records
from glyphmill.sources.sinks import write_records


def evaluate_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The printed table and the summary lines of a JSON file of records."""
    records = E.with_record_defaults(read_records(spark, path))
    scored = E.stored_scores(records)
    return E.report(scored), E.summary_lines(E.summary(scored))


def compare_systems(
    truth: DataFrame, predictions: dict[str, DataFrame], export: str | None = None, with_problems: bool = False
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Scores of joined predictions; the joined texts are exported first if asked, and then read from there.

    With ``with_problems`` also the keys that do not match one to one, as ``system, id, problem``. Both come
    from one stored table, made by one shuffle of truth and predictions.
    """
    systems = {name: name for name in predictions}
    matched = E.matched_predictions(truth, predictions)
    if with_problems:
        matched = materialize(matched, "matched")
    joined = E.with_record_defaults(matched.filter("known"), systems)
    if export:
        columns = E.export_columns(joined, systems)
        write_records(columns, export)
        joined = truth.sparkSession.read.schema(columns.schema).json(export)
    scored = E.scores(joined, systems)
    if not with_problems:
        return scored
    return scored, matched.select("id", F.inline("problems")).select("system", "id", "problem")
