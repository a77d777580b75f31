"""Scoring recognition systems against the ground truth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.metrics import cer, percent, wer
from glyphmill.operators.runlog import figures_of, observed
from glyphmill.session import dealt, materialize

# Score label -> column of the system's texts; the first is the baseline.
SYSTEMS = {"raw": "raw", "ft": "finetuned"}
DETAIL_ROWS = 20
#: Code points of both texts of a pair from which stored scores deal records out on their own.
LONG_TEXT = 20_000
ALL_ROWS_UP_TO = 50


def with_record_defaults(df: DataFrame, systems: dict[str, str] = SYSTEMS, *keep: str) -> DataFrame:
    """Evaluation records with defaults. A missing column and a null mean the same.

    ``ground_truth`` falls back to ``text``, then to empty. ``id`` falls back to
    the 0-based ``pos``, so a table without ids must bring that column. ``keep`` names more columns to pass on.
    """

    def first_of(*names: str, default: Column) -> Column:
        return F.coalesce(*[F.col(n).cast("string") for n in names if n in df.columns], default)

    no_id = F.col("pos").cast("string") if "pos" in df.columns else F.lit(None).cast("string")
    return df.select(
        *[c for c in ("pos",) if c in df.columns],
        first_of("id", default=no_id).alias("id"),
        first_of("language", default=F.lit("unk")).alias("language"),
        first_of("ground_truth", "text", default=F.lit("")).alias("ground_truth"),
        *[first_of(c, default=F.lit("")).alias(c) for c in systems.values()],
        *keep,
    )


def scores(df: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """Per record ``{label}_cer`` and ``{label}_wer``, and the baseline's CER minus each other's.

    Records are dealt out evenly first: edit distances cost far more than moving texts.
    """
    rates = {}
    for label, column in systems.items():
        rates[f"{label}_cer"] = cer(F.col("ground_truth"), F.col(column))
        rates[f"{label}_wer"] = wer(F.col("ground_truth"), F.col(column))
    scored = dealt(df).withColumns(rates)
    return scored.withColumns(
        {
            name: F.col(f"{base}_cer") - F.col(f"{label}_cer")
            for base, label, name in _improvements(systems)
        }
    )


def stored_scores(df: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """``scores`` without the texts, stored once for the report and the summary.

    Records of texts over ``LONG_TEXT`` are scored on their own, if there are any: dealt evenly among themselves,
    as one of them takes as long as thousands of others.
    """
    texts = ["ground_truth", *systems.values()]
    long = F.coalesce(reduce(Column.__or__, [_long(c) for c in systems.values()]), F.lit(False))
    told, seen = observed(df, "records", long=F.count_if(long))
    stored = materialize(scores(told.filter(~long), systems).drop(*texts), "scores")
    if not figures_of(seen, long=0)["long"]:
        return stored
    return stored.unionByName(materialize(scores(df.filter(long), systems).drop(*texts), "scores"))


def _long(column: str) -> Column:
    return F.least(F.length("ground_truth"), F.length(column)) > LONG_TEXT


def _improvements(systems: dict[str, str]) -> list[tuple[str, str, str]]:
    base, *others = systems
    if len(others) == 1:
        return [(base, others[0], "improvement")]
    return [(base, label, f"{label}_improvement") for label in others]


def averages(scored: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """One row: the number of records and the plain mean of every rate; empty for no records."""
    means = [F.avg(f"{s}_{m}").alias(f"{s}_{m}") for s in systems for m in ("cer", "wer")]
    return scored.agg(F.count("*").alias("n"), *means).filter(F.col("n") > 0)


def summary(scored: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """One row of overall figures: mean rates, accuracies, and gains over the baseline."""
    base, *others = systems
    gains = []
    for label in others:
        prefix = "" if len(others) == 1 else f"{label}_"
        gain = F.col(f"{base}_cer") - F.col(f"{label}_cer")
        gains += [
            gain.alias(f"{prefix}cer_improvement"),
            (F.col(f"{base}_wer") - F.col(f"{label}_wer")).alias(f"{prefix}wer_improvement"),
            F.when(F.col(f"{base}_cer") > 0, gain / F.col(f"{base}_cer"))
            .otherwise(0.0)
            .alias(f"{prefix}relative_cer_reduction"),
        ]
    accuracy = [(1 - F.col(f"{s}_cer")).alias(f"{s}_accuracy") for s in systems]
    return averages(scored, systems).select("*", *accuracy, *gains)


def is_detail_row(pos: Column, n: int) -> Column:
    """All rows of up to 50; else every (n // 20)-th by position, and the last."""
    if n <= ALL_ROWS_UP_TO:
        return F.lit(True)
    return (pos % (n // DETAIL_ROWS) == 0) | (pos == n - 1)


def report(scored: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    """The printed table: chosen rows in order of ``row_no``, then the AVERAGE row.

    ``scored`` is stored and its rows carry their 0-based ``pos``.
    """
    n = scored.count()
    rates = [f"{s}_{m}" for m in ("cer", "wer") for s in systems]
    gains = _improvements(systems)

    def printed(df: DataFrame) -> DataFrame:
        return df.select(
            "row_no",
            "id",
            "language",
            *[percent(F.col(r)).alias(r) for r in rates],
            *[percent(F.col(name), signed=True).alias(name) for _, _, name in gains],
        )

    detail = scored.filter(is_detail_row(F.col("pos"), n))
    average = averages(scored, systems).withColumns(
        {name: F.col(f"{b}_cer") - F.col(f"{s}_cer") for b, s, name in gains}
    )
    return printed(detail.withColumn("row_no", F.col("pos").cast("long"))).unionByName(
        printed(
            average.withColumns(
                {"row_no": F.col("n"), "id": F.lit("AVERAGE"), "language": F.lit("")}
            )
        )
    )


def summary_lines(summed: DataFrame) -> DataFrame:
    """The overall figures as ``line_no, label, value`` with percent texts."""
    lines = [
        ("Overall Raw CER", percent(F.col("raw_cer"))),
        ("Overall Finetuned CER", percent(F.col("ft_cer"))),
        ("Overall Raw WER", percent(F.col("raw_wer"))),
        ("Overall Finetuned WER", percent(F.col("ft_wer"))),
        ("Overall Raw Accuracy (1-CER)", percent(F.col("raw_accuracy"))),
        ("Overall Finetuned Accuracy (1-CER)", percent(F.col("ft_accuracy"))),
        ("CER Improvement", percent(F.col("cer_improvement"), signed=True)),
        ("WER Improvement", percent(F.col("wer_improvement"), signed=True)),
        ("Relative CER Reduction", percent(F.col("relative_cer_reduction"), 1)),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("line_no"), F.lit(label).alias("label"), value.alias("value"))
            for i, (label, value) in enumerate(lines)
        ]
    )
    return summed.select(F.inline(rows))


def join_predictions(truth: DataFrame, predictions: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Ground truth with each system's text, joined on the record key.

    ``predictions`` maps the wanted column to a table ``key, text``. A record a
    system has no text for gets null there. Of several texts for one key the least
    counts, so a record is scored once; ``prediction_problems`` lists such keys.
    """
    named = [p.groupBy(key).agg(F.min("text").alias(name)) for name, p in predictions.items()]
    return reduce(lambda left, right: left.join(right, key, "left"), named, truth)


def prediction_problems(truth: DataFrame, predictions: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Keys that do not match one to one, as ``system, key, problem``."""
    found = []
    for name, p in predictions.items():
        for problem, rows in (
            ("missing", truth.join(p, key, "left_anti")),
            ("unknown", p.join(truth, key, "left_anti")),
            ("duplicate", p.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")),
        ):
            found.append(
                rows.select(F.lit(name).alias("system"), key, F.lit(problem).alias("problem"))
            )
    return reduce(DataFrame.unionByName, found)


def matched_predictions(truth: DataFrame, predictions: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Ground truth and every system's text by key, with ``known`` and ``problems``: one grouped pass, one shuffle.

    All keys are there: those that only systems have are not ``known``. ``problems`` is an array of structs ``system,
    problem`` as in ``prediction_problems``. Of several texts, or truths, for one key the least counts.
    """
    told = F.struct(*[c for c in truth.columns if c != key])
    shape = truth.select(told.alias("t")).schema["t"].dataType
    rows = [truth.select(key, F.lit(0).alias("_side"), told.alias("_truth"), F.lit(None).cast("string").alias("_text"))]
    for n, p in enumerate(predictions.values(), 1):
        rows.append(p.select(key, F.lit(n).alias("_side"), F.lit(None).cast(shape).alias("_truth"), F.col("text").alias("_text")))
    figures = [F.max(F.col("_side") == 0).alias("known"), F.min("_truth").alias("_truth")]
    for n, name in enumerate(predictions, 1):
        own = F.col("_side") == n
        figures += [F.min(F.when(own, F.col("_text"))).alias(name), F.count_if(own).alias(f"_n{n}")]
    grouped = reduce(DataFrame.unionByName, rows).groupBy(key).agg(*figures)

    def problem(n: int, name: str) -> list[Column]:
        texts = F.col(f"_n{n}")
        found = {
            "missing": F.col("known") & (texts == 0),
            "unknown": ~F.col("known") & (texts > 0),
            "duplicate": texts > 1,
        }
        return [F.when(on, F.struct(F.lit(name).alias("system"), F.lit(p).alias("problem"))) for p, on in found.items()]

    listed = F.array(*[c for n, name in enumerate(predictions, 1) for c in problem(n, name)])
    return grouped.select(
        key, "known", "_truth.*", *predictions, F.filter(listed, lambda p: p.isNotNull()).alias("problems")
    )


def export_columns(df: DataFrame, systems: dict[str, str] = SYSTEMS) -> DataFrame:
    return df.select("id", "language", "ground_truth", *systems.values())


def first_rows(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The first ``n`` rows by position: a filter that reaches the scan, not a sort."""
    return df.filter(F.col(pos) < n)


def row_at(df: DataFrame, at: int, pos: str = "pos") -> DataFrame:
    return df.filter(F.col(pos) == at)


def with_content(places: DataFrame, df: DataFrame, key: list[str]) -> DataFrame:
    """The other columns of ``df`` for a few rows found by position: places are numbered on keys alone."""
    return places.join(df.drop(*[c for c in places.columns if c not in key]), key)


def evaluate(
    df: DataFrame, systems: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Per-record scores and the one-row summary of any number of systems."""
    systems = systems or SYSTEMS
    scored = scores(with_record_defaults(df, systems), systems)
    return scored, summary(scored, systems)
