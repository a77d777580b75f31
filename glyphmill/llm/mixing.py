"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Token sums of the cells (source, language, topic) are raked until each marginal has its target
share. A document is kept with its cell's ratio of raked to present tokens, scaled so that
the largest ratio is 1: then the expected tokens of the sample meet every target. The draw is a
hash of id and seed, so a rerun keeps the same documents.

All in DataFrame functions. The documents are summed up once before any shuffle; the raking
works on the table of cells, stored after each round, and only the largest deviation reaches the
driver. Cells are as many as combinations that occur, and Spark broadcasts them below its threshold.

Results for odd input: null values of a dimension are a value of their own; null and empty
texts have no tokens and are kept with their cell's probability; a value without a target, or
with target 0, is sampled with probability 0; targets without documents are left out and the rest
made to sum to 1; rows that repeat an id are kept or dropped together where their cells agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.session import materialize

#: Topics by what a text contains, the first that fits; others are "prose".
TOPICS = {"legal": ["licensed under", "copyright", "all rights reserved"], "contact": ["@", "://"]}


def topic_of(text: Column) -> Column:
    """A topic by plain marks in the whole text."""
    low, topic = F.lower(F.coalesce(text, F.lit(""))), F.lit("prose")
    for name, marks in reversed(TOPICS.items()):
        topic = F.when(reduce(Column.__or__, [F.contains(low, F.lit(m)) for m in marks]), name).otherwise(topic)
    return topic


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """``value, share``: the present shares of ``dim`` raised to ``power``, made to sum to 1."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("n"))
    raised = sums.filter("n > 0").select("value", F.pow(F.col("n").cast("double"), F.lit(power)).alias("x"))
    return raised.select("value", (F.col("x") / F.lit(_total(raised, F.sum("x")))).alias("share"))


def _total(df: DataFrame, of: Column) -> float:
    """One number over a table of cells; 1 where it is empty."""
    return float(df.agg(of).first()[0] or 1.0)


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-6, rounds: int = 100
) -> DataFrame:
    """``cells`` with ``weight``: shares of tokens whose marginals meet the targets.

    ``targets``: for each column of ``cells`` a table ``value, share``. Targets that contradict
    each other are met as well as ``rounds`` rounds can.
    """
    fitted = cells.filter("tokens > 0")
    for dim, target in targets.items():
        named = target.groupBy(F.col("value").alias("_value")).agg(F.sum("share").alias(f"_{dim}"))
        fitted = fitted.join(named, fitted[dim].eqNullSafe(named["_value"])).drop("_value")
        fitted = fitted.filter(F.col(f"_{dim}") > 0)
    fitted = materialize(fitted.withColumn("weight", F.col("tokens").cast("double")), "cells")
    fitted = fitted.withColumn("weight", F.col("weight") / F.lit(_total(fitted, F.sum("weight"))))
    # Of the targets, those whose value has cells.
    for dim in targets:
        kept = _total(fitted.groupBy(dim).agg(F.max(f"_{dim}").alias("_share")), F.sum("_share"))
        fitted = fitted.withColumn(f"_{dim}", F.col(f"_{dim}") / F.lit(kept))
    for _ in range(rounds):
        off = F.lit(0.0)
        for dim in targets:
            margin = F.sum("weight").over(Window.partitionBy(dim))
            fitted = fitted.withColumn("_factor", F.col(f"_{dim}") / margin)
            off = F.greatest(off, F.abs(F.col("_factor") - 1))
            fitted = fitted.withColumn("_off", off).withColumn("weight", F.col("weight") * F.col("_factor"))
            off = F.col("_off")
        fitted = materialize(fitted.drop("_factor"), "cells")
        worst = fitted.agg(F.max("_off")).first()[0]
        fitted = fitted.drop("_off")
        if worst is None or worst < tolerance:
            break
    return fitted.drop(*[f"_{dim}" for dim in targets])


def probabilities(cells: DataFrame, rate: float = 1.0) -> DataFrame:
    """Raked cells with ``probability``; ``rate`` scales the largest sample that meets the targets."""
    ratio = F.col("weight") / F.col("tokens")
    largest = _total(cells, F.max(ratio))
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(rate) * ratio / F.lit(largest)))


def chance(id_col: Column, seed: int) -> Column:
    """A number from 0 to 1 drawn by the id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    dims: dict[str, Column],
    targets: dict[str, DataFrame] | float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = 1.0,
    seed: int = 11,
) -> DataFrame:
    """``id``, the dimensions, ``tokens``, ``probability`` and ``sampled`` of every document.

    ``targets`` names the shares of each dimension's values; a number stands for the present
    shares raised to it.
    """
    narrow = materialize(
        docs.select(
            F.col(id_col).alias("id"), *[c.alias(d) for d, c in dims.items()], tokens_of(F.col(text_col)).alias("tokens")
        ),
        "mix-rows",
    )
    cells = materialize(narrow.groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "cells")
    if isinstance(targets, float):
        targets = {d: materialize(tempered(cells, d, targets), "targets") for d in dims}
    raked = materialize(probabilities(rake(cells, targets), rate), "raked").select(
        *[F.col(d).alias(f"_{d}") for d in dims], "probability"
    )
    same = reduce(Column.__and__, [narrow[d].eqNullSafe(raked[f"_{d}"]) for d in dims])
    probability = F.coalesce("probability", F.lit(0.0))
    return narrow.join(raked, same, "left").select(
        "id", *dims, "tokens", probability.alias("probability"),
        (chance(F.col("id"), seed) < probability).alias("sampled"),
    )
