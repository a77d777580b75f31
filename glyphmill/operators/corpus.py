"""Rows of a text corpus: defaults, id and blank filters, resume and limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.functions.text import clean_markdown, is_blank, repair_escapes

# Parts of an id that mark a row as out of scope.
EXCLUDED_ID_PARTS = ("eng", "esp", "spa", "fra", "deu", "por", "all")

_CUT_BUCKETS = 65_536


def with_defaults(df: DataFrame, ordinal: str = "row_ordinal") -> DataFrame:
    """``id``, ``language`` and ``text`` with defaults for missing columns and nulls."""

    def or_default(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name).cast("string"), default) if name in df.columns else default

    return df.withColumns(
        {
            "id": or_default("id", F.concat(F.lit("row_"), F.col(ordinal).cast("string"))),
            "language": or_default("language", F.lit("unk")),
            "text": or_default("text", F.lit("")),
        }
    )


def is_excluded_id(
    row_id: Column, parts: tuple[str, ...] = EXCLUDED_ID_PARTS, whole_tokens: bool = False
) -> Column:
    """The id holds one of ``parts`` anywhere, case-sensitive (so ``all`` drops ``small`` too).

    With ``whole_tokens`` a part counts only between non-alphanumeric characters.
    """
    if whole_tokens:
        tokens = F.split(row_id, r"[^\p{L}\p{N}]+")
        return F.arrays_overlap(tokens, F.array(*map(F.lit, parts)))
    return reduce(Column.__or__, [F.contains(row_id, F.lit(p)) for p in parts])


def is_effective(row_id: Column, text: Column) -> Column:
    """The row is in scope and has text."""
    return ~is_excluded_id(row_id) & ~is_blank(text)


def cleaned(text: Column) -> Column:
    return clean_markdown(repair_escapes(text))


def limit_cut(df: DataFrame, ordinal: str, n: int, keep: Column | None = None, after: int = -1) -> int | None:
    """Ordinal of the n-th row past ``after`` for which ``keep`` holds; None when there are fewer.

    Rows are counted in windows of ordinals that double until the n-th row is inside, so little more than
    what lies before it is read. That window is then counted in at most 65,536 stretches, again and
    again, until a stretch is one ordinal wide. Single numbers alone reach the driver.
    """
    at = F.col(ordinal)
    past = df.filter(at > after)
    last = past.agg(F.max(ordinal)).first()[0]  # reads the ordinals alone
    if last is None:
        return None
    kept = past if keep is None else past.filter(keep)
    low, width, need = after + 1, max(4 * n, 1000), n
    while low <= last:
        inside = kept.filter((at >= low) & (at < low + width))
        found = inside.count()
        if found >= need:
            return _nth(inside, ordinal, need, low, width)
        low, width, need = low + width, 2 * width, need - found
    return None


def _nth(df: DataFrame, ordinal: str, n: int, low: int, width: int) -> int:
    """Ordinal of the n-th row of ``df``, whose ordinals fill ``width`` numbers from ``low`` on."""
    at = F.col(ordinal)
    while width > 1:
        step = -(-width // _CUT_BUCKETS)
        inside = df.filter((at >= low) & (at < low + width))
        stretches = inside.groupBy(F.floor((at - low) / step).alias("_stretch")).agg(F.count("*").alias("_n"))
        upto = F.sum("_n").over(Window.orderBy("_stretch"))
        hit = stretches.withColumn("_upto", upto).filter(F.col("_upto") >= n).orderBy("_stretch").first()
        low, width, n = low + hit["_stretch"] * step, step, n - (hit["_upto"] - hit["_n"])
    return low
