"""Corpus rows to numbered text blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.blocks import split_blocks
from glyphmill.operators.corpus import cleaned, is_effective, limit_cut, with_defaults
from glyphmill.operators.numbering import ROW, RUN, SPLIT, in_ordinal_order, number_runs, stored_in_order
from glyphmill.session import materialize


#: What a row costs besides its text, in bytes of text.
ROW_BYTES = 64


def row_blocks(df: DataFrame, seed: int = 42) -> DataFrame:
    """The blocks of each effective row as an array column; narrow, streaming or not."""
    effective = df.filter(is_effective(F.col("id"), F.col("text")))
    blocks = split_blocks(cleaned(F.col("text")), F.col("row_ordinal") + seed)
    return effective.select(
        "row_ordinal",
        "id",
        "language",
        blocks.alias("blocks"),
        *[c for c in (RUN, SPLIT) if c in df.columns],
    )


def plan_chunks(
    df: DataFrame,
    seed: int = 42,
    resume_from: int = 0,
    limit: int = 0,
    order_by: list[str] | None = None,
    renumber_on_resume: bool = False,
    numbered_to: tuple[int, int] = (0, 0),
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Block table ``row_ordinal, id, language, block_idx, chunk_no, block_text``.

    Rows come with a 1-based ``row_ordinal``, or get one from the unique key
    ``order_by``. Either way the texts are shuffled once. Blocks are written once
    to the scratch folder, numbered there, and then read from it.

    Rows up to ``resume_from`` are left out, and ``limit`` stops after that many
    effective rows past them. Chunk numbers are those of an unbroken run;
    ``renumber_on_resume`` starts them at the first row resumed instead. ``numbered_to``
    names a row of an earlier run and the last chunk number up to it: rows up to there are not cut again.
    ``watch`` gets the rows on the pass that cuts them, each once.
    """
    if order_by:
        rows = stored_in_order(df, order_by, "row_ordinal", start=1)
        rows = with_defaults(rows)
    else:
        rows = with_defaults(df)

    if limit > 0:
        effective = is_effective(F.col("id"), F.col("text"))
        cut = limit_cut(rows, "row_ordinal", limit, effective, resume_from)
        if cut is not None:
            rows = rows.filter(F.col("row_ordinal") <= cut)
    known_row, known_chunk = (resume_from, 0) if renumber_on_resume else numbered_to
    if known_row > resume_from:
        raise ValueError("chunks are numbered beyond the row to resume from")
    if known_row > 0:
        rows = rows.filter(F.col("row_ordinal") > known_row)

    if order_by:
        # Already stored in order; this only restores it inside each task.
        rows = rows.sortWithinPartitions("row_ordinal")
    else:
        rows = in_ordinal_order(rows, "row_ordinal", F.octet_length("text") + ROW_BYTES)
    blocks = (
        row_blocks(watch(rows) if watch else rows, seed)
        .select(
            "row_ordinal",
            "id",
            "language",
            RUN,
            SPLIT,
            # The outer form: from the inner one Spark infers a filter on the size of
            # the blocks, and pushing it down would cut every text several times.
            F.posexplode_outer("blocks").alias("_idx", "block_text"),
        )
        .filter(F.col("block_text").isNotNull())
        .withColumn("block_idx", F.col("_idx") + 1)
        .drop("_idx")
        .withColumn(ROW, F.monotonically_increasing_id())
    )
    stored = materialize(blocks, "blocks")
    numbered = number_runs(stored, [RUN, SPLIT], "row_ordinal", "chunk_no", start=known_chunk + 1)
    if resume_from > 0:
        numbered = numbered.filter(F.col("row_ordinal") > resume_from)
    return numbered.select("row_ordinal", "id", "language", "block_idx", "chunk_no", "block_text")
