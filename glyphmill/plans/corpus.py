"""Corpus to render manifest: rows, blocks, draws, accepted texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators.chunks import plan_chunks
from glyphmill.operators.corpus import is_effective
from glyphmill.operators.manifest import ACCEPTED, MANIFEST_COLUMNS, REJECTED, manifest_outcomes
from glyphmill.operators.runlog import error_rows, figures_of, logged_progress, observed, progress_line
from glyphmill.session import temporary_tables
from glyphmill.sources.corpus import read_corpus
from glyphmill.sources.digests import differences, digests_by, row_digest, total
from glyphmill.sources.files import folder_megabytes
from glyphmill.sources.publish import Publication, partitions, read_published

TABLES = ("manifest", "text", "rejected", "digests", "counters")


def build_manifest(
    spark: SparkSession,
    corpus: str | DataFrame,
    output: str,
    seed: int = 42,
    resume_from: int = 0,
    limit: int = 0,
    order_by: list[str] | None = None,
    renumber_on_resume: bool = False,
    log_file: str | None = None,
) -> dict[str, int]:
    """Write ``manifest``, ``text``, ``rejected``, ``digests`` and ``counters`` below ``output``, a folder per run.

    ``corpus`` is a CSV path, or a table with ``row_ordinal`` or a unique key
    to order by. Returns the run's counters. A run resumed from a row keeps what
    earlier runs wrote up to it and replaces what later ones did, so a limited run
    and its continuation make one full run, however often they are repeated.

    The draws are made in one pass that writes accepted and rejected blocks. The manifest is read back and
    compared with what was made, then all tables of the run count at once. ``log_file``, on the driver,
    gets progress lines while jobs run.
    """
    publication = Publication(spark, output)
    numbered_to = (0, 0)
    runs = [int(part.removeprefix("run=")) for part in partitions(spark, f"{output}/counters", 1) if part.startswith("run=")]
    if any(run < resume_from for run in runs):
        earlier = read_published(spark, output, "counters").filter(F.col("run") < resume_from)
        past = earlier.agg(F.max(F.struct("last_row", "last_chunk")).alias("at")).select("at.*").first()
        if past.last_row is not None and past.last_row > resume_from:
            raise ValueError(f"an earlier run went to row {past.last_row}: resume from there, or from one of its starts")
        numbered_to = (past.last_row or 0, past.last_chunk or 0)
    with logged_progress(spark, log_file), temporary_tables(spark):
        rows = read_corpus(spark, corpus) if isinstance(corpus, str) else corpus
        new = F.col("row_ordinal") > resume_from
        effective = F.count_if(new & is_effective(F.col("id"), F.col("text")))
        seen = {}

        def watch(df: DataFrame) -> DataFrame:
            df, seen["rows"] = observed(df, "rows", rows=F.count_if(new), effective_rows=effective, read_to=F.max("row_ordinal"))
            return df

        blocks = plan_chunks(rows, seed, resume_from, limit, order_by, renumber_on_resume, numbered_to, watch)
        counted, seen["blocks"] = observed(
            blocks, "blocks", chunks=F.count(F.lit(1)), last_row=F.max("row_ordinal"), last_chunk=F.max("chunk_no")
        )
        counters = _write_outcomes(publication, manifest_outcomes(counted, seed))
        counters |= figures_of(seen["blocks"], chunks=0, last_row=None, last_chunk=None)
        counters |= figures_of(seen["rows"], rows=0, effective_rows=0, read_to=None)
        counters["total_rows"] = rows.count()
        _write_counters(publication, counters)
        for table in TABLES:
            for later in (run for run in runs if run > resume_from):
                publication.drop(f"{table}/run={later}")
            folder = f"outcomes/outcome={ACCEPTED}" if table == "manifest" and counters["accepted"] else table
            publication.put(folder, f"{table}/run={resume_from}")
        publication.commit()
    return counters


def _write_outcomes(publication: Publication, outcomes: DataFrame) -> dict[str, int]:
    """One write of accepted and rejected blocks, the tables read from it, and their check."""
    spark, accepted = publication.spark, F.col("outcome") == ACCEPTED
    kept = outcomes.schema[: len(MANIFEST_COLUMNS)]
    made, seen = observed(
        outcomes, "manifest",
        accepted=F.count_if(accepted), digest=total(F.when(accepted, row_digest(kept))),
    )
    made.write.partitionBy("outcome").parquet(publication.aside("outcomes"))
    figures = figures_of(seen, accepted=0, digest=0)
    count, digest = figures["accepted"], figures["digest"]
    stored = spark.read.schema(outcomes.schema).parquet(publication.aside("outcomes"))
    manifest = stored.filter(accepted).select(*MANIFEST_COLUMNS)
    if not count:  # then no folder holds it
        manifest.write.parquet(publication.aside("manifest"))
    manifest.select("basename", "text").write.parquet(publication.aside("text"))
    rejected = error_rows(stored.filter(F.col("outcome") == REJECTED), "basename", "size", F.col("text"))
    rejected.write.parquet(publication.aside("rejected"))
    digests_by(manifest, []).write.parquet(publication.aside("digests"))
    found = spark.read.parquet(publication.aside("digests")).first()
    if (found.rows, found.digest) != (count, digest):
        raise OSError(f"the manifest reads back as {found.rows} rows, {found.digest}, and was made as {count}, {digest}")
    return {"accepted": count}


def _write_counters(publication: Publication, counters: dict[str, int]) -> None:
    spark, names = publication.spark, ["chunks", "last_row", "last_chunk", "accepted", "rows", "effective_rows", "read_to", "total_rows"]
    row = spark.createDataFrame([tuple(counters[n] for n in names)], ", ".join(f"{n} long" for n in names))
    megabytes = folder_megabytes(spark, publication.aside("outcomes")).first().megabytes
    figures = row.withColumn("output_mb", F.lit(float(megabytes)))
    current, every = F.coalesce("read_to", F.lit(0)), F.greatest("total_rows", F.lit(1))
    figures = figures.withColumn("percent", 100 * current / every)
    line = progress_line(current, every, F.col("effective_rows"), F.col("chunks"), F.col("output_mb"))
    figures.withColumn("progress", line).coalesce(1).write.parquet(publication.aside("counters"))


def verify_manifest(spark: SparkSession, output: str) -> DataFrame:
    """Runs whose manifest is not what was written: ``run, problem``; empty if all is well."""
    manifest, wanted = (read_published(spark, output, table) for table in ("manifest", "digests"))
    found = digests_by(manifest.select(*MANIFEST_COLUMNS, "run"), ["run"])
    return differences(found, wanted, ["run"])
