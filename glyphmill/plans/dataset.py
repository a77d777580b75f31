"""Images and texts to training datasets: pair, shuffle, split, shard, reshape, write.

Each builder writes usable and failed samples in one pass, reads them back, and publishes all its tables as one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glyphmill.config import PrepConfig
from glyphmill.functions.png import has_image_signature
from glyphmill.operators import reshape
from glyphmill.operators.pairs import checked_images, missing_values, orphan_counts, orphan_side, usable_pair
from glyphmill.operators.runlog import error_rows, figures_of, observed
from glyphmill.operators.splits import (
    asset_manifest, id_manifest, resume_shards, shard_starts, split_and_shard, with_shard,
)
from glyphmill.session import materialize, temporary_tables
from glyphmill.sources import sinks
from glyphmill.sources.digests import differences, digests_by, row_digest, total
from glyphmill.sources.files import read_images, read_texts
from glyphmill.sources.publish import Publication, partitions, read_published

_SHARD = ["split", "shard_idx"]
_PLACE = (*_SHARD, "split_pos")
USABLE, FAILED = "usable", "failed"


def _usable_pairs(publication: Publication, images_dir: str, texts_dir: str, config: PrepConfig, readable: bool = False) -> DataFrame:
    """``basename, path, length`` of the stored pairs that can be used; names only.

    One join of all names gives the pairs and the ``orphans``. Images of a refused size (if the config asks) and texts
    that are not UTF-8 (if ``readable``) are settled here, before anything is split. They are listed as ``refused``.
    """
    spark, fine = publication.spark, F.lit(None).cast("string")
    if config.check_geometry:
        images = checked_images(read_images(spark, images_dir, content=True))
    else:
        images = read_images(spark, images_dir).withColumn("reject_reason", fine)
    valid = F.try_validate_utf8("text").isNotNull() if readable else F.lit(True)
    texts = read_texts(spark, texts_dir, value=readable).select("basename", valid.alias("valid"))
    images = images.select("basename", "path", "length", "reject_reason")
    names = materialize(images.join(texts, "basename", "full_outer"), "names")

    found = names.select(F.col("basename").alias("key"), orphan_side(F.col("length"), F.col("valid")).alias("side"))
    found.filter(F.col("side").isNotNull()).write.parquet(publication.aside("orphans"))
    bad = F.col("reject_reason").isNotNull()
    unread = names.filter(~F.col("valid") & F.col("length").isNotNull() & ~bad)
    refused = [
        error_rows(names.filter(bad), "basename", "geometry", F.col("reject_reason")),
        error_rows(unread, "basename", "text", F.lit("missing text")),
    ]
    reduce(DataFrame.unionByName, refused).write.parquet(publication.aside("refused"))
    for table in ("orphans", "refused"):
        publication.put(table, table)
    usable = usable_pair(F.col("length"), F.col("valid"), config.min_image_bytes) & F.col("reject_reason").isNull()
    return names.filter(usable).select("basename", "path", "length")


def placed_pairs(pairs: DataFrame, shard_size: int, config: PrepConfig) -> DataFrame:
    """Stored pairs with their split and shard."""
    return split_and_shard(pairs, "basename", shard_size, config.train_ratio, config.shuffle_seed)


def orphan_report(spark: SparkSession, images_dir: str, texts_dir: str) -> DataFrame:
    return orphan_counts(
        read_images(spark, images_dir), read_texts(spark, texts_dir, value=False)
    )


def _with_text(spark: SparkSession, placed: DataFrame, texts_dir: str) -> DataFrame:
    """Texts joined on; one that is not UTF-8 is null."""
    texts = read_texts(spark, texts_dir).select("basename", F.try_validate_utf8("text").alias("text"))
    return placed.join(texts, "basename")


def _image(content: Column, checked: bool = True) -> Column:
    """A file as image; if ``checked``, one that does not begin like an image of any kind is null."""
    image = reshape.image_struct(content, F.concat("basename", F.lit(".png"))).cast(reshape.IMAGE_TYPE)
    return F.when(has_image_signature(content), image) if checked else image


def with_image(spark: SparkSession, texts: DataFrame, placed: DataFrame, images_dir: str, config: PrepConfig) -> DataFrame:
    """``texts`` with ``image``, every shard in one task.

    A file's shard is found at the scan, from its name, so its bytes are shuffled once, to their shard. There
    they meet the row that has their text. ``placed`` are the stored places of all pairs, of whatever shard.
    """
    starts = materialize(shard_starts(placed, "basename", config.shuffle_seed), "shard-starts")
    files = read_images(spark, images_dir, content=True).filter(F.col("length") >= config.min_image_bytes)
    files = with_shard(files, "basename", starts, config.shuffle_seed)
    files = resume_shards(files, config.resume_train_shard, config.resume_test_shard)
    row = F.struct(F.lit(True).alias("placed"), "split_pos", "text")
    row_type = "struct<placed:boolean,split_pos:bigint,text:string>"
    rows = texts.select(*_SHARD, "basename", F.lit(None).cast(reshape.IMAGE_TYPE).alias("image"), row.cast(row_type).alias("row"))
    files = files.select(*_SHARD, "basename", _image(F.col("content")).alias("image"), F.lit(None).cast(row_type).alias("row"))
    both = rows.unionByName(files).repartition(*_SHARD)
    # Rows of a shard are together, so grouping by more columns moves nothing.
    met = both.groupBy(*_SHARD, "basename").agg(F.first("image", True).alias("image"), F.first("row", True).alias("row"))
    return met.filter(F.col("row.placed")).select(*_SHARD, "basename", "image", "row.split_pos", "row.text")


def _earlier(config: PrepConfig) -> Column:
    """Whether a row lies in a shard before those that the run covers."""
    train = (F.col("split") == "train") & (F.col("shard_idx") < config.resume_train_shard)
    return train | ((F.col("split") == "test") & (F.col("shard_idx") < config.resume_test_shard))


def _replace(publication: Publication, df: DataFrame, table: str, kept: Column) -> None:
    """``df`` shall replace a small table, but for the rows of an earlier run for which ``kept`` holds."""
    earlier = read_published(publication.spark, publication.output, table)
    if earlier is not None:
        df = earlier.select(*df.columns).filter(kept).unionByName(df)
    df.write.parquet(publication.aside(table))
    publication.put(table, table)


def _write_samples(
    publication: Publication,
    df: DataFrame,
    required: list[str],
    sample: Callable[..., DataFrame],
    teller: tuple[str, Callable[[Column, Column], Column], Callable[[Column], tuple[Column, Column]]],
    table: str,
    config: PrepConfig,
    fmt: str = "parquet",
) -> None:
    """Write the samples of ``df`` as ``table`` and list those that lack a ``required`` value as ``failed``.

    One write partitioned by outcome holds both: a failed sample tells key and error in the column ``teller`` names.
    Usable samples are read back, and their digests by shard are compared with those of the rows that were made.
    """
    spark, name = publication.spark, "samples"
    column, error, told = teller
    flagged = sample(df.withColumn("_error", missing_values(required)), *_PLACE, "basename", "_error")
    usable = F.col("_error").isNull()
    columns = [f for f in flagged.schema.fields if f.name not in (*_PLACE, "basename", "_error")]
    other = {column: error(F.col("basename"), F.col("_error"))}
    samples = flagged.select(
        *[F.when(usable, F.col(f.name)).otherwise(other.get(f.name)).alias(f.name) for f in columns],
        *_PLACE,
        F.when(usable, USABLE).otherwise(FAILED).alias("outcome"),
    )
    is_usable = F.col("outcome") == USABLE
    made, seen = observed(
        samples, "samples",
        rows=F.count_if(is_usable), digest=total(F.when(is_usable, row_digest(StructType(columns)))),
    )
    sinks.write_placed(made, publication.aside(name), ["outcome", *_SHARD], fmt)

    made_rows = figures_of(seen, rows=0, digest=0)
    rows, digest = made_rows["rows"], made_rows["digest"]
    schema = StructType(columns).add("outcome", "string").add("split", "string").add("shard_idx", "integer")
    back = spark.read.schema(schema).format(fmt).load(publication.aside(name))
    key, why = told(F.col(column))
    failed = back.filter(F.col("outcome") == FAILED).select(
        key.alias("key"), F.lit("reshape").alias("stage"), why.alias("error"), *_SHARD
    )
    _replace(publication, failed, "failed", _earlier(config))
    found = materialize(digests_by(back.filter(is_usable).drop("outcome"), _SHARD), "digests")
    read_back = found.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("digest"), F.lit(0))).first()
    if tuple(read_back) != (rows, digest):
        raise OSError(f"{table} reads back as {tuple(read_back)}, and was made as {(rows, digest)}")
    _replace(publication, found, "digests", _earlier(config))

    parts = publication.put_parts(f"{name}/outcome={USABLE}", table, depth=len(_SHARD))
    first = {"train": config.resume_train_shard, "test": config.resume_test_shard}
    for part in partitions(spark, f"{publication.output}/{table}", len(_SHARD)):
        split, shard = (value.partition("=")[2] for value in part.split("/"))
        if part not in parts and int(shard) >= first.get(split, 0):
            publication.drop(f"{table}/{part}")


def build_flat(
    spark: SparkSession, images_dir: str, texts_dir: str, output: str, config: PrepConfig = PrepConfig()
) -> None:
    """The flat train/test dataset at ``output/data`` and the id manifest at ``output/ids``.

    Pairs with an unreadable text are left out first, so the split sizes and the ids are those of the rows
    written. Image bytes pass through as they are.
    """
    publication = Publication(spark, output)
    with temporary_tables(spark):
        pairs = _usable_pairs(publication, images_dir, texts_dir, config, readable=True)
        placed = placed_pairs(pairs, config.chat_shard_size, config)
        files = read_images(spark, images_dir, content=True)
        image = _image(F.col("content"), checked=False).alias("image")
        full = _with_text(spark, placed, texts_dir).join(files.select("basename", image), "basename")
        samples = reshape.flat_sample(full, "split", "split_pos")
        made, seen = observed(samples, "samples", rows=F.count(F.lit(1)), digest=total(_flat_digest(samples)))
        sinks.write_flat(made, publication.aside("data"))
        back = spark.read.schema(samples.schema).parquet(publication.aside("data"))
        found = materialize(digests_by(back, ["split"]), "digests")
        read_back = found.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("digest"), F.lit(0))).first()
        made_rows = figures_of(seen, rows=0, digest=0)
        if tuple(read_back) != (made_rows["rows"], made_rows["digest"]):
            raise OSError(f"data reads back as {tuple(read_back)}, and was made as {made_rows}")
        found.write.parquet(publication.aside("digests"))
        id_manifest(placed, "basename").write.parquet(publication.aside("ids"))
        for table in ("data", "digests", "ids"):
            publication.put(table, table)
        publication.commit()


def _flat_digest(samples: DataFrame) -> Column:
    return row_digest(StructType([f for f in samples.schema.fields if f.name != "split"]))


def build_chat(
    spark: SparkSession, images_dir: str, texts_dir: str, output: str, config: PrepConfig = PrepConfig()
) -> None:
    """Chat-message shards at ``output/data``, from the configured shard of each split on."""
    publication = Publication(spark, output)
    with temporary_tables(spark):
        pairs = _usable_pairs(publication, images_dir, texts_dir, config)
        placed = materialize(placed_pairs(pairs, config.chat_shard_size, config), "placed")
        covered = resume_shards(placed, config.resume_train_shard, config.resume_test_shard)
        full = with_image(spark, _with_text(spark, covered, texts_dir), placed, images_dir, config)

        def sample(df: DataFrame, *keep: str) -> DataFrame:
            return reshape.chat_sample(df, *keep, instruction=config.instruction)

        teller = ("messages", reshape.chat_error, reshape.told_by_chat)
        _write_samples(publication, full, ["text", "image"], sample, teller, "data", config)
        publication.commit()


def build_instruction(
    spark: SparkSession, images_dir: str, texts_dir: str, output: str, config: PrepConfig = PrepConfig()
) -> None:
    """Instruction JSON lines at ``output/lines`` and the archive lists at ``output/assets``."""
    publication = Publication(spark, output)
    with temporary_tables(spark):
        pairs = _usable_pairs(publication, images_dir, texts_dir, config)
        placed = materialize(placed_pairs(pairs, config.instruction_shard_size, config), "placed")
        placed = resume_shards(placed, config.resume_train_shard, config.resume_test_shard)

        def sample(df: DataFrame, *keep: str) -> DataFrame:
            return reshape.instruction_sample(
                df, *keep, instruction=config.instruction, assets_prefix=config.assets_prefix
            )

        teller = ("text_info", reshape.instruction_error, reshape.told_by_instruction)
        full = _with_text(spark, placed, texts_dir).repartition(*_SHARD)
        _write_samples(publication, full, ["text"], sample, teller, "lines", config, "json")
        # A sample whose text failed is in no archive either.
        failed = spark.read.parquet(publication.aside("failed")).select(F.col("key").alias("basename"))
        kept = placed.join(failed, "basename", "left_anti")
        _replace(publication, asset_manifest(kept, "basename"), "assets", _earlier(config))
        publication.commit()


def verify_dataset(spark: SparkSession, output: str, table: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Shards, or splits of a flat dataset, that are not what was written: their keys and ``problem``; empty if all is well.

    JSON lines need the ``schema`` of their samples.
    """
    wanted = read_published(spark, output, "digests")
    keys = [c for c in _SHARD if c in wanted.columns]
    found = read_published(spark, output, table, fmt, schema)
    return differences(digests_by(found, keys), wanted, keys)
