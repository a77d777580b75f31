"""Images and their transcripts: pairing, orphans, size and geometry filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.config import MAX_ASPECT, MIN_ASPECT, MIN_SIDE
from glyphmill.functions.png import png_size
from glyphmill.functions.text import collapse


def large_enough(images: DataFrame, min_bytes: int, length: str = "length") -> DataFrame:
    return images.filter(F.col(length) >= min_bytes)


def usable_pair(length: Column, text: Column, min_bytes: int) -> Column:
    """Of a row of the full join of images and texts: both are there, and the image has enough bytes."""
    return (length >= min_bytes) & text


def orphan_side(image: Column, text: Column) -> Column:
    """The side that is there alone; null if both are."""
    return F.when(text.isNull(), "image").when(image.isNull(), "text")


def pair(
    images: DataFrame, texts: DataFrame, min_bytes: int, key: str = "basename", length: str = "length"
) -> DataFrame:
    """Images of enough bytes joined with their texts.

    Sizes are checked below the join, so small images are never shuffled. Keys
    are unique on both sides, as file names are. Leave image content out here:
    splits and shards need names and sizes only.
    """
    return large_enough(images, min_bytes, length).join(texts, key)


def orphans(images: DataFrame, texts: DataFrame, key: str = "basename") -> DataFrame:
    """Names on one side only, as ``key, side``: one join for both directions."""
    left = images.select(key, F.lit(True).alias("_image"))
    right = texts.select(key, F.lit(True).alias("_text"))
    side = orphan_side(F.col("_image"), F.col("_text"))
    return left.join(right, key, "full_outer").select(key, side.alias("side")).filter(
        F.col("side").isNotNull()
    )


def orphan_counts(images: DataFrame, texts: DataFrame, key: str = "basename") -> DataFrame:
    return orphans(images, texts, key).groupBy("side").agg(F.count("*").alias("n"))


def geometry_reject(width: Column, height: Column) -> Column:
    """Why a rendered image is refused; null if it is not. The bounds themselves are kept."""
    aspect = width / height
    return (
        F.when(width.isNull() | height.isNull(), "unreadable")
        .when((width < MIN_SIDE) | (height < MIN_SIDE), "too small")
        .when((aspect < MIN_ASPECT) | (aspect > MAX_ASPECT), "too extreme")
    )


def checked_images(images: DataFrame) -> DataFrame:
    """``images`` with ``content`` read for ``width``, ``height``, ``aspect``, ``reject_reason``."""
    size = png_size(F.col("content"))
    sized = images.withColumn("_size", size).drop("content")
    return sized.select(
        *[c for c in images.columns if c != "content"],
        F.col("_size.width").alias("width"),
        F.col("_size.height").alias("height"),
        (F.col("_size.width") / F.col("_size.height")).alias("aspect"),
        geometry_reject(F.col("_size.width"), F.col("_size.height")).alias("reject_reason"),
    )


def missing_values(required: list[str]) -> Column:
    """Why a row cannot be used: the required values that it lacks; null if it has them all."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())
    return F.when(F.size(missing) > 0, F.left(F.concat(F.lit("missing "), F.array_join(missing, ", ")), F.lit(500)))


def split_usable(
    df: DataFrame, required: list[str], stage: str, key: str, place: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows with every required value, and error rows ``key, stage, error`` and ``place`` for the others."""
    flagged = df.withColumn("_error", missing_values(required))
    usable = flagged.filter(F.col("_error").isNull()).drop("_error")
    failed = flagged.filter(F.col("_error").isNotNull())
    return usable, failed.select(F.col(key).alias("key"), F.lit(stage).alias("stage"), F.col("_error").alias("error"), *place)


def transcript(text: Column) -> Column:
    return collapse(text)
