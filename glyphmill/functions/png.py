"""Image headers read from the bytes, without an image library."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PNG_SIGNATURE = "89504E470D0A1A0A"

# How files of common image formats begin (PNG, JPEG, GIF, TIFF, BMP; WebP has its size in between).
SIGNATURES = (PNG_SIGNATURE, "FFD8FF", "474946383761", "474946383961", "49492A00", "4D4D002A", "424D")
RIFF, WEBP = "52494646", "57454250"


def _uint32(content: Column, at: int) -> Column:
    """Null where the field is no positive int, which no real size is."""
    return F.conv(F.hex(F.substring(content, at, 4)), 16, 10).try_cast("int")


def png_size(content: Column) -> Column:
    """``STRUCT<width, height>`` of a PNG; null for anything else."""
    header = F.hex(F.substring(content, 1, 8)) == PNG_SIGNATURE
    named = F.hex(F.substring(content, 13, 4)) == "49484452"
    width, height = _uint32(content, 17), _uint32(content, 21)
    whole = (F.octet_length(content) >= 24) & header & named & (width > 0) & (height > 0)
    return F.when(whole, F.struct(width.alias("width"), height.alias("height")))


def has_image_signature(content: Column) -> Column:
    """Whether the bytes begin like an image of a common format, whatever the file is called."""
    head = F.hex(F.substring(content, 1, 12))
    known = [F.startswith(head, F.lit(x)) for x in SIGNATURES]
    webp = F.startswith(head, F.lit(RIFF)) & F.endswith(head, F.lit(WEBP))
    return F.coalesce(reduce(Column.__or__, known, webp), F.lit(False))
