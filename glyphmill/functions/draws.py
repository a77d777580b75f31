"""Reproducible random draws: a value depends only on (seed, index, name).

The source of every draw is the MD5 digest of ``seed:index:name``. Its first
eight hex digits give one uniform number, the next eight a second one; together
they go as one long.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.config import (
    ASPECT_RANGES,
    CHOICES,
    FAMILY_MIX,
    FONTS,
    MAX_SHORT_SIDE,
    MIN_PIXELS_PER_CHAR,
    MIN_SIDE,
    NORMALS,
    SIZE_ATTEMPTS,
    VARIANT_MIX,
    Normal,
)
from glyphmill.functions.md5 import first_bits
from glyphmill.functions.text import let

# Sent with the query: the draws need no copy of this library where the executors run.
for _name in (__name__, first_bits.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_name])

_MAX32 = 0xFFFFFFFF


def digest(seed: Column, index: Column, name: Column | str) -> Column:
    """The first 16 hex digits as a long, for single draws; many come cheaper from ``digests``."""
    name = F.lit(name) if isinstance(name, str) else name
    hexes = F.md5(F.concat_ws(":", seed.cast("string"), index.cast("string"), name))
    return F.conv(F.substring(hexes, 1, 16), 16, -10).cast("long")


def digests(seed: int, index: Column, names: list[str]) -> Column:
    """``digest`` of every name, as a struct of longs; in Arrow batches, one name after the other."""

    def run(prefixes: pd.Series) -> pd.DataFrame:
        found = first_bits(prefixes.to_numpy().astype("S"), names)
        return pd.DataFrame(dict(zip(names, found, strict=True)))

    prefix = F.concat_ws(":", F.lit(seed).cast("string"), index.cast("string"), F.lit(""))
    return F.pandas_udf(run, ", ".join(f"{n} long" for n in names))(prefix)


def uniform(bits: Column, which: int = 0) -> Column:
    """The ``which``-th uniform number in [0, 1] of a digest."""
    number = bits.bitwiseAND(F.lit(_MAX32)) if which else F.shiftrightunsigned(bits, 32)
    return number.cast("double") / float(_MAX32)


def uniform_between(bits: Column, low: Column | float, high: Column | float) -> Column:
    return low + uniform(bits) * (high - low)


def normal(bits: Column, spec: Normal) -> Column:
    """A normal draw (Box-Muller), clamped and turned into its type."""
    z = F.sqrt(-2 * F.ln(F.greatest(uniform(bits, 0), F.lit(1e-10)))) * F.cos(
        2 * math.pi * uniform(bits, 1)
    )
    raw = spec.median + z * spec.std
    if spec.low is not None:
        raw = F.greatest(F.lit(float(spec.low)), raw)
    if spec.high is not None:
        raw = F.least(F.lit(float(spec.high)), raw)
    if spec.kind == "int":
        return F.rint(raw).cast("int")
    if spec.kind == "bool":
        return raw > 0.5
    if spec.kind == "decimals":
        return F.greatest(F.lit(0.0), F.bround(raw, 2))
    return raw


def choice(bits: Column, options: tuple[tuple[str, float], ...]) -> Column:
    """The first option whose summed weight reaches u times the total; else the last."""
    u = uniform(bits) * sum(weight for _, weight in options)
    upto, picked = 0.0, None
    for option, weight in options:
        upto += weight
        picked = (F.when if picked is None else picked.when)(u <= upto, option)
    return picked.otherwise(options[-1][0])


def _times_mod32(index: Column, factor: int) -> Column:
    """``index * factor`` modulo 2**32, in halves so that no index overflows."""
    low = index.bitwiseAND(F.lit(0xFFFF).cast("long"))
    high = F.shiftright(index, 16).bitwiseAND(F.lit(0xFFFF).cast("long"))
    shifted = F.shiftleft((high * factor).bitwiseAND(F.lit(0xFFFF).cast("long")), 16)
    return (low * factor + shifted).bitwiseAND(F.lit(_MAX32))


def font_families(fonts: tuple[str, ...] = FONTS) -> list[list[str]]:
    """Families by name, each with its fonts in the given order."""
    families: dict[str, list[str]] = {}
    for font in fonts:
        families.setdefault(font.partition("-")[0], []).append(font)
    return [families[name] for name in sorted(families)]


def font(seed: int, index: Column, fonts: tuple[str, ...] = FONTS) -> Column:
    """A family first, then a font of it, so that every family is equally likely."""
    families = font_families(fonts)
    if not families:
        return F.lit(None).cast("string")

    def mixed(factor: int) -> Column:
        return (_times_mod32(index.cast("long"), factor) + seed).bitwiseAND(F.lit(_MAX32))

    table = F.array(*[F.array(*map(F.lit, family)) for family in families])
    return let(
        F.get(table, (mixed(FAMILY_MIX) % len(families)).cast("int")),
        lambda family: F.get(family, (mixed(VARIANT_MIX) % F.size(family)).cast("int")),
    )


def is_valid_size(width: Column, height: Column, chars: Column) -> Column:
    area = width * height
    return (
        (F.least(width, height) >= MIN_SIDE)
        & (area >= MIN_SIDE * MIN_SIDE)
        & ((chars == 0) | (area / chars >= MIN_PIXELS_PER_CHAR))
    )


#: What the first attempt at a size is drawn from.
SIZE_DIGESTS = ["short_side", "ar_archetype", *[f"ar_{a}" for a in ASPECT_RANGES]]
FIRST_SIZE = ["_archetype", "_side", "_ratio"]

_NO_SIZE = (
    "cast(named_struct('ok', false, 'attempt', null, 'archetype', null, 'short_side', null,"
    " 'aspect_ratio', null, 'width', null, 'height', null) as struct<ok:boolean,attempt:int,"
    "archetype:string,short_side:int,aspect_ratio:double,width:int,height:int>)"
)


def _side(bits: Column) -> Column:
    side = normal(bits, NORMALS["short_side"])
    return F.greatest(F.lit(MIN_SIDE), F.least(F.lit(MAX_SHORT_SIDE), side))


def _ratio(bits: Column, archetype: Column) -> Column:
    low, high = (_by_archetype(archetype, {a: r[i] for a, r in ASPECT_RANGES.items()}) for i in (0, 1))
    return uniform_between(bits, low, high)


def _sized(attempt: Column, archetype: Column, side: Column, ratio: Column, chars: Column) -> Column:
    wide = ratio >= 1.0
    width = F.when(wide, (side * ratio).cast("int")).otherwise(side)
    height = F.when(wide, side).otherwise((side / ratio).cast("int"))
    return F.struct(
        is_valid_size(width, height, chars).alias("ok"),
        attempt.alias("attempt"),
        archetype.alias("archetype"),
        side.alias("short_side"),
        ratio.alias("aspect_ratio"),
        width.alias("width"),
        height.alias("height"),
    )


def size_plan(seed: int, index: Column, chars: Column, start: int = 0) -> Column:
    """``STRUCT<ok, attempt, archetype, short_side, aspect_ratio, width, height>``.

    The first of 11 attempts (from ``start`` on), each with the next seed, whose size suits the
    number of characters. Later attempts are not computed once one fits.
    """

    def attempt(k: Column) -> Column:
        s = F.lit(seed) + k
        drawn = F.struct(
            k.alias("attempt"),
            let(digest(s, index, "short_side"), _side).alias("side"),
            let(digest(s, index, "ar_archetype"), lambda d: choice(d, CHOICES["ar_archetype"])).alias("archetype"),
        )
        return let(drawn, lambda d: let(with_ratio(d), sized))

    def with_ratio(d: Column) -> Column:
        bits = digest(
            F.lit(seed) + d["attempt"], index, F.concat(F.lit("ar_"), d["archetype"])
        )
        return F.struct(
            d["attempt"].alias("attempt"),
            d["archetype"].alias("archetype"),
            d["side"].alias("side"),
            _ratio(bits, d["archetype"]).alias("ratio"),
        )

    def sized(d: Column) -> Column:
        return _sized(d["attempt"], d["archetype"], d["side"], d["ratio"], chars)

    return F.aggregate(
        F.sequence(F.lit(start), F.lit(SIZE_ATTEMPTS - 1)),
        F.expr(_NO_SIZE),
        lambda found, k: F.when(found["ok"], found).otherwise(attempt(k)),
    )


def first_size_draws(drawn: dict[str, Column]) -> dict[str, Column]:
    """The columns ``FIRST_SIZE`` of the first attempt, from the digests ``SIZE_DIGESTS``."""
    archetype = choice(drawn["ar_archetype"], CHOICES["ar_archetype"])
    bits = _by_archetype(archetype, {a: drawn[f"ar_{a}"] for a in ASPECT_RANGES})
    return dict(zip(FIRST_SIZE, (archetype, _side(drawn["short_side"]), _ratio(bits, archetype)), strict=True))


def size_plan_from(seed: int, index: Column, chars: Column) -> Column:
    """``size_plan`` where the first attempt is drawn: only blocks that it does not suit are searched further."""
    first = _sized(F.lit(0), *map(F.col, FIRST_SIZE), chars)
    return F.when(first["ok"], first).otherwise(size_plan(seed, index, chars, start=1))


def _by_archetype(archetype: Column, values: dict[str, float] | dict[str, Column]) -> Column:
    picked = None
    for name, value in values.items():
        picked = (F.when if picked is None else picked.when)(archetype == name, value)
    return picked


def jittered_channel(bits: Column, base: Column, variance: Column) -> Column:
    """One colour channel: the base moved uniformly within the variance, kept in 0..255."""
    moved = base + uniform_between(bits, -variance, variance)
    return F.greatest(F.lit(0.0), F.least(F.lit(255.0), moved)).cast("int")


def rgb(r: Column, g: Column, b: Column) -> Column:
    return F.concat(F.lit("rgb("), r, F.lit(","), g, F.lit(","), b, F.lit(")"))
