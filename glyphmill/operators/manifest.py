"""The render manifest: every accepted block with the parameters to draw it with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.config import CHOICES, NORMALS, PADDING_RANGE
from glyphmill.functions import draws as D
from glyphmill.functions.text import is_blank, let, reflow, sample_key, upper_if
from glyphmill.session import dealt_by

CHANNELS = ("bg_r", "bg_g", "bg_b", "txt_r", "txt_g", "txt_b")
# short_side and ar_archetype are drawn again for every size attempt.
_DIGESTED = (
    [n for n in NORMALS if n != "short_side"]
    + [n for n in CHOICES if n != "ar_archetype"]
    + ["extent_padding", *CHANNELS]
)

ACCEPTED, REJECTED = "accepted", "rejected"

MANIFEST_COLUMNS = [
    "basename", "text", "font", "alignment", "width", "height", "aspect_ratio", "text_w", "text_h",
    "wrap_cols", "margin_factor", "bg_color", "text_color", "ptsize", "char_spacing",
    "line_spacing", "rotation", "blur", "skew_x", "skew_y", "perspective", "apply_wave",
    "use_noise", "noise_type", "noise_amount", "use_motion_blur", "mb_radius", "mb_sigma",
    "mb_angle", "use_ebc", "brightness", "contrast", "use_dirty", "dirty_attenuate",
    "use_banding", "use_morphology", "morphology_type", "morphology_kernel", "extent_padding",
    "effects",
]


def with_draws(df: DataFrame, seed: int = 42, index: str = "chunk_no") -> DataFrame:
    """All draws that do not depend on the text."""
    return _with_draws(df, seed, index, [])


def _with_draws(df: DataFrame, seed: int, index: str, more: list[str]) -> DataFrame:
    """The digests of all draws (and of ``more``) are made together, each once."""
    hashed = df.withColumn("_h", D.digests(seed, F.col(index), [*_DIGESTED, *more]))
    h = {n: F.col(f"_h.{n}") for n in (*_DIGESTED, *more)}
    drawn = {n: D.normal(h[n], s) for n, s in NORMALS.items() if n != "short_side"}
    drawn |= {n: D.choice(h[n], o) for n, o in CHOICES.items() if n != "ar_archetype"}
    drawn["extent_padding"] = D.uniform_between(h["extent_padding"], *map(float, PADDING_RANGE)).cast("int")
    if more:
        drawn |= D.first_size_draws(h)
    # The font's lambda keeps these 35 columns out of whole-stage code: as one method
    # they are too long for the JIT and run about 1.6 times slower.
    drawn["font"] = D.font(seed, F.col(index))
    hashed = hashed.withColumns(drawn)

    def channel(name: str) -> Column:
        base = F.col("background_gray" if name.startswith("bg") else "text_gray")
        jittered = D.jittered_channel(h[name], base, F.col("color_variance"))
        return F.when(F.col("use_color"), jittered).otherwise(base)

    return hashed.withColumns(
        {
            "bg_color": D.rgb(*[channel(n) for n in CHANNELS[:3]]),
            "text_color": D.rgb(*[channel(n) for n in CHANNELS[3:]]),
        }
    ).drop("_h")


def with_text_region(df: DataFrame) -> DataFrame:
    """The text box inside the margins, and the column to wrap the text at."""
    def inner(side: str) -> Column:
        margin = (F.col(side) * F.col("margin_factor")).cast("int")
        return F.greatest(F.lit(50), F.col(side) - 2 * margin)

    cols = F.sqrt(2.5 * (F.col("text_w") / F.col("text_h")) * F.length("text")).cast("int")
    return df.withColumns({"text_w": inner("width"), "text_h": inner("height")}).withColumn(
        "wrap_cols", F.greatest(F.lit(10), cols)
    )


def _decimal(x: Column) -> Column:
    """A double in plain decimals with at least one place, like 0.0005 and 1.0."""
    bare = F.rtrim(x.cast("decimal(38,18)").cast("string"), F.lit("0"))
    return let(bare, lambda n: F.when(F.endswith(n, F.lit(".")), F.concat(n, F.lit("0"))).otherwise(n))


def effects() -> Column:
    """The active image effects in the order they apply, as ``ARRAY<STRUCT<op, args>>``."""
    w, h, p = F.col("width"), F.col("height"), F.col("perspective")
    shift = (F.least(w, h) * p * 0.2).cast("int")
    text = {n: _decimal(F.col(n)) for n in ("rotation", "skew_x", "skew_y")}
    noise = F.when(
        F.col("noise_amount") > 0,
        F.concat_ws(" ", F.col("noise_type"), _decimal(F.col("noise_amount"))),
    ).otherwise(F.col("noise_type"))
    border = _decimal(F.col("extent_padding") / 2.0)
    rules = [
        ("rotate", F.abs("rotation") > 0.1, text["rotation"]),
        (
            "shear",
            (F.abs("skew_x") > 0.1) | (F.abs("skew_y") > 0.1),
            F.concat(text["skew_x"], F.lit("x"), text["skew_y"]),
        ),
        ("perspective", (F.abs(p) > 0.01) & (shift > 0), shift.cast("string")),
        ("noise", F.col("use_noise"), noise),
        (
            "dirty",
            F.col("use_dirty") & ~F.col("use_noise"),
            _decimal(F.col("dirty_attenuate")),
        ),
        (
            "brightness-contrast",
            F.col("use_ebc"),
            F.format_string("%dx%d", "brightness", "contrast"),
        ),
        ("banding", F.col("use_banding"), F.format_string("%dx%d", "width", "height")),
        (
            "morphology",
            F.col("use_morphology"),
            F.concat_ws(" ", "morphology_type", "morphology_kernel"),
        ),
        ("wave", F.col("apply_wave"), F.concat(F.lit("2x"), _decimal(w * 0.5))),
        ("trim", F.lit(True), F.lit("10%")),
        ("border", F.col("extent_padding") > 0, F.concat(border, F.lit("x"), border)),
    ]
    listed = [F.when(on, F.struct(F.lit(op).alias("op"), args.alias("args"))) for op, on, args in rules]
    return F.filter(F.array(*listed), lambda e: e.isNotNull())


def planned_blocks(blocks: DataFrame, seed: int = 42) -> DataFrame:
    """Non-empty blocks with all draws, final text and size plan, accepted or not.

    ``reject_reason`` is null for accepted blocks. One pass; blocks are dealt out evenly first, which costs
    far less than their draws.
    """
    shown = dealt_by(blocks.filter(~is_blank(F.col("block_text"))), "chunk_no")
    drawn = _with_draws(shown, seed, "chunk_no", D.SIZE_DIGESTS)
    drawn = drawn.withColumn("text", upper_if(F.col("uppercase"), reflow(F.col("block_text"))))
    drawn = drawn.withColumn("_chars", F.length("text"))
    size = D.size_plan_from(seed, F.col("chunk_no"), F.col("_chars"))
    # A generator, because filters on its columns stay above it. On a plain column
    # they would move to the scan and take the whole size search with them.
    planned = drawn.select("*", F.inline_outer(F.array(size))).drop("_chars", *D.FIRST_SIZE)
    return planned.withColumn("reject_reason", F.when(~F.col("ok"), "no valid size in 11 attempts"))


def _rendered(planned: DataFrame) -> DataFrame:
    key = sample_key(F.col("language"), F.col("id"), F.col("block_idx"), F.col("aspect_ratio"))
    return with_text_region(planned.withColumn("basename", key)).withColumn("effects", effects())


def render_manifest(blocks: DataFrame, seed: int = 42) -> DataFrame:
    """The block table as arguments for a renderer, one row per accepted block."""
    return _rendered(planned_blocks(blocks, seed).filter(F.col("ok"))).select(*MANIFEST_COLUMNS)


def manifest_outcomes(blocks: DataFrame, seed: int = 42) -> DataFrame:
    """Accepted and rejected blocks of one pass, by ``outcome``, in the columns of the manifest.

    A rejected block has its number in place of the name and the reason in place of the text, and nothing else,
    so that one write partitioned by outcome holds both.
    """
    told = {"basename": F.col("chunk_no").cast("string"), "text": F.col("reject_reason")}
    return _rendered(planned_blocks(blocks, seed)).select(
        *[F.when(F.col("ok"), F.col(c)).otherwise(told.get(c)).alias(c) for c in MANIFEST_COLUMNS],
        F.when(F.col("ok"), ACCEPTED).otherwise(REJECTED).alias("outcome"),
    )
