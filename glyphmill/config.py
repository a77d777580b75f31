"""Fixed settings of rendering, pairing and evaluation.

Every table here holds values that decide results, in their published order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Sizes in pixels, and the smallest pixel area per character.
MIN_SIDE = 200
MAX_SHORT_SIDE = 1680
MIN_PIXELS_PER_CHAR = 170
MIN_ASPECT = 0.25
MAX_ASPECT = 5.0
SIZE_ATTEMPTS = 11


@dataclass(frozen=True)
class Normal:
    """A normal draw: clamped to [low, high] if given, then turned into ``kind``.

    Kinds: ``int`` (rounded half to even), ``bool`` (above one half), ``decimals``
    (two places, not negative) and ``float``.
    """

    median: float
    std: float
    kind: str
    low: float | None = None
    high: float | None = None


# The normally distributed render parameters.
NORMALS: dict[str, Normal] = {
    "ptsize": Normal(21, 11.0, "int"),
    "char_spacing": Normal(0.0, 0.3, "float"),
    "line_spacing": Normal(0.0, 3.0, "int"),
    "uppercase": Normal(0, 0.3, "bool"),
    "background_gray": Normal(255, 80, "int", 100, 255),
    "text_gray": Normal(0, 80, "int", 0, 200),
    "use_color": Normal(0, 0.75, "bool"),
    "color_variance": Normal(50, 20, "int", 20, 100),
    "short_side": Normal(500, 150, "int", 200, 800),
    "margin_factor": Normal(0.01, 0.03, "float", 0),
    "rotation": Normal(0, 0.5, "float"),
    "blur": Normal(0.2, 1.0, "decimals", 0.0),
    "skew_x": Normal(0, 0.5, "float"),
    "skew_y": Normal(0, 0.5, "float"),
    "perspective": Normal(0, 0.1, "float"),
    "use_noise": Normal(0, 0.0, "bool"),
    "noise_amount": Normal(0, 0.5, "float", 0.0),
    "use_motion_blur": Normal(0, 0.5, "bool"),
    "mb_radius": Normal(4, 2.0, "float", 0.0),
    "mb_sigma": Normal(2, 1.0, "float", 0.1),
    "mb_angle": Normal(0, 90, "int", 0, 360),
    "use_ebc": Normal(0, 0.3, "bool"),
    "brightness": Normal(0, 10.0, "int", -20, 20),
    "contrast": Normal(0, 10.0, "int", -20, 20),
    "use_dirty": Normal(0, 0.3, "bool"),
    "dirty_attenuate": Normal(0.0, 0.05, "float", 0.0),
    "use_banding": Normal(0, 0.0, "bool"),
    "use_morphology": Normal(0, 0.0, "bool"),
    "apply_wave": Normal(0, 0.4, "bool"),
}

# Weighted choices, as (option, weight).
CHOICES: dict[str, tuple[tuple[str, float], ...]] = {
    "ar_archetype": (("vertical", 0.2), ("square", 0.2), ("horizontal", 0.6)),
    "alignment": (("West", 0.60), ("Center", 0.30), ("East", 0.10)),
    "noise_type": (
        ("Gaussian", 0.3),
        ("Impulse", 0.3),
        ("Laplacian", 0.1),
        ("Poisson", 0.1),
        ("Uniform", 0.2),
    ),
    "morphology_type": (("Erode", 0.5), ("Dilate", 0.5)),
    "morphology_kernel": (("Diamond", 0.4), ("Disk", 0.4), ("Square", 0.2)),
}

# Aspect ratio (width / height) range of each archetype.
ASPECT_RANGES: dict[str, tuple[float, float]] = {
    "vertical": (0.7, 0.8),
    "square": (0.8, 1.2),
    "horizontal": (1.2, 2.5),
}

PADDING_RANGE = (0, 50)

# The font files. A family is the part before the first dash.
FONTS: tuple[str, ...] = (
    "fonts/Andika-Regular.ttf",
    "fonts/Andika-Bold.ttf",
    "fonts/Andika-BoldItalic.ttf",
    "fonts/Andika-Italic.ttf",
    "fonts/M-PLUS-Rounded-1c-Black.ttf",
    "fonts/arial unicode ms.otf",
    "fonts/arial unicode ms bold.otf",
    "fonts/CharisSIL-Regular.ttf",
    "fonts/CharisSIL-Bold.ttf",
    "fonts/CharisSIL-BoldItalic.ttf",
    "fonts/CharisSIL-Italic.ttf",
    "fonts/DejaVuSans.ttf",
    "fonts/DejaVuSans-Bold.ttf",
    "fonts/DejaVuSans-BoldOblique.ttf",
    "fonts/DejaVuSans-Oblique.ttf",
    "fonts/DejaVuSans-ExtraLight.ttf",
    "fonts/DejaVuSansCondensed.ttf",
    "fonts/DejaVuSansCondensed-Bold.ttf",
    "fonts/DejaVuSansCondensed-BoldOblique.ttf",
    "fonts/DejaVuSansCondensed-Oblique.ttf",
    "fonts/DejaVuSerif.ttf",
    "fonts/DejaVuSerif-Bold.ttf",
    "fonts/DejaVuSerif-BoldItalic.ttf",
    "fonts/DejaVuSerif-Italic.ttf",
    "fonts/DejaVuSerifCondensed.ttf",
    "fonts/DejaVuSerifCondensed-Bold.ttf",
    "fonts/DejaVuSerifCondensed-BoldItalic.ttf",
    "fonts/DejaVuSerifCondensed-Italic.ttf",
    "fonts/GentiumPlus-Regular.ttf",
    "fonts/GentiumPlus-Bold.ttf",
    "fonts/GentiumPlus-BoldItalic.ttf",
    "fonts/GentiumPlus-Italic.ttf",
    "fonts/NotoSans-VariableFont_wdth,wght.ttf",
    "fonts/NotoSans-Italic-VariableFont_wdth,wght.ttf",
    "fonts/NotoSerif-VariableFont_wdth,wght.ttf",
    "fonts/NotoSerif-Italic-VariableFont_wdth,wght.ttf",
    "fonts/MPLUSRounded1c-Regular.ttf",
    "fonts/MPLUSRounded1c-Bold.ttf",
    "fonts/MPLUSRounded1c-Light.ttf",
    "fonts/MPLUSRounded1c-Medium.ttf",
    "fonts/MPLUSRounded1c-Thin.ttf",
    "fonts/MPLUSRounded1c-Black.ttf",
    "fonts/MPLUSRounded1c-ExtraBold.ttf",
)

# 32-bit mixing constants of the font choice.
FAMILY_MIX = 0x9E3779B9
VARIANT_MIX = 0x85EBCA6B


@dataclass(frozen=True)
class PrepConfig:
    """Settings of pairing, splitting and sharding.

    ``check_geometry`` reads the headers of all images before they are paired, for folders that
    hold rendered images as they came, and leaves out those of a refused size or aspect.
    """

    # Fixed values.
    min_image_bytes: int = 20 * 1024
    train_ratio: float = 0.9
    shuffle_seed: int = 42
    chat_shard_size: int = 2000
    instruction_shard_size: int = 5000
    resume_train_shard: int = 0
    resume_test_shard: int = 0
    instruction: str = "OCR:"
    assets_prefix: str = "./assets/"
    check_geometry: bool = False
