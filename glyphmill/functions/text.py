"""Text functions, each ``Column -> Column`` and built from Spark expressions only.

Whitespace always means the Unicode set below. ``trim`` alone knows only U+0020,
and regex ``\\s`` is ASCII-only, so both are given the set explicitly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as whitespace.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a Java character class.
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_RUN = f"[{WS_CLASS}]+"
# The ends of a line as str.splitlines sees them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    # Trimming the left side alone stops at the first character that counts.
    return F.ltrim(c, F.lit(WS_CHARS)) == ""


def words(c: Column) -> Column:
    """Whitespace-separated words; blank text has none."""
    return F.filter(F.split(c, WS_RUN), lambda w: w != "")


def repair_escapes(c: Column) -> Column:
    r"""Two-character ``\n`` and ``\r`` become the control characters."""
    c = F.replace(c, F.lit("\\n"), F.lit("\n"))
    return F.replace(c, F.lit("\\r"), F.lit("\r"))


# The markup patterns, in the order they apply, as
# (markers, Java pattern, replacement); every match holds one of the markers.
MARKDOWN_RULES: list[tuple[tuple[str, ...], str, str]] = [
    (("#",), rf"(?md)^#{{1,6}}{WS_RUN}", ""),
    (("***",), r"(?d)\*\*\*(.+?)\*\*\*", "$1"),
    (("___",), r"(?d)___(.+?)___", "$1"),
    (("**",), r"(?d)\*\*(.+?)\*\*", "$1"),
    (("__",), r"(?d)__(.+?)__", "$1"),
    (("*",), r"(?d)\*(.+?)\*", "$1"),
    # The mark itself is looked for first, the character before it only there.
    (("_",), rf"(?d)_((?![_{WS_CLASS}]).{{2,}}?(?=_)(?<![_{WS_CLASS}]))_", "$1"),
    (("~~",), r"(?d)~~(.+?)~~", "$1"),
    # Nothing shorter ends at a bracket either: what was passed is not given back.
    (("](",), r"\[([^\]]++)\]\([^\)]++\)", "$1"),
    (("![",), r"!\[([^\]]*+)\]\([^\)]++\)", "$1"),
    (("][",), r"\[([^\]]++)\]\[[^\]]*+\]", "$1"),
    (("```",), r"(?s)```.*?```", ""),
    (("~~~",), r"(?s)~~~.*?~~~", ""),
    (("    ", "\t"), r"(?md)^(?: {4}|\t).+$", ""),
    (("\n\n\n",), r"\n{3,}", "\n\n"),
    (("  ",), r" {2,}", " "),
]


# How many rules in turn have markers that all hold one of the parts: without these, none of the rules applies.
_RULE_GROUPS: list[tuple[int, tuple[str, ...]]] = [
    (1, ("#",)), (6, ("*", "_")), (1, ("~~",)), (3, ("[",)), (1, ("```",)), (1, ("~~~",)), (3, ("  ", "\t", "\n\n\n")),
]


def clean_markdown(c: Column) -> Column:
    """Markup removed in rule order, then stripped; null and empty stay as they are.

    A rule's regex runs only on texts that hold its marker. Most texts hold few,
    and a byte search is far cheaper than a regex pass over every text.
    """
    rules = iter(MARKDOWN_RULES)
    for n, parts in _RULE_GROUPS:
        c = let(c, _when_marked(parts, _by_rules([next(rules) for _ in range(n)])))
    return strip(c)


def _when_marked(markers: tuple[str, ...], changed: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def apply(t: Column) -> Column:
        marked = reduce(Column.__or__, [F.contains(t, F.lit(m)) for m in markers])
        return F.when(marked, changed(t)).otherwise(t)

    return apply


def _by_rules(rules: list[tuple[tuple[str, ...], str, str]]) -> Callable[[Column], Column]:
    def replaced(pattern: str, replacement: str) -> Callable[[Column], Column]:
        return lambda t: F.regexp_replace(t, pattern, replacement)

    def apply(t: Column) -> Column:
        if len(rules) == 1:  # its marker was found
            return replaced(*rules[0][1:])(t)
        for markers, *rule in rules:
            t = let(t, _when_marked(markers, replaced(*rule)))
        return t

    return apply


def reflow(c: Column) -> Column:
    """Runs of spaces and tabs become one space; newlines stay; then stripped."""
    return strip(F.regexp_replace(c, "[ \t]+", " "))


def collapse(c: Column) -> Column:
    """A transcript on one line: every whitespace run, line ends too, is one space."""
    return F.trim(F.regexp_replace(c, WS_RUN, " "))


def upper_if(flag: Column, c: Column) -> Column:
    return F.when(flag, F.upper(c)).otherwise(c)


def non_blank_lines(c: Column) -> Column:
    return F.filter(F.split(c, LINE_END), lambda line: ~is_blank(line))


def line_stats(c: Column) -> Column:
    """``STRUCT<line_count, mean_line_len, text_aspect>``; null where every line is blank."""

    def stats(lines: Column) -> Column:
        n = F.size(lines)
        total = F.aggregate(lines, F.lit(0), lambda acc, line: acc + F.length(line))
        return F.when(
            n > 0,
            F.struct(
                n.alias("line_count"),
                (total / n).alias("mean_line_len"),
                (total / n / n).alias("text_aspect"),
            ),
        )

    return let(non_blank_lines(c), stats)


def is_noise(c: Column) -> Column:
    """Nothing but whitespace, dots, underscores and dashes (and at least one of them)."""
    return (c != "") & (F.ltrim(c, F.lit(WS_CHARS + "._-")) == "")


def is_index_like(c: Column) -> Column:
    """Longer than 10 characters and more than half dots and underscores."""
    n = F.length(c)
    bare = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit("_"), F.lit(""))
    dots = n - F.length(bare)
    return (n > 10) & (dots * 2 > n)


def language_of_key(basename: Column) -> Column:
    return F.substring(basename, 1, 3)


def safe_name(c: Column) -> Column:
    """Every character but letters, digits, ``_``, ``-`` and ``.`` becomes ``_``."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_.\-]", "_")


def sample_key(language: Column, row_id: Column, block_idx: Column, aspect_ratio: Column) -> Column:
    """Key of a sample: ``block_idx`` counts from 1 inside its row."""
    percent = (aspect_ratio * 100).cast("int")
    return safe_name(F.format_string("%s_%s_%03d_%dar", language, row_id, block_idx, percent))
