"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines, cut after every ``PARAGRAPH`` code points; its set of their
64-bit digests is what is compared. A sketch has twelve cells in three groups; a digest goes
into one cell of each group, which keeps a count, the exclusive or of its digests and that of
their checks. The sketches of two versions subtract cell by cell: what both hold cancels out, and
peeling cells that hold one digest recovers the rest.

Where peeling gets stuck the digests are dealt into more sketches by a hash, as many as the
texts' paragraphs need, and what fails there into more again under the next seed, until none
fails. So a retry is a larger sketch made of small ones, and a text of any length costs time in
proportion. Each level is a stored table that holds only the digests that have failed.

All in DataFrame functions. Texts cross the network once: rows are dealt into stretches of ids, in
which a window finds the next text; the first row of each stretch is also sent to the one before.

Results for odd input: a null text counts as empty; a text without paragraphs has an empty
sketch, and two of them are alike (1.0); rows without an id are left out; rows that share an id are
put in order by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.session import materialize

PARAGRAPH = 240
GROUPS, SLOTS = 3, 4
CELLS = GROUPS * SLOTS
PEELS = 8  # digests a sketch gives up at most; more count as a failure
PER_SKETCH = 4  # digests to a sketch where texts are dealt into several
STRETCH = 2000  # rows of a stretch of ids
MOST_STRETCHES = 10_000  # whose bounds go through the driver; beyond them stretches grow
LEVELS = 64


def paragraphs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PARAGRAPH}}}"), F.lit(0)))


def digests(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.xxhash64(p))


def _check(x: Column) -> Column:
    return F.xxhash64(x, F.lit("check"))


def _slot(x: Column, group: int) -> Column:
    return F.shiftrightunsigned(x, 7 + 9 * group).bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _cell(n: Column, x: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), x.alias("x"), check.alias("check"))


def sketch(xs: Column) -> Column:
    """The cells of an array of distinct digests."""

    def cell(group: int, slot: int) -> Column:
        inside = F.filter(xs, lambda x: _slot(x, group) == slot)
        zero = F.lit(0).cast("long")
        return _cell(
            F.size(inside),
            F.aggregate(inside, zero, lambda a, x: a.bitwiseXOR(x)),
            F.aggregate(inside, zero, lambda a, x: a.bitwiseXOR(_check(x))),
        )

    return F.array(*[cell(g, s) for g in range(GROUPS) for s in range(SLOTS)])


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a, b, lambda x, y: _cell(x["n"] - y["n"], x["x"].bitwiseXOR(y["x"]), x["check"].bitwiseXOR(y["check"]))
    )


def peel(cells: Column) -> Column:
    """``found``: digests recovered; ``left``: cells that are not empty after that."""

    def remove(cells: Column, pure: Column) -> Column:
        def less(c: Column, i: Column) -> Column:
            group = F.floor(i / SLOTS)
            slot = F.when(group == 0, _slot(pure["x"], 0)).when(group == 1, _slot(pure["x"], 1))
            slot = slot.otherwise(_slot(pure["x"], 2))
            return F.when(
                i % SLOTS == slot,
                _cell(c["n"] - pure["n"], c["x"].bitwiseXOR(pure["x"]), c["check"].bitwiseXOR(pure["check"])),
            ).otherwise(c)

        return F.transform(cells, less)

    def step(state: Column, _: Column) -> Column:
        pure = state["pure"]
        # A state without a pure cell stays as it is.
        cells = F.when(pure.isNull(), state["cells"]).otherwise(remove(state["cells"], pure))
        return F.struct(
            cells.alias("cells"),
            (state["found"] + F.when(pure.isNull(), 0).otherwise(1)).alias("found"),
            F.lit(None).cast("struct<n:int,x:bigint,check:bigint>").alias("pure"),
        )

    def look(state: Column) -> Column:
        pure = F.get(F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["x"]))), 0)
        return F.struct(state["cells"].alias("cells"), state["found"].alias("found"), pure.alias("pure"))

    start = F.struct(
        cells.alias("cells"),
        F.lit(0).alias("found"),
        F.lit(None).cast("struct<n:int,x:bigint,check:bigint>").alias("pure"),
    )
    # Odd turns look for a pure cell, even turns remove it.
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(2 * PEELS - 1)),
        start,
        lambda state, i: F.when(i % 2 == 0, look(state)).otherwise(step(state, i)),
        lambda state: F.struct(
            state["found"].alias("found"),
            F.size(F.filter(state["cells"], lambda c: (c["n"] != 0) | (c["x"] != 0) | (c["check"] != 0))).alias("left"),
        ),
    )


def as_text(cells: Column) -> Column:
    """A sketch as a string: count and digest of each cell."""
    return F.array_join(
        F.transform(cells, lambda c: F.concat(F.conv(c["n"].cast("string"), 10, 16), F.lit("."), F.hex(c["x"]))), "-"
    )


def _dealt(xs: str, parts: Column, level: int) -> Column:
    """The digests in at least ``parts`` arrays by a hash: halved bit by bit, so each digest is looked at twice a bit."""

    def halved(state: Column, bit: Column) -> Column:
        def half(part: Column, side: int) -> Column:
            return F.filter(
                part, lambda x: F.call_function("shiftright", F.xxhash64(x, F.lit(level)), bit).bitwiseAND(F.lit(1)) == side
            )

        return F.flatten(F.transform(state, lambda part: F.array(half(part, 0), half(part, 1))))

    bits = F.ceil(F.log2(parts)).cast("int")
    return F.aggregate(F.sequence(F.lit(0), bits - 1), F.array(F.col(xs)), halved)


def differences(pairs: DataFrame) -> DataFrame:
    """``id, kind, d``: how many digests of ``a`` or ``b`` the other has not, by peeling.

    ``pairs``: ``id, kind, a, b``, with digests that are distinct in each array.
    """
    state, settled = materialize(pairs.select("id", "kind", "a", "b"), "sketch-level"), []
    for level in range(LEVELS):
        if level == 0:
            dealt = state
        else:
            total = F.size("a") + F.size("b")
            dealt = state.withColumn("parts", F.greatest(F.lit(2), F.ceil(total / PER_SKETCH)).cast("int"))
            dealt = dealt.withColumn("a", _dealt("a", F.col("parts"), level)).withColumn(
                "b", _dealt("b", F.col("parts"), level)
            )
            dealt = dealt.select("id", "kind", F.inline_outer(F.arrays_zip("a", "b")))
            dealt = dealt.filter((F.size("a") > 0) | (F.size("b") > 0))
        dealt = dealt.withColumn("cells", subtract(sketch(F.col("a")), sketch(F.col("b"))))
        peeled = materialize(
            dealt.select("id", "kind", "a", "b", peel(F.col("cells")).alias("peeled")).select(
                "id", "kind", "peeled.found", (F.col("peeled.left") == 0).alias("done"),
                F.when(F.col("peeled.left") > 0, F.col("a")).alias("a"),
                F.when(F.col("peeled.left") > 0, F.col("b")).alias("b"),
            ), "sketch-level",
        )
        settled.append(peeled.filter("done").select("id", "kind", "found"))
        state = peeled.filter("not done").select("id", "kind", "a", "b")
        if state.isEmpty():
            break
    else:
        raise RuntimeError("digests that no seed can part")
    found = settled[0]
    for part in settled[1:]:
        found = found.unionAll(part)
    return found.groupBy("id", "kind").agg(F.sum("found").alias("d"))


def _bounds_passed(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above ``value``, found by halving."""
    known = F.expr(f"array({', '.join(f'bigint({b})' for b in bounds)})")
    widths = [1 << b for b in reversed(range(len(bounds).bit_length()))]

    def further(passed: Column, width: Column) -> Column:
        ahead = passed + width
        return F.when((ahead <= len(bounds)) & (F.get(known, ahead - 1) <= value), ahead).otherwise(passed)

    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), further)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, next``: each text with that of the next id, after the last that of the first."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    n = rows.count()
    if not n:
        return rows.withColumn("next", F.col("text"))
    stretches = min(MOST_STRETCHES, -(-n // STRETCH))
    quantiles = F.expr(f"array({', '.join(str(i / stretches) for i in range(1, stretches + 1))})")
    bounds = rows.agg(F.percentile_approx("id", quantiles, 10 * MOST_STRETCHES)).first()[0]
    rows = rows.withColumn("stretch", _bounds_passed(F.col("id"), sorted(set(bounds))))
    # Where each stretch begins: one narrow row for each.
    firsts = rows.groupBy("stretch").agg(F.min("id").alias("id"))
    order = Window.orderBy("stretch")
    before = F.coalesce(F.lag("stretch").over(order), F.last("stretch").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ))
    heads = materialize(firsts.select("id", before.alias("before")), "stretch-heads")
    ghosts = rows.join(heads, "id").groupBy("id").agg(F.min("before").alias("stretch"), F.min("text").alias("text"))
    # A ghost stands after all rows of the stretch that it ends.
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))
    inside = Window.partitionBy("stretch").orderBy("ghost", "id", "text")
    return (
        both.withColumn("next", F.lead("text").over(inside)).filter(~F.col("ghost")).select("id", "text", "next")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has the last half of the text, rounded down, replaced by as much of the
    next document's text, or all of it. Likeness is the share of digests that both texts have
    among those that either has.
    """
    rows = with_next(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next", F.lit(1), half))
    # The row's number tells rows that share an id apart; the table is stored, so it is fixed.
    base = rows.withColumn("edited", edited).select(
        "id", F.monotonically_increasing_id().alias("row"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"),
        digests(F.col("next")).alias("following"),
    )
    base = materialize(base, "digests")
    pairs = base.select(
        F.col("row").alias("id"), F.col("own").alias("a"),
        F.inline(F.array(
            F.struct(F.lit("edited").alias("kind"), F.col("changed").alias("b")),
            F.struct(F.lit("next").alias("kind"), F.col("following").alias("b")),
        )),
    )
    found = differences(pairs).groupBy("id").agg(
        F.max(F.when(F.col("kind") == "edited", F.col("d"))).alias("d_edited"),
        F.max(F.when(F.col("kind") == "next", F.col("d"))).alias("d_next"),
    )

    def alike(d: str, other: str) -> Column:
        total = F.size("own") + F.size(other)
        return F.when(total == 0, 1.0).otherwise((total - F.col(d)) / (total + F.col(d)))

    named = base.withColumn("fingerprint", as_text(sketch(F.col("own")))).withColumn(
        "edited_fingerprint", as_text(sketch(F.col("changed")))
    )
    found = found.withColumnRenamed("id", "row")
    return named.join(found, "row").select(
        "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        alike("d_edited", "changed").alias("near_edited"), alike("d_next", "following").alias("near_next"),
    )
