import hashlib
import math

import pytest
from pyspark.sql import functions as F

from glyphmill.config import CHOICES, FAMILY_MIX, FONTS, NORMALS, VARIANT_MIX
from glyphmill.functions import draws as D
from glyphmill.operators import manifest as M

N = 20_000


@pytest.fixture(scope="module")
def drawn(spark):
    rows = spark.range(1, N + 1).withColumnRenamed("id", "chunk_no")
    size = D.size_plan(42, F.col("chunk_no"), F.lit(400))
    return M.with_draws(rows, 42).withColumn("size", size).cache()


def u(name, i, which=0, seed=42):
    return int(hashlib.md5(f"{seed}:{i}:{name}".encode()).hexdigest()[8 * which :][:8], 16) / 0xFFFFFFFF


def test_normal_draws_follow_the_rule(drawn):
    rows = drawn.filter("chunk_no <= 300").collect()
    for r in rows:
        for name, spec in NORMALS.items():
            if name == "short_side":
                continue
            z = math.sqrt(-2 * math.log(max(u(name, r.chunk_no), 1e-10)))
            raw = spec.median + spec.std * z * math.cos(2 * math.pi * u(name, r.chunk_no, 1))
            if spec.low is not None:
                raw = max(spec.low, raw)
            if spec.high is not None:
                raw = min(spec.high, raw)
            expected = {
                "int": round(raw), "bool": raw > 0.5, "float": raw, "decimals": max(0.0, round(raw, 2)),
            }[spec.kind]
            assert r[name] == pytest.approx(expected, abs=1e-9), (name, r.chunk_no)


def test_digests_of_many_names_at_once(spark):
    names = ["n", "ptsize", "morphology_kernel", "n" * 40, "n" * 130]
    indexes = [None, 0, 1, -7, 12, 123_456, 2**62, *range(95, 105)]
    rows = spark.createDataFrame([(i,) for i in indexes], "i long").repartition(2)
    for seed in (42, -(2**62)):
        named = {f"n{k}": n for k, n in enumerate(names)}
        many = D.digests(seed, F.col("i"), names).alias("many")
        one = F.struct(*[D.digest(F.lit(seed), F.col("i"), n).alias(k) for k, n in named.items()]).alias("one")
        for r in rows.select("i", many, one).collect():
            start = f"{seed}:" if r.i is None else f"{seed}:{r.i}:"
            want = [int.from_bytes(hashlib.md5((start + n).encode()).digest()[:8], "big", signed=True) for n in names]
            assert list(r.many) == list(r.one) == want


def test_draws_of_a_block_are_not_digested_one_by_one(spark):
    rows = spark.range(1, 10).withColumnRenamed("id", "chunk_no")
    plan = M.with_draws(rows, 42)._jdf.queryExecution().executedPlan().toString()
    assert "md5(" not in plan and "conv(" not in plan


def test_draws_are_dealt_over_several_tasks_a_core(spark):
    rows = spark.range(1, 2000, 1, 1).select(
        F.col("id").alias("chunk_no"), F.lit("r").alias("id"), F.lit("zpo").alias("language"), F.lit(1).alias("block_idx"), F.lit("some text").alias("block_text")
    )
    tasks = M.render_manifest(rows).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 * spark.sparkContext.defaultParallelism and max(r["count"] for r in tasks) < 250


def test_sizes_of_blocks_are_those_of_the_search(spark):
    texts = F.expr("repeat('a', cast(1 + id * 37 % 3000 as int))")
    rows = spark.range(1, 400).select(
        F.col("id").alias("chunk_no"), F.lit("r").alias("id"), F.lit("zpo").alias("language"), F.lit(1).alias("block_idx"), texts.alias("block_text")
    )
    names = ["ok", "attempt", "archetype", "short_side", "aspect_ratio", "width", "height"]
    got = M.planned_blocks(rows).select("chunk_no", *names).collect()
    want = rows.select("chunk_no", F.inline(F.array(D.size_plan(42, F.col("chunk_no"), F.length("block_text"))))).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len({r.attempt for r in got}) > 5


def test_rates_of_flags(drawn):
    expected = {
        "use_color": 0.253, "uppercase": 0.048, "use_ebc": 0.048, "use_dirty": 0.048,
        "use_motion_blur": 0.159, "apply_wave": 0.106, "use_noise": 0, "use_banding": 0,
        "use_morphology": 0,
    }
    means = drawn.agg(*[F.avg(F.col(n).cast("int")).alias(n) for n in expected]).first()
    for name, p in expected.items():
        assert abs(means[name] - p) <= 3 * math.sqrt(p * (1 - p) / N) + 5e-4, name


def test_rates_of_choices_and_ranges(drawn):
    for name, options in CHOICES.items():
        column = F.col("size.archetype") if name == "ar_archetype" else F.col(name)
        counts = {r.o: r["count"] for r in drawn.groupBy(column.alias("o")).count().collect()}
        for option, p in options:
            assert abs(counts[option] / N - p) <= 3 * math.sqrt(p * (1 - p) / N) + 0.01
    low, high = drawn.agg(F.min("extent_padding"), F.max("extent_padding")).first()
    assert (low, high) in {(0, 49), (0, 50)}


def test_fonts_of_every_index(spark):
    families = {}
    for f in FONTS:
        families.setdefault(f.split("-")[0], []).append(f)
    names = sorted(families)
    assert len(FONTS) == 43 and len(names) == 17
    indexes = [1, 2, 41, 42, 1000, 2**31, 2**32 + 5, 2**40 + 12345, 10**15]
    rows = spark.createDataFrame([(i,) for i in indexes], "i long")
    got = {r.i: r.font for r in rows.select("i", D.font(42, F.col("i")).alias("font")).collect()}
    for i in indexes:
        family = families[names[((42 + i * FAMILY_MIX) & 0xFFFFFFFF) % 17]]
        assert got[i] == family[((42 + i * VARIANT_MIX) & 0xFFFFFFFF) % len(family)]


def test_no_fonts(spark):
    assert spark.range(1).select(D.font(42, F.col("id"), ()).alias("f")).first().f is None


@pytest.mark.parametrize(
    "width, height, chars, ok",
    [(400, 400, 942, False), (400, 400, 941, True), (199, 900, 1, False), (200, 200, 0, True)],
)
def test_valid_size(spark, width, height, chars, ok):
    got = spark.range(1).select(D.is_valid_size(F.lit(width), F.lit(height), F.lit(chars)).alias("v"))
    assert got.first().v is ok


def test_size_plan_takes_the_first_fitting_attempt(spark):
    def attempt(i, k):
        seed = 42 + k
        z = math.sqrt(-2 * math.log(max(u("short_side", i, 0, seed), 1e-10)))
        side = 500 + 150 * z * math.cos(2 * math.pi * u("short_side", i, 1, seed))
        side = round(min(800, max(200, side)))
        pick = u("ar_archetype", i, 0, seed)
        kind = "vertical" if pick <= 0.2 else "square" if pick <= 0.4 else "horizontal"
        low, high = {"vertical": (0.7, 0.8), "square": (0.8, 1.2), "horizontal": (1.2, 2.5)}[kind]
        ratio = low + u(f"ar_{kind}", i, 0, seed) * (high - low)
        return (int(side * ratio), side) if ratio >= 1 else (side, int(side / ratio))

    for chars in (300, 1500, 3000, 20_000):
        rows = spark.range(1, 200).select("id", D.size_plan(42, F.col("id"), F.lit(chars)).alias("s"))
        for r in rows.collect():
            fits = [k for k in range(11) if math.prod(attempt(r.id, k)) / chars >= 170]
            assert r.s.ok == bool(fits)
            if fits:
                assert r.s.attempt == fits[0]
                assert (r.s.width, r.s.height) == attempt(r.id, fits[0])


def test_effects_in_order_with_thresholds(spark):
    base = dict(
        width=600, height=400, rotation=0.0, skew_x=0.0, skew_y=0.0, perspective=0.0, use_noise=False,
        noise_type="Gaussian", noise_amount=0.0, use_dirty=False, dirty_attenuate=0.05, use_ebc=False,
        brightness=3, contrast=-4, use_banding=False, use_morphology=False, morphology_type="Erode",
        morphology_kernel="Disk", apply_wave=False, extent_padding=0,
    )
    cases = [
        ({}, [("trim", "10%")]),
        ({"rotation": 0.1, "skew_x": -0.1}, [("trim", "10%")]),
        ({"rotation": -0.2, "skew_y": 0.3}, [("rotate", "-0.2"), ("shear", "0.0x0.3"), ("trim", "10%")]),
        ({"perspective": -0.5}, [("trim", "10%")]),
        ({"perspective": 0.012}, [("trim", "10%")]),
        ({"perspective": 0.25}, [("perspective", "20"), ("trim", "10%")]),
        (
            {"use_noise": True, "use_dirty": True, "noise_amount": 0.5},
            [("noise", "Gaussian 0.5"), ("trim", "10%")],
        ),
        ({"use_noise": True}, [("noise", "Gaussian"), ("trim", "10%")]),
        (
            {"use_dirty": True, "use_ebc": True, "use_banding": True, "use_morphology": True,
             "apply_wave": True, "extent_padding": 7},
            [("dirty", "0.05"), ("brightness-contrast", "3x-4"), ("banding", "600x400"),
             ("morphology", "Erode Disk"), ("wave", "2x300.0"), ("trim", "10%"),
             ("border", "3.5x3.5")],
        ),
    ]
    for change, expected in cases:
        df = spark.createDataFrame([{**base, **change}])
        df = df.withColumns({c: F.col(c).cast("int") for c in ("width", "height", "brightness", "contrast")})
        got = df.select(M.effects().alias("e")).first().e
        assert [tuple(e) for e in got] == expected


def test_text_region(spark):
    df = spark.createDataFrame(
        [(500, 400, 0.1, "x" * 300), (200, 200, 0.45, "x"), (500, 400, -0.1, "x" * 300)],
        "width int, height int, margin_factor double, text string",
    )
    got = [tuple(r)[4:] for r in M.with_text_region(df).collect()]
    assert got[0] == (400, 320, int(math.sqrt(2.5 * 400 / 320 * 300)))
    assert got[1] == (50, 50, 10)
    assert got[2][:2] == (600, 480)
