"""Digests of stored rows: what was written is read back and compared, values and types, without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS, DIGEST = "rows", "digest"


def row_digest(schema: T.StructType) -> Column:
    """64 bits of a row's values, column names and types; the order of the columns does not matter."""
    fields = sorted(schema.fields, key=lambda f: f.name)
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    values = [_told(F.col(f"`{f.name}`"), f.dataType).alias(f"c{n}") for n, f in enumerate(fields)]
    return F.xxhash64(F.lit(kinds), F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def _told(value: Column, kind: T.DataType) -> Column:
    """``value`` as JSON tells it in full: bytes by their digest, moments in microseconds, maps as entries in order."""
    if isinstance(kind, T.BinaryType):
        return F.when(value.isNotNull(), F.concat_ws(":", F.octet_length(value), F.xxhash64(value)))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.StructType):
        inner = [_told(value[f.name], f.dataType).alias(f"c{n}") for n, f in enumerate(kind.fields)]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _told(v, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType().add("key", kind.keyType).add("value", kind.valueType))
        return _told(F.array_sort(F.map_entries(value)), entries)
    return value


def total(digest: Column) -> Column:
    """Digests of many rows in one number that does not depend on their order, but on how often each is there."""
    return F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def digests_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` and ``digest`` of the other columns for each value of ``keys``."""
    rest = T.StructType([f for f in df.schema.fields if f.name not in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), total(row_digest(rest)).alias(DIGEST))


def differences(found: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``problem`` where two tables of digests differ: lost, extra, rows or values."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("side"), ROWS, DIGEST)

    def of(name: str, figure: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(figure)))

    both = side(found, "found").unionByName(side(wanted, "wanted")).groupBy(*keys)
    compared = both.agg(*[of(s, f).alias(f"{s}_{f}") for s in ("found", "wanted") for f in (ROWS, DIGEST)])
    problem = (
        F.when(F.col("found_rows").isNull(), "lost")
        .when(F.col("wanted_rows").isNull(), "extra")
        .when(F.col("found_rows") != F.col("wanted_rows"), "rows")
        .when(F.col("found_digest") != F.col("wanted_digest"), "values")
    )
    return compared.select(*keys, problem.alias("problem")).filter(F.col("problem").isNotNull())
