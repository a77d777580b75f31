"""The text corpus as CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from glyphmill.operators.corpus import with_defaults
from glyphmill.operators.numbering import ROW, SPLIT, number_runs
from glyphmill.session import materialize

_SHORT = "_short_row"
FILE = "_file"
_OPTIONS = {
    "header": True,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    # Every field is parsed, so that short rows are told from empty fields.
    "columnPruning": False,
    # A file whose header has other names or another order ends the read with an error.
    "enforceSchema": False,
    "columnNameOfCorruptRecord": _SHORT,
}


def read_corpus_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns of the CSV as strings, in UTF-8 with bad bytes replaced.

    An empty field is empty text; a field that its row does not have is null.
    Quoted fields may hold line ends, so a file is read by one task; ``read_corpus`` can
    read a large file by many.
    """
    reader = spark.read.options(**_OPTIONS)
    flagged = _flagged(reader.csv(path).schema)
    rows = reader.schema(flagged).csv(path)
    filled = _or_empty(flagged)
    return rows.select(*[c.alias(n) for n, c in filled.items()], F.col("_metadata.file_path").alias(FILE))


def _flagged(header: StructType) -> StructType:
    return StructType(header.fields).add(_SHORT, StringType())


def _or_empty(flagged: StructType, prefix: str = "") -> dict[str, Column]:
    """The fields of a parsed row; those that are there and hold nothing as empty text."""
    def field(name: str) -> Column:
        return F.col(f"{prefix}`{name}`")

    short = field(_SHORT).isNull()
    names = [f.name for f in flagged.fields if f.name != _SHORT]
    return {n: F.when(field(n).isNull() & short, "").otherwise(field(n)) for n in names}


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_file, _split, _row, record``, stored: the records of CSV files, each file cut into many tasks.

    A line begins a record if an even number of quotes stands before it in its file, as quotes come in
    pairs wherever a record is whole. So quotes are counted by file split, the counts are added up over the splits, and
    each split's lines are put together to records in its own task. What a split begins with inside a quoted
    field goes to the last record before it. Lines end with a line feed, with or without a carriage return before it.

    A quote inside an unquoted field must not occur. A file whose quotes do not pair ends the read with an error.
    """
    split = [FILE, SPLIT]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias("_line"),
        F.make_valid_utf8("value").alias("line"),
    )
    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).alias("_quotes")
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.select(*split, quotes).groupBy(*split).agg(F.sum("_quotes").alias("n"))
    counted = materialize(counted.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "quotes")
    odd = counted.groupBy(FILE).agg(F.sum("n").alias("n")).filter("n % 2 = 1").first()
    if odd is not None:
        raise ValueError(f"the quotes of {odd[FILE]} do not pair: read it by one task")

    # One shuffle of the texts: what follows is by split.
    before = Window.partitionBy(*split).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.select("*", quotes).join(counted.drop("n"), split)
    begins = (F.col("_before") + F.coalesce(F.sum("_quotes").over(before), F.lit(0))) % 2 == 0
    numbered = placed.withColumn("_begins", begins.cast("int")).withColumn("_record", F.sum("_begins").over(upto))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_line", "line"))), lambda x: x["line"]), "\n")
    pieces = numbered.groupBy(*split, "_record").agg(whole.alias("record"))
    last = F.max("_record").over(Window.partitionBy(*split))
    pieces = materialize(pieces.withColumn("_last", (F.col("_record") == last) & (last > 0)), "records")

    # A row for each split that begins inside a field.
    tails = pieces.filter("_record = 0").select(*split, "record")
    owners = pieces.filter("_last").select(FILE, F.col(SPLIT).alias("_owner"))
    places = tails.join(owners, FILE).filter(F.col("_owner") < F.col(SPLIT)).groupBy(*split).agg(F.max("_owner").alias("_owner"))
    rest = F.array_sort(F.collect_list(F.struct(SPLIT, "record")))
    tails = tails.join(places, split).groupBy(FILE, F.col("_owner").alias(SPLIT)).agg(
        F.array_join(F.transform(rest, lambda x: x["record"]), "\n").alias("_rest")
    )
    tails = materialize(tails.withColumn("_last", F.lit(True)), "record-ends")
    joined = pieces.filter("_record > 0").join(tails, [*split, "_last"], "left")
    record = F.rtrim(F.concat_ws("\n", "record", "_rest"), F.lit("\r"))
    first = (F.col(SPLIT) == 0) & (F.col("_record") == 1)
    # Blank lines are no records, and the first record is the header.
    records = joined.select(*split, "_record", record.alias("record")).filter((F.col("record") != "") & ~first)
    records = records.repartition(*split).sortWithinPartitions(*split, "_record")
    return materialize(records.drop("_record").withColumn(ROW, F.monotonically_increasing_id()), "csv-records")


def _read_by_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    header = spark.read.options(**_OPTIONS).csv(path).schema
    flagged = _flagged(header)
    records = csv_records(spark, path)
    order = F.concat(FILE, F.lit("/"), F.lpad(F.col(SPLIT).cast("string"), 20, "0"))
    numbered = number_runs(records.withColumn("_order", order), [FILE, SPLIT], "_order", "row_ordinal", start=1)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _OPTIONS.items() if k not in ("header", "enforceSchema")}
    fields = ", ".join(f"`{f.name}` STRING" for f in flagged.fields)
    parsed = numbered.select("row_ordinal", F.from_csv("record", fields, options).alias("_parsed"))
    return parsed.select("row_ordinal", *[c.alias(n) for n, c in _or_empty(flagged, "_parsed.").items()])


def read_corpus(spark: SparkSession, path: str | list[str], many_tasks: bool = False) -> DataFrame:
    """``row_ordinal, id, language, text``: ordinals from 1 in file order, files by path.

    The rows are stored once in the scratch folder, where the ordinals hold
    still. Numbering needs one small row per file and no shuffle of the texts.
    With ``many_tasks`` large files are cut as ``csv_records`` says, for one shuffle of the texts.
    """
    if many_tasks:
        return with_defaults(_read_by_records(spark, path)).select("row_ordinal", "id", "language", "text")
    raw = read_corpus_csv(spark, path)
    kept = [c for c in ("id", "language", "text") if c in raw.columns]
    rows = raw.select(
        *kept,
        FILE,
        F.monotonically_increasing_id().alias(ROW),
    )
    stored = materialize(rows, "corpus")
    numbered = number_runs(stored, [FILE], FILE, "row_ordinal", start=1)
    return with_defaults(numbered).select("row_ordinal", "id", "language", "text")


def count_rows(spark: SparkSession, path: str | list[str]) -> int:
    """Rows of the CSV without headers."""
    return read_corpus_csv(spark, path).count()
