"""From raw documents to a training sample: five stages, each over all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps with the columns of
``documents``. Rows without an id pass the stages that compare documents and are not sampled by the last.
More columns, whatever their names, are passed on as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import langid, mixing
from glyphmill.llm.decontaminate import decontaminate
from glyphmill.llm.line_dedup import line_dedup
from glyphmill.llm.ngram_join import similarity_classes
from glyphmill.llm.shared import fold_of, table
from glyphmill.session import materialize

#: A language whose mean probability over the text is lower is a guess.
LEAST_SCORE = 0.3


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_any_columns(stage: Stage) -> Stage:
    """``stage`` for tables with columns of any name: it sees those it does not know under neutral names.

    A column that it adds gets underscores if the table has one of that name.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        neutral = {f"extra{n}": c for n, c in enumerate(docs.columns) if c not in COLUMNS}
        known = {c: name for name, c in neutral.items()}
        out = stage(spark, docs.toDF(*[known.get(c, c) for c in docs.columns]), sf_dir)
        names: list[str] = []
        for c in out.columns:
            name = neutral.get(c, c)
            while c not in neutral and name not in COLUMNS and (name in docs.columns or name in names):
                name += "_"
            names.append(name)
        return out.toDF(*names)

    return run


@_with_any_columns
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a language that the network can tell."""
    model = langid.fit(docs.filter(fold_of(F.col("doc_id"), 4) != 2))
    judged = docs.withColumn("_judged", langid.predict(F.col("text"), model))
    known = (F.col("_judged.lang") != langid.UNDETERMINED) & (F.col("_judged.score") >= LEAST_SCORE)
    return judged.filter(known).select(*docs.columns)


@_with_any_columns
def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in the last of them alone."""
    deduped = line_dedup(docs, out="_deduped")
    changed = {"text": F.col("_deduped.text"), "n_chars": F.length("_deduped.text").cast("long")}
    return deduped.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


@_with_any_columns
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles the one of the least id stays."""
    classes = similarity_classes(docs, words=5, percent=80)
    copies = materialize(classes.filter("id <> component_id").select(F.col("id").alias("doc_id")).distinct(), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


@_with_any_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    hits = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    leaks = materialize(hits.filter("n_hit > 0").select(F.col("id").alias("doc_id")).distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


@_with_any_columns
def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample sources, languages and topics evened out by the power of the mixing operator."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    mixed = mixing.mix(docs, dims).filter("sampled").groupBy(F.col("id").alias("doc_id"))
    sampled = mixed.agg(F.max("topic").alias("mix_topic"), F.max("probability").alias("mix_probability"))
    return docs.join(materialize(sampled, "sampled"), "doc_id").select(*docs.columns, "mix_topic", "mix_probability")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("ngram_join", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("source_mixing", sample_mixture),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
