"""Every operator as a query over the shared test tables: ``(spark, sf_dir) -> DataFrame``.

The tables stand in for the real inputs: ``documents`` for the corpus and for
transcripts, ``labels`` for a side that covers only some of them, ``pages`` for
payloads with a byte size, ``conversations`` for short texts to score.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.config import CHOICES, NORMALS, PrepConfig
from glyphmill.functions import draws as D
from glyphmill.functions import text as T
from glyphmill.functions.blocks import pack_sentences, paragraphs
from glyphmill.functions.metrics import percent
from glyphmill.operators import corpus as C
from glyphmill.operators import evaluate as E
from glyphmill.operators import manifest as M
from glyphmill.operators import pairs as P
from glyphmill.operators import reshape as R
from glyphmill.operators import splits as S
from glyphmill.operators.chunks import plan_chunks
from glyphmill.operators.numbering import positions
from glyphmill.operators.runlog import error_rows, run_counters
from glyphmill.plans.evaluation import compare_systems
from glyphmill.session import dealt

SEED = 42
Query = Callable[[SparkSession, str], DataFrame]

# Replacements that make the texts of two imaginary systems from a ground truth.
RAW_EDITS = [("tion", "tlon"), (" de ", " "), ("é", "e"), ("er", "cr"), (" the ", " th e ")]
FT_EDITS = [("ê", "e"), ("tion", "tlon"), (" und ", " vnd ")]
ID_WORDS = ("small", "zpo", "english", "nhg", "tall", "esp", "Spain", "azz", "porto", "mam")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as corpus rows; ids count from 0, so the ordinal is the id plus one."""
    return table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("row_ordinal"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("language"),
        "text",
    )


def edited(c: Column, edits: list[tuple[str, str]]) -> Column:
    for old, new in edits:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _records(df: DataFrame, record_id: Column, language: Column, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        record_id.alias("id"),
        language.alias("language"),
        F.col("text").alias("ground_truth"),
        edited(F.col("text"), RAW_EDITS).alias("raw"),
        edited(F.col("text"), FT_EDITS).alias("finetuned"),
    )


def turns_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return _records(turns, F.concat_ws("-", "conv_id", "turn"), F.col("role"))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _records(docs, F.col("doc_id").cast("string"), F.col("lang"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


RATES = ("raw_cer", "raw_wer", "ft_cer", "ft_wer")


# --- evaluation ---------------------------------------------------------------


def eval_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = E.scores(E.with_record_defaults(turns_records(spark, sf_dir)))
    return _rounded(
        scored.select("id", "language", "raw_cer", "ft_cer", "improvement"),
        "raw_cer", "ft_cer", "improvement",
    )


def eval_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = E.scores(E.with_record_defaults(turns_records(spark, sf_dir)))
    return _rounded(scored.select("id", "raw_wer", "ft_wer"), "raw_wer", "ft_wer")


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summed = E.evaluate(turns_records(spark, sf_dir))
    return _rounded(summed, *[c for c in summed.columns if c != "n"])


def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored first, so that rows without their texts are put in order."""
    turns = table(spark, sf_dir, "conversations")
    records = _records(turns, F.concat_ws("-", "conv_id", "turn"), F.col("role"), "conv_id", "turn")
    scored = E.stored_scores(E.with_record_defaults(records, E.SYSTEMS, "conv_id", "turn"))
    return E.report(positions(scored, ["conv_id", "turn"]))


def eval_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = E.scores(E.with_record_defaults(document_records(spark, sf_dir)))
    return _rounded(scored.select("id", "language", *RATES, "improvement"), *RATES, "improvement")


def eval_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character error rates over the blocks of the corpus, the unit that is read and scored."""
    blocks = chunk_blocks(spark, sf_dir).withColumnRenamed("block_text", "text")
    records = _records(blocks, F.col("chunk_no"), F.col("language"))
    scored = E.scores(E.with_record_defaults(records))
    shown = scored.select(F.col("id").cast("bigint").alias("chunk_no"), "language", "raw_cer", "ft_cer")
    return _rounded(shown, "raw_cer", "ft_cer")


def percent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.col("n_chars") / 40_000
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        percent(share).alias("two"),
        percent(share - 0.05, signed=True).alias("signed"),
        percent(share, 1).alias("one"),
    )


def _predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    truth = docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("text").alias("ground_truth")
    )
    labelled = labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"), edited(F.col("text"), RAW_EDITS).alias("text")
    )
    # Every document twice, once under an id that no document has.
    doubled = docs.select(
        F.explode(F.array("doc_id", F.col("doc_id") - 100)).alias("id"),
        edited(F.col("text"), FT_EDITS).alias("text"),
    )
    return truth, {"raw": labelled, "finetuned": doubled}


def prediction_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, _ = _predictions(spark, sf_dir)
    text = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    raw = text.join(labels, "id").withColumn("text", edited(F.col("text"), RAW_EDITS))
    ft = text.withColumn("text", edited(F.col("text"), FT_EDITS))
    joined = E.join_predictions(truth, {"raw": raw, "finetuned": ft})
    return E.export_columns(E.with_record_defaults(joined))


def prediction_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth, predictions = _predictions(spark, sf_dir)
    return E.prediction_problems(truth, predictions)


def system_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns read by two systems: one misses every fifth, the other reads every third twice and one in seven of no record."""
    turns = table(spark, sf_dir, "conversations").withColumn("n", F.col("conv_id") * 1000 + F.col("turn"))
    name = F.concat_ws("-", "conv_id", "turn")
    truth = turns.select(name.alias("id"), F.col("role").alias("language"), F.col("text").alias("ground_truth"))
    raw = turns.filter("n % 5 <> 0").select(name.alias("id"), edited(F.col("text"), RAW_EDITS).alias("text"))
    names = F.array(name, F.when(F.col("n") % 3 == 0, name), F.when(F.col("n") % 7 == 0, F.concat(F.lit("x"), name)))
    ft = turns.select(F.explode(F.array_compact(names)).alias("id"), edited(F.col("text"), FT_EDITS).alias("text"))
    scored, problems = compare_systems(truth, {"raw": raw, "ft": ft}, with_problems=True)
    listed = problems.groupBy("id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "system", "problem"))), ", ").alias("problems")
    )
    rates = _rounded(scored.select("id", "raw_cer", "ft_cer"), "raw_cer", "ft_cer")
    return rates.join(listed, "id", "full_outer")


def record_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    return E.with_record_defaults(
        joined.select(
            F.col("doc_id").alias("pos"),
            F.when(F.col("quality") == 1, F.concat(F.lit("q"), "doc_id")).alias("id"),
            F.when(F.col("toxic") == 0, F.col("lang")).alias("language"),
            F.when(F.col("quality") == 0, F.upper("source")).alias("ground_truth"),
            F.when(F.col("n_chars") % 3 > 0, F.col("text")).alias("text"),
            F.col("source").alias("raw"),
        )
    )


def _places_by_lang(docs: DataFrame) -> DataFrame:
    return positions(docs.select("lang", "doc_id"), ["lang", "doc_id"])


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    first = E.first_rows(_places_by_lang(docs), 600)
    return E.with_content(first, docs, ["doc_id"]).select("pos", "doc_id", "lang", "text")


def row_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    row = E.row_at(_places_by_lang(docs), 20)
    return E.with_content(row, docs, ["doc_id"]).select("pos", "doc_id", "lang", "text")


# --- text ---------------------------------------------------------------------


def decorated(c: Column) -> Column:
    """A text with every kind of markup set around and into it."""
    marks = [
        ("# ", c, "\n\n\n\n## Two   words\n"),
        ("***bold*** ___both___ __under__ *it* _snake case_ ~~gone~~\n", c, "\n"),
        ("    indented code\n\tand by tab\n", F.replace(c, F.lit(" de "), F.lit(" **de** ")), ""),
        ("```\n", F.replace(c, F.lit(" la "), F.lit(" [la](u/v) ")), "\n``` end\n~~~x\ny~~~"),
        ("![](pic) ![alt](u) [a][b] ", F.replace(c, F.lit("."), F.lit("_.  _")), "\n####### no"),
    ]
    return F.concat(*[part for head, body, tail in marks for part in (F.lit(head), body, F.lit(tail))])


def clean_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents")).select(
        "doc_id", T.clean_markdown(decorated(F.col("text"))).alias("cleaned")
    )


def repair_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit("\\n")), F.lit(". "), F.lit(".\\r"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.repair_escapes(escaped).alias("repaired")
    )


def _spaced(c: Column) -> Column:
    """Odd whitespace put between sentences and words."""
    c = F.replace(c, F.lit(". "), F.lit(".\u2009\t \r\n"))
    c = F.replace(c, F.lit(" la "), F.lit(" \t\u00a0la\u3000 "))
    return F.concat(F.lit(" \x1c "), c, F.lit(" \u2028\n"))


def collapse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        T.collapse(_spaced(F.col("text"))).alias("collapsed"),
        T.language_of_key(F.col("source")).alias("language"),
    )


def reflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", T.reflow(_spaced(F.col("text"))).alias("reflowed")
    )


def upper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_sharp_s = F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.upper_if(F.col("n_chars") % 2 == 0, without_sharp_s).alias("text")
    )


def line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = docs.select("doc_id", T.line_stats(F.col("text")).alias("s")).select("doc_id", "s.*")
    return _rounded(stats, "mean_line_len", "text_aspect")


def sample_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from ids with spaces, slashes and accents in them."""
    row_id = F.concat_ws(" é/", "source", F.col("doc_id").cast("string"), "text")
    block = (F.col("doc_id") % 1200 + 1).cast("int")
    ratio = (F.col("n_chars") % 250) / 100
    return table(spark, sf_dir, "documents").select(
        "doc_id", T.sample_key(F.col("lang"), row_id, block, ratio).alias("basename")
    )


# --- filters ------------------------------------------------------------------


def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs kept, of texts with noise and index lines set between theirs."""
    noisy = F.replace(F.col("text"), F.lit("\n"), F.lit("\n. . _ --\n\nPage 12 ................\n"))
    docs = dealt(table(spark, sf_dir, "documents")).filter(F.length("text") >= 200)
    return docs.select("doc_id", F.posexplode(paragraphs(noisy)).alias("place", "paragraph"))


def _worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.get(F.array(*map(F.lit, ID_WORDS)), (F.col("doc_id") % len(ID_WORDS)).cast("int"))
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("n_chars") % 11 == 0, F.lit(" \n ")).otherwise(F.col("text"))
    return docs.select(
        (F.col("doc_id") + 1).alias("row_ordinal"),
        F.concat_ws("-", word, F.col("doc_id").cast("string")).alias("id"),
        text.alias("text"),
    )


def exclude_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _worded(spark, sf_dir)
    return rows.filter(C.is_effective(F.col("id"), F.col("text"))).select("row_ordinal", "id")


def resume_and_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    effective = C.is_effective(F.col("id"), F.col("text"))
    rows = _worded(spark, sf_dir)
    cut = C.limit_cut(rows, "row_ordinal", 120, effective, after=50)
    rows = rows.filter((F.col("row_ordinal") > 50) & effective)
    rows = rows if cut is None else rows.filter(F.col("row_ordinal") <= cut)
    return rows.select("row_ordinal", "id")


def corpus_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id", "left").select(
        (F.col("doc_id") + 1).alias("row_ordinal"),
        F.when(F.col("quality") == 1, F.col("source")).alias("id"),
        F.when(F.col("toxic") == 0, F.col("lang")).alias("language"),
        F.when(F.col("quality") == 0, F.col("text")).alias("text"),
    )
    return C.with_defaults(rows).select("row_ordinal", "id", "language", "text")


def image_bytes_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as images: a page's bytes are its HTML."""
    sized = table(spark, sf_dir, "pages").select(
        "page_id", F.octet_length("html").cast("long").alias("length")
    )
    return P.large_enough(sized, 2048)


def image_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG headers written from table values, read back and judged."""
    side = lambda c: F.lpad(F.hex(c), 8, "0")
    width, height = F.col("n_chars") % 1400 + 20, F.col("doc_id") * 7 % 900 + 20
    header = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), side(width), side(height))
    broken = F.when(F.col("doc_id") % 13 == 0, F.lit("FFD8")).otherwise(header)
    images = table(spark, sf_dir, "documents").select("doc_id", F.unhex(broken).alias("content"))
    checked = P.checked_images(images)
    return _rounded(checked, "aspect")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left").withColumn(
        "text", F.when(F.col("n_chars") % 5 > 0, F.col("text"))
    )
    _, failed = P.split_usable(joined, ["quality", "text"], "reshape", "doc_id")
    return failed


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as errors; source and language, with text and length, as the effects of the command that failed."""
    effects = [("source", F.col("text")), ("lang", F.col("n_chars").cast("string"))]
    listed = F.array(*[F.struct(F.col(op).alias("op"), args.alias("args")) for op, args in effects])
    return error_rows(table(spark, sf_dir, "documents"), "doc_id", "render", F.col("text"), listed)


# --- blocks -------------------------------------------------------------------


def chunk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_chunks(corpus(spark, sf_dir), SEED)


def chunk_blocks_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinals taken from the order of (source, doc_id) instead of given."""
    rows = table(spark, sf_dir, "documents").select(
        "source", "doc_id", F.col("doc_id").cast("string").alias("id"), "text"
    )
    blocks = plan_chunks(rows, SEED, order_by=["source", "doc_id"])
    return blocks.select("row_ordinal", "id", "block_idx", "chunk_no", "block_text")


def chunk_blocks_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = plan_chunks(corpus(spark, sf_dir), SEED, resume_from=400, limit=300)
    return blocks.select("row_ordinal", "block_idx", "chunk_no", "block_text")


def sentence_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text as one paragraph."""
    joined = T.strip(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    docs = dealt(table(spark, sf_dir, "documents")).select("doc_id", joined.alias("p"))
    long = docs.filter(F.length("p") > 600)
    return long.select("doc_id", F.posexplode_outer(pack_sentences(F.col("p"))).alias("place", "block"))


def word_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with most sentence ends taken out, so that words must be packed."""
    joined = T.strip(F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit("e. "), F.lit("e ")))
    docs = dealt(table(spark, sf_dir, "documents")).select("doc_id", joined.alias("p"))
    long = docs.filter(F.length("p") > 600)
    return long.select("doc_id", F.posexplode_outer(pack_sentences(F.col("p"))).alias("place", "block"))


# --- draws and manifest -------------------------------------------------------


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents")).select(
        (F.col("doc_id") + 1).alias("chunk_no"), F.col("n_chars").cast("int").alias("chars")
    )


def font_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir).select("chunk_no", D.font(SEED, F.col("chunk_no")).alias("font"))


def normal_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    def draw(name: str) -> Column:
        value = D.normal(D.digest(F.lit(SEED), F.col("chunk_no"), name), NORMALS[name])
        return F.round(value, 6) if NORMALS[name].kind in ("float", "decimals") else value

    return _indexed(spark, sf_dir).select("chunk_no", *[draw(n).alias(n) for n in NORMALS])


def choice_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    def draw(name: str) -> Column:
        return D.choice(D.digest(F.lit(SEED), F.col("chunk_no"), name), CHOICES[name])

    return _indexed(spark, sf_dir).select("chunk_no", *[draw(n).alias(n) for n in CHOICES])


def uniform_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    hexes = D.digest(F.lit(SEED), F.col("chunk_no"), "extent_padding")
    return _indexed(spark, sf_dir).select(
        "chunk_no", F.round(D.uniform_between(hexes, 0.0, 50.0), 9).alias("value")
    )


def size_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes for texts of ``n_chars`` modulo 3000 characters, so that many need retries."""
    rows = _indexed(spark, sf_dir).withColumn("chars", F.col("chars") % 3000)
    size = D.size_plan(SEED, F.col("chunk_no"), F.col("chars"))
    planned = rows.select("chunk_no", "chars", size.alias("s")).select("chunk_no", "chars", "s.*")
    return _rounded(planned, "aspect_ratio")


def color_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = M.with_draws(_indexed(spark, sf_dir), SEED)
    return drawn.select("chunk_no", "use_color", "bg_color", "text_color")


def render_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as drawn; effects with all arguments, whose numbers are shown with six places."""
    rows = corpus(spark, sf_dir)
    rows = rows.withColumn("text", F.replace(F.col("text"), F.lit("ß"), F.lit("ss")))
    manifest = M.render_manifest(plan_chunks(rows, SEED), SEED)
    floats = [
        "aspect_ratio", "margin_factor", "char_spacing", "rotation", "blur", "skew_x", "skew_y",
        "perspective", "noise_amount", "mb_radius", "mb_sigma", "dirty_attenuate",
    ]
    shown = F.transform("effects", lambda e: F.concat(e["op"], F.lit("="), _six_places(e["args"])))
    return manifest.withColumns({c: F.round(c, 6) for c in floats}).withColumn("effects", F.array_join(shown, "; "))


def _six_places(args: Column) -> Column:
    """Arguments between spaces and ``x`` with their numbers in one format."""
    def number(n: Column) -> Column:
        def shown(value: Column) -> Column:
            # What rounds to zero keeps its sign.
            sign = F.when((value == 0) & F.startswith(n, F.lit("-")), "-").otherwise("")
            return F.coalesce(F.concat(sign, value.cast("string")), n)

        return T.let(n.try_cast("decimal(38,6)"), shown)

    def part(words: Column) -> Column:
        return F.array_join(F.transform(F.split(words, "x"), number), "x")

    return F.array_join(F.transform(F.split(args, " "), part), " ")


# --- pairs, splits, reshapes --------------------------------------------------


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labelled documents and some more names as images; documents of odd length as texts."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    images = labels.select(
        (F.col("doc_id") * 2).alias("basename"),
        (F.col("doc_id") * 97 % 40_000).alias("length"),
    )
    return images, docs.select(F.col("doc_id").alias("basename"), "text")


def pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, texts = _sides(spark, sf_dir)
    paired = P.pair(images, texts, PrepConfig().min_image_bytes)
    return paired.select("basename", "length", P.transcript(F.col("text")).alias("text"))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.orphans(*_sides(spark, sf_dir))


def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.orphan_counts(*_sides(spark, sf_dir))


def _placed(spark: SparkSession, sf_dir: str, shard_size: int = 100) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").alias("length"), F.concat("lang", F.lit("/"), "source").alias("path")
    )
    return S.split_and_shard(docs, "doc_id", shard_size)


def shuffle_split_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir).select("doc_id", "pos", "split", "split_pos", "shard_idx")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_sizes(_placed(spark, sf_dir))


def resume_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    resumed = S.resume_shards(_placed(spark, sf_dir, 30), train_shard=12)
    return resumed.select("doc_id", "split", "split_pos", "shard_idx")


def id_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.id_manifest(_placed(spark, sf_dir), "doc_id")


def asset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = S.asset_manifest(_placed(spark, sf_dir), "doc_id")
    names = F.transform("files", lambda f: F.concat_ws("=", f["arcname"], f["path"]))
    return listed.withColumn("files", F.array_join(names, " "))


def flat_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = F.concat_ws("_", F.concat("lang", F.lit("x")), "source", F.col("doc_id").cast("string"))
    image = R.image_struct(F.encode("source", "UTF-8"), F.concat(name, F.lit(".png")))
    flat = R.flat_sample(docs.select(name.alias("basename"), "text", image.alias("image")))
    return flat.select("id", "language", "text", F.col("image.path").alias("image_path"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat layout, one row for every part of every turn."""
    docs = table(spark, sf_dir, "documents")
    image = R.image_struct(F.encode("source", "UTF-8"), F.concat("source", F.lit(".png")))
    chats = R.chat_sample(docs.select("doc_id", "text", image.alias("image")), "doc_id")
    turns = chats.select(
        "doc_id",
        F.size("images").alias("n_images"),
        F.posexplode("messages").alias("turn", "message"),
    )
    parts = turns.select(
        "doc_id",
        "n_images",
        "turn",
        F.col("message.role").alias("role"),
        F.posexplode("message.content").alias("part", "content"),
    )
    return parts.select(
        "doc_id", "n_images", "turn", "role", "part",
        F.col("content.type").alias("type"),
        F.col("content.text").alias("text"),
        F.col("content.image.path").alias("image_path"),
    )


def instruction_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Quotes and backslashes aside, JSON text is the same from every writer.
    plain = F.translate("text", '"\\', "''")
    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("basename"), plain.alias("text"))
    samples = R.instruction_sample(rows, "doc_id")
    return samples.select("doc_id", F.to_json(F.struct("image_info", "text_info")).alias("line"))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, effective rows and blocks of the corpus; the page bytes stand for the output."""
    rows = corpus(spark, sf_dir)
    effective = rows.filter(C.is_effective(F.col("id"), F.col("text")))
    pages = table(spark, sf_dir, "pages")
    megabytes = pages.agg((F.sum(F.octet_length("html")) / 1048576).alias("megabytes"))
    counted = run_counters(rows, effective, plan_chunks(rows, SEED), megabytes)
    return _rounded(counted, "output_mb")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        eval_cer, eval_wer, eval_summary, eval_report, eval_blocks, eval_documents, percent_text,
        prediction_join, prediction_problems, system_comparison, record_defaults, first_rows, row_at,
        clean_markdown, repair_escapes, collapse_text, reflow, upper_text, line_stats, sample_keys,
        noise_filter, exclude_ids, resume_and_limit, corpus_defaults, image_bytes_filter,
        image_geometry, quarantine, error_log,
        chunk_blocks, chunk_blocks_by_source, chunk_blocks_resumed, sentence_pack, word_pack,
        font_draw, normal_draw, choice_draw, uniform_draw, size_plan, color_draw, render_manifest,
        pair_join, orphans, orphan_counts, shuffle_split_shard, split_sizes, resume_shards,
        id_manifest, asset_manifest, flat_samples, chat_messages, instruction_json, run_counts,
    )
}
