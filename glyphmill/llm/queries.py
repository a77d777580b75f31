"""The registered queries of the pipeline operators, and SQL for those that SQL can express.

Each query applies one operator to its whole table with production parameters and derives the
columns of its contract from what the operator returns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import conversations, fingerprints, html_text, langid, mixing, neighbours, quality, token_alignment
from glyphmill.llm import toxicity, urls
from glyphmill.llm.decontaminate import decontaminate
from glyphmill.llm.line_dedup import line_dedup
from glyphmill.llm.ngram_join import similarity_classes
from glyphmill.llm.shared import fold_of, table

#: A rule and its verdict; the longest that fits a URL wins.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
TOXIC_AT = 0.7
#: Folder of the public tokenizer files.
TOKENIZERS = "/opt/tokenizers"


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    return mixing.mix(table(spark, sf_dir, "documents"), dims).withColumnRenamed("id", "doc_id")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), model).alias("p"))
    return predicted.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages"))
    return texts.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = similarity_classes(table(spark, sf_dir, "documents"), words=4, percent=85)
    return classes.withColumnRenamed("id", "doc_id")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site of a document is its source, the path below it its language."""
    held_out = fold_of(F.col("id"), 5) == 0
    scored = quality.quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"),
        learn=~held_out,
    )
    return scored.withColumn("held_out", held_out).withColumnRenamed("id", "doc_id")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def line_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup(table(spark, sf_dir, "documents"))
    return deduped.select(
        "doc_id", "deduped.n_lines", "deduped.n_dropped", F.sha2("deduped.text", 256).alias("kept_sha256")
    )


def _marked(ids: np.ndarray, sizes: np.ndarray, end: str) -> np.ndarray:
    """Ids as decimals, a comma behind each but ``end`` behind the last one of a group."""
    known, place = np.unique(ids, return_inverse=True)
    last = np.zeros(len(ids), int)
    last[np.cumsum(sizes) - 1] = 1
    return np.array([[f"{i},", f"{i}{end}"] for i in known], dtype=object)[place, last]


def _group_digests(aligned: pa.RecordBatch) -> pa.Array:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3``, the groups of a row in order; empty without tokens."""
    a, b, a_sizes, b_sizes = (aligned.column(n).flatten().to_numpy() for n in ("a", "b", "a_sizes", "b_sizes"))
    digests = np.full(len(aligned), "", dtype=object)
    if len(a):
        # Tokens of A stand behind the tokens of B of earlier groups, those of B behind A's up to their own.
        texts = np.empty(len(a) + len(b), dtype=object)
        texts[np.arange(len(a)) + np.repeat(np.cumsum(b_sizes) - b_sizes, a_sizes)] = _marked(a, a_sizes, "|")
        texts[np.arange(len(b)) + np.repeat(np.cumsum(a_sizes), b_sizes)] = _marked(b, b_sizes, ";")
        lengths = sum(aligned.column(n).value_lengths().to_numpy() for n in ("a", "b"))
        ends = np.cumsum(lengths)
        for n in np.flatnonzero(lengths):
            joined = "".join(texts[ends[n] - lengths[n] : ends[n]].tolist())
            digests[n] = hashlib.sha256(joined[:-1].encode()).hexdigest()
    return pa.array(digests, pa.string())


def tokenizer_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    a_path, b_path = f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model"
    digest = {"groups_sha256": ("string", _group_digests)}
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), "doc_id", "text", a_path, b_path, digest)
    sizes = [F.size(c).cast("long").alias(n) for c, n in (("a", "n_a"), ("b", "n_b"), ("a_sizes", "n_groups"))]
    per_row = aligned.select("row", F.col("id").alias("doc_id"), *sizes, "groups_sha256")
    scored = per_row.join(token_alignment.link_scores(aligned), "row", "left")
    figures = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return scored.select("doc_id", "n_a", "n_b", "n_groups", *figures, "groups_sha256")


def damaged_conversations(turns: DataFrame) -> DataFrame:
    """Nulls as one space; by the digest of id and turn a row is lost, emptied, stripped of ends, repeated or the user's."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fate, text = F.crc32(key.cast("binary")) % 20, F.coalesce("text", space)
    text = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fate == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(fate == 3, 2).otherwise(1))).alias("copy")
    return turns.filter(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


def _transcripts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits in order to a row for each conversation. SHA-256 reads a whole text in order, so one task does it, edit by edit."""
    own, letters, digest, turns = None, [], hashlib.sha256(), 0

    def row() -> pa.RecordBatch:
        columns = [pa.array([own[0]], own[1]), pa.array(["".join(letters)]), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=["of", "audit", "repaired_sha256"])

    for batch in batches:
        ids, edits, roles, texts = (batch.column(n) for n in ("id", "edit", "role", "text"))
        for n, (id, edit, role) in enumerate(zip(ids.to_pylist(), edits.to_pylist(), roles.to_pylist(), strict=True)):
            if own is None or own[0] != id:
                if own is not None:
                    yield row()
                own, letters, digest, turns = (id, ids.type), [], hashlib.sha256(), 0
            letters.append(edit)
            if role is not None:
                digest.update(("\n" * (turns > 0) + role + ":").encode())
                digest.update(texts[n].as_buffer())
                turns += 1
    if own is not None:
        yield row()


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    edits, summary = conversations.repair(damaged_conversations(turns), "conv_id", "turn", "role", "text")
    kind = edits.schema["id"].dataType.simpleString()
    in_order = edits.repartition("id").sortWithinPartitions("id", "pos", "nth").select("id", "edit", "role", "text")
    transcripts = in_order.mapInArrow(_transcripts, f"of {kind}, audit string, repaired_sha256 string")
    ids = turns.select("conv_id").distinct()
    known = ids.join(summary, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    known = known.join(transcripts, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return known.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in figures],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = neighbours.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {
    "op1_source_mixing": source_mixing,
    "op2_decontamination": decontamination,
    "op3_language_id": language_id,
    "op4_fingerprints": document_fingerprints,
    "op5_toxicity": toxicity_scores,
    "op6_html_extraction": html_extraction,
    "op7_ngram_join": ngram_join,
    "op8_quality": quality_scores,
    "op9_url_filter": url_filter,
    "op10_line_dedup": line_deduplication,
    "op11_tokenizer_alignment": tokenizer_alignment,
    "op12_conversation_repair": conversation_repair,
    "op13_nearest_neighbours": nearest_neighbours,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION_SQL = f"""
WITH docs AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ')
                 FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS key
  FROM items WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT n FROM item_windows),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, lengths),
doc_windows AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS key FROM starts),
hits AS (SELECT DISTINCT doc_id, n, s, item_id FROM doc_windows JOIN item_windows USING (n, key)),
words AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS place FROM hits),
per_doc AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
per_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_items USING (doc_id)
"""

_NGRAM_JOIN_SQL = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM docs
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
FROM sets LEFT JOIN least USING (doc_id)
"""

_LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, i, l AS line,
    translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
  )
),
common AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT doc_id, i, line, coalesce(doc_id < last, false) AS gone FROM lines LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: CRC-32 of ASCII text: each byte goes in with the first of its eight bits.
_CRC32 = """xor(list_reduce(
  list_concat([4294967295::UBIGINT], flatten([[ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(key, '')])),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384::UBIGINT * (xor(c, x) & 1))), 4294967295)"""
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: States: 0 nothing, 1 system, 2 user, 3 assistant. A way is its cost, its audit and the repaired turns.
_CONVERSATION_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
),
fated AS (SELECT *, {_CRC32} % 20 AS fate FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS i,
         rtrim(text, {_SPACE}) AS visible FROM damaged
),
faults AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
         CASE WHEN visible = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(visible, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM turns
),
inserts(a, b, cost, audit, told) AS (
  VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']),
         (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])
),
edits(a, b, letter, cost, needs) AS (
  VALUES (0, 0, 'D', 3, ''), (1, 1, 'D', 3, ''), (2, 2, 'D', 3, ''), (3, 3, 'D', 3, ''),
         (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'),
         (0, 2, 'R', 2, ''), (1, 2, 'R', 2, ''), (3, 2, 'R', 2, ''), (2, 3, 'R', 2, '')
),
ends AS (SELECT conv_id, max(i) AS n FROM faults GROUP BY conv_id),
ways(conv_id, i, state, cost, audit, told) AS (
  SELECT conv_id, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM ends
  UNION ALL
  SELECT conv_id, i, b, cost, audit, told FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, b ORDER BY cost, audit) AS best FROM (
      SELECT w.conv_id, f.i, e.b,
             w.cost + s.cost + e.cost + CASE WHEN f.fault = 'truncated' AND e.letter <> 'D' THEN 1 ELSE 0 END AS cost,
             w.audit || s.audit || e.letter AS audit,
             list_concat(list_concat(w.told, s.told), CASE e.letter WHEN 'D' THEN []
               ELSE [CASE WHEN e.letter = 'K' THEN f.role WHEN e.b = 2 THEN 'user' ELSE 'assistant' END || ':' || f.text] END)
               AS told
      FROM ways w JOIN inserts s ON s.a = w.state JOIN edits e ON e.a = s.b
      JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      WHERE (e.needs = '' OR e.needs = f.initial) AND (e.letter = 'D' OR f.fault IS NULL OR f.fault = 'truncated')))
  WHERE best = 1
),
closed AS (
  SELECT w.conv_id, w.cost + s.cost AS cost, w.audit || s.audit AS audit, list_concat(w.told, s.told) AS told,
         row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + s.cost, w.audit || s.audit) AS best
  FROM ways w JOIN ends e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.i
  JOIN inserts s ON s.a = w.state AND s.b IN (0, 3)
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(told, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN closed w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.best = 1
"""

ORACLES = {
    "op2_decontamination": _DECONTAMINATION_SQL,
    "op7_ngram_join": _NGRAM_JOIN_SQL,
    "op10_line_dedup": _LINE_DEDUP_SQL,
    "op12_conversation_repair": _CONVERSATION_SQL,
}
