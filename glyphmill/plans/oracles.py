"""The same queries in DuckDB SQL, to check results against an independent engine."""

from __future__ import annotations

import math

from glyphmill.config import (
    ASPECT_RANGES,
    CHOICES,
    FAMILY_MIX,
    NORMALS,
    VARIANT_MIX,
    Normal,
)
from glyphmill.functions.draws import font_families
from glyphmill.functions.text import WS_CHARS
from glyphmill.operators.corpus import EXCLUDED_ID_PARTS
from glyphmill.plans.queries import FT_EDITS, ID_WORDS, RAW_EDITS

# --- small pieces of SQL ------------------------------------------------------

WS_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def lit(text: str) -> str:
    """A string literal; characters outside printable ASCII are spelled as chr()."""
    parts, plain = [], ""
    for ch in text:
        if ch == "'":
            plain += "''"
        elif " " <= ch <= "~" or (ch.isalpha() and ch.isprintable()):
            plain += ch
        else:
            if plain:
                parts.append(f"'{plain}'")
                plain = ""
            parts.append(f"chr({ord(ch)})")
    if plain or not parts:
        parts.append(f"'{plain}'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


WS = lit(WS_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def replace(x: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    return x


def is_noise(p: str) -> str:
    return f"({p} <> '' AND trim({p}, {WS} || '._-') = '')"


def is_index_like(p: str) -> str:
    dots = f"(length({p}) - length(replace(replace({p}, '.', ''), '_', '')))"
    return f"(length({p}) > 10 AND 2 * {dots} > length({p}))"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS_CLASS}]+', ' ', 'g'), ' ')"


CLEAN_RULES = [
    (rf"(?m)^#{{1,6}}[{WS_CLASS}]+", ""),
    (r"\*\*\*(.+?)\*\*\*", r"\1"),
    (r"___(.+?)___", r"\1"),
    (r"\*\*(.+?)\*\*", r"\1"),
    (r"__(.+?)__", r"\1"),
    (r"\*(.+?)\*", r"\1"),
    (rf"_([^_{WS_CLASS}].*?[^_{WS_CLASS}])_", r"\1"),
    (r"~~(.+?)~~", r"\1"),
    (r"\[([^\]]+)\]\([^\)]+\)", r"\1"),
    (r"!\[([^\]]*)\]\([^\)]+\)", r"\1"),
    (r"\[([^\]]+)\]\[[^\]]*\]", r"\1"),
    (r"(?s)```.*?```", ""),
    (r"(?s)~~~.*?~~~", ""),
    (r"(?m)^(?:    |\t).+$", ""),
    (r"\n{3,}", "\n\n"),
    (r" {2,}", " "),
]


def clean(x: str) -> str:
    for pattern, replacement in CLEAN_RULES:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"
    return strip(x)


def repaired(x: str) -> str:
    return replace(x, ("\\n", "\n"), ("\\r", "\r"))


def excluded(row_id: str) -> str:
    return "(" + " OR ".join(f"contains({row_id}, '{p}')" for p in EXCLUDED_ID_PARTS) + ")"


def percent(x: str, digits: int = 2, signed: bool = False) -> str:
    sign = "+" if signed else ""
    return f"printf('%{sign}.{digits}f%%', ({x}) * 100)"


# --- error rates --------------------------------------------------------------

TURNS = f"""
turns AS (
  SELECT conv_id || '-' || turn AS id, role AS language, conv_id, turn, text AS truth,
         {replace('text', *RAW_EDITS)} AS raw, {replace('text', *FT_EDITS)} AS ft
  FROM conversations)"""

# DuckDB compares bytes: every non-ASCII letter becomes a control character no text holds.
LETTERS = "éóèñçêüäößíÉÈÑÓÇÄÊÜÖÍ"
CONTROLS = [c for c in range(1, 32) if c not in range(9, 14)][: len(LETTERS)]


def one_byte(x: str) -> str:
    return f"translate({x}, '{LETTERS}', {' || '.join(f'chr({c})' for c in CONTROLS)})"


def cer(ref: str, hyp: str) -> str:
    distance = f"levenshtein({one_byte(ref)}, {one_byte(hyp)})"
    return (
        f"CASE WHEN length({ref}) = 0 THEN CASE WHEN length({hyp}) > 0 THEN 1.0 ELSE 0.0 END "
        f"ELSE {distance}::DOUBLE / length({ref}) END"
    )


def words(x: str) -> str:
    return f"[w FOR w IN string_split_regex({x}, '[{WS_CLASS}]+') IF w <> '']"


# Word distance: one table row of the classic dynamic program per step, all texts at once.
WORD_DISTANCE = f"""
lists AS MATERIALIZED (
  SELECT row_number() OVER () AS q, * FROM (
    SELECT id, 'raw' AS sys, {words('truth')} AS r, {words('raw')} AS h FROM turns
    UNION ALL SELECT id, 'ft', {words('truth')}, {words('ft')} FROM turns)),
refs AS MATERIALIZED (SELECT q, unnest(r) AS w, generate_subscripts(r, 1) AS j FROM lists),
hyps AS MATERIALIZED (SELECT q, unnest(h) AS w, generate_subscripts(h, 1) AS i FROM lists),
dp(q, i, j, d) AS (
  SELECT q, 0::BIGINT, unnest(range(len(r) + 1)), unnest(range(len(r) + 1)) FROM lists
  UNION ALL
  SELECT q, i, j, min(t - j) OVER (PARTITION BY q ORDER BY j) + j FROM (
    SELECT dp.q, dp.i + 1 AS i, dp.j,
           CASE WHEN dp.j = 0 THEN dp.i + 1 ELSE least(dp.d + 1,
             lag(dp.d) OVER (PARTITION BY dp.q ORDER BY dp.j)
               + CASE WHEN r.w = h.w THEN 0 ELSE 1 END) END AS t
    FROM dp JOIN hyps h ON h.q = dp.q AND h.i = dp.i + 1
    LEFT JOIN refs r ON r.q = dp.q AND r.j = dp.j) s),
wer AS (
  SELECT l.id, l.sys,
         CASE WHEN len(r) = 0 THEN CASE WHEN len(h) > 0 THEN 1.0 ELSE 0.0 END
              ELSE d::DOUBLE / len(r) END AS v
  FROM lists l JOIN dp ON dp.q = l.q AND dp.i = len(h) AND dp.j = len(r)),
scored AS (
  SELECT t.*, {cer('truth', 'raw')} AS raw_cer, {cer('truth', 'ft')} AS ft_cer,
         wr.v AS raw_wer, wf.v AS ft_wer
  FROM turns t JOIN wer wr ON wr.id = t.id AND wr.sys = 'raw'
  JOIN wer wf ON wf.id = t.id AND wf.sys = 'ft')"""

SCORED = f"WITH RECURSIVE {TURNS}, {WORD_DISTANCE}"
MEANS = "avg(raw_cer) AS raw_cer, avg(raw_wer) AS raw_wer, avg(ft_cer) AS ft_cer, avg(ft_wer) AS ft_wer"

EVAL_CER = f"""WITH {TURNS}, s AS (
  SELECT id, language, {cer('truth', 'raw')} AS raw_cer, {cer('truth', 'ft')} AS ft_cer FROM turns)
SELECT id, language, round(raw_cer, 9) AS raw_cer, round(ft_cer, 9) AS ft_cer,
       round(raw_cer - ft_cer, 9) AS improvement FROM s"""

EVAL_WER = f"{SCORED} SELECT id, round(raw_wer, 9) AS raw_wer, round(ft_wer, 9) AS ft_wer FROM scored"

EVAL_SUMMARY = f"""{SCORED}, m AS (SELECT count(*) AS n, {MEANS} FROM scored)
SELECT n, {', '.join(f'round({s}_{k}, 9) AS {s}_{k}' for s in ('raw', 'ft') for k in ('cer', 'wer'))},
  round(1 - raw_cer, 9) AS raw_accuracy, round(1 - ft_cer, 9) AS ft_accuracy,
  round(raw_cer - ft_cer, 9) AS cer_improvement, round(raw_wer - ft_wer, 9) AS wer_improvement,
  round(CASE WHEN raw_cer > 0 THEN (raw_cer - ft_cer) / raw_cer ELSE 0 END, 9)
    AS relative_cer_reduction
FROM m WHERE n > 0"""

_SHOWN = ", ".join(
    f"{percent(r)} AS {r}" for r in ("raw_cer", "ft_cer", "raw_wer", "ft_wer")
) + f", {percent('raw_cer - ft_cer', signed=True)} AS improvement"

EVAL_REPORT = f"""{SCORED}, placed AS (
  SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, count(*) OVER () AS n FROM scored)
SELECT pos AS row_no, id, language, {_SHOWN} FROM placed
WHERE n <= 50 OR pos % (n // 20) = 0 OR pos = n - 1
UNION ALL
SELECT n, 'AVERAGE', '', {_SHOWN} FROM (SELECT count(*) AS n, {MEANS} FROM scored)"""

EVAL_BLOCKS = f"""WITH RECURSIVE @BLOCKS@,
systems AS (SELECT chunk_no, language, block_text AS truth,
  {replace('block_text', *RAW_EDITS)} AS raw, {replace('block_text', *FT_EDITS)} AS ft FROM numbered),
s AS (SELECT *, {cer('truth', 'raw')} AS raw_cer, {cer('truth', 'ft')} AS ft_cer FROM systems)
SELECT chunk_no, language, round(raw_cer, 9) AS raw_cer, round(ft_cer, 9) AS ft_cer FROM s"""

PERCENT_TEXT = f"""SELECT doc_id, {percent('n_chars / 40000')} AS two,
  {percent('n_chars / 40000 - 0.05', signed=True)} AS signed, {percent('n_chars / 40000', 1)} AS one
FROM documents"""

PREDICTION_JOIN = f"""
SELECT d.doc_id::VARCHAR AS id, d.lang AS language, d.text AS ground_truth,
       CASE WHEN l.doc_id IS NULL THEN '' ELSE {replace('d.text', *RAW_EDITS)} END AS raw,
       {replace('d.text', *FT_EDITS)} AS finetuned
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

PREDICTION_PROBLEMS = """
WITH doubled AS (SELECT unnest([doc_id, doc_id - 100]) AS id FROM documents)
SELECT 'raw' AS system, doc_id AS id, 'missing' AS problem FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'finetuned', doc_id, 'missing' FROM documents
WHERE doc_id NOT IN (SELECT id FROM doubled)
UNION ALL SELECT 'raw', doc_id, 'unknown' FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'finetuned', id, 'unknown' FROM doubled
WHERE id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'raw', doc_id, 'duplicate' FROM labels GROUP BY doc_id HAVING count(*) > 1
UNION ALL SELECT 'finetuned', id, 'duplicate' FROM doubled GROUP BY id HAVING count(*) > 1"""

SYSTEM_COMPARISON = f"""WITH {TURNS}, t AS (SELECT *, conv_id * 1000 + turn AS n FROM turns),
shown AS (
  SELECT id, {cer('truth', "CASE WHEN n % 5 <> 0 THEN raw ELSE '' END")} AS raw_cer, {cer('truth', 'ft')} AS ft_cer FROM t),
found AS (
  SELECT id, 'raw missing' AS p FROM t WHERE n % 5 = 0
  UNION ALL SELECT id, 'ft duplicate' FROM t WHERE n % 3 = 0
  UNION ALL SELECT 'x' || id, 'ft unknown' FROM t WHERE n % 7 = 0),
listed AS (SELECT id, string_agg(p, ', ' ORDER BY p) AS problems FROM found GROUP BY id)
SELECT id, round(raw_cer, 9) AS raw_cer, round(ft_cer, 9) AS ft_cer, problems
FROM shown FULL JOIN listed USING (id)"""

RECORD_DEFAULTS = """
SELECT d.doc_id AS pos,
       CASE WHEN l.quality = 1 THEN 'q' || d.doc_id ELSE d.doc_id::VARCHAR END AS id,
       CASE WHEN l.toxic = 0 THEN lang ELSE 'unk' END AS language,
       CASE WHEN l.quality = 0 THEN upper(source) WHEN n_chars % 3 > 0 THEN text ELSE '' END
         AS ground_truth,
       source AS raw, '' AS finetuned
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

_BY_LANG = "SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS pos, doc_id, lang, text FROM documents"
FIRST_ROWS = f"SELECT * FROM ({_BY_LANG}) WHERE pos < 600"
ROW_AT = f"SELECT * FROM ({_BY_LANG}) WHERE pos = 20"

# --- text ---------------------------------------------------------------------


def _decorated(x: str) -> str:
    head = [
        lit("# "), x, lit("\n\n\n\n## Two   words\n"),
        lit("***bold*** ___both___ __under__ *it* _snake case_ ~~gone~~\n"), x, lit("\n"),
        lit("    indented code\n\tand by tab\n"), replace(x, (" de ", " **de** ")),
        lit("```\n"), replace(x, (" la ", " [la](u/v) ")), lit("\n``` end\n~~~x\ny~~~"),
        lit("![](pic) ![alt](u) [a][b] "), replace(x, (".", "_.  _")), lit("\n####### no"),
    ]
    return "(" + " || ".join(head) + ")"


def _spaced(x: str) -> str:
    body = replace(x, (". ", ". \t \r\n"), (" la ", " \t la　 "))
    return f"({lit(' ' + chr(28) + ' ')} || {body} || {lit(' ' + chr(0x2028) + chr(10))})"


CLEAN_MARKDOWN = f"SELECT doc_id, {clean(_decorated('text'))} AS cleaned FROM documents"
REPAIR_ESCAPES = f"""SELECT doc_id,
  {repaired(replace('text', (chr(10), chr(92) + 'n'), ('. ', '.' + chr(92) + 'r')))} AS repaired
FROM documents"""
COLLAPSE_TEXT = f"""SELECT doc_id, {collapse(_spaced('text'))} AS collapsed,
  substr(source, 1, 3) AS language FROM documents"""
REFLOW = f"""SELECT conv_id, turn,
  {strip(f"regexp_replace({_spaced('text')}, '[ {chr(92)}t]+', ' ', 'g')")} AS reflowed
FROM conversations"""
UPPER_TEXT = """SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN upper(replace(text, 'ß', 'ss'))
  ELSE replace(text, 'ß', 'ss') END AS text FROM documents"""
LINE_STATS = f"""
WITH lines AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|[\\n\\r]')) AS line FROM documents),
s AS (SELECT doc_id, count(*) AS n, sum(length(line)) AS total FROM lines
      WHERE {strip('line')} <> '' GROUP BY doc_id)
SELECT d.doc_id, n::INTEGER AS line_count, round(total::DOUBLE / n, 9) AS mean_line_len,
       round(total::DOUBLE / n / n, 9) AS text_aspect
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id"""
SAMPLE_KEYS = """SELECT doc_id, regexp_replace(
  lang || '_' || source || ' é/' || doc_id || ' é/' || text || '_'
    || printf('%03d', doc_id % 1200 + 1) || '_' || trunc((n_chars % 250) / 100 * 100)::INTEGER || 'ar',
  '[^\\p{L}\\p{N}_.\\-]', '_', 'g') AS basename FROM documents"""

# --- filters ------------------------------------------------------------------

NOISE_FILTER = f"""
WITH p0 AS (
  SELECT doc_id, string_split_regex(replace(text, chr(10),
    {lit(chr(10) + '. . _ --' + chr(10) * 2 + 'Page 12 ................' + chr(10))}), '[\\r\\n]+') AS l
  FROM documents WHERE length(text) >= 200),
p AS (SELECT doc_id, unnest(l) AS p0, generate_subscripts(l, 1) AS k FROM p0),
s AS (SELECT doc_id, k, {strip('p0')} AS paragraph FROM p)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS place, paragraph
FROM s WHERE paragraph <> '' AND NOT {is_noise('paragraph')} AND NOT {is_index_like('paragraph')}"""

_WORDED = f"""
SELECT doc_id + 1 AS row_ordinal,
       {list(ID_WORDS)}[doc_id % {len(ID_WORDS)} + 1] || '-' || doc_id AS id,
       CASE WHEN n_chars % 11 = 0 THEN ' ' || chr(10) || ' ' ELSE text END AS text
FROM documents"""
_EFFECTIVE = f"SELECT row_ordinal, id FROM w WHERE NOT {excluded('id')} AND {strip('text')} <> ''"
EXCLUDE_IDS = f"WITH w AS ({_WORDED}) {_EFFECTIVE}"
RESUME_AND_LIMIT = f"""WITH w AS ({_WORDED}), e AS ({_EFFECTIVE} AND row_ordinal > 50)
SELECT row_ordinal, id FROM (SELECT *, row_number() OVER (ORDER BY row_ordinal) AS rn FROM e)
WHERE rn <= 120"""

CORPUS_DEFAULTS = """
SELECT d.doc_id + 1 AS row_ordinal,
       CASE WHEN l.quality = 1 THEN source ELSE 'row_' || (d.doc_id + 1) END AS id,
       CASE WHEN l.toxic = 0 THEN lang ELSE 'unk' END AS language,
       CASE WHEN l.quality = 0 THEN text ELSE '' END AS text
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

IMAGE_BYTES_FILTER = """SELECT page_id, octet_length(encode(html)) AS length FROM pages
WHERE octet_length(encode(html)) >= 2048"""

IMAGE_GEOMETRY = """
WITH s AS (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN n_chars % 1400 + 20 END AS w,
                  CASE WHEN doc_id % 13 <> 0 THEN doc_id * 7 % 900 + 20 END AS h FROM documents)
SELECT doc_id, w::INTEGER AS width, h::INTEGER AS height, round(w::DOUBLE / h, 9) AS aspect,
       CASE WHEN w IS NULL THEN 'unreadable' WHEN w < 200 OR h < 200 THEN 'too small'
            WHEN w / h < 0.25 OR w / h > 5 THEN 'too extreme' END AS reject_reason
FROM s"""

QUARANTINE = """
WITH j AS (SELECT d.doc_id, l.quality IS NULL AS q, n_chars % 5 = 0 AS t
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id AS key, 'reshape' AS stage,
       'missing ' || CASE WHEN q AND t THEN 'quality, text' WHEN q THEN 'quality' ELSE 'text' END
         AS error
FROM j WHERE q OR t"""

ERROR_LOG = """WITH d AS (SELECT *, replace(replace(text, chr(13), ' '), chr(10), ' ') AS line FROM documents)
SELECT doc_id::VARCHAR AS key, 'render' AS stage, substr(line, 1, 500) AS error,
  substr(source || ' ' || line || ' ' || lang || ' ' || n_chars, 1, 500) AS command FROM d"""

# --- blocks -------------------------------------------------------------------

_NEXT = "(({s}) * 1103515245 + 12345) & 2147483647"


def sentence_blocks(source: str) -> str:
    """CTEs from ``source(ord, k, p)``, paragraphs over the limit, to ``sblocks(ord, k, place, sub, b)``."""
    return f"""
sent0 AS (SELECT ord, k, string_split(regexp_replace(p, '([.!?])[{WS_CLASS}]+', '\\1' || chr(1), 'g'),
                                      chr(1)) AS l FROM {source}),
sent1 AS (SELECT ord, k, unnest(l) AS x, generate_subscripts(l, 1) AS s0 FROM sent0),
sent2 AS (SELECT ord, k, s0, {strip('x')} AS x FROM sent1),
sent AS MATERIALIZED (SELECT ord, k, x, length(x) AS n,
                row_number() OVER (PARTITION BY ord, k ORDER BY s0) AS s
         FROM sent2 WHERE x <> '' AND NOT {is_noise('x')}),
sfold(ord, k, s, len, mark) AS (
  SELECT DISTINCT ord, k, 0::BIGINT, 0::BIGINT, '' FROM sent
  UNION ALL
  SELECT f.ord, f.k, f.s + 1,
         CASE WHEN t.n > 600 THEN f.len WHEN f.len + t.n + 1 > 600 THEN t.n ELSE f.len + t.n + 1 END,
         CASE WHEN t.n > 600 THEN 'l' WHEN f.len + t.n + 1 > 600 THEN 'o' ELSE 'k' END
  FROM sfold f JOIN sent t ON t.ord = f.ord AND t.k = f.k AND t.s = f.s + 1),
waiting AS (SELECT t.*, sum(CASE WHEN f.mark = 'o' THEN 1 ELSE 0 END)
                          OVER (PARTITION BY t.ord, t.k ORDER BY t.s) AS run
            FROM sent t JOIN sfold f ON f.ord = t.ord AND f.k = t.k AND f.s = t.s
            WHERE f.mark <> 'l'),
buffers AS (SELECT ord, k, run, min(s) AS first, string_agg(x, chr(10) ORDER BY s) AS b
            FROM waiting GROUP BY ord, k, run),
unbroken AS MATERIALIZED (SELECT ord, k, s, {words('x')} AS ws FROM sent WHERE n > 600),
wfold(ord, k, s, w, len, mark) AS (
  SELECT ord, k, s, 0::BIGINT, -1::BIGINT, '' FROM unbroken
  UNION ALL
  SELECT f.ord, f.k, f.s, f.w + 1,
         CASE WHEN f.len + 1 + length(u.ws[f.w + 1]) > 600 THEN length(u.ws[f.w + 1])
              ELSE f.len + 1 + length(u.ws[f.w + 1]) END,
         CASE WHEN f.len + 1 + length(u.ws[f.w + 1]) > 600 THEN 'o' ELSE 'k' END
  FROM wfold f JOIN unbroken u ON u.ord = f.ord AND u.k = f.k AND u.s = f.s AND f.w < len(u.ws)),
wrun AS (SELECT f.*, u.ws[f.w] AS x, sum(CASE WHEN mark = 'o' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY f.ord, f.k, f.s ORDER BY f.w) AS run
         FROM wfold f JOIN unbroken u ON u.ord = f.ord AND u.k = f.k AND u.s = f.s WHERE f.w > 0),
sblocks AS (
  SELECT ord, k, coalesce(lead(first) OVER (PARTITION BY ord, k ORDER BY run), 1000000000) AS place,
         0::BIGINT AS sub, b FROM buffers
  UNION ALL
  SELECT ord, k, s, run::BIGINT, string_agg(x, ' ' ORDER BY w) FROM wrun GROUP BY ord, k, s, run
  UNION ALL
  SELECT ord, k, s, -1, '' FROM wrun WHERE w = 1 AND mark = 'o')"""


def blocks(rows: str) -> str:
    """CTEs from ``rows`` (SQL giving ord, id, language, t) to ``numbered`` blocks."""
    return f"""
src AS MATERIALIZED ({rows}),
para0 AS (SELECT ord, string_split_regex(t, '[\\r\\n]+') AS l FROM src WHERE length(t) >= 200),
para1 AS (SELECT ord, unnest(l) AS p0, generate_subscripts(l, 1) AS k0 FROM para0),
para2 AS (SELECT ord, k0, {strip('p0')} AS p FROM para1),
para AS MATERIALIZED (
  SELECT ord, p, length(p) AS n, row_number() OVER (PARTITION BY ord ORDER BY k0) AS k
  FROM para2 WHERE p <> '' AND NOT {is_noise('p')} AND NOT {is_index_like('p')}),
fold(ord, k, len, rng, mark) AS (
  SELECT ord, 0::BIGINT, 0::BIGINT, {_NEXT.format(s='(42 + ord)::BIGINT')}, '' FROM src
  UNION ALL
  SELECT f.ord, f.k + 1,
         CASE WHEN p.n > 600 THEN 0 WHEN f.len + p.n + 2 > 600 THEN p.n
              WHEN f.len + p.n + 2 >= 200 + f.rng % 401 THEN 0 ELSE f.len + p.n + 2 END,
         CASE WHEN CASE WHEN p.n > 600 THEN f.len > 0
                        ELSE f.len + p.n + 2 > 600 OR f.len + p.n + 2 >= 200 + f.rng % 401 END
              THEN {_NEXT.format(s='f.rng')} ELSE f.rng END,
         CASE WHEN p.n > 600 THEN 'l' WHEN f.len + p.n + 2 > 600 THEN 'o'
              WHEN f.len + p.n + 2 >= 200 + f.rng % 401 THEN 'c' ELSE 'k' END
  FROM fold f JOIN para p ON p.ord = f.ord AND p.k = f.k + 1),
marked AS (SELECT p.*, f.mark, lag(f.mark) OVER (PARTITION BY p.ord ORDER BY p.k) AS before
           FROM para p JOIN fold f ON f.ord = p.ord AND f.k = p.k),
runs AS (SELECT *, sum(CASE WHEN before IS NULL OR mark IN ('o', 'l') OR before IN ('c', 'l')
                            THEN 1 ELSE 0 END) OVER (PARTITION BY ord ORDER BY k) AS run
         FROM marked),
long AS MATERIALIZED (SELECT ord, k, p FROM para WHERE n > 600),
{sentence_blocks('long')},
allblocks AS (
  SELECT ord, run, 0::BIGINT AS place, 0::BIGINT AS sub,
         string_agg(p, chr(10) || chr(10) ORDER BY k) AS b
  FROM runs WHERE mark <> 'l' GROUP BY ord, run
  UNION ALL
  SELECT s.ord, r.run, s.place, s.sub, s.b
  FROM sblocks s JOIN runs r ON r.ord = s.ord AND r.k = s.k),
numbered AS MATERIALIZED (
  SELECT a.ord AS row_ordinal, r.id, r.language, a.b AS block_text,
         (row_number() OVER (PARTITION BY a.ord ORDER BY run, place, sub))::INTEGER AS block_idx,
         row_number() OVER (ORDER BY a.ord, run, place, sub) AS chunk_no
  FROM allblocks a JOIN src r ON r.ord = a.ord)"""


def _corpus(text: str = "text", ordinal: str = "doc_id + 1") -> str:
    return (
        f"SELECT {ordinal} AS ord, doc_id::VARCHAR AS id, lang AS language, "
        f"{clean(repaired(text))} AS t FROM documents WHERE {strip(text)} <> '' "
        f"AND NOT {excluded('doc_id::VARCHAR')}"
    )


EVAL_BLOCKS = EVAL_BLOCKS.replace("@BLOCKS@", blocks(_corpus()))

CHUNK_BLOCKS = f"""WITH RECURSIVE {blocks(_corpus())}
SELECT row_ordinal, id, language, block_idx, chunk_no, block_text FROM numbered"""

CHUNK_BLOCKS_BY_SOURCE = f"""WITH RECURSIVE
ordered AS (SELECT *, row_number() OVER (ORDER BY source, doc_id) AS o FROM documents),
{blocks(_corpus(ordinal='o').replace('FROM documents', 'FROM ordered'))}
SELECT row_ordinal, id, block_idx, chunk_no, block_text FROM numbered"""

CHUNK_BLOCKS_RESUMED = f"""WITH RECURSIVE {blocks(_corpus())},
resumed AS (SELECT ord, row_number() OVER (ORDER BY ord) AS rn FROM src WHERE ord > 400)
SELECT row_ordinal, block_idx, chunk_no, block_text
FROM numbered JOIN resumed ON ord = row_ordinal WHERE rn <= 300"""


def _packed(text: str) -> str:
    return f"""WITH RECURSIVE
source AS MATERIALIZED (SELECT doc_id AS ord, 1::BIGINT AS k, {strip(text)} AS p FROM documents
           WHERE length({strip(text)}) > 600),
{sentence_blocks('source')},
placed AS (SELECT ord, (row_number() OVER (PARTITION BY ord ORDER BY place, sub) - 1)::INTEGER AS place, b
           FROM sblocks)
SELECT source.ord AS doc_id, place, b AS block FROM source LEFT JOIN placed ON placed.ord = source.ord"""


SENTENCE_PACK = _packed(replace("text", ("\n", " ")))
WORD_PACK = _packed(replace("text", ("\n", " "), ("e. ", "e ")))

# --- draws and manifest -------------------------------------------------------


def _u(name: str, which: int = 0, index: str = "chunk_no", seed: str = "42") -> str:
    """``name`` is an SQL expression."""
    hexes = f"substr(md5(({seed})::VARCHAR || ':' || {index} || ':' || {name}), {8 * which + 1}, 8)"
    return f"(('0x' || {hexes})::BIGINT::DOUBLE / 4294967295.0)"


def _normal(name: str, spec: Normal, seed: str = "42") -> str:
    quoted = f"'{name}'"
    z = (
        f"(sqrt(-2 * ln(greatest({_u(quoted, 0, seed=seed)}, 1e-10))) "
        f"* cos({2 * math.pi!r} * {_u(quoted, 1, seed=seed)}))"
    )
    raw = f"({float(spec.median)}::DOUBLE + {z} * {float(spec.std)}::DOUBLE)"
    if spec.low is not None:
        raw = f"greatest({float(spec.low)}::DOUBLE, {raw})"
    if spec.high is not None:
        raw = f"least({float(spec.high)}::DOUBLE, {raw})"
    return {
        "int": f"round_even({raw}, 0)::INTEGER",
        "bool": f"({raw} > 0.5)",
        "decimals": f"greatest(0.0::DOUBLE, round_even({raw}, 2))",
        "float": raw,
    }[spec.kind]


def _choice(name: str, seed: str = "42") -> str:
    options = CHOICES[name]
    u = f"({_u(repr(name), seed=seed)} * {sum(w for _, w in options)!r}::DOUBLE)"
    upto, whens = 0.0, ""
    for option, weight in options:
        upto += weight
        whens += f" WHEN {u} <= {upto!r}::DOUBLE THEN '{option}'"
    return f"CASE{whens} ELSE '{options[-1][0]}' END"


def _font() -> str:
    families = font_families()

    def mixed(factor: int) -> str:
        return f"((42 + chunk_no::HUGEINT * {factor}) % 4294967296)"

    whens = ""
    for i, family in enumerate(families):
        options = "[" + ", ".join(f"'{f}'" for f in family) + "]"
        picked = f"({options})[({mixed(VARIANT_MIX)} % {len(family)})::INTEGER + 1]"
        whens += f" WHEN {i} THEN {picked}"
    return f"CASE ({mixed(FAMILY_MIX)} % {len(families)})::INTEGER{whens} END"


_INDEXED = "ix AS (SELECT doc_id + 1 AS chunk_no, n_chars::INTEGER AS chars FROM documents)"
FONT_DRAW = f"WITH {_INDEXED} SELECT chunk_no, {_font()} AS font FROM ix"


def _shown(name: str, spec: Normal) -> str:
    draw = _normal(name, spec)
    return f"{f'round({draw}, 6)' if spec.kind in ('float', 'decimals') else draw} AS {name}"


NORMAL_DRAW = f"""WITH {_INDEXED} SELECT chunk_no,
{', '.join(_shown(n, s) for n, s in NORMALS.items())} FROM ix"""
CHOICE_DRAW = f"""WITH {_INDEXED} SELECT chunk_no,
{', '.join(f'{_choice(n)} AS {n}' for n in CHOICES)} FROM ix"""
UNIFORM_DRAW = f"""WITH {_INDEXED} SELECT chunk_no,
round({_u("'extent_padding'")} * 50, 9) AS value FROM ix"""


def _sizes(source: str) -> str:
    """CTEs from ``source(chunk_no, chars)`` to ``sizes``, the first valid attempt or none."""
    low, high = (
        "CASE archetype " + " ".join(f"WHEN '{a}' THEN {r[i]}::DOUBLE" for a, r in ASPECT_RANGES.items()) + " END"
        for i in (0, 1)
    )
    ar_name = "'ar_' || archetype"
    return f"""
tries AS (SELECT chunk_no, chars, unnest(range(11))::INTEGER AS attempt FROM {source}),
drawn AS (SELECT *, {_normal('short_side', NORMALS['short_side'], '42 + attempt')} AS side0,
                 {_choice('ar_archetype', '42 + attempt')} AS archetype FROM tries),
ratios AS (SELECT *, greatest(200, least(1680, side0)) AS short_side,
                  {low} + {_u(ar_name, seed='42 + attempt')} * ({high} - {low}) AS ratio FROM drawn),
sized AS (SELECT *,
  CASE WHEN ratio >= 1 THEN trunc(short_side * ratio)::INTEGER ELSE short_side END AS width,
  CASE WHEN ratio >= 1 THEN short_side ELSE trunc(short_side / ratio)::INTEGER END AS height
  FROM ratios),
valid AS (SELECT *, least(width, height) >= 200 AND width * height >= 40000
                    AND (chars = 0 OR width * height / chars >= 170) AS ok FROM sized),
-- Attempts that did not fit: the last one stands for the text, as nothing was found.
sizes AS (SELECT * FROM valid
          QUALIFY row_number() OVER (PARTITION BY chunk_no
                                     ORDER BY ok DESC, CASE WHEN ok THEN attempt ELSE -attempt END) = 1)"""


SIZE_PLAN = f"""WITH {_INDEXED}, ix2 AS (SELECT chunk_no, (chars % 3000)::INTEGER AS chars FROM ix),
{_sizes('ix2')}
SELECT chunk_no, chars, ok, attempt, archetype, short_side, round(ratio, 9) AS aspect_ratio,
       width, height FROM sizes"""


def _channel(name: str) -> str:
    base = "background_gray" if name.startswith("bg") else "text_gray"
    quoted = f"'{name}'"
    moved = f"({base} + (-color_variance + {_u(quoted)} * (2 * color_variance)))"
    return f"CASE WHEN use_color THEN trunc(greatest(0, least(255, {moved})))::INTEGER ELSE {base} END"


def _rgb(*names: str) -> str:
    return "'rgb(' || " + " || ',' || ".join(f"({_channel(n)})" for n in names) + " || ')'"


_COLOR_INPUTS = ("background_gray", "text_gray", "use_color", "color_variance")
COLOR_DRAW = f"""WITH {_INDEXED}, d AS (SELECT chunk_no,
{', '.join(f'{_normal(n, NORMALS[n])} AS {n}' for n in _COLOR_INPUTS)} FROM ix)
SELECT chunk_no, use_color, {_rgb('bg_r', 'bg_g', 'bg_b')} AS bg_color,
       {_rgb('txt_r', 'txt_g', 'txt_b')} AS text_color FROM d"""

_DRAWN = [n for n in NORMALS if n != "short_side"]
_ROUNDED = [
    "margin_factor", "char_spacing", "rotation", "blur", "skew_x", "skew_y", "perspective",
    "noise_amount", "mb_radius", "mb_sigma", "dirty_attenuate",
]
_PLAIN = [
    "font", "alignment", "width", "height", "text_w", "text_h", "bg_color", "text_color", "ptsize",
    "line_spacing", "apply_wave", "use_noise", "noise_type", "use_motion_blur", "mb_angle", "use_ebc",
    "brightness", "contrast", "use_dirty", "use_banding", "use_morphology", "morphology_type",
    "morphology_kernel", "extent_padding", "text",
]



def _six(*numbers: str) -> str:
    return " || 'x' || ".join(f"printf('%.6f', ({n})::DOUBLE)" for n in numbers)


RENDER_MANIFEST = f"""WITH RECURSIVE {blocks(_corpus(replace('text', ('ß', 'ss'))))},
flowed AS (SELECT *, {strip("regexp_replace(block_text, '[ " + chr(92) + "t]+', ' ', 'g')")} AS t FROM numbered),
draws AS (SELECT *,
  {', '.join(f'{_normal(n, NORMALS[n])} AS {n}' for n in _DRAWN)},
  {', '.join(f'{_choice(n)} AS {n}' for n in CHOICES if n != 'ar_archetype')},
  {_font()} AS font, trunc({_u("'extent_padding'")} * 50)::INTEGER AS extent_padding
  FROM flowed WHERE t <> ''),
final AS (SELECT *, CASE WHEN uppercase THEN upper(t) ELSE t END AS text,
                 {_rgb('bg_r', 'bg_g', 'bg_b')} AS bg_color, {_rgb('txt_r', 'txt_g', 'txt_b')} AS text_color
          FROM draws),
lengths AS (SELECT chunk_no, length(text) AS chars FROM final),
{_sizes('lengths')},
accepted AS (SELECT f.*, s.width, s.height, s.ratio,
  greatest(50, s.width - 2 * trunc(s.width * margin_factor)::INTEGER) AS text_w,
  greatest(50, s.height - 2 * trunc(s.height * margin_factor)::INTEGER) AS text_h,
  trunc(least(s.width, s.height) * perspective * 0.2::DOUBLE)::INTEGER AS shift
  FROM final f JOIN sizes s ON s.chunk_no = f.chunk_no WHERE s.ok)
SELECT {', '.join(_PLAIN)}, {', '.join(f'round({c}, 6) AS {c}' for c in _ROUNDED)},
  round(ratio, 6) AS aspect_ratio,
  greatest(10, trunc(sqrt(2.5 * (text_w / text_h) * length(text)))::INTEGER) AS wrap_cols,
  regexp_replace(language || '_' || id || '_' || printf('%03d', block_idx) || '_'
                 || trunc(ratio * 100)::INTEGER || 'ar', '[^\\p{{L}}\\p{{N}}_.\\-]', '_', 'g') AS basename,
  concat_ws('; ',
    CASE WHEN abs(rotation) > 0.1 THEN 'rotate=' || {_six('rotation')} END,
    CASE WHEN abs(skew_x) > 0.1 OR abs(skew_y) > 0.1 THEN 'shear=' || {_six('skew_x', 'skew_y')} END,
    CASE WHEN abs(perspective) > 0.01 AND shift > 0 THEN 'perspective=' || {_six('shift')} END,
    CASE WHEN use_noise THEN 'noise=' || noise_type
      || CASE WHEN noise_amount > 0 THEN ' ' || {_six('noise_amount')} ELSE '' END END,
    CASE WHEN use_dirty AND NOT use_noise THEN 'dirty=' || {_six('dirty_attenuate')} END,
    CASE WHEN use_ebc THEN 'brightness-contrast=' || {_six('brightness', 'contrast')} END,
    CASE WHEN use_banding THEN 'banding=' || {_six('width', 'height')} END,
    CASE WHEN use_morphology THEN 'morphology=' || morphology_type || ' ' || morphology_kernel END,
    CASE WHEN apply_wave THEN 'wave=' || {_six('2', 'width * 0.5')} END,
    'trim=10%',
    CASE WHEN extent_padding > 0 THEN 'border=' || {_six('extent_padding / 2', 'extent_padding / 2')} END) AS effects
FROM accepted"""

# --- pairs, splits, reshapes --------------------------------------------------

_IMAGES = """images AS (SELECT doc_id * 2 AS basename, doc_id * 97 % 40000 AS length FROM labels)"""
PAIR_JOIN = f"""WITH {_IMAGES}
SELECT basename, length, {collapse('text')} AS text
FROM images JOIN documents ON doc_id = basename WHERE length >= 20480"""
ORPHANS = f"""WITH {_IMAGES}
SELECT basename, 'image' AS side FROM images WHERE basename NOT IN (SELECT doc_id FROM documents)
UNION ALL
SELECT doc_id, 'text' FROM documents WHERE doc_id NOT IN (SELECT basename FROM images)"""
ORPHAN_COUNTS = f"SELECT side, count(*) AS n FROM ({ORPHANS}) GROUP BY side"


def _placed(shard_size: int) -> str:
    return f"""
shuffled AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS pos,
                    count(*) OVER () * 9 // 10 AS train FROM documents),
split_rows AS (SELECT *, CASE WHEN pos < train THEN 'train' ELSE 'test' END AS split,
                         CASE WHEN pos < train THEN pos ELSE pos - train END AS split_pos
               FROM shuffled),
placed AS (SELECT *, (split_pos // {shard_size})::INTEGER AS shard_idx FROM split_rows)"""


SHUFFLE_SPLIT_SHARD = f"WITH {_placed(100)} SELECT doc_id, pos, split, split_pos, shard_idx FROM placed"
SPLIT_SIZES = f"WITH {_placed(100)} SELECT split, count(*) AS n FROM placed GROUP BY split"
RESUME_SHARDS = f"""WITH {_placed(30)} SELECT doc_id, split, split_pos, shard_idx FROM placed
WHERE split = 'test' OR shard_idx >= 12"""
ID_MANIFEST = f"""WITH {_placed(100)}
SELECT split, 0::BIGINT AS line_no,
       '--- ' || upper(split) || ' SPLIT | Total: ' || count(*) || ' ---' AS line
FROM placed GROUP BY split
UNION ALL SELECT split, split_pos + 1, doc_id::VARCHAR FROM placed"""
ASSET_MANIFEST = f"""WITH {_placed(100)}
SELECT split, shard_idx, count(*) AS members, sum(n_chars)::BIGINT AS total_bytes,
       string_agg(doc_id || '.png=' || lang || '/' || source, ' ' ORDER BY split_pos) AS files,
       split || '_shard_' || printf('%04d', shard_idx) AS archive
FROM placed GROUP BY split, shard_idx"""

_NAME = "lang || 'x_' || source || '_' || doc_id"
FLAT_SAMPLES = f"""SELECT {_NAME} AS id, substr({_NAME}, 1, 3) AS language,
  {collapse('text')} AS text, {_NAME} || '.png' AS image_path FROM documents"""
CHAT_MESSAGES = f"""
SELECT doc_id, 1 AS n_images, 0 AS turn, 'user' AS role, 0 AS part, 'text' AS type, 'OCR:' AS text,
       NULL::VARCHAR AS image_path FROM documents
UNION ALL SELECT doc_id, 1, 0, 'user', 1, 'image', NULL, source || '.png' FROM documents
UNION ALL SELECT doc_id, 1, 1, 'assistant', 0, 'text', {collapse('text')}, NULL FROM documents"""
INSTRUCTION_JSON = f"""SELECT doc_id,
  '{{"image_info":[{{"matched_text_index":0,"image_url":"./assets/' || doc_id || '.png"}}],'
  || '"text_info":[{{"text":"OCR:","tag":"mask"}},{{"text":"'
  || {collapse(replace('text', ('"', "'"), (chr(92), "'")))}
  || '","tag":"no_mask"}}]}}' AS line FROM documents"""
RUN_COUNTS = f"""WITH RECURSIVE {blocks(_corpus())}
SELECT (SELECT count(*) FROM documents) AS rows, (SELECT count(*) FROM src) AS effective_rows,
       (SELECT count(*) FROM numbered) AS chunks,
       (SELECT round(sum(octet_length(encode(html)))::DOUBLE / 1048576, 9) FROM pages) AS output_mb"""

ORACLES: dict[str, str] = {
    "eval_cer": EVAL_CER,
    "eval_wer": EVAL_WER,
    "eval_summary": EVAL_SUMMARY,
    "eval_report": EVAL_REPORT,
    "eval_blocks": EVAL_BLOCKS,
    "percent_text": PERCENT_TEXT,
    "prediction_join": PREDICTION_JOIN,
    "prediction_problems": PREDICTION_PROBLEMS,
    "system_comparison": SYSTEM_COMPARISON,
    "record_defaults": RECORD_DEFAULTS,
    "first_rows": FIRST_ROWS,
    "row_at": ROW_AT,
    "clean_markdown": CLEAN_MARKDOWN,
    "repair_escapes": REPAIR_ESCAPES,
    "collapse_text": COLLAPSE_TEXT,
    "reflow": REFLOW,
    "upper_text": UPPER_TEXT,
    "line_stats": LINE_STATS,
    "sample_keys": SAMPLE_KEYS,
    "noise_filter": NOISE_FILTER,
    "exclude_ids": EXCLUDE_IDS,
    "resume_and_limit": RESUME_AND_LIMIT,
    "corpus_defaults": CORPUS_DEFAULTS,
    "image_bytes_filter": IMAGE_BYTES_FILTER,
    "image_geometry": IMAGE_GEOMETRY,
    "quarantine": QUARANTINE,
    "error_log": ERROR_LOG,
    "chunk_blocks": CHUNK_BLOCKS,
    "chunk_blocks_by_source": CHUNK_BLOCKS_BY_SOURCE,
    "chunk_blocks_resumed": CHUNK_BLOCKS_RESUMED,
    "sentence_pack": SENTENCE_PACK,
    "word_pack": WORD_PACK,
    "font_draw": FONT_DRAW,
    "normal_draw": NORMAL_DRAW,
    "choice_draw": CHOICE_DRAW,
    "uniform_draw": UNIFORM_DRAW,
    "size_plan": SIZE_PLAN,
    "color_draw": COLOR_DRAW,
    "render_manifest": RENDER_MANIFEST,
    "pair_join": PAIR_JOIN,
    "orphans": ORPHANS,
    "orphan_counts": ORPHAN_COUNTS,
    "shuffle_split_shard": SHUFFLE_SPLIT_SHARD,
    "split_sizes": SPLIT_SIZES,
    "resume_shards": RESUME_SHARDS,
    "id_manifest": ID_MANIFEST,
    "asset_manifest": ASSET_MANIFEST,
    "flat_samples": FLAT_SAMPLES,
    "chat_messages": CHAT_MESSAGES,
    "instruction_json": INSTRUCTION_JSON,
    "run_counts": RUN_COUNTS,
}
