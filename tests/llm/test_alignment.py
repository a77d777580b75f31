"""Token alignment against plain encodings, groups and counts."""

from __future__ import annotations

import base64
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from glyphmill.llm import queries, token_alignment

SCHEMA = "doc_id long, text string, row string, pair string"
TEXTS = [
    None, "", " ", "one", "two  spaces", " leading", "trailing ", "line\nbreak\ttab", "naïve café ꞌéñ", "日本語のテキスト", "😀😀 emoji",
    "<|endoftext|> and </s> <unk> ▁", "x" * 3000, "Ünïcödé " * 400, "don't 123 4567 ½ ²", "​﻿ ", "ﬁ ligature",
    "repeat repeat repeat", "repeat repeat repeat", "ab\r\ncd", "\x00\x01",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    a_bytes = {int(i): base64.b64decode(t) for t, i in (line.split() for line in open(ranks, "rb"))}
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(id):
        piece = b.id_to_piece(id)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(id) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_parts, b_parts = [a_bytes[i] for i in a_ids], [b_bytes(i) for i in b_ids]
        if not b"".join(a_parts) == (" " + text).encode() == b"".join(b_parts):
            return []
        found, x, y, a_end, b_end = [([], [])], 0, 0, 0, 0
        while x < len(a_ids) or y < len(b_ids):
            if a_end <= b_end and x < len(a_ids):
                found[-1][0].append(a_ids[x])
                a_end, x = a_end + len(a_parts[x]), x + 1
            else:
                found[-1][1].append(b_ids[y])
                b_end, y = b_end + len(b_parts[y]), y + 1
            if a_end == b_end and found[-1][1]:
                found.append(([], []))
        return found[:-1]

    return groups


def expected(plain, texts):
    every = [plain(t) for t in texts]
    count = Counter((a[-1], b[-1]) for groups in every for a, b in groups)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    rows = []
    for groups in every:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
            sha256(text.encode()).hexdigest() if groups else "",
        ))
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_alignment_equals_plain_groups(spark, plain, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(token_alignment, "BROADCAST_PAIRS", 0)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab cdé.\n") for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = [(i % 70 if i % 9 else None, t, "clash", "clash") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).withColumn("a.b", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.tokenizer_alignment(spark, str(tmp_path)).collect()
    want = [(doc_id, *row) for (doc_id, *_), row in zip(rows, expected(plain, texts), strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(r.n_a == 0 for r in got) >= 3 and sum(r.n_a > 0 for r in got) > 60


def test_real_texts_in_stretches(spark, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "TEXT_BYTES", 5000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.collect()
    assert got == dict(zip([r.doc_id for r in rows], expected(plain, [r.text for r in rows]), strict=True))


def test_empty_table_and_invalid_bytes(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "empty/documents.parquet"))
    assert queries.tokenizer_alignment(spark, str(tmp_path / "empty")).collect() == []
    bad = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(b"a\xff").cast("string").alias("text"))
    bad.write.parquet(str(tmp_path / "bad/documents.parquet"))
    row = queries.tokenizer_alignment(spark, str(tmp_path / "bad")).first()
    assert (row.n_a, row.n_b, row.n_groups, row.groups_sha256) == (0, 0, 0, "")


def test_pointer_jumping_over_a_long_component():
    a, b = np.arange(2, 200_002, 2), np.append(np.arange(1, 200_000, 2), 200_000)
    of_a, of_b = token_alignment.groups(a, b)
    assert set(of_a) == set(of_b) == {0}
    of_a, of_b = token_alignment.groups(np.array([3, 4, 9]), np.array([1, 4, 8, 9]))
    assert (of_a.tolist(), of_b.tolist()) == ([0, 0, 1], [0, 0, 1, 1])
