"""Operators against brute force on small tables with nulls, blanks, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import fingerprints as P
from glyphmill.llm import html_text, langid, mixing, ngram_join, quality, toxicity, urls
from glyphmill.llm.decontaminate import decontaminate
from glyphmill.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key string"
LINE = "A line that many documents have in common."
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, BASE), (6, BASE.upper()), (7, BASE.replace("word30", "other")),
    (8, f"{LINE}\nown text of eight"), (9, f"  {LINE.upper()} \nshort\nshort"), (10, f"x\n{LINE}"), (10, f"x\n{LINE}"),
    (11, "Zürich " * 300), (12, "é" * 500 + "\n" + BASE), (None, LINE),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, "clash", "clash") for i, t in TEXTS], SCHEMA)


def shingles(text, n):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(texts, n, percent):
    sets = {i: shingles(t, n) for i, t in texts if i is not None}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    group[a] = group[b] = min(group[a], group[b])
    return {i: (len(s), group[i]) for i, s in sets.items()}


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_similarity_classes(spark, docs, words, percent):
    rng = np.random.default_rng(percent)
    variants = []
    for i in range(40):  # copies of a few texts with some words changed
        w = [f"t{i % 4}w{j}" for j in range(80 + 40 * (i % 4))]
        for j in rng.choice(len(w), int(rng.integers(0, 5)), False):
            w[j] = f"new{i}"
        variants.append((100 + i, " ".join(w)))
    both = docs.unionByName(
        spark.createDataFrame([(i, t, "en", "s", 0, "", "") for i, t in variants], SCHEMA)
    )
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_classes(both, words=words, percent=percent).collect()}
    assert got == components(TEXTS + variants, words, percent)


def test_tile_keys_of_linked_sets_meet():
    rng = np.random.default_rng(3)
    for percent in (80, 85, 95):
        for n in (6, 9, 17, 60, 300):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            gone = rng.integers(0, ngram_join.most_apart(len(a), percent) + 1) // 2
            b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, gone, dtype=np.uint64))))
            common = len(np.intersect1d(a, b))
            if common * 100 >= percent * (len(a) + len(b) - common) and common < max(len(a), len(b)):
                assert set(ngram_join.tile_keys(a, percent)) & set(ngram_join.tile_keys(b, percent))


def test_tile_keys_meet_whichever_set_stops_first():
    for seed in (3170, 3655, 9123, 10249):  # the larger set was good where the smaller had too many empty parts
        larger = np.unique(np.random.default_rng(seed).integers(0, 2**63, 16, dtype=np.uint64))
        smaller = np.sort(np.random.default_rng(seed).permutation(larger)[:13])
        assert set(ngram_join.tile_keys(smaller, 80)) & set(ngram_join.tile_keys(larger, 80))


def test_line_dedup(docs):
    holders = {}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t in TEXTS:
        if i is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(i)
    expected = Counter()
    for i, t in TEXTS:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(key(x)) < 20 or len(holders[key(x)]) < 3 or i == max(holders[key(x)])
        ]
        expected[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    out = line_dedup(docs)
    got = Counter((r.doc_id, *r.deduped) for r in out.collect())
    assert got == expected and out.columns == [*docs.columns, "deduped"]


def test_decontaminate(spark, docs):
    items = [(1, " ".join(f"WORD{i}" for i in range(20, 45))), (2, "one, two"), (3, None), (4, ""), (None, "own text"), (5, "nowhere " * 12)]
    hits = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {
        (tuple(w[i : i + min(10, len(w))]), str(k))
        for k, t in items if k is not None and (w := split(t)) for i in range(max(1, len(w) - 9))
    }
    expected = Counter()
    for i, t in TEXTS:
        words, places, found = split(t), set(), set()
        for window, k in windows:
            for s in range(len(words) - len(window) + 1):
                if i is not None and tuple(words[s : s + len(window)]) == window:
                    places |= set(range(s, s + len(window)))
                    found.add(k)
        expected[i, len(words), len(places), tuple(sorted(found))] += 1
    assert Counter((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in hits.collect()) == expected


def test_fingerprints(docs):
    rows = sorted((i, t or "") for i, t in TEXTS if i is not None)
    pieces = lambda t: set(re.findall(r"[^\n]{1,240}", t))
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    expected = Counter()
    for k, (i, t) in enumerate(rows):
        following, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = (round(alike(pieces(t), pieces(x)), 9) for x in (edited, following))
        expected[i, len(t), digest, *near] += 1
    got = P.fingerprints(docs).collect()
    assert Counter((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == expected
    by_text = {}
    for r in got:
        by_text.setdefault(r.id, set()).add(r.fingerprint)
    assert len(by_text[10]) == 1 and by_text[1] == by_text[2]


def test_language_id_held_out(spark):
    rng = np.random.default_rng(1)
    kinds = {"xx": ["alo", "ben", "cat"], "yy": ["ñur", "óst", "zéb"]}
    rows = [(i, " ".join(rng.choice(kinds[g], 40)), g) for i, g in enumerate(["xx", "yy"] * 60)]
    model = langid.fit(spark.createDataFrame(rows[:80], "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([*rows[80:], (-1, None, None), (-2, "12 34 !", None), (-3, "", "xx")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.p for r in asked.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()}
    assert all(got[i].lang == g for i, _, g in rows[80:])
    assert all(tuple(got[i]) == ("und", 0.0) for i in (-1, -2, -3))
    assert langid.fit(asked.limit(0)) is None


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(2)
    plain = [a + b + c for a in "bdg" for b in ("elo", "ani", "uro") for c in ("n", "st", "rem")]

    def text(bad):
        words = list(rng.choice(plain, 60))
        return " ".join([*words[:20], *(["vilewretch"] if bad else []), *words[20:]])

    rows = [(i, text(i % 2)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert all((model.score(t) >= 0.7) == bool(i % 2) for i, t in rows)
    assert model.score("vilewretchh " + plain[0]) > model.score(plain[1] + " " + plain[0])
    for odd in (None, "", " \n", "x" * 100_000):
        assert 0 <= model.score(odd) < 0.7
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None


def test_html_extraction(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><a href=x>Menu</a></nav>"
        "<div class='ad'>Buy</div><article><h1>Head {0}</h1><p>One  &amp;\n two<b>bold</b><br>next<p>unclosed {0}<form>f</form>"
        "<section class='comments'><p>nice</p></section></article><footer>&copy; me</footer></body></html>"
    )
    bare = "<body><ul class=links><li><a href=a>Home</a></li></ul><div>Common words</div><p>Text {0}</p></body>"
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(5)]
    rows += [(10 + i, f"http://b.org/{i}", bare.format(i)) for i in range(9)]
    rows += [(30, None, None), (31, "x", ""), (32, "http://c.org", "no tags at all"), (32, "http://c.org", "no tags at all")]
    got = Counter((r.id, r.text) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = [(i, f"Head {i}\nOne & twobold\nnext\nunclosed {i}") for i in range(5)]
    want += [(10 + i, f"Text {i}") for i in range(9)]
    assert got == Counter([*want, (30, ""), (31, ""), (32, "no tags at all"), (32, "no tags at all")])


def test_html_template_decides_inside_article(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a href=x>Menu</a></nav><article><header><h1>Head {0}</h1></header>"
        "<div class='strip'>Members read more</div><div class='post-header'>By author {0}<p>All rights reserved</p></div>"
        "<div class='has-sidebar'><p>Own {0}</p><p>More {0}</p></div><div class='related-posts'><ul>"
        "<li><a href=a>Other {0}</a></li><li><a href=b>Another {0}</a></li></ul></div></article></body></html>"
    )
    copy = "<body><article><p>One article</p><p>under many addresses</p></article><footer>me</footer></body>"
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(10)]
    rows += [(20 + i, f"http://b.org/{i}", copy) for i in range(10)]
    got = {r.id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: f"Head {i}\nBy author {i}\nOwn {i}\nMore {i}" for i in range(10)}
    assert got == {**want, **{20 + i: "One article\nunder many addresses" for i in range(10)}}


def test_html_template_texts_of_any_length_on_most_pages(spark):
    notice = "Long notice that is on every page but one. " * 8
    page = (
        "<body><div class='top'>Common words</div><p>Own {0}</p><p>" + notice + "</p>"
        "<div>With <b>marked</b> words</div></body>"
    )
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(12)]
    rows += [(20, "http://a.org/20", None), (21, "http://a.org/21", ""), (22, "http://a.org/22", "<p>odd page</p>")]
    got = {r.id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Own {i}" for i in range(12)}, 20: "", 21: "", 22: "odd page"}


def test_url_rules_and_models(spark):
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]
    good = [(i, f"http://good{i % 7}.com/aaa/{i}") for i in range(60)]
    bad = [(100 + i, f"http://spam{i % 7}.net/es/zzz/{i}") for i in range(60)]
    odd = [
        (300, None), (301, "no scheme"), (302, "HTTP://WWW.Example.COM/en/x?y#z"), (303, "http://a.example.com/en/"),
        (304, "http://xcom/"), (305, "http://q.org/aaa/1"), (306, "http://spam1.org/es/zzz/1"), (307, "http://com"),
    ]
    got = {r.id: r for r in urls.judge_urls(spark.createDataFrame(good + bad + odd, "page_id long, url string"), rules).collect()}
    assert all(got[i].verdict == "allow" for i, _ in good) and all(got[i].verdict == "block" for i, _ in bad)
    assert (got[302].host, got[302].path, got[302].rule) == ("www.example.com", "/en/x", "www.example.com/en/")
    assert (got[303].rule, got[304].rule, got[307].rule) == ("example.com/en/", None, None)
    assert got[301].host == got[300].path == "" and got[300].verdict == "allow"
    assert (got[305].verdict, got[306].verdict) == ("allow", "block")


def test_url_models_read_the_query(spark):
    good = [(i, f"http://site{i % 7}.com/page?topic=garden&n={i}") for i in range(60)]
    bad = [(100 + i, f"http://site{i % 7}.net/page?buy=pills#zzz{i}") for i in range(60)]
    odd = [(300, "http://q.org/page?topic=garden&n=1"), (301, "http://q.org/page?buy=pills#zzz1")]
    pages = spark.createDataFrame(good + bad + odd, "page_id long, url string")
    got = {r.id: r.verdict for r in urls.judge_urls(pages, [("com/", "allow"), ("net/", "block")]).collect()}
    assert (got[300], got[301]) == ("allow", "block")


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(1, 30)), f"s{min(3, int(rng.exponential()))}", str(rng.choice(["a", "b"]))) for i in range(400)]
    rows += [(900, None, None, "a"), (901, "", "s0", None), (902, "w w", None, "a"), (903, "w", None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, 0.5)
    assert mixed.count() == len(rows)
    for dim in ("source", "lang"):
        sums = mixed.groupBy(dim).agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("probability")).alias("e"))
        sums = [r for r in sums.collect() if r.n]
        roots, expected = sum(r.n**0.5 for r in sums), sum(r.e for r in sums)
        assert all(abs(r.e / expected - r.n**0.5 / roots) < 1e-4 for r in sums)
    assert 0.999 < mixed.agg(F.max("probability")).first()[0] <= 1
    assert mixing.mix(docs.limit(0), {"lang": F.col("lang")}).count() == 0


def test_quality_shrinks_sparse_sites(spark):
    rows = [(i, "Plain words of a good text. " * 5, "big", "a") for i in range(60)]
    rows += [(100 + i, "| ||| 00 !!" * 9, "bad", "a") for i in range(60)]
    rows += [(200, "Plain words of a good text. " * 5, "new", "z"), (201, None, None, None), (202, "", "bad", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(50), *range(100, 150)]], "doc_id long, quality int")
    got = {r.id: r for r in quality.quality(docs, labels, F.col("source"), F.col("lang")).collect()}
    assert all(got[i].keep for i in range(60)) and not any(got[100 + i].keep for i in range(60))
    assert got[200].host_share == pytest.approx(0.5) and got[200].keep
    assert got[55].host_share > 0.9 > got[202].host_share and 0 <= got[201].score <= 1
    none = quality.quality(docs, labels.limit(0), F.col("source"), F.col("lang")).select("score", "keep").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, True)]


def test_empty_tables(spark, docs):
    empty = docs.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.similarity_classes(empty).count() == line_dedup(empty).count() == 0
    assert decontaminate(empty, items).count() == P.fingerprints(empty).count() == 0
    assert decontaminate(docs, items).agg(F.sum("n_hit")).first()[0] == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == urls.judge_urls(pages, [("com/", "allow")]).count() == 0


def test_language_sample_keeps_every_language(spark):
    rows = [(7, "aa", f"word{i} aa text") for i in range(3000)] + [(1000 + i, "zz", f"other{i} zz") for i in range(300)]
    df = spark.createDataFrame([(i, lang, t) for i, lang, t in rows], "doc_id long, lang string, text string")
    for shift in (0, 1):  # the id of the many rows is drawn, or another one is
        moved = df.withColumn("doc_id", F.col("doc_id") + shift)
        _, langs = langid.labelled_sample(moved, "doc_id", "text", "lang", 400, 4, 256)
        assert set(langs) == {"aa", "zz"} and 300 <= langs.count("zz") <= 4 * 300 and langs.count("aa") <= 4


def test_numbers_are_no_letters(spark):
    df = spark.createDataFrame([(i, "en" if i % 2 else "de", "word text" if i % 2 else "über Öl") for i in range(40)], "doc_id long, lang string, text string")
    model = langid.fit(df)
    odd = spark.createDataFrame([("½ ² ٣",), ("_ 12",), ("é",)], "text string").select(langid.predict(F.col("text"), model).alias("p"))
    assert [r.p.lang == "und" for r in odd.collect()] == [True, True, False]


def test_toxic_sample_is_one_bounded_row_an_id(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.update(texts=texts, labels=labels))
    docs = spark.createDataFrame([(1, "bad " * 40_000)] * 50 + [(i, f"fine {i}") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen["labels"].count(1) == 1 and len(seen["texts"]) == 39
    assert max(map(len, seen["texts"])) <= toxicity.PASSAGES * (toxicity.PASSAGE + 1)


@pytest.mark.parametrize("page", ["<a " * 350_000, "</b " * 250_000, '<a "' * 250_001, "<div>x" * 100_000, "<a><b>x</b>" * 90_000])
def test_damaged_and_nested_pages_take_time_in_proportion(page):
    import time

    start = time.process_time()
    sum(1 for _ in html_text.layout(page))
    assert time.process_time() - start < 10


def test_many_digests_are_dealt_in_time_in_proportion(spark):
    import time

    df = spark.range(100_000).agg(F.collect_list(F.xxhash64("id")).alias("a"))
    start = time.perf_counter()
    row = df.select(P._dealt("a", F.lit(25_000), 1).alias("p")).select(F.size("p").alias("n"), F.size(F.flatten("p")).alias("of")).first()
    assert row.n >= 25_000 and row.of == 100_000 and time.perf_counter() - start < 30


def test_next_text_with_ids_far_apart(spark):
    ids = [*range(4000), 2**62, -5]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.id: r.next for r in P.with_next(df, "doc_id", "text").collect()}
    order = sorted(ids)
    assert got == {i: f"t{j}" for i, j in zip(order, order[1:] + order[:1])}


def test_repeated_ids_are_documents_of_their_own(spark):
    ten = " ".join(f"w{i}" for i in range(10))
    rows = [(5, ten, "x"), (5, f"{ten} {ten}", "x"), (5, "clean text", "x"), (6, None, "x"), (5, ten, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").withColumn("a.b", F.lit(1))
    hits = decontaminate(docs, spark.createDataFrame([(1, ten)], "item_id long, text string")).collect()
    assert sorted((r.id, r.n_words, r.n_hit) for r in hits) == [(5, 2, 0), (5, 10, 10), (5, 10, 10), (5, 20, 20), (6, 0, 0)]
