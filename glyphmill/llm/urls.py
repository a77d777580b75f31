"""URL filters: rules, and for the rest a ratio of two character language models.

The rules' verdicts are the training labels: accepted and rejected URLs each give a Markov model of
variable order. A character's probability mixes the counts after its last five, four, ... no
characters, each order leaning on the next lower one where it has seen little. The score is the
mean over the characters of the log ratio of the two models, so long URLs are judged like short ones.
The characters are those of the whole URL, with scheme and host lower-cased; rules see host and path alone.
The threshold is calibrated on a fold of the labelled URLs that is kept out of the models.

All counts are over every labelled URL and grow with them. They stay in tables: URLs become rows of
their character windows, each distinct window is scored once by joins with the counts, and the
scores are summed by URL. Windows of a host that has a third of all rows are counted before any
shuffle; the scored windows are stored, so Spark can split a hot join or broadcast the smaller side.

Results for odd input: a URL that is null or has no ``://`` has empty host and path, fits no
rule, and scores as the threshold, which allows it; without labels of both verdicts every other URL is
allowed; rows that repeat an id share a verdict only if their URLs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.shared import ascii_lower, fold_of
from glyphmill.session import materialize

ORDER = 5
LEAN = 2.0  # how many sightings a lower order's opinion is worth
ALPHABET = 256.0
FOLDS, HELD_OUT = 4, 3
STEPS = 400  # thresholds tried
_START = "\x02"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def text_of(url: Column) -> Column:
    """The whole URL as the models read it."""
    url = F.coalesce(url, F.lit(""))
    start = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1))
    return F.concat(start, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits; a rule names a host with its subdomains and the start of a path."""
    fitting = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, start = rule.partition("/")
        own = (host == domain) | F.endswith(host, F.lit(f".{domain}"))
        fitting = F.when(own & F.startswith(path, F.lit(f"/{start}")), rule).otherwise(fitting)
    return fitting


def _windows(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row for each character of ``text``: ``window`` has it and the ``ORDER`` characters before."""
    padded = F.concat(F.lit(_START * ORDER), F.col(text))
    n = F.length(text)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(places, lambda i: F.substr(padded, i, F.lit(ORDER + 1)))
    return df.select(*keep, F.explode(windows).alias("window"))


def _tails(windows: DataFrame, keep: list[str]) -> DataFrame:
    """Each window's last 1 to ``ORDER`` + 1 characters as ``gram``."""
    grams = F.transform(F.sequence(F.lit(1), F.lit(ORDER + 1)), lambda k: F.right(F.col("window"), k))
    return windows.select(*keep, F.explode(grams).alias("gram"))


def counts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sightings in either class: ``gram, yes, no``, and ``context, all_yes, all_no`` of what precedes a character."""
    windows = _windows(labelled, "text", ["good"]).groupBy("good", "window").agg(F.count(F.lit(1)).alias("n"))
    grams = _tails(windows, ["good", "n"]).groupBy("gram").agg(
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("good"), 0).otherwise(F.col("n"))).alias("no"),
    )
    grams = materialize(
        grams.withColumn("context", F.expr("substr(gram, 1, length(gram) - 1)")), "url-grams"
    )
    contexts = grams.groupBy("context").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    return grams.select("gram", "yes", "no"), materialize(contexts, "url-contexts")


def window_scores(windows: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """``window, ratio`` of each distinct window: its character's log ratio of the two models."""
    distinct = windows.select("window").distinct()
    tails = distinct.select(
        "window",
        F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(ORDER + 1)), lambda k: F.right(F.col("window"), k))).alias(
            "order", "gram"
        ),
    ).withColumn("context", F.expr("substr(gram, 1, length(gram) - 1)"))
    found = tails.join(grams, "gram", "left").join(contexts, "context", "left")
    found = found.fillna(0, ["yes", "no", "all_yes", "all_no"])
    by_window = found.groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct("order", "yes", "no", "all_yes", "all_no"))).alias("orders")
    )  # ORDER + 1 entries

    def probability(n: str, total: str) -> Column:
        return F.aggregate(
            "orders", F.lit(1 / ALPHABET), lambda lower, o: (o[n] + LEAN * lower) / (o[total] + LEAN)
        )

    ratio = F.log(probability("yes", "all_yes")) - F.log(probability("no", "all_no"))
    return materialize(by_window.select("window", ratio.alias("ratio")), "url-window-scores")


def url_scores(urls: DataFrame, good: Column, fold: Column) -> tuple[DataFrame, float]:
    """``row, score`` of the rows of ``urls``, and the threshold from which a score is accepted.

    ``urls`` is stored and has ``row``, a number of its own, and ``text``. ``good`` is null where no rule judges.
    """
    marked = urls.withColumn("good", good).withColumn("fold", fold)
    learnt = marked.filter(F.col("good").isNotNull() & (F.col("fold") != HELD_OUT))
    if learnt.select("good").distinct().count() < 2:
        return urls.select("row", F.lit(0.0).alias("score")), 0.0
    grams, contexts = counts(learnt)
    asked = marked.filter(F.col("good").isNull() | (F.col("fold") == HELD_OUT))
    windows = _windows(asked, "text", ["row"])
    scored = windows.join(window_scores(windows, grams, contexts), "window")
    scores = materialize(scored.groupBy("row").agg(F.avg("ratio").alias("score")), "url-scores")

    # The best parting of the labelled scores, by counts in at most STEPS bins of each verdict.
    judged = scores.join(asked.filter(F.col("good").isNotNull()).select("row", "good"), "row")
    low, high = judged.agg(F.min("score"), F.max("score")).first()
    if low is None or low == high:
        return scores, 0.0
    width = (high - low) / STEPS
    place = F.least(F.floor((F.col("score") - low) / width), F.lit(STEPS - 1))
    tally = {(r.good, r.bin): r.n for r in judged.groupBy("good", place.alias("bin")).agg(F.count("*").alias("n")).collect()}
    totals = {g: sum(n for (x, _), n in tally.items() if x == g) or 1 for g in (True, False)}
    missed, alarms, best = 0.0, 1.0, []
    for b in range(STEPS + 1):  # accept from bin b on
        best.append((missed + alarms, b))
        missed += tally.get((True, b), 0) / totals[True]
        alarms -= tally.get((False, b), 0) / totals[False]
    least = min(best)[0]
    good_cuts = [b for error, b in best if error <= least + 1e-9]
    return scores, low + width * (good_cuts[0] + good_cuts[-1]) / 2


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``id, host, path, rule, score, verdict`` of every row.

    ``rules``: pairs of a rule like ``example.com/en/`` and ``allow`` or ``block``; the longest that fits wins,
    and the models judge the rest.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(
        F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), text_of(F.col(url_col)).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = materialize(rows, "urls")
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule]) if rules else F.create_map().cast("map<string,string>")
    verdict = verdicts[F.col("rule")]
    scores, threshold = url_scores(rows, verdict == "allow", F.coalesce(fold_of(F.col("id"), FOLDS), F.lit(0)))
    judged = rows.join(scores, "row", "left")
    by_score = F.when(F.coalesce("score", F.lit(threshold)) >= threshold, "allow").otherwise("block")
    return judged.select("id", "host", "path", "rule", "score", F.coalesce(verdict, by_score).alias("verdict"))
