"""Quality by hierarchical empirical Bayes.

A document's own evidence is a naive Bayes log ratio over binned shape features of its whole text.
Its site adds a prior: the share of good documents of a host is shrunk toward the share of
all, that of a path toward its host's. How strongly is fitted to the spread between sites by the
method of moments, so a host with few labels says little and one without says what all say.

    log odds = log odds of the path's share + evidence

All in DataFrame functions. Labels meet the documents in one join of narrow rows; the
counts by feature, host and path are grouped sums. The table of bins has a fixed size (features times
bins), the sites are joined as stored tables.

Results for odd input: null and empty texts have their own bin; documents without host or path
use the level above; without labels the score is 0.5 and everything is kept; the least label
counts where an id has several; rows that repeat an id are scored alike if their texts agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.session import materialize

BINS = 16


def features(text: Column) -> dict[str, Column]:
    """Bins 0 to ``BINS`` - 1 of each feature; -1 where a text has no characters."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    words = F.regexp_count(t, F.lit(r"\S+"))
    distinct_words = F.size(F.array_distinct(F.split(t, " ")))
    lines = F.split(t, "\n")

    def part(pattern: str) -> Column:
        """Root of the share of characters that are of one kind: small shares are spread out."""
        return F.sqrt(F.length(F.regexp_replace(t, pattern, "")) / n)

    shapes = {
        "length": F.log2(n.cast("double") + 1) / 20,
        "word_length": n / F.greatest(words, F.lit(1)) / 16,
        "symbols": part(r"[\p{L}\p{N}\s.,]+"),
        "capitals": part(r"[^\p{Lu}]+"),
        "digits": part(r"[^0-9]+"),
        "word_variety": distinct_words / F.greatest(words, F.lit(1)),
        "line_variety": F.size(F.array_distinct(lines)) / F.size(lines),
    }
    return {
        k: F.when(n == 0, -1).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(v * BINS)))).cast("int")
        for k, v in shapes.items()
    }


def _strength(groups: DataFrame, k: str, n: str, prior: Column) -> Column:
    """Pseudo-counts that a prior share is worth, from how the groups' shares spread around it.

    The spread beyond what draws of the groups' sizes show by themselves is the sites' own. Between
    1 (sites differ as much as they can) and 1e6 (no difference shows).
    """
    share = F.col(k) / F.col(n)
    inner = prior * (1 - prior)
    between = F.sum(F.col(n) * (F.pow(share - prior, F.lit(2)) - inner / F.col(n))) / F.sum(n)
    within = F.sum(F.col(n) * inner) / F.sum(n)
    return F.greatest(F.lit(1.0), F.least(F.lit(1e6), within / F.greatest(between, F.lit(1e-9)) - 1))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_shares(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """``host, host_share`` and ``host, path, path_share`` of labelled rows, and the share of all."""
    good, n = labelled.agg(F.sum("good"), F.count(F.lit(1))).first()
    overall = ((good or 0) + 1) / (n + 2)
    sums = [F.sum("good").alias("k"), F.count(F.lit(1)).alias("n")]
    hosts = materialize(labelled.filter("host is not null").groupBy("host").agg(*sums), "hosts")
    strength = hosts.agg(_strength(hosts, "k", "n", F.lit(overall))).first()[0] or 1.0
    hosts = hosts.select("host", ((F.col("k") + strength * overall) / (F.col("n") + strength)).alias("host_share"))
    hosts = materialize(hosts, "host-shares")
    paths = labelled.filter("host is not null and path is not null").groupBy("host", "path").agg(*sums)
    paths = materialize(paths.join(hosts, "host"), "paths")
    strength = paths.agg(_strength(paths, "k", "n", F.col("host_share"))).first()[0] or 1.0
    share = (F.col("k") + strength * F.col("host_share")) / (F.col("n") + strength)
    return hosts, materialize(paths.select("host", "path", share.alias("path_share")), "path-shares"), overall


def quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learn: Column | None = None,
    keep_at: float = 0.5,
) -> DataFrame:
    """``id, host, path, host_share, path_share, evidence, score, keep`` of every document.

    ``learn``: a condition on ``id`` that labels must meet to be learnt from.
    """
    names = list(features(F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
        *[v.alias(k) for k, v in features(F.col(text_col)).items()],
    )
    rows = materialize(rows, "quality-rows")
    marks = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    labelled = materialize(rows.join(marks.filter(learn if learn is not None else F.lit(True)), "id"), "labelled")

    hosts, paths, overall = site_shares(labelled)
    good, bad = labelled.agg(F.sum("good"), F.count_if(F.col("good") == 0)).first()
    bins = labelled.select(
        "good", F.inline(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(k).alias("bin")) for k in names]))
    ).groupBy("feature", "bin")
    # Every bin counts as seen once more in the proportions of the classes.
    ratio = F.log((F.sum("good") + overall) / ((good or 0) + overall)) - F.log(
        (F.count_if(F.col("good") == 0) + (1 - overall)) / ((bad or 0) + (1 - overall))
    )
    # At most features * (BINS + 1) numbers.
    known = {(r.feature, r.bin): r.ratio for r in bins.agg(ratio.alias("ratio")).collect()}
    evidence = F.lit(0.0)
    for k in names:
        by_bin = F.array(*[F.lit(float(known.get((k, b), 0.0))) for b in range(-1, BINS)])
        evidence += F.get(by_bin, F.col(k) + 1)
    scored = rows.withColumn("evidence", evidence)
    scored = scored.join(hosts, "host", "left").join(paths, ["host", "path"], "left")
    host_share = F.coalesce("host_share", F.lit(overall))
    path_share = F.coalesce("path_share", "host_share", F.lit(overall))
    odds = _logit(path_share) + F.col("evidence")
    score = F.when(F.lit(bool(good) and bool(bad)), 1 / (1 + F.exp(-odds))).otherwise(F.lit(0.5))
    return scored.select(
        "id", "host", "path", host_share.alias("host_share"), path_share.alias("path_share"), "evidence",
        score.alias("score"), (score >= keep_at).alias("keep"),
    )
