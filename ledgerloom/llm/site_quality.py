"""Document quality by hierarchical empirical Bayes over sites.

A classifier of the text alone (logistic regression on counts of words, symbols and repeats,
fitted to labelled documents) gives each document's evidence. The expected number of good documents
is added up by host and by path below it, over all documents. A host's rate is shrunk towards that of
the whole table, a path's towards that of its host, the more the fewer documents it has; how
strongly is estimated from how much rates differ between sites beyond chance. A document's
score combines the rate of its path, without its own share, with its own evidence.

Defined results: a null, empty or word-less text is judged on its counts of 0; null hosts and paths
are sites of their own; without labelled rows of both kinds the evidence is neutral and every
score is one half; repeated rows are rows of their own; a very long text is counted whole; an empty table gives an empty one.
The result has its own columns only, so those of ``docs`` may have any names.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_counts
from .runs import same
from .sampling import fold
from .scratch import stored

#: Most rows of each label in the training sample; only their counts reach the driver.
SAMPLE = 2000
FEATURES = 6
#: Bounds of how many documents the parent's rate counts for.
STRENGTH = (1.0, 1000.0)


def features(text: Column) -> Column:
    """Numbers between about 0 and 5 that tell junk from prose."""
    c = text_counts(text)
    words, lines = F.greatest(c["words"]["n_words"], F.lit(1)), F.greatest(c["lines"]["n_lines"], F.lit(1))
    length = c["words"]["word_chars"] / words
    return F.array(
        F.lit(1.0),
        F.least(c["n_symbols"] / words, F.lit(1.0)),
        c["words"]["n_repeat_words"] / words,
        c["lines"]["n_dup_lines"] / lines,
        F.least(F.abs(length - 5), F.lit(10.0)) / 2,
        F.log10(words),
    )


def fit(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Ridge logistic regression by Newton's method; both labels weigh the same, so that the
    logit is evidence for or against, without a prior."""
    if not y.any() or y.all():
        return [0.0] * FEATURES
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    b, ridge = np.zeros(FEATURES), 1e-4 * np.eye(FEATURES)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in b]


def train(measured: DataFrame, labels: DataFrame, label: str) -> list[float]:
    known = labels.where(fold() > 0).groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).withColumn("_order", F.xxhash64("doc_id"))
    rows = []
    for value in (0, 1):
        chosen = known.where(F.col("y") == value).orderBy("_order", "doc_id").limit(SAMPLE).withColumnRenamed("doc_id", "id")
        # at most SAMPLE rows are broadcast
        found = measured.join(F.broadcast(chosen), "id").orderBy("_order", "id", "x").limit(SAMPLE)
        rows += found.select("x", "y").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, FEATURES)
    return fit(x, np.array([r.y == 1 for r in rows], bool))


def strength(sites: DataFrame, parent: Column) -> float:
    """How many documents the parent's rate stands for, by the method of moments: what the
    rates of sites differ from their parents' beyond what counts of their size differ by chance."""
    m = F.greatest(F.least(parent, F.lit(1 - 1e-6)), F.lit(1e-6))
    chance = m * (1 - m)
    sums = sites.agg(
        F.sum(F.col("n") * ((F.col("good") / F.col("n") - m) ** 2 / chance)).alias("excess"),
        F.sum(F.lit(1)).alias("sites"),
        F.sum("n").alias("n"),
    ).first()
    if not sums.sites or sums.n <= sums.sites:
        return STRENGTH[1]
    # E[excess] = sites + (n - sites) * r, with r = 1 / (strength + 1)
    r = (sums.excess - sums.sites) / (sums.n - sums.sites)
    return float(min(max(1 / r - 1, STRENGTH[0]), STRENGTH[1])) if r > 0 else STRENGTH[1]


def with_site(docs: DataFrame, url_column: str, host_column: str = "host", path_column: str = "path", levels: int = 1) -> DataFrame:
    """``docs`` with the host of an address and the first ``levels`` folders of its path; null where it is
    none. What stands behind those folders (a page's own name, a query) names no site."""
    url = F.trim(F.col(url_column))
    folders = F.split(F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "^/+", ""), "/+")
    # the last part is the page itself
    path = F.array_join(F.slice(folders, F.lit(1), F.least(F.lit(levels), F.size(folders) - 1)), "/")
    return docs.withColumns({host_column: F.lower(F.try_parse_url(url, F.lit("HOST"))), path_column: path})


def page_text(html: Column) -> Column:
    """What a page shows, without scripts, styles, comments and tags."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(shown, r"(?i)</(p|h[1-6]|li|div)>|<br\s*/?>", "\n"), r"<[^>]*>", " ")


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_column: str = "lang",
    label: str = "quality",
) -> DataFrame:
    """One row per document: its id, ``host``, ``path``, ``evidence`` (log-odds of the text alone),
    ``host_rate``, ``path_rate`` (posterior means), ``score`` (0 to 1) and ``kept``."""
    measured = stored(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(host_column).alias("host"),
            F.col(path_column).alias("path"),
            features(F.col(text_column)).alias("x"),
        ),
        "features",
    )
    weights = train(measured, labels, label)
    logit = sum((F.get("x", F.lit(i)) * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0))
    judged = measured.select("id", "host", "path", F.greatest(F.least(logit, F.lit(15.0)), F.lit(-15.0)).alias("evidence"))
    judged = judged.withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))

    paths = stored(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "hosts")
    whole = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    overall = F.lit(0.5 if whole is None else float(whole))
    by_host = strength(hosts, overall)
    hosts = stored(
        hosts.withColumn("host_rate", (F.col("good") + by_host * overall) / (F.col("n") + by_host)).select("host", "host_rate"), "hosts"
    )
    paths = stored(same(paths, hosts, "host"), "paths")
    by_path = strength(paths, F.col("host_rate"))
    placed = same(judged, paths, "host", "path")
    # the document's own share is taken out of the rate it is combined with
    rate = (F.col("good") - F.col("p") + by_path * F.col("host_rate")) / (F.col("n") - 1 + by_path)
    rate = F.greatest(F.least(rate, F.lit(1 - 1e-6)), F.lit(1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(rate / (1 - rate)))))
    return placed.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "evidence",
        "host_rate",
        ((F.col("good") + by_path * F.col("host_rate")) / (F.col("n") + by_path)).alias("path_rate"),
        score.alias("score"),
        (score >= 0.5).alias("kept"),
    )
