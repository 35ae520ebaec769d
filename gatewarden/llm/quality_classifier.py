"""Quality of documents: a text classifier combined with hierarchical empirical Bayes over sites.

A logistic regression on style and word features, fitted on a bounded sample of
labelled documents, gives every whole text its evidence. Grouped sums of known labels
and predicted probabilities give every host, and every path of a host, a posterior
rate: a path is shrunk towards its host and a host towards all documents, the more so
the fewer documents it has. The strengths of both shrinkages are estimated from the
spread of the groups themselves. A document's prior is its path's rate without its
own share; prior odds times evidence give its probability.

Defined cases: a null text is an empty one; a null source is a site of its own;
repeated rows count as often as they occur; an empty table gives an empty result;
without labels of both classes there is no evidence and every document is kept. Extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.quality_rules import text_counts
from gatewarden.llm.text_batches import slices, unused_names, words_of

#: Labelled documents that the classifier is fitted on at most; chosen by hash of the id.
SAMPLE_DOCUMENTS = 8_000
WORD_BUCKETS = 128
RIDGE = 5.0
NEWTON_STEPS = 25
#: Bounds of a shrinkage's strength, in documents.
STRENGTH = (1.0, 1e6)
_TINY = 1e-6


def _ratio(over, under) -> np.ndarray:
    over, under = np.asarray(over, float), np.asarray(under, float)
    return np.divide(over, under, out=np.zeros(len(over)), where=under > 0)


def text_features(texts: pa.Array) -> np.ndarray:
    """(texts, features): style ratios, whether each is high, and shares of hashed words."""
    counts = text_counts(texts)
    c = {f.name: counts.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(counts.type)}
    symbols, repeats = _ratio(c["n_symbols"], c["n_words"]), _ratio(c["n_repeat_words"], c["n_words"])
    upper, copies = _ratio(c["n_upper"], c["n_chars_all"]), _ratio(c["n_dup_lines"], c["n_lines"])
    mean = _ratio(c["word_chars"], c["n_words"])
    style = np.stack([
        np.log1p(c["n_words"]), np.log1p(symbols), np.minimum(symbols, 0.3), repeats, np.minimum(repeats, 0.3),
        upper, np.minimum(upper, 0.15), copies, np.minimum(copies, 0.3), _ratio(c["n_digits"], c["n_chars_all"]),
        np.minimum(mean, 12), np.maximum(mean - 6, 0).clip(max=6),
    ], axis=1)
    buckets = np.zeros((len(texts), WORD_BUCKETS))
    for part in slices(texts):
        words = words_of(part)
        at = words.row * WORD_BUCKETS + (words.hash % np.uint64(WORD_BUCKETS)).astype(np.int64)
        own = np.bincount(at, minlength=part.rows * WORD_BUCKETS).reshape(part.rows, WORD_BUCKETS)
        buckets[part.first : part.first + part.rows] = own
    return np.concatenate([style, np.sqrt(_ratio_rows(buckets, c["n_words"]))], axis=1)


def _ratio_rows(values: np.ndarray, under: np.ndarray) -> np.ndarray:
    return values / np.maximum(under, 1)[:, None]


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    #: Share of good documents in the sample it was fitted on.
    base: float

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(features: np.ndarray, good: np.ndarray) -> Classifier | None:
    """Ridge logistic regression by Newton steps; None if a class is missing."""
    if not len(good) or good.all() or not good.any():
        return None
    mean, scale = features.mean(0), features.std(0)
    scale[scale == 0] = 1
    x = np.concatenate([(features - mean) / scale, np.ones((len(good), 1))], axis=1)
    y = good.astype(float)
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, w[:-1], float(w[-1]), float(y.mean()))


def known_labels(labels: DataFrame) -> DataFrame:
    """One quality per doc_id: 1 good, 0 bad; contradicting labels count as bad."""
    return (
        labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )


def learn_classifier(docs: DataFrame, labels: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Classifier | None:
    """Fit on at most ``documents`` labelled documents, the same whatever the partitions."""
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array(text_features(texts).tolist(), pa.list_(pa.float64()))

    sample = known_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    # The sample has a fixed bound, so it may be broadcast to the scan of texts.
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .select(F.xxhash64("doc_id").alias("order"), "doc_id", "quality", features("text").alias("x"))
        .orderBy("order", "doc_id", "x").limit(documents)
        .toPandas()
    )
    if rows.empty:
        return None
    return fit(np.stack(rows["x"].tolist()), rows["quality"].to_numpy() == 1)


def site_of(source: Column) -> Column:
    """Host of a url, or the whole name of a source that is none."""
    return F.regexp_extract(source, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]+)", 1)


def path_of(source: Column, section: Column) -> Column:
    """First directory below the host; where a source has none, its ``section`` (sites part languages so)."""
    found = F.regexp_extract(source, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]+/([^/?#]+)", 1)
    return F.when(found != "", found).otherwise(section)


def _strength(groups: DataFrame, towards: Column) -> float:
    """Strength of shrinkage by moments: how much groups differ beyond what their sizes explain.

    ``groups`` has n and good; ``towards`` is the rate each is shrunk to.
    """
    rate = F.col("good") / F.col("n")
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * (rate - towards) ** 2).alias("spread"), F.sum("n").alias("n"),
        F.count("*").alias("groups"), F.sum(F.col("n") * towards).alias("rate"),
    ).first()
    if not row["n"]:
        return STRENGTH[1]
    rate = min(max(row["rate"] / row["n"], _TINY), 1 - _TINY)
    chance = rate * (1 - rate)
    between = row["spread"] / row["n"] - chance * row["groups"] / row["n"]
    return float(np.clip(chance / max(between, chance * _TINY) - 1, *STRENGTH))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - _TINY)), F.lit(_TINY))
    return F.log(p / (1 - p))


def hierarchical_quality(
    docs: DataFrame, labels: DataFrame, site: Column | None = None, path: Column | None = None,
    training: DataFrame | None = None,
) -> DataFrame:
    """One row per document: doc_id, text_key, site, path, evidence, prior, p_quality and kept.

    The classifier is fitted on labelled documents of ``training`` (``docs`` by default).
    """
    site = site_of(F.col("source")) if site is None else site
    path = path_of(F.col("source"), F.col("lang")) if path is None else path
    model = learn_classifier(docs if training is None else training, labels)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(model.probability(text_features(texts)), pa.float64())

    scored = computed_once(
        docs.select(
            "doc_id", F.xxhash64("text").alias("text_key"), site.alias("site"), path.alias("path"),
            (probability("text") if model else F.lit(0.5)).alias("p_document"),
        )
        .join(known_labels(labels), "doc_id", "left")
        .withColumn("share", F.coalesce(F.col("quality").cast("double"), "p_document"))
    )
    sums = [F.count("*").alias("n"), F.sum("share").alias("good")]
    sites = computed_once(scored.groupBy("site").agg(*sums))
    paths = computed_once(scored.groupBy("site", "path").agg(*sums))
    total = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = float(total["good"] / total["n"]) if total["n"] else 0.5
    k_site = _strength(sites, F.lit(overall))
    site_rate = (F.col("site_good") + k_site * overall) / (F.col("site_n") + k_site)
    within = computed_once(
        paths.alias("p").join(
            sites.select(F.col("site").alias("s"), F.col("n").alias("site_n"), F.col("good").alias("site_good")),
            F.col("p.site").eqNullSafe(F.col("s")),
        ).select("site", "path", "n", "good", "site_n", "site_good")
    )
    k_path = _strength(within.withColumn("towards", site_rate), F.col("towards"))
    groups = within.withColumnsRenamed({"site": "own_site", "path": "own_path"})
    # Every rate leaves the document itself out, so that no text is its own prior.
    without_site = (F.col("site_good") - F.col("share") + k_site * overall) / (F.col("site_n") - 1 + k_site)
    without_path = (F.col("good") - F.col("share") + k_path * F.col("site_prior")) / (F.col("n") - 1 + k_path)
    evidence = _logit(F.col("p_document")) - _logit(F.lit(model.base if model else 0.5))
    return (
        scored.join(
            groups, F.col("site").eqNullSafe(F.col("own_site")) & F.col("path").eqNullSafe(F.col("own_path"))
        )
        .withColumn("site_prior", without_site)
        .withColumn("prior", without_path)
        .withColumn("evidence", evidence)
        .withColumn("p_quality", 1 / (1 + F.exp(-(_logit(F.col("prior")) + F.col("evidence")))))
        .select(
            "doc_id", "text_key", "site", "path", "p_document", "evidence", "site_prior", "prior", "p_quality",
            (F.col("p_quality") >= 0.5 if model else F.lit(True)).alias("kept"),
        )
    )


def op2_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: evidence, priors, probability of being good and whether it is kept."""
    return hierarchical_quality(docs, labels).drop("text_key")


def good_documents(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The documents that the classifier keeps, columns unchanged.

    Where an earlier stage has dropped what one class has, ``training`` names the
    documents that have both.
    """
    site, path = site_of(F.col("source")), path_of(F.col("source"), F.col("lang"))
    id_, key, site_, path_ = unused_names(docs.columns, "kept_id", "kept_key", "kept_site", "kept_path")
    kept = hierarchical_quality(docs, labels, site, path, training).where("kept").select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("site").alias(site_), F.col("path").alias(path_)
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key))
        & site.eqNullSafe(F.col(site_)) & path.eqNullSafe(F.col(path_))
    )
    return docs.join(kept, same, "left_semi")
