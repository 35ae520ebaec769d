"""Learned decision lists: threshold conjunctions that reject documents.

Statistics of every whole text are counted in one pass. Sequential covering on
a bounded sample of labelled statistics grows a conjunction of thresholds by
information gain, prunes it on held-back rows, keeps it if it is precise enough,
removes what it covers and goes on. The list is emitted as one ordered Spark
``when(...).when(...).otherwise(...)`` expression, so applying it needs no Python.

Defined cases: a null text counts as one without words and is rejected by the
fixed floor of words; repeated rows and repeated doc_ids each keep their own row;
an empty table gives an empty result; without labels of both classes the list is
empty and only the fixed rules decide. Extra columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.text_batches import range_hashes, row_sums, slices, unused_names, window_hashes, words_of

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_chars_all")
STATS_TYPE = "struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">"

#: Labelled rows the list is learned from at most; the choice is by hash of the id.
SAMPLE_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Share of rejected among the rows a rule covers, on the rows that pruned it.
MIN_PRECISION = 0.9
MIN_COVERED = 5
THRESHOLDS = 24

#: Ratios the rules test; written once for Spark and once for numpy, from the same parts.
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "n_chars_all"),
    "digit_share": ("n_digits", "n_chars_all"),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _repeated(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many equal (row, key) there are of each, aligned with the input."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    group = np.cumsum(new) - 1
    count = np.bincount(group)
    out = np.empty(len(k), np.int64)
    out[order] = count[group]
    return out


def _slice_counts(part) -> dict[str, np.ndarray]:
    words = words_of(part)
    n = part.rows
    lead = (part.data & 0xC0) != 0x80  # first byte of a code point
    out = {"n_words": np.bincount(words.row, minlength=n)}
    # Code points between the first and last byte of each word.
    points = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum(lead, out=points[1:])
    out["word_chars"] = np.bincount(
        words.row, weights=points[words.end] - points[words.start], minlength=n
    ).astype(np.int64)
    out["n_symbols"] = row_sums(_SYMBOL[part.data], part.offsets)
    out["n_upper"] = row_sums(_UPPER[part.data], part.offsets)
    out["n_digits"] = row_sums(_DIGIT[part.data], part.offsets)
    out["n_chars_all"] = row_sums(lead, part.offsets)

    first, windows = window_hashes(words, 3)
    covered = np.zeros(len(words.row), bool)
    if len(first):
        again = first[_repeated(windows, words.row[first]) > 1]
        for k in range(3):
            covered[again + k] = True
    out["n_repeat_words"] = np.bincount(words.row[covered], minlength=n)

    breaks = np.flatnonzero(part.data == 10)
    start = np.union1d(breaks + 1, part.offsets[:-1])
    start = start[start < len(part.data)]
    end = np.append(start[1:], len(part.data))
    # A line ends before its \n, or where the row ends.
    ends_in_break = (end > start) & (part.data[end - 1] == 10) if len(start) else np.zeros(0, bool)
    end = end - ends_in_break
    row = np.searchsorted(part.offsets, start, "right") - 1
    has_word = np.zeros(len(start), bool)
    has_word[np.searchsorted(start, words.start, "right") - 1] = True
    start, end, row = start[has_word], end[has_word], row[has_word]
    out["n_lines"] = np.bincount(row, minlength=n)
    hashed = range_hashes(part.data, start, end)
    distinct = np.unique(np.stack([row.astype(np.uint64), hashed]), axis=1)[0].astype(np.int64) if len(row) else row
    out["n_dup_lines"] = out["n_lines"] - np.bincount(distinct, minlength=n)
    return out


def text_counts(texts: pa.Array) -> pa.Array:
    """The counts of each text of a batch as structs."""
    parts = [_slice_counts(part) for part in slices(texts)]
    fields = [
        pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0), pa.int64())
        for c in COUNTS
    ]
    return pa.StructArray.from_arrays(fields, list(COUNTS))


def with_counts(docs: DataFrame, name: str = "counts", text: str = "text") -> DataFrame:
    """The documents with one more column, the struct of counts."""
    @F.arrow_udf(STATS_TYPE)
    def counted(texts: pa.Array) -> pa.Array:
        return text_counts(texts)

    return docs.withColumn(name, counted(F.col(text)))


@dataclass(frozen=True)
class Condition:
    ratio: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.ratio]
        return x >= self.threshold if self.at_least else x <= self.threshold

    def column(self, counts: Column) -> Column:
        over, under = RATIOS[self.ratio]
        x = F.coalesce(
            F.try_divide(counts[over].cast("double"), counts[under].cast("double")), F.lit(0.0)
        )
        return x >= self.threshold if self.at_least else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.ratio} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return -np.inf
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0 or not n0:
            break
        best, chosen = 0.0, None
        for ratio, x in values.items():
            # Midpoints between quantiles, and every border between the classes' extremes.
            cuts = np.unique(np.quantile(x[inside & bad], np.linspace(0, 1, THRESHOLDS)))
            for cut in cuts:
                for at_least in (True, False):
                    condition = Condition(ratio, at_least, float(cut))
                    covered = inside & condition.holds(values)
                    p = int((covered & bad).sum())
                    gain = _gain(p, int(covered.sum()) - p, p0, n0)
                    if gain > best + 1e-9:
                        best, chosen = gain, condition
        if chosen is None:
            break
        rule += (_between_classes(chosen, values, inside, bad),)
        inside &= rule[-1].holds(values)
    return rule


def _between_classes(c: Condition, values, inside, bad) -> Condition:
    """Moves a threshold to the middle of the gap towards the next kept row."""
    x = values[c.ratio]
    outside = x[inside & ~bad & ~c.holds(values)]
    if not len(outside):
        return c
    near = outside.max() if c.at_least else outside.min()
    between = x[inside & bad & ~c.holds(values)]
    if len(between):
        edge = between.max() if c.at_least else between.min()
        near = max(near, edge) if c.at_least else min(near, edge)
    return Condition(c.ratio, c.at_least, float((near + c.threshold) / 2))


def _pruned(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix of the rule that is best on held-back rows, its precision and coverage."""
    best: tuple[float, Rule, float, int] = (-np.inf, rule, 0.0, 0)
    for size in range(len(rule), 0, -1):
        covered = _covers(rule[:size], values, len(bad))
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        worth = (p - n) / max(1, p + n)
        if worth > best[0]:
            best = (worth, rule[:size], p / max(1, p + n), p)
    return best[1:]


def learn_rules(counts: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Sequential covering; ``bad`` marks the rows to reject. Deterministic."""
    values = {}
    for ratio, (over, under) in RATIOS.items():
        below = counts[under].astype(float)
        values[ratio] = np.divide(
            counts[over].astype(float), below, out=np.zeros(len(below)), where=below > 0
        )
    held = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grow, prune = left & ~held, left & held
        if (grow & bad).sum() < MIN_COVERED:
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule, precision, covered = _pruned(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        if precision < MIN_PRECISION or not covered:
            break
        rules.append(rule)
        left &= ~_covers(rule, values, len(bad))
    return rules


def rejecting_rule(rules: list[Rule], counts: Column) -> Column:
    """Number of the first rule that rejects, from 1; null if none does."""
    out: Column | None = None
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column(counts)
        for condition in rule[1:]:
            holds = holds & condition.column(counts)
        out = F.when(holds, number) if out is None else out.when(holds, number)
    return F.lit(None).cast("int") if out is None else out.otherwise(F.lit(None).cast("int"))


def base_failed(counts: Column) -> Column:
    """Fixed rules: too few words, or most words in repeated three-word windows."""
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def labelled_sample(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, quality of at most ``sample_rows`` labelled documents, chosen by hash of the id."""
    return (
        labels.select("doc_id", "quality")
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )


def rules_from_labels(counted: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most ``sample_rows`` labelled documents that pass the fixed rules.

    ``counted`` has doc_id and counts, ``labels`` doc_id and quality (1 keep, 0
    reject; null is no label). The sample is chosen by hash of the id, so it
    is the same whatever the partitions.
    """
    rows = (
        counted.join(labelled_sample(labels, sample_rows), "doc_id")
        .where(~base_failed(F.col("counts")))
        .select(F.xxhash64("doc_id").alias("order"), "doc_id", "quality", "counts.*")
        .orderBy("order", "doc_id", *COUNTS).limit(sample_rows)
        .toPandas()
    )
    counts = {c: rows[c].to_numpy(np.int64) for c in COUNTS}
    return learn_rules(counts, rows["quality"].to_numpy() == 0)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document; ``rule`` is the rejecting one, if any."""
    counted = computed_once(with_counts(docs.select("doc_id", "text")).select("doc_id", "counts"))
    rule = rejecting_rule(rules_from_labels(counted, labels), F.col("counts"))
    return (
        counted.withColumn("base_failed", base_failed(F.col("counts")))
        .withColumn("rule", rule)
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def op9_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the contract's counts, verdicts and the rejecting rule."""
    return quality_rules(docs, labels).select(
        "doc_id", "counts.n_words", "counts.word_chars", "counts.n_symbols",
        "counts.n_dup_lines", "counts.n_repeat_words", "base_failed", "kept", "rule",
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither a fixed nor a learned rule rejects, columns unchanged."""
    # Only the sample is counted to learn from; its ids are at most SAMPLE_ROWS.
    learned = docs.select("doc_id", "text").join(F.broadcast(labelled_sample(labels).select("doc_id")), "doc_id", "left_semi")
    counted = with_counts(learned).select("doc_id", "counts")
    rules = rules_from_labels(computed_once(counted), labels)
    (own,) = unused_names(docs.columns, "counts")
    judged = with_counts(docs, own)
    rejected = base_failed(F.col(own)) | rejecting_rule(rules, F.col(own)).isNotNull()
    return judged.where(~rejected).drop(own)
