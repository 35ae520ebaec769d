"""Quality rules, quality classifier and language identification."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gatewarden.llm import byte_gru, language_id, quality_classifier, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, counts string, kept string, site string"
LABELS = "doc_id long, quality int, toxic int, kept string"
SF = "/root/testdata/sf0.01"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "c", "k", "s") for i, t, lang, s in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "k") for i, q in rows], LABELS)


def counts_by_force(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


TEXTS = [
    None, "", "\n", "a", "a\na\nb\n\na", "a a a a", "é ß\n é ß", "x|y # <z>", "a b c\r\na b c\r\n", "\n\nend",
    "one two three four one two three five one two three", "a\x0bb\x1cc",
]


def some_documents(n: int = 400, seed: int = 1):
    """Clean texts, and junk of three kinds, labelled."""
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghijk", k=rng.randint(2, 8))) for _ in range(rng.randint(60, 120))]
        bad = i % 5 == 0
        if bad:
            kind = i // 5 % 2
            words = [w + "###" for w in words] if kind else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en", f"src{i % 7}"))
        marks.append((i, 0 if bad else 1))
    return rows, marks


@pytest.mark.parametrize("limit", [1, 20, 1 << 20])
def test_counts_equal_brute_force(monkeypatch, limit):
    rng = random.Random(7)
    more = ["".join(rng.choices("ab \n\t#é", k=rng.randint(0, 60))) for _ in range(300)]
    texts = TEXTS + more
    whole = quality_rules.slices
    monkeypatch.setattr(quality_rules, "slices", lambda t: whole(t, limit))
    found = quality_rules.text_counts(pa.array(texts, pa.string())).to_pylist()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in found] == [counts_by_force(t) for t in texts]


def test_rules_reject_junk_and_keep_the_clean(spark):
    rows, marks = some_documents()
    docs = documents(spark, rows)
    known = labels(spark, marks[:300])
    found = {r.doc_id: r for r in quality_rules.op9_quality_rules(docs, known).collect()}
    wrong = [i for i, good in marks if found[i].kept != bool(good)]
    assert len(wrong) <= 4 and not any(found[i].base_failed for i, good in marks if good)
    kept = quality_rules.kept_documents(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


def test_rules_equal_their_expressions(spark):
    rows, marks = some_documents(150)
    counted = quality_rules.with_counts(documents(spark, rows), "own").select("doc_id", F.col("own").alias("counts"))
    rules = quality_rules.rules_from_labels(counted, labels(spark, marks))
    assert rules and all(str(c) for rule in rules for c in rule)
    found = counted.withColumn("rule", quality_rules.rejecting_rule(rules, F.col("counts"))).collect()
    for r in found:
        c = r.counts
        values = {
            k: np.array([c[a] / c[b] if c[b] else 0.0]) for k, (a, b) in quality_rules.RATIOS.items()
        }
        expected = next((n for n, rule in enumerate(rules, 1) if all(x.holds(values)[0] for x in rule)), None)
        assert r.rule == expected


def test_rules_edges(spark):
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(TEXTS)] + [(None, "x " * 60, None, None)] * 2)
    found = quality_rules.op9_quality_rules(docs, labels(spark, [(None, 1), (3, None), (4, 1)])).collect()
    assert len(found) == len(TEXTS) + 2
    assert not any(r.kept for r in found if r.doc_id is not None)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert quality_rules.op9_quality_rules(docs.where("false"), labels(spark, [])).count() == 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    seen = known.where("doc_id % 2 = 0")
    found = quality_classifier.op2_quality_classifier(docs, seen)
    truth = known.where("doc_id % 2 = 1").select("doc_id", "quality")
    rows = found.join(truth, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) >= 0.97
    assert np.mean([r.kept for r in rows if r.quality == 1]) >= 0.98
    assert all(0 <= r.p_quality <= 1 for r in rows)


def test_sparse_sites_shrink_towards_the_rest(spark):
    rows, marks = some_documents(400)
    # One site is mostly junk, one has a single document.
    rows = [(i, t, lang, "bad.example/a" if not good else "good.example/b") for (i, t, lang, _), (_, good) in zip(rows, marks)]
    rows.append((1000, rows[1][1] + " more", "en", "rare.example/c"))
    found = {r.doc_id: r for r in quality_classifier.op2_quality_classifier(documents(spark, rows), labels(spark, marks)).collect()}
    good_site, bad_site, rare = found[1], found[0], found[1000]
    assert bad_site.site == "bad.example" and bad_site.path == "a"
    assert bad_site.prior < 0.2 < 0.8 < good_site.prior
    assert bad_site.prior < rare.prior < good_site.prior
    kept = quality_classifier.good_documents(documents(spark, rows), labels(spark, marks))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    assert kept.columns == documents(spark, rows).columns


def test_classifier_edges(spark):
    docs = documents(spark, [(1, None, None, None), (1, None, None, None), (None, "", "en", ""), (2, "word " * 20_000, "en", "http://h/p/q")])
    without = quality_classifier.op2_quality_classifier(docs, labels(spark, [(1, None)]))
    assert [r.kept for r in without.collect()] == [True] * 4
    assert quality_classifier.op2_quality_classifier(docs, labels(spark, [(1, 0), (2, 1)])).count() == 4
    assert quality_classifier.good_documents(docs, labels(spark, [])).count() == 4
    assert quality_classifier.op2_quality_classifier(docs.where("false"), labels(spark, [])).count() == 0


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    model = byte_gru.ByteGru.fresh(("a", "b", "c"))
    for name in ("table", "recur"):
        setattr(model, name, [w.astype(np.float64) for w in getattr(model, name)])
    windows = rng.integers(0, 256, (6, 5)).astype(np.int16)
    windows[4:, 0] = byte_gru.PAD
    target, weight = np.array([0, 1, 2, 1, 0]), np.array([1.0, 0.5, 2.0])
    _, grads = byte_gru.gradients(model, windows, target, weight)
    for w, g in zip(model.weights(), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if w.shape[1] == 257:
                at = (at[0], int(windows[rng.integers(0, 4), rng.integers(0, 5)]))
            old = w[at]
            step = 1e-2
            w[at] = old + step
            up = byte_gru.gradients(model, windows, target, weight)[0]
            w[at] = old - step
            down = byte_gru.gradients(model, windows, target, weight)[0]
            w[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], abs=2e-3)


def test_padding_changes_nothing():
    model = byte_gru.ByteGru.fresh(("a", "b"))
    texts = [b"short", b"", b"x" * 200, b"another text"]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    together, counted = byte_gru.pooled(model, data, offsets)
    for k, text in enumerate(texts):
        alone, _ = byte_gru.pooled(model, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert together[k] == pytest.approx(alone[0], abs=1e-5)
    assert counted.sum(1).tolist() == [len(t) for t in texts]


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.op4_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 250
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(i, "the thing and that " * 10, "en", "s") for i in range(30)]
    rows += [(100 + i, "der und das ein " * 10, "de", "s") for i in range(30)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "123 ...", "en", "s"), (None, "der und das", None, "s"), (1, "the thing", "en", "s")]
    docs = documents(spark, rows)
    found = language_id.op4_language_id(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i in (200, 201, 202):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].lang_pred == "de" and by_id[None].held_out
    assert all(r.lang_pred in ("en", "de", "und") for r in found)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.op4_language_id(unlabelled).collect()} == {"und"}
    assert language_id.op4_language_id(docs.where("false")).count() == 0
