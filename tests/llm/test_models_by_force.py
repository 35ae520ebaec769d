"""The classifier's priors and the language model's pooling, document by document in plain Python."""

from __future__ import annotations

import json
import math
from collections import defaultdict

import numpy as np
import pytest

from gatewarden.llm import byte_gru, language_id, quality_classifier
from tests.llm.test_filters import documents, labels, some_documents


def strength(groups, lowest=1.0, highest=1e6):
    """Of (n, good, towards): how strongly groups are to be shrunk, by the spread beyond chance."""
    n = sum(g[0] for g in groups)
    spread = sum(k * (good / k - towards) ** 2 for k, good, towards in groups)
    rate = min(max(sum(k * towards for k, _, towards in groups) / n, 1e-6), 1 - 1e-6)
    chance = rate * (1 - rate)
    between = (spread - chance * len(groups)) / n
    return min(max(chance / max(between, chance * 1e-6) - 1, lowest), highest)


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def test_priors_equal_brute_force(spark):
    """Sites of very different rates and sizes, paths that differ within a site, and known labels."""
    rows, marks = some_documents(300)
    sites = ("a.example/x", "a.example/y", "b.example/x", "c.example/z", None)
    rows = [
        (i, t, lang, sites[(i * 7) % 5] if i % 11 else sites[3 if good else 2]) for (i, t, lang, _), (_, good) in zip(rows, marks)
    ]
    known = dict(marks[:150])
    found = quality_classifier.op2_quality_classifier(documents(spark, rows), labels(spark, marks[:150])).collect()
    share = {r.doc_id: float(known[r.doc_id]) if r.doc_id in known else r.p_document for r in found}
    by_site, by_path = defaultdict(list), defaultdict(list)
    for r in found:
        by_site[r.site].append(share[r.doc_id])
        by_path[r.site, r.path].append(share[r.doc_id])
    overall = sum(share.values()) / len(share)
    k_site = strength([(len(v), sum(v), overall) for v in by_site.values()])
    rate = {s: (sum(v) + k_site * overall) / (len(v) + k_site) for s, v in by_site.items()}
    k_path = strength([(len(v), sum(v), rate[s]) for (s, _), v in by_path.items()])
    base = logit(np.mean([known[i] for i in known]))
    assert len(by_path) >= 5 and max(rate.values()) - min(rate.values()) > 0.1
    for r in found:
        site, path, own = by_site[r.site], by_path[r.site, r.path], share[r.doc_id]
        site_prior = (sum(site) - own + k_site * overall) / (len(site) - 1 + k_site)
        prior = (sum(path) - own + k_path * site_prior) / (len(path) - 1 + k_path)
        assert r.site_prior == pytest.approx(site_prior, rel=1e-9)
        assert r.prior == pytest.approx(prior, rel=1e-9)
        p = 1 / (1 + math.exp(-(logit(prior) + logit(r.p_document) - base)))
        assert r.p_quality == pytest.approx(p, rel=1e-6) and r.kept == (r.p_quality >= 0.5)


def language_by_force(model, text):
    """(label, score, bytes by label): every byte's state step by step, one window and direction at a time."""
    data, h = text.encode(), byte_gru.HIDDEN
    probabilities = []
    for begin in range(0, len(data), byte_gru.WINDOW):
        window = data[begin : begin + byte_gru.WINDOW]
        states = np.zeros((2 * h, len(window)))
        for d, order in enumerate((range(len(window)), range(len(window) - 1, -1, -1))):
            state = np.zeros(h)
            for t in order:
                x, u = model.table[d][:, window[t]].astype(float), model.recur[d].astype(float) @ state
                z, r = 1 / (1 + np.exp(-(x[:h] + u[:h]))), 1 / (1 + np.exp(-(x[h : 2 * h] + u[h : 2 * h])))
                state = z * state + (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :])
                states[d * h : (d + 1) * h, t] = state
        for column in states.T:
            e = np.exp(model.out.astype(float) @ column + model.bias[:, 0])
            probabilities.append(e / e.sum())
    mean = np.mean(probabilities, axis=0)
    labelled = np.bincount([int(p.argmax()) for p in probabilities], minlength=len(model.labels))
    return model.labels[int(mean.argmax())], float(mean.max()), {x: int(n) for x, n in zip(model.labels, labelled) if n}


def test_languages_equal_brute_force(spark):
    rows = [(i, "the thing and that " * 10, "en", "s") for i in range(30)]
    rows += [(100 + i, "der und das ein " * 10, "de", "s") for i in range(30)]
    rows += [
        (200, "x", "en", "s"), (201, "der und the and " * 40, None, "s"), (202, "é" * 33 + "the", "en", "s"),
        (203, "a" * 64, "en", "s"), (204, "das " * 16 + "!", "de", "s"),
    ]
    docs = documents(spark, rows)
    model = language_id.learn_languages(docs)
    found = {r.doc_id: r for r in language_id.op4_language_id(docs).collect()}
    for i, text, _, _ in rows[::9] + rows[-5:]:
        label, score, counts = language_by_force(model, text)
        assert found[i].lang_pred == label and found[i].score == pytest.approx(score, abs=1e-4)
        assert json.loads(found[i].label_bytes) == counts
