"""Near-copies of texts and vectors against brute force, and their edge cases."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gatewarden.llm import embedding_dedup, minhash_dedup
from gatewarden.llm.components import connected
from gatewarden.llm.prob_minhash import probability_jaccard, signatures, weighted_shingles
from gatewarden.llm.text_batches import slices, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, rep long, bands long"
VECTORS = "vec_id long, embedding array<float>, label int, rep long, links long, vector string"


def some_text(rng: random.Random, words: int) -> list[str]:
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(words)]


def near_copies(seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        base = some_text(rng, rng.randint(20, 150))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "x" + str(rng.randint(0, 99))
            texts.append(" ".join(copy))
    return texts


def shingle_set(text: str | None) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def classes_by_force(ids: list[int], texts: list[str | None]) -> dict[int, int]:
    sets = [shingle_set(t) for t in texts]
    root = dict(zip(ids, ids))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) / len(a | b) >= 0.8:
                x, y = find(ids[i]), find(ids[j])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1, 2) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def test_words_are_those_of_the_pattern():
    texts = ["a b", "", None, "é\x0b\x0cß x  ", "\n\n", "one", " two"]
    for limit in (1, 6, 1000):
        found = []
        for part in slices(pa.array(texts), limit):
            words = words_of(part)
            for row in range(part.rows):
                own = words.row == row
                found.append([
                    part.data[a:b].tobytes().decode() for a, b in zip(words.start[own], words.end[own])
                ])
        assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_signatures_estimate_the_probability_jaccard():
    rng = np.random.default_rng(1)
    a = np.sort(rng.choice(10_000, 300, replace=False)).astype(np.uint64)
    b = np.sort(np.concatenate([a[:240], rng.choice(np.arange(20_000, 30_000), 60, replace=False).astype(np.uint64)]))
    wa, wb = 1 + rng.integers(0, 3, len(a)) / 2, 1 + rng.integers(0, 3, len(b)) / 2
    row = np.repeat([0, 1], [len(a), len(b)])
    registers = 4_000
    signed = signatures(row, np.concatenate([a, b]), np.concatenate([wa, wb]), 2, registers)
    exact = probability_jaccard(a, wa, b, wb)
    total = {x: (dict(zip(a.tolist(), wa)).get(x, 0), dict(zip(b.tolist(), wb)).get(x, 0)) for x in {*a.tolist(), *b.tolist()}}
    by_force = sum(
        1 / sum(max(p / x, q / y) for p, q in total.values()) for x, y in total.values() if x and y
    )
    assert exact == pytest.approx(by_force)
    assert (signed[0] == signed[1]).mean() == pytest.approx(exact, abs=5 * math.sqrt(0.25 / registers))


def test_equal_weights_give_the_plain_jaccard():
    part = next(slices(pa.array(["a b c d e f g h", "a b c d e f g x"])))
    row, element, weight = weighted_shingles(part)
    one, two = (element[row == k] for k in (0, 1))
    assert probability_jaccard(one, weight[row == 0], two, weight[row == 1]) == pytest.approx(3 / 5)


@pytest.mark.parametrize("block", [256, 3])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    texts = near_copies()
    found = {r.doc_id: r for r in minhash_dedup.op1_prob_minhash(documents(spark, texts)).collect()}
    expected = classes_by_force(list(found), [texts[i] for i in found])
    assert {i: r.class_id for i, r in found.items()} == expected
    assert {i for i, r in found.items() if r.kept} == set(expected.values())


def test_documents_edges(spark):
    long = " ".join(some_text(random.Random(1), 30_000))
    texts = [None, "", " \n", "one two", "one two", "one  two", long, long + " end", "x y z"]
    docs = documents(spark, texts)
    again = docs.union(docs.where("doc_id in (3, 8)")).union(spark.createDataFrame([(None, "x y z", "en", "s", 5, "", 0, 0)], DOCS))
    rows = minhash_dedup.op1_prob_minhash(again).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(texts) + 3
    assert [by_id[i][0].class_id for i in (0, 1, 2)] == [0, 1, 2]
    assert by_id[4][0].class_id == by_id[5][0].class_id == by_id[3][0].class_id == 3
    assert by_id[7][0].class_id == 6
    assert by_id[None][0].class_id == 8 and not by_id[None][0].kept
    assert sum(r.kept for r in by_id[3]) == sum(r.kept for r in by_id[8]) == 1
    kept = minhash_dedup.without_near_duplicates(again)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 6, 8]
    empty = minhash_dedup.op1_prob_minhash(docs.where("false"))
    assert empty.count() == 0


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 150)]
    noise = [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    links = chain + star + noise + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in chain + star + noise for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in chain + star + noise:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert found == {x: find(x) for x in root if find(x) != x}


def vectors_by_force(rows):
    out = {}
    for n, (i, v, label) in enumerate(rows):
        links = [
            m for m, (_, w, other) in enumerate(rows)
            if m != n and label is not None and label == other and v and w and len(v) == len(w)
            and all(x is not None and math.isfinite(x) for x in [*v, *w]) and any(v) and any(w)
            and np.dot(np.float32(v).astype(float), np.float32(w).astype(float))
            / np.linalg.norm(np.float32(v).astype(float)) / np.linalg.norm(np.float32(w).astype(float)) >= 0.93
        ]
        out[n] = links
    return out


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = []
    for group in range(30):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 30 if group == 0 else 6)):
            # Cosines on both sides of the threshold.
            v = base + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.2, 0.28, 0.4])
            rows.append((len(rows), [float(x) for x in np.float32(v)], group % 3))
    rows += [(len(rows) + k, v, label) for k, (v, label) in enumerate([
        (None, 1), ([], 1), ([0.0] * 32, 1), ([float("nan")] * 32, 1), ([None] + [1.0] * 31, 1), ([float("inf")] * 32, 1),
        (rows[0][1], None), (rows[0][1], 0), ([2 * x for x in rows[0][1]], 0), ([1.0, 2.0], 0), ([1.0, 2.0], 0), ([2.0, 4.0], 0),
        ([1e-30] * 32, 2), ([1e30] * 32, 2),
    ])]
    frame = spark.createDataFrame([(i, v, label, 1, 2, "x") for i, v, label in rows], VECTORS)
    found = {r.vec_id: r for r in embedding_dedup.op6_embedding_dedup(frame).collect()}
    links = vectors_by_force(rows)
    assert {i: r.n_links for i, r in found.items()} == {i: len(x) for i, x in links.items()}
    root = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, own in links.items():
            low = min([root[i], *(root[j] for j in own)])
            changed |= low != root[i]
            root[i] = low
    assert {i: r.component_id for i, r in found.items()} == root
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_repeated_vectors_and_empty_table(spark):
    rows = [(7, [1.0, 0.0], 1, 0, 0, ""), (7, [1.0, 0.0], 1, 0, 0, ""), (9, [1.0, 0.0], 1, 0, 0, "")]
    frame = spark.createDataFrame(rows, VECTORS)
    found = embedding_dedup.op6_embedding_dedup(frame).collect()
    assert [(r.n_links, r.component_id) for r in found] == [(2, 7)] * 3
    assert embedding_dedup.op6_embedding_dedup(frame.where("false")).count() == 0


def test_recall_of_the_tables_at_the_threshold():
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(4_000, 64))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    bits, tables = embedding_dedup.plan(50_000, 64, 0.93)
    mean, projections = embedding_dedup.quantisation(sample, -(-tables // (64 // bits)))
    a = sample[:2_000]
    away = rng.normal(size=a.shape)
    away -= (away * a).sum(1, keepdims=True) * a
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    b = 0.94 * a + math.sqrt(1 - 0.94**2) * away
    keys = [embedding_dedup.table_keys(x, mean, projections, bits, tables) for x in (a, b)]
    assert (keys[0] == keys[1]).any(1).mean() >= 0.999


@pytest.mark.parametrize("common, vectors", [(0.0, 50_000), (0.5, 50_000), (0.7, 50_000), (0.7, 1_000_000)])
def test_recall_under_a_common_mean(common, vectors):
    rng = np.random.default_rng(11)
    mean = rng.normal(size=64)
    mean /= np.linalg.norm(mean)
    away = rng.normal(size=(6_000, 64))
    away -= (away @ mean)[:, None] * mean
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    unit = math.sqrt(common) * mean + math.sqrt(1 - common) * away
    model = embedding_dedup.fitted(unit[:3_000], vectors, 0.93)
    a = unit[3_000:]
    off = rng.normal(size=a.shape)
    off -= (off * a).sum(1, keepdims=True) * a
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * off
    keys = [embedding_dedup.table_keys(x, *model) for x in (a, b)]
    assert (keys[0] == keys[1]).any(1).mean() >= 0.998
