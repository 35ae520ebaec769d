"""Word BPE, the conversation trie and spelling variants against libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatewarden.llm import conversation_trie, corpus_sql, spelling_variants, word_bpe
from gatewarden.llm.conversation_trie import op12_sequence_collapse_trie
from gatewarden.llm.pair_index import PairMerges
from gatewarden.llm.spelling_variants import op13_permuterm_variants
from gatewarden.llm.word_bpe import op11_pair_index_bpe

DOCS = "doc_id long, text string"


# --- op11 ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe.default_tokenizer())


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


BPE_TEXTS = [
    None, "", "  \t\n", "Hello world", "DON'T it's WE'LL 's ''s", "x<|endoftext|>y", "<|ENDOFTEXT|>", "<|startoftext|><|endoftext|>",
    "a<|endoftext|>́b", "é H̱ İ ΣΣ aΣ", "a\u0085b c　d\x1ce", "a" * 100_001, "ab" * 50_001 + " the",
    "12345 a1b2", "\U0001f600\U0001f600 ok", " " * 1_200_000 + "x" + "\n" * 1_200_000, "\x00\x01 \x7f",
]


def test_word_bpe_equals_the_library(spark, library):
    docs = spark.createDataFrame(list(enumerate(BPE_TEXTS * 2)), DOCS).withColumn("IDS_ROW", F.lit(1))
    got = {r.doc_id: r for r in op11_pair_index_bpe(docs).collect()}
    full = {r.doc_id: r for r in word_bpe.decode(word_bpe.encode(docs)).collect()}
    for number, ids in enumerate(library_ids(library, BPE_TEXTS * 2)):
        text = library.decode(ids, skip_special_tokens=False)
        assert full[number].ids == ids and full[number].decoded == text
        assert got[number].n_tokens == len(ids)
        assert got[number].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[number].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_word_bpe_of_every_code_point(library):
    own = word_bpe.WordBpe(word_bpe.default_tokenizer())
    texts = ["a" + chr(i) + "B c" for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    assert encoded(own, texts) == library_ids(library, texts)


def encoded(own, texts):
    import pyarrow as pa

    out = []
    for part in word_bpe.slices(pa.array(texts, pa.string()), word_bpe.BATCH_BYTES):
        ids, offsets = own.encode(part)
        out += [x.tolist() for x in np.split(ids, offsets[1:-1])]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aabbeZé̈ßİΣς \n'sSTl.,!012<|>endoftx", max_size=60), max_size=6))
def test_word_bpe_of_any_text(texts):
    from tokenizers import Tokenizer

    own = word_bpe.vocabulary(word_bpe.default_tokenizer())
    assert encoded(own, texts) == library_ids(Tokenizer.from_file(word_bpe.default_tokenizer()), texts)


def test_remembered_chunks_are_bounded(monkeypatch, library):
    monkeypatch.setattr(word_bpe, "REMEMBERED_IDS", 50)
    monkeypatch.setattr(word_bpe, "BATCH_BYTES", 200)
    own = word_bpe.WordBpe(word_bpe.default_tokenizer())
    texts = [f"word{i} again and {i * 7919}" for i in range(300)]
    assert encoded(own, texts) == library_ids(library, texts)
    assert len(own.words) + len(own.chunks) < 2_000


def merged_by_force(symbols, rank):
    """The lowest rank of the word first, the leftmost of equals."""
    symbols = list(symbols)
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank), default=None)
        if best is None:
            return symbols
        i = best[1]
        symbols[i : i + 2] = [100 + best[0]]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.lists(st.text(alphabet="abc", max_size=14), max_size=8))
def test_pair_index_merges_in_rank_order(seed, words):
    rng, made, pairs = random.Random(seed), [97, 98, 99], []
    while len(pairs) < 12:
        pair = (rng.choice(made), rng.choice(made))
        if pair not in pairs:
            made.append(100 + len(pairs))
            pairs.append(pair)
    merges = PairMerges(*(np.array(x) for x in ([a for a, _ in pairs], [b for _, b in pairs], [100 + i for i in range(12)])))
    symbols = np.array([ord(c) for w in words for c in w], np.int64)
    ids, sizes = merges.merged(symbols, np.array([len(w) for w in words], np.int64))
    rank = {p: i for i, p in enumerate(pairs)}
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])][: len(words)] == [
        merged_by_force(map(ord, w), rank) for w in words
    ] or not words


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        PairMerges(np.array([5, 1]), np.array([1, 2]), np.array([6, 5]))


# --- op12 ---------------------------------------------------------------------------------


def trie_by_force(rows):
    """Nodes as (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, digest), from sorted turns."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, ends = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", p[-1][1]) if w]) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children.get(p, ()))
        leaves[p] = sum(leaves[k] for k in children.get(p, ())) or 1
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, ())), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


TURNS = "conv_id long, turn long, role string, text string"


def trie_of(spark, rows):
    table = spark.createDataFrame(rows, TURNS).withColumn("Depth", F.lit(0)).repartition(5)
    return sorted(tuple(r) for r in op12_sequence_collapse_trie(table).collect())


def test_trie_of_edges(spark):
    rows = [
        (0, 0, "user", "a b"), (0, 1, "assistant", "c"), (0, None, "system", "first"), (0, 2, "user", "d e f"),
        (1, 0, "user", "a b"), (1, 1, "assistant", "c"), (2, 0, None, None), (3, 0, "", ""), (4, 5, "user", "only"),
        (21, 0, "user", "gone"), (22, 0, "user", "x\ty z"), (23, 0, "user", "x"), (None, 0, "user", "nobody"),
        (40, 0, "user", "long"), (41, 0, "user", "q"), (41, 1, "user", "q"), (41, 2, "user", "q"), (41, 3, "user", "q"),
    ]
    assert trie_of(spark, rows) == trie_by_force(rows)
    assert trie_of(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, monkeypatch, seed):
    """With spans of three turns and parts of seven ends, and a parent with many children split."""
    monkeypatch.setattr(conversation_trie, "SPAN", 3)
    monkeypatch.setattr(conversation_trie, "ENDS", 7)
    monkeypatch.setattr(conversation_trie, "ROWS_PER_TASK", 2)
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(200), 150):
        for t in range(rng.choice([1, 2, 3, 5, 17])):
            rows.append((c, t * 2, rng.choice(["user", None]), rng.choice(["a", "a b", "", "c d e"])))
    assert trie_of(spark, rows) == trie_by_force(rows)


def test_trie_equals_sql(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}'")
    expected = sorted(con.execute(corpus_sql.TRIE).fetchall())
    assert sorted(tuple(r) for r in op12_sequence_collapse_trie(spark.read.parquet(path)).collect()) == expected


# --- op13 ---------------------------------------------------------------------------------


def variants_by_force(docs):
    import re

    counts = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w, n in words.items():
        found = sorted((-words[o], o) for o in words if near(w, o))
        if found and -found[0][0] >= 2 * n:
            form[w] = found[0][1]
        out[w] = len(found)
    def root(w):
        return root(form[w]) if w in form else w
    return sorted(((w, form.get(w), root(w), words[w], out[w], words.get(form.get(w))) for w in words), key=str)


def variants_of(spark, docs):
    table = spark.createDataFrame(docs, DOCS).withColumn("WORD", F.lit("x")).repartition(4)
    return sorted((tuple(r) for r in op13_permuterm_variants(table).collect()), key=str)


def test_variants_of_edges(spark):
    docs = [
        (1, None), (2, ""), (None, "hello hello hello helo"), (3, "aaaaa aaaaaa aaaaaaa " * 4), (4, "Àrbre Àrbre àrbre "),
        (5, "Àrbre ×÷×÷× " * 3), (6, "x1hello_hello-HELLO"), (7, "hellp hellp hellp hallo hallo hallo"),
        (8, "b" * 100_000 + " " + "c" * 60), (8, "b" * 100_000), (8, "b" * 100_000 + " abĀcdefg cdefg cdefg"),
        (8, ("b" * 99_999 + " ") * 3), (9, ("z" * 47 + " ") * 9 + ("z" * 48 + " ") * 3 + ("z" * 49 + " ") * 3),
    ]
    assert variants_of(spark, docs) == variants_by_force(docs)
    assert variants_of(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_equal_brute_force(spark, monkeypatch, seed):
    """Short alphabets make repeated letters, long chains of forms and many ties.

    Keys of six letters and more are fingerprints in some cases.
    """
    monkeypatch.setattr(spelling_variants, "TEXT_KEYS", (48, 6, 4)[seed - 1])
    monkeypatch.setattr(spelling_variants, "LONG_ROWS", 5)
    monkeypatch.setattr(spelling_variants, "BATCH_BYTES", 300)
    monkeypatch.setattr(spelling_variants, "HELD_WORDS", 40)
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(150)]
    docs = [
        (i, " ".join(words[min(int(rng.expovariate(0.03)), 149)] + rng.choice(["", "", "X"]) for _ in range(40)))
        for i in range(100)
    ]
    assert variants_of(spark, docs) == variants_by_force(docs)


def test_every_run_may_lose_a_letter(spark, monkeypatch):
    import pyarrow as pa

    text = "Abécde " * 3 + "é" * 70
    for part in spelling_variants.slices(pa.array([text]), 1 << 20):
        monkeypatch.setattr(spelling_variants, "MISSPELLED", 1)
        found = spelling_variants.slice_words(part, ["9"]).to_pylist()
    expected = []
    for run in ("abécde",) * 3 + ("é" * 70,):
        h = zlib.crc32(f"9:{run}".encode())
        expected.append(run[: h % len(run)] + run[h % len(run) + 1 :])
    assert found == [w for w in expected if len(w) >= 5]


def test_variants_equal_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    expected = sorted(con.execute(corpus_sql.VARIANTS).fetchall(), key=str)
    assert sorted((tuple(r) for r in op13_permuterm_variants(spark.read.parquet(path)).collect()), key=str) == expected
