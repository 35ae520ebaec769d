"""Spelling variants of a corpus' words, by permuterm rotations.

Words are counted in numpy over whole Arrow text batches. Every word, ended by a mark, is
rotated: ``b$a`` is a rotation of ``ab``, and of ``axb`` without its last character
``x``. So in the sorted rotations all words that differ at one place share a prefix
that skips the edited character: those with some character there are replacements of each
other, and the one word that ends where the prefix does lacks a character. A scan over each
such prefix gives every word the number and the best of its neighbours there.

A prefix group has at most one word per letter and one without, so its size is bounded by
the alphabet; no pairs are made. Where a letter is repeated, deleting any of the row gives
the same word: only the first of the row counts. Forms at least double a word's count,
so following them ends after the logarithm of the largest count; each round of joins
doubles the way gone.

Defined cases: a null text has no words; a null doc_id is written as empty; words are told apart by
code points only; a tie for a form goes to the smallest word; repeated rows count as
often as they occur; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.text_batches import Slice, slices

#: Every run whose checksum this divides loses a character.
MISSPELLED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: How many times as often as the word its form occurs.
FORM_RATIO = 2
#: Bytes of text worked on at once, and words a task counts before it passes them on.
BATCH_BYTES = 4 << 20
HELD_WORDS = 400_000
#: Bytes of a run whose checksum is taken together with others'.
SHORT_RUN = 48

#: Letters of the longest rotations kept as text, and rows of longer words made at once.
TEXT_KEYS = 48
LONG_ROWS = 20_000

_KEY_PRIME = (1 << 127) - 1
_KEY_BASE = 0x5851F42D4C957F2D14057B7EF767814F
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):  # the table of the reflected polynomial
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def letter_runs(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z in lower case, start, end, row) of the maximal runs of letters of every row."""
    data = part.data
    upper = (data >= 0x41) & (data <= 0x5A)
    data = data + np.where(upper, np.uint8(0x20), np.uint8(0))
    inside = ((data >= 0x61) & (data <= 0x7A)) | (data == _LEAD)
    inside[1:] |= data[:-1] == _LEAD
    edge = np.zeros(len(data) + 1, np.int8)
    edge[:-1] += inside
    edge[1:] -= inside
    begin, finish = edge[:-1] == 1, edge[1:] == -1
    filled = part.offsets[1:] > part.offsets[:-1]
    heads, tails = part.offsets[:-1][filled], part.offsets[1:][filled] - 1
    begin[heads] = inside[heads]
    finish[tails] = inside[tails]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return data, start, end, np.searchsorted(part.offsets, start, "right") - 1


def run_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's bytes, continued from its seed (the CRC-32 of what stands before them)."""
    state = ~seeds.astype(np.uint32)
    size = end - start
    order = np.argsort(size, kind="stable")
    first = np.searchsorted(size[order], np.arange(1, SHORT_RUN + 1))  # runs of at least k bytes
    limit = int(np.searchsorted(size[order], SHORT_RUN, "right"))
    for k in range(SHORT_RUN):
        own = order[first[k] : limit]
        if not len(own):
            break
        s = state[own]
        state[own] = (s >> np.uint32(8)) ^ _CRC[(s ^ data[start[own] + k]) & np.uint32(0xFF)]
    out = ~state
    for i in order[limit:].tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(seeds[i]))
    return out


def slice_words(part: Slice, names: list[str]) -> pa.Array:
    """The words of a slice, one per run: misspelled where the checksum says so, short ones left out."""
    data, start, end, row = letter_runs(part)
    if not len(start):
        return pa.array([], pa.large_string())
    seeds = np.array([zlib.crc32(f"{name}:".encode()) for name in names], np.uint32)
    checksums = run_checksums(data, start, end, seeds[row])
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lead_places = np.flatnonzero((data & 0xC0) != 0x80)
    first, points = leads[start], leads[end] - leads[start]
    hit = checksums % MISSPELLED == 0
    gone = lead_places[first[hit] + checksums[hit] % points[hit]]
    kept = np.ones(len(data), bool)
    kept[gone] = False
    wide = gone[data[gone] == _LEAD]
    kept[wide + 1] = False
    size = end - start
    size[hit] -= 1 + (data[gone] == _LEAD)
    long_enough = points - hit >= LEAST_LENGTH
    # Runs are disjoint and ascending, so the bytes of the kept ones stand one after another.
    mark = np.zeros(len(data) + 1, np.int8)
    mark[start[long_enough]] += 1
    mark[end[long_enough]] -= 1
    text = data[(np.cumsum(mark[:-1]) > 0) & kept]
    bounds = np.zeros(int(long_enough.sum()) + 1, np.int64)
    np.cumsum(size[long_enough], out=bounds[1:])
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(text)))


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n of all documents' words, however rare; counted in tasks before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            names = [x or "" for x in batch.column("name").to_pylist()]
            for part in slices(batch.column("text"), BATCH_BYTES):
                found = pc.value_counts(slice_words(part, names[part.first : part.first + part.rows]))
                held.append(pa.table({"word": found.field("values").cast(pa.string()), "n": found.field("counts").cast(pa.int64())}))
                size += len(found)
                if size > HELD_WORDS:
                    held = [summed()]
                    size = len(held[0])
                    if size > HELD_WORDS // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from summed().to_batches()

    named = docs.select(F.col(doc_id).cast("string").alias("name"), F.col(text).alias("text"))
    return named.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """Add ``code``, a number that orders words as their code points do."""
    return computed_once(words.orderBy("word").withColumn("code", F.monotonically_increasing_id()))


def rotations(words: DataFrame) -> DataFrame:
    """key, code, n, whole, counts: every prefix of a rotation of ``word$`` that a neighbour may share.

    A ``whole`` rotation is a key itself; the others skip their last character, and ``counts`` says
    that this character does not repeat the one before it. Keys of more than ``TEXT_KEYS`` letters
    are fingerprints of their texts, so that a word's keys are not as long as its square.
    """
    size = F.char_length("word")
    ended = F.concat(F.substring("word", F.col("at") + 1, size), F.lit("$"), F.substring("word", F.lit(1), F.col("at")))
    skipped = F.concat(F.substring("word", F.col("at") + 2, size), F.lit("$"), F.substring("word", F.lit(1), F.col("at")))
    here = F.substring("word", F.col("at") + 1, F.lit(1))
    whole = F.when(size < TEXT_KEYS, F.struct(ended.alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("counts")))
    lacking = F.when(F.col("at") < size, F.struct(
        skipped.alias("key"), F.lit(False).alias("whole"),
        ((F.col("at") == 0) | (F.substring("word", F.col("at"), F.lit(1)) != here)).alias("counts"),
    ))
    short = (
        words.where(size <= TEXT_KEYS)
        .withColumn("at", F.explode(F.sequence(F.lit(0), size)))
        .select("code", "n", F.inline(F.filter(F.array(whole, lacking), lambda entry: entry.isNotNull())))
        .select("key", "code", "n", "whole", "counts")
    )
    long = words.where(size >= TEXT_KEYS).select("word", "code", "n").mapInArrow(
        partial(_long_rotations, TEXT_KEYS, LONG_ROWS), "key string, code bigint, n bigint, whole boolean, counts boolean"
    )
    return short.unionByName(long)


def _long_rotations(text_keys: int, rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprinted keys of words of ``text_keys`` letters (whole ones only) and more.

    The fingerprint is a polynomial in the letters modulo a prime of 127 bits; those of all
    rotations follow from those of the beginnings of the word.
    """
    for batch in batches:
        for word, code, n in zip(*(batch.column(c).to_pylist() for c in ("word", "code", "n"))):
            size = len(word)
            begins, powers = [0], [1, _KEY_BASE]
            for letter in word:
                begins.append((begins[-1] * _KEY_BASE + ord(letter)) % _KEY_PRIME)
                powers.append(powers[-1] * _KEY_BASE % _KEY_PRIME)

            def key(at: int, after: int) -> str:
                """Of word[after:] + "$" + word[:at]."""
                tail = begins[size] - begins[after] * powers[size - after]
                value = (tail * powers[at + 1] + ord("$") * powers[at] + begins[at]) % _KEY_PRIME
                return f"#{size - after + at}:{value:x}"

            for first in range(0, size + 1, rows):
                places = range(first, min(first + rows, size + 1))
                skips = [i for i in places if i < size] if size > text_keys else []
                keys = [key(i, i) for i in places] + [key(i, i + 1) for i in skips]
                whole = [True] * len(places) + [False] * len(skips)
                counts = [False] * len(places) + [i == 0 or word[i - 1] != word[i] for i in skips]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()), pa.array([code] * len(keys), pa.int64()),
                        pa.array([n] * len(keys), pa.int64()), pa.array(whole), pa.array(counts),
                    ],
                    ["key", "code", "n", "whole", "counts"],
                )


def neighbours(words: DataFrame) -> DataFrame:
    """code, n_near, best: the number of near words, and (-n, code) of the preferred one.

    Words without a near word are left out.
    """
    ranked = Window.partitionBy("key").orderBy("whole", F.desc("n"), "code")
    group = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct((-F.col("n")).alias("m"), F.col("code").alias("code"))
    scanned = (
        rotations(words).withColumn("own", own)
        .withColumns({
            "place": F.row_number().over(ranked),  # a word with no character at the place comes last
            "rows": F.count("*").over(group),
            "first": F.first("own").over(group),
            "second": F.nth_value("own", 2).over(group),
            "last": F.last(F.struct("whole", "own")).over(group),
            "longer": F.count_if("counts").over(group),
            "best_longer": F.min(F.when(F.col("counts"), F.col("own"))).over(group),
        })
        .where("rows > 1")
    )
    shorter = F.col("counts") & F.col("last.whole")
    others = F.col("rows") - 1 - F.col("last.whole").cast("int")
    best_other = F.when(others > 0, F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first")))
    best_here = F.least(best_other, F.when(shorter, F.col("last.own")))
    return (
        scanned.select(
            "code",
            F.when(F.col("whole"), F.col("longer")).otherwise(others + shorter.cast("int")).alias("near"),
            F.when(F.col("whole"), F.col("best_longer")).otherwise(best_here).alias("best"),
        )
        .where("near > 0")
        .groupBy("code").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """code, root: where following the ``form`` of code (each row has one) from word to word ends."""
    steps = computed_once(forms.select("code", F.col("form").alias("root"), F.lit(True).alias("open")))
    while not steps.where("open").isEmpty():
        ahead = steps.select(F.col("code").alias("root"), F.col("root").alias("further"), F.col("open").alias("goes_on"))
        jumped = steps.where("open").join(ahead, "root", "left").select(
            "code", F.coalesce("further", "root").alias("root"), F.coalesce("goes_on", F.lit(False)).alias("open")
        )
        steps = computed_once(jumped.union(steps.where("not open")))
    return steps.select("code", "root")


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per word → word, form, root, n, n_near, form_n."""
    words = numbered(word_counts(docs, text, doc_id).where(F.col("n") >= LEAST_COUNT))
    found = computed_once(
        words.select("code", "n").join(neighbours(words), "code")
        .select("code", "n_near", F.when(-F.col("best.m") >= FORM_RATIO * F.col("n"), F.col("best")).alias("best"))
        .select("code", "n_near", F.col("best.code").alias("form"), (-F.col("best.m")).alias("form_n"))
    )
    ends = roots(found.where("form is not null"))
    named = words.select("code", "word")
    forms = (
        found.where("form is not null").join(ends, "code")
        .join(named.withColumnsRenamed({"code": "form", "word": "form_word"}), "form")
        .join(named.withColumnsRenamed({"code": "root", "word": "root_word"}), "root")
        .select("code", "form_word", "root_word", "form_n")
    )
    return (
        words.join(found.select("code", "n_near"), "code", "left").join(forms, "code", "left")
        .select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n",
        )
    )


def op13_permuterm_variants(docs: DataFrame) -> DataFrame:
    """One row per word of all documents, with its form, its root and its number of near words."""
    return variants(docs)
