"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens; full
pieces are sequences of their own. The others are dealt into lots of a bounded
number of pieces. Each lot is packed on several islands: a population of packings
evolves by a crossover that injects whole well-filled bins of one parent into the
other, removes the bins that hold the same pieces and best-fits what they leave
over. Between epochs every island's best packing migrates to the next island, as
rows of a shuffle. The best island of each lot is kept.

Defined cases: a null text is an empty document, which is the end token alone;
repeated rows are packed as often as they occur; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once

CAPACITY = 2048
END_TOKEN = 0
#: Pieces of a lot on average; what one task packs does not grow with the table.
LOT_PIECES = 2048
ISLANDS = 3
EPOCHS = 2
POPULATION = 6
GENERATIONS = 8
#: A run of as many blanks is more than the faster library's pattern can take.
LONG_BLANK = 100_000

PIECES_TYPE = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
_PIECES = pa.list_(pa.struct([
    ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
]))


@lru_cache(maxsize=2)
def encoding(path: str):
    """The byte-level vocabulary and added tokens of a tokenizers file as a tiktoken encoding."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    added = {t["content"]: t["id"] for t in model.get("added_tokens", ())}
    special = set(added.values())
    # The printable stand-ins of bytes: printable Latin-1 as is, others from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in plain}
    stand_in |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {
        bytes(stand_in[c] for c in token): number
        for token, number in model["model"]["vocab"].items() if number not in special
    }
    return tiktoken.Encoding(
        "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text as the unmodified tokenizers file gives them: an added token in the text is its one id.

    tiktoken is faster, and equal where added tokens are matched as they stand and
    none begins another. Its pattern fails on very long runs of blanks; texts with such a run
    are left to the tokenizers library.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", ())
    whole = Tokenizer.from_file(path)

    def plainly(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    names = sorted(t["content"] for t in added)
    flags = any(t.get(f) for t in added for f in ("single_word", "lstrip", "rstrip", "normalized"))
    if flags or any(b.startswith(a) for a, b in zip(names, names[1:])):
        return plainly
    own = encoding(path)

    def faster(text: str) -> list[int]:
        if len(text) >= LONG_BLANK and has_long_blank(text):
            return plainly(text)
        return own.encode(text, allowed_special="all") if any(n in text for n in names) else own.encode_ordinary(text)

    return faster


def has_long_blank(text: str, limit: int = LONG_BLANK) -> bool:
    return any(m.end() - m.start() >= limit for m in re.finditer(r"\s+", text))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or capacity
    yield 0, min(first, n)
    for start in range(first, n, capacity):
        yield start, capacity


def with_pieces(docs: DataFrame, tokenizer: str | None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the CRC-32 of its token ids."""
    @F.arrow_udf(PIECES_TYPE)
    def pieces(texts: pa.Array) -> pa.Array:
        own = encoder(tokenizer or default_tokenizer())
        out = []
        for text in texts.to_pylist():
            ids = np.array([*own(text or ""), END_TOKEN], "<u4")
            out.append([
                {"piece": k, "start": s, "length": n, "ids_crc32": zlib.crc32(ids[s : s + n].tobytes())}
                for k, (s, n) in enumerate(cut(len(ids), capacity))
            ])
        return pa.array(out, _PIECES)

    return docs.select("doc_id", F.explode(pieces("text")).alias("p")).select("doc_id", "p.*")


class Packing:
    """Bins of piece numbers, with the tokens each has left."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.left: list[int] = []

    def insert(self, items: list[int]) -> None:
        """Best-fit, longest first (as the caller ordered them)."""
        order = sorted((left, k) for k, left in enumerate(self.left))
        for item in items:
            size = int(self.lengths[item])
            at = bisect.bisect_left(order, (size, -1))
            if at < len(order):
                left, k = order.pop(at)
                self.bins[k].append(item)
                self.left[k] = left - size
            else:
                k = len(self.bins)
                self.bins.append([item])
                self.left.append(self.capacity - size)
            bisect.insort(order, (self.left[k], k))

    def fitness(self) -> float:
        """Mean squared filling: prefers few bins, and full ones among equally many."""
        if not self.bins:
            return 1.0
        return float(np.mean((1 - np.array(self.left) / self.capacity) ** 2))

    def without(self, gone: set[int]) -> tuple[Packing, list[int]]:
        """A copy without the bins that hold any of ``gone``, and the pieces they leave over."""
        out, over = Packing(self.lengths, self.capacity), []
        for items, left in zip(self.bins, self.left):
            if gone.isdisjoint(items):
                out.bins.append(list(items))
                out.left.append(left)
            else:
                over += [i for i in items if i not in gone]
        return out, over

    @classmethod
    def of(cls, lengths: np.ndarray, capacity: int, bins: np.ndarray) -> Packing:
        out = cls(lengths, capacity)
        for k in np.unique(bins):
            items = np.flatnonzero(bins == k).tolist()
            out.bins.append(items)
            out.left.append(capacity - int(lengths[items].sum()))
        return out

    def assignment(self) -> np.ndarray:
        out = np.empty(len(self.lengths), np.int64)
        for k, items in enumerate(self.bins):
            out[items] = k
        return out


def _longest_first(items, lengths: np.ndarray) -> list[int]:
    return sorted(items, key=lambda i: (-lengths[i], i))


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``; duplicates go, displaced pieces are best-fitted."""
    filled = np.argsort(b.left, kind="stable")[: max(1, len(b.bins) // 2)]
    chosen = rng.choice(filled, max(1, len(filled) // 2), replace=False)
    taken = {i for k in chosen for i in b.bins[k]}
    child, over = a.without(taken)
    for k in sorted(chosen):
        child.bins.append(list(b.bins[k]))
        child.left.append(b.left[k])
    child.insert(_longest_first(over, a.lengths))
    return child


def mutation(a: Packing, rng: np.random.Generator) -> Packing:
    """Empty the worst-filled bin and a few others, and best-fit their pieces, longest first."""
    some = min(len(a.bins), 2 + len(a.bins) // 50)
    gone = {int(np.argmax(a.left)), *rng.choice(len(a.bins), some, replace=False).tolist()}
    child, over = Packing(a.lengths, a.capacity), []
    for k, items in enumerate(a.bins):
        if k in gone:
            over += items
        else:
            child.bins.append(list(items))
            child.left.append(a.left[k])
    child.insert(_longest_first(over, a.lengths))
    return child


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed) -> Packing:
    """The best packing of one island's epoch; stops where no better one can exist."""
    rng = np.random.default_rng(seed)
    fewest = -(-int(lengths.sum()) // capacity)
    people = [Packing.of(lengths, capacity, bins) for bins in elites]
    if not people:
        best_fit = Packing(lengths, capacity)
        best_fit.insert(_longest_first(range(len(lengths)), lengths))
        people = [best_fit]
    if min(len(p.bins) for p in people) > fewest:
        while len(people) < POPULATION:  # noisy best-fit orders
            order = np.argsort(-(lengths * rng.uniform(0.85, 1.15, len(lengths))), kind="stable")
            other = Packing(lengths, capacity)
            other.insert(order.tolist())
            people.append(other)
        for _ in range(GENERATIONS):
            people.sort(key=lambda p: (len(p.bins), -p.fitness()))
            if len(people[0].bins) <= fewest:
                break
            best = people[: POPULATION // 2]
            pairs = rng.integers(0, len(best), (POPULATION - len(best), 2))
            children = [mutation(crossover(best[i], best[j], rng), rng) for i, j in pairs]
            people = best + children
    return min(people, key=lambda p: (len(p.bins), -p.fitness()))


_EVOLVED = "lot long, island int, item long, length long, bin long, bins long"


def _epoch(rows: DataFrame, capacity: int, number: int) -> DataFrame:
    """Evolve every (lot, island); the rows of each origin are one elite packing."""
    def run(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        lot, island = key
        group = group.sort_values(["origin", "item"], kind="stable")
        own = group[group["origin"] == group["origin"].iloc[0]]
        lengths = own["length"].to_numpy(np.int64)
        elites = [
            g["bin"].to_numpy(np.int64) for _, g in group.groupby("origin", sort=True) if g["bin"].iloc[0] >= 0
        ]
        best = evolve(lengths, elites, capacity, seed=(int(lot), int(island), number))
        return pd.DataFrame({
            "lot": lot, "island": island, "item": own["item"].to_numpy(), "length": lengths,
            "bin": best.assignment(), "bins": len(best.bins),
        })

    return computed_once(rows.groupBy("lot", "island").applyInPandas(run, _EVOLVED))


def pack(
    items: DataFrame, capacity: int = CAPACITY, lot_pieces: int = LOT_PIECES,
    islands: int = ISLANDS, epochs: int = EPOCHS,
) -> DataFrame:
    """Bins for ``items`` (item long, unique; length long up to ``capacity``): item, lot, bin.

    Reads ``items`` several times; give a stored table.
    """
    lots = max(1, -(-items.count() // lot_pieces))
    rows = items.select(
        F.pmod(F.xxhash64("item"), F.lit(lots)).alias("lot"), "item", "length",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.lit(-1).cast("long").alias("bin"), F.lit(0).alias("origin"),
    )
    for number in range(epochs):
        evolved = _epoch(rows, capacity, number)
        elites = evolved.select("lot", "island", "item", "length", "bin", F.lit(0).alias("origin"))
        guests = elites.withColumn("island", (F.col("island") + 1) % islands).withColumn("origin", F.lit(1))
        rows = elites.unionByName(guests)
    best = (
        evolved.groupBy("lot", "island").agg(F.max("bins").alias("bins"))
        .groupBy("lot").agg(F.min_by("island", F.struct("bins", "island")).alias("island"))
    )
    return evolved.join(best, ["lot", "island"]).select("item", "lot", "bin")


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every document with its sequence and place there.

    Sequences of several pieces are numbered from lot and bin, full pieces by
    negative numbers of their own.
    """
    numbered = computed_once(
        with_pieces(docs, tokenizer, capacity).withColumn("item", F.monotonically_increasing_id())
    )
    full = numbered.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    short = numbered.where(F.col("length") < capacity)
    bins = pack(short.select("item", "length"), capacity)
    # A bin holds at most ``capacity`` pieces, as none is empty.
    before = Window.partitionBy("lot", "bin").orderBy("item").rowsBetween(-capacity, -1)
    places = F.sum("length").over(before)
    packed = short.join(bins, "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.shiftleft("lot", 32) + F.col("bin")).alias("sequence_id"),
        F.coalesce(places, F.lit(0)).cast("long").alias("offset"),
    )
    return packed.unionByName(full)


def op8_best_fit_packing(docs: DataFrame) -> DataFrame:
    """One row per piece of all documents, at most 2048 tokens to a sequence."""
    return pack_documents(docs)
