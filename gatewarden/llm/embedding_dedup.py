"""Near-copies among vectors: learned balanced codes, multi-index Hamming tables, exact rerank.

Iterative quantisation learns rotations of the centred principal axes under which
the signs of the coordinates are balanced bits that near vectors share. The bits
are cut into one short key per Hamming table; two vectors meet where they agree
on a whole key. Within a bucket all cosines are computed in double precision from
the original vectors, so nothing below the threshold is linked. Keys are so long
that buckets stay small and tables so many that a pair at the threshold is missed
in all of them once in ten thousand times. As centring widens the angle of a pair
where vectors have a common mean, both are planned from the bits that pairs made at
the threshold around sampled vectors share under the learned codes.

Equal vectors are merged first and counted as copies. A bucket of many different
vectors is cut into blocks, and each pair of blocks is a task of its own; a task
reports a number of links per vector and one link per vector of its component,
never the pairs.

Defined cases: vectors that are null, zero, without components or with a null or
non-finite one link with nothing, nor do vectors without a label or of different
lengths; repeated rows are vectors of their own and link with each other; an
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.components import connected

THRESHOLD = 0.93
#: Vectors that the rotations are learned from at most, chosen by hash.
SAMPLE_VECTORS = 8_192
ITERATIONS = 40
#: Vectors of one label and bucket on average; sets the length of the keys.
BUCKET = 48
MISSED = 1e-4
#: Different vectors of a bucket that are compared in one task; larger buckets are cut.
BLOCK = 1_024


def quantisation(sample: np.ndarray, rotations: int, seed: int = 3) -> tuple[np.ndarray, list[np.ndarray]]:
    """(mean, projections): each maps a centred vector to coordinates whose signs are its code."""
    dim = sample.shape[1]
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    turned = centred @ axes
    out = []
    for k in range(rotations):
        rng = np.random.default_rng(seed + k)
        r = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(ITERATIONS):
            bits = np.where(turned @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(bits.T @ turned)
            r = (u @ w).T
        out.append(axes @ r)
    return mean, out


def table_keys(unit: np.ndarray, mean: np.ndarray, projections: list[np.ndarray], bits: int, tables: int) -> np.ndarray:
    """(vectors, tables) keys of ``bits`` bits; the bits of a code are dealt out among its tables."""
    if not bits:
        return np.zeros((len(unit), tables), np.int64)
    signs = np.concatenate([(unit - mean) @ p >= 0 for p in projections], axis=1)
    per_code = unit.shape[1] // bits
    keys = np.zeros((len(unit), tables), np.int64)
    for t in range(tables):
        code, part = divmod(t, per_code)
        columns = code * unit.shape[1] + part + per_code * np.arange(bits)
        keys[:, t] = signs[:, columns] @ (1 << np.arange(bits, dtype=np.int64))
    return keys


def plan(vectors: int, dim: int, threshold: float) -> tuple[int, int]:
    """(bits of a key, tables) for the largest label's number of vectors."""
    bits = int(np.clip(round(math.log2(max(2, vectors / BUCKET))), 2, min(dim, 30)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(4, math.ceil(math.log(MISSED) / math.log(1 - agree)))


#: Pairs made at the threshold of each kind, and groups of them by their centred angle.
MADE, ANGLES = 2_000, 20
#: Cost of comparing a pair and of a key in a row, as parts of the cost of a row.
PAIR_COST, KEY_COST = 0.01, 0.013
#: Where so many tables do not do, all vectors of a label are compared.
MOST_TABLES = 4_096


def made_pairs(sample: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors and others at that cosine: off in any direction, and towards other vectors."""
    rng = np.random.default_rng(7)
    a = sample[rng.integers(0, len(sample), MADE)]
    out = []
    for away in (rng.normal(size=a.shape), sample[rng.integers(0, len(sample), MADE)] + 1e-9 * rng.normal(size=a.shape)):
        away = away - (away * a).sum(1, keepdims=True) * a
        length = np.sqrt((away * away).sum(1, keepdims=True))
        away = np.divide(away, length, out=np.zeros_like(away), where=length > 0)
        out.append((a, threshold * a + math.sqrt(1 - threshold**2) * away))
    return out


def _tables(agree: np.ndarray, bits: int) -> float:
    """Fewest tables that miss at most MISSED of pairs whose bits agree so often, infinite beyond MOST_TABLES."""
    apart = 1 - agree**bits
    low, high = 3, 4
    while (apart**high).mean() > MISSED:
        low, high = high, 2 * high
        if high > MOST_TABLES:
            return math.inf
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if (apart**middle).mean() > MISSED else (low, middle)
    return high


def fitted(
    sample: np.ndarray, vectors: int, threshold: float
) -> tuple[np.ndarray, list[np.ndarray], int, int]:
    """(mean, projections, bits of a key, tables) for unit vectors like the sample."""
    dim = sample.shape[1]
    most, tables = plan(vectors, dim, threshold)
    mean, projections = quantisation(sample, -(-tables // (dim // most)))
    made = made_pairs(sample, threshold)
    agree = []
    for a, b in made:
        x, y = a - mean, b - mean
        cosine = (x * y).sum(1) / np.maximum(np.sqrt((x * x).sum(1) * (y * y).sum(1)), 1e-300)
        same = np.mean([((x @ p >= 0) == (y @ p >= 0)).mean(1) for p in projections], axis=0)
        agree.append(np.array([same[k].mean() for k in np.array_split(np.argsort(cosine), ANGLES)]))

    def cost(bits: int) -> float:
        n = max(_tables(x, bits) for x in agree)
        return n * (1 + PAIR_COST * vectors / 2**bits + KEY_COST * n)

    bits = min(range(1, most + 1), key=lambda b: (cost(b), -b))
    tables = max(_tables(x, bits) for x in agree)
    while tables <= MOST_TABLES:
        more = -(-tables // (dim // bits)) - len(projections)
        if more > 0:
            projections += quantisation(sample, more, seed=3 + len(projections))[1]
        met = [
            (table_keys(a, mean, projections, bits, tables) == table_keys(b, mean, projections, bits, tables)).any(1).mean()
            for a, b in made
        ]
        # What bits of one key have in common is seen only here.
        if min(met) >= 1 - max(MISSED, 1 / MADE):
            return mean, projections, bits, tables
        tables = tables * 5 // 4 + 1
    return mean, projections, 0, 1


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _verified(threshold: float):
    """Compares the vectors of one bucket, or of two blocks of it."""
    out_schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key: tuple[Any, ...], group: pa.Table) -> pa.Table:
        table, low, high = key[2].as_py(), key[4].as_py(), key[5].as_py()
        rep = group["rep"].to_numpy()
        own = group["block"].to_numpy()
        copies = group["copies"].to_numpy()
        unit = _unit(_matrix(group["vector"]))
        codes = _matrix(group["keys"]).astype(np.int64)
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        if low != high:  # pairs within a block belong to that block's own task
            near &= own[:, None] != own[None, :]
        i, j = np.nonzero(near)
        # A pair is counted in the first table where it meets.
        first = ~(codes[i, :table] == codes[j, :table]).any(1)
        links = np.bincount(i[first], weights=copies[j[first]], minlength=len(rep)).astype(np.int64)
        root = rep.copy()
        while True:
            new = root.copy()
            np.minimum.at(new, i, root[j])
            if (new == root).all():
                break
            root = new
        some = near.any(1)
        return pa.table([rep[some], links[some], root[some]], schema=out_schema)

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(vectors, links): every row with its ``rep`` (null if it cannot link), and per rep its links.

    ``vectors`` has vec_id, embedding and label. ``links`` has rep, copies, n_links
    and component_id, for the reps of all vectors that can link.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    fine = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    usable = rows.where(F.coalesce(fine, F.lit(False)))
    distinct = computed_once(
        usable.groupBy("label", "vector")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("smallest"))
        .withColumn("rep", F.monotonically_increasing_id())
        .withColumn("dim", F.size("vector"))
    )
    sizes = distinct.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("n"))
    largest = {r["dim"]: r["n"] for r in sizes.orderBy(F.desc("n"), "dim").limit(64).collect()}
    sample = (
        distinct.select("dim", "vector").orderBy(F.xxhash64("vector")).limit(SAMPLE_VECTORS).toPandas()
    )
    models = {}
    for dim in largest:
        own = sample.loc[sample["dim"] == dim, "vector"]
        learned = _unit(np.stack(own.tolist())) if len(own) >= 2 * dim else np.random.default_rng(1).normal(size=(4 * dim, dim))
        models[dim] = fitted(_unit(learned), largest[dim], threshold)

    # Lengths beyond the first 64 get one table with one bucket per label: blocks keep it exact.
    @F.arrow_udf("array<bigint>")
    def keys(column: pa.Array) -> pa.Array:
        lengths = np.diff(column.offsets.to_numpy())
        out: list = [[0]] * len(column)
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            if dim in models:
                found = table_keys(_unit(_matrix(column.take(pa.array(at)))), *models[dim])
                for k, own in zip(at, found.tolist()):
                    out[k] = own
        return pa.array(out, pa.list_(pa.int64()))

    coded = computed_once(distinct.withColumn("keys", keys("vector")))
    bucket = ["label", "dim", "table", "key"]
    met = coded.select("label", "dim", "rep", F.posexplode("keys").alias("table", "key"))
    crowded = computed_once(
        met.groupBy(*bucket).count().where(F.col("count") > BLOCK)
        .select(*bucket, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    filled = (
        coded.select("label", "dim", "rep", "copies", "vector", "keys", F.posexplode("keys").alias("table", "key"))
        .join(crowded, bucket, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    )
    found = computed_once(
        filled.select(*bucket, "low", "high", "block", "rep", "copies", "vector", "keys")
        .groupBy(*bucket, "low", "high")
        .applyInArrow(_verified(threshold), "rep long, links long, root long")
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    stars = connected(found.select("rep", "root"), "rep", "root")
    reps = (
        coded.select("rep", "copies", "smallest")
        .join(counts, "rep", "left")
        .join(stars.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    reps = computed_once(reps)
    smallest = computed_once(reps.groupBy("root").agg(F.min("smallest").alias("component_id")))
    links = reps.join(smallest, "root").select(
        "rep", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    located = rows.join(
        distinct.select("label", "vector", "rep"), ["label", "vector"], "left"
    ).select("vec_id", "rep")
    return located, links


def op6_embedding_dedup(embeddings: DataFrame) -> DataFrame:
    """One row per vector: number of links, component and whether it is the one to keep."""
    located, links = near_vectors(embeddings)
    component = F.coalesce("component_id", "vec_id")
    return located.join(links, "rep", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
