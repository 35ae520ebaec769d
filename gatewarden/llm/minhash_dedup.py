"""Near-copies of whole texts: ProbMinHash signatures, banding and exact verification.

Equal texts are merged first. The signature of every different text is cut into
bands, and texts that agree on a whole band meet in a bucket. A bucket's task
estimates all its similarities from the signatures, drops what lies far below the
threshold, and verifies the rest exactly on the whole shingle sets, the most similar
first and only between texts that are not linked yet. It reports each text's link
towards its component, so a bucket gives as many rows as it has texts. Large buckets
are cut into blocks and each pair of blocks is a task of its own; nothing is capped.
Of buckets that hold the same texts only one is worked on.

A pair of similarity 0.8 shares none of the 25 bands of 5 registers once in 20,000
times. Shingles are of five words; a shorter text is one shingle.

Defined cases: texts that are null or without a word are alone in their class;
repeated rows are copies, of which one is kept; an empty table gives an empty
result. A class is named by its smallest doc_id that is not null. Extra columns
are not read.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.components import connected
from gatewarden.llm.prob_minhash import band_keys, probability_jaccard, signatures, weighted_shingles
from gatewarden.llm.text_batches import slices, unused_names

THRESHOLD = 0.8
BANDS = 25
BAND_REGISTERS = 5
#: Standard deviations of an estimate below the threshold from which pairs are not verified.
DEVIATIONS = 5.5
#: Texts of a bucket compared in one task; larger buckets are cut into pairs of blocks.
BLOCK = 256


def text_digest(text: str = "text") -> Column:
    """Digest of a whole text by which equal texts are merged; null is empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _signed(texts: pa.Array) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Per slice of the texts: signatures, and (elements, weights) of each row."""
    out = []
    for part in slices(texts):
        row, element, weight = weighted_shingles(part)
        bounds = np.searchsorted(row, np.arange(part.rows + 1))
        sets = [(element[a:b], weight[a:b]) for a, b in zip(bounds, bounds[1:])]
        out.append((signatures(row, element, weight, part.rows, BANDS * BAND_REGISTERS), sets))
    return out


def _linked(threshold: float):
    lowest = threshold - DEVIATIONS * (threshold * (1 - threshold) / (BANDS * BAND_REGISTERS)) ** 0.5
    schema = pa.schema([("rep", pa.int64()), ("root", pa.int64())])

    def run(key: tuple[Any, ...], group: pa.Table) -> pa.Table:
        band, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        rep, block = group["rep"].to_numpy(), group["block"].to_numpy()
        signed = _signed(group["text"].combine_chunks())
        signature = np.concatenate([s for s, _ in signed])
        sets = [x for _, own in signed for x in own]
        n = len(rep)
        agree = np.zeros((n, n), np.uint16)
        for register in signature.T:
            agree += register[:, None] == register[None, :]
        near = np.triu(agree >= lowest * signature.shape[1], 1)
        if low != high:  # pairs within a block belong to that block's own task
            near &= block[:, None] != block[None, :]
        i, j = np.nonzero(near)
        keys = band_keys(signature, BANDS)
        first = ~(keys[i, :band] == keys[j, :band]).any(1)  # each pair in the first band it shares
        i, j = i[first], j[first]
        order = np.argsort(-agree[i, j].astype(int), kind="stable")
        parent = list(range(n))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(i[order].tolist(), j[order].tolist()):
            a, b = root(x), root(y)
            if a != b and probability_jaccard(*sets[x], *sets[y]) >= threshold:
                parent[max(a, b, key=lambda k: rep[k])] = min(a, b, key=lambda k: rep[k])
        roots = np.array([root(x) for x in range(n)], np.int64)
        moved = roots != np.arange(n)
        return pa.table([rep[moved], rep[roots[moved]]], schema=schema)

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, digest of its text, class_id, class_size and kept.

    Exactly one row of each class is kept.
    """
    @F.arrow_udf("array<bigint>")
    def bands_of(texts: pa.Array) -> pa.Array:
        out: list = []
        for signature, sets in _signed(texts):
            keys = band_keys(signature, BANDS).tolist()
            out += [k if len(s[0]) else None for k, s in zip(keys, sets)]
        return pa.array(out, pa.list_(pa.int64()))

    rows = computed_once(
        docs.select("doc_id", text_digest().alias("digest"), bands_of("text").alias("bands"))
        .withColumn("row_no", F.monotonically_increasing_id())
    )
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"))
    # Texts without a word stay apart, each row a class of its own.
    reps = computed_once(
        rows.where("bands is not null").groupBy("digest")
        .agg(first_row.alias("first"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    bucket = ["band", "key"]
    met = reps.select("rep", F.posexplode("bands").alias(*bucket))
    # Near copies share many bands, and then their buckets hold the same texts: the one of the first
    # band is enough, as a pair's first shared band is never the later of two equal buckets.
    shared = computed_once(
        met.groupBy(*bucket).agg(
            F.count("*").alias("count"), F.bit_xor(F.xxhash64("rep")).alias("a"),
            F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("b"),
        ).where("count > 1")
        .groupBy("count", "a", "b").agg(F.min(F.struct(*bucket)).alias("first"))
        .select("first.*", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    involved = (
        met.join(shared, bucket).groupBy("rep")
        .agg(F.collect_list(F.struct(*bucket, "blocks")).alias("buckets"))  # one per band at most
        .join(reps.select("rep", "digest", F.col("first.doc_id").alias("first_id")), "rep")
    )
    own = docs.select("doc_id", "text").withColumn("own_digest", text_digest())
    bodies = computed_once(
        own.join(
            involved, own["doc_id"].eqNullSafe(involved["first_id"]) & (own["own_digest"] == involved["digest"])
        )
        .groupBy("rep").agg(F.any_value("text").alias("text"), F.any_value("buckets").alias("buckets"))
    )
    links = computed_once(
        bodies.select("rep", "text", F.inline("buckets"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .select(*bucket, "low", "high", "block", "rep", "text")
        .groupBy(*bucket, "low", "high").applyInArrow(_linked(threshold), "rep long, root long")
    )
    stars = connected(links, "rep", "root").withColumnRenamed("node", "rep")
    placed = computed_once(
        reps.select("rep", "digest", "first", "copies").join(stars, "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    classes = computed_once(
        placed.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("copies").alias("class_size"))
    )
    found = placed.join(classes, "root").select(
        F.col("digest").alias("rep_digest"), "keeper", "class_size"
    )
    grouped = rows.where("bands is not null").join(computed_once(found), F.col("digest") == F.col("rep_digest")).select(
        "doc_id", "digest", F.col("keeper.doc_id").alias("class_id"), "class_size",
        (F.col("row_no") == F.col("keeper.row_no")).alias("kept"),
    )
    alone = rows.where("bands is null").select(
        "doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
    )
    return grouped.unionByName(alone)


def op1_prob_minhash(docs: DataFrame) -> DataFrame:
    """One row per document: its class, that class's size and whether it is the one kept."""
    return near_duplicates(docs).drop("digest")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, columns unchanged."""
    id_, digest, own_digest = unused_names(docs.columns, "kept_id", "kept_digest", "own_digest")
    kept = near_duplicates(docs).where("kept").select(
        F.col("doc_id").alias(id_), F.col("digest").alias(digest)
    )
    own = docs.withColumn(own_digest, text_digest())
    some_word = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = own.where(some_word).join(
        kept.distinct(), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own_digest) == F.col(digest))
    )
    # Repeated rows agree on id and text; one of them is enough.
    return (
        chosen.dropDuplicates([id_, digest]).select(*docs.columns).unionByName(docs.where(~some_word))
    )
