"""The prefix trie of conversations, from whole sequences collapsed first.

Every turn is a narrow row: conversation, place, a 128-bit fingerprint of role and text,
and the words of the text. A prefix is known by the exclusive or of the fingerprints of its
(place, turn) pairs, which a window adds up along a conversation; two different prefixes
have the same 128 bits with a chance that no table size makes noticeable.

1. Identical conversations collapse into one weighted sequence, represented by its
   smallest conversation, with the list of those that end there.
2. A sequence is a leaf if it is no proper prefix of another: an anti-join.
3. The prefixes of the sequences, weighted, are aggregated to nodes. A node belongs to the
   sequence of its smallest conversation, and all later nodes of that sequence belong to it
   too. So what a sequence's own nodes save is summed along it from the end, and the
   aggregate of these sums over all sequences through a node is the sum over its subtree.

A first turn, or a whole conversation, that a third of all conversations share is
summed up before it is shuffled. Lists of ends are cut by ranges of conversations and read
in order by a hash that keeps no list. Windows along a conversation are cut into spans.

Defined cases: a null role or text is empty; a null conversation is no conversation and its rows
are left out; turns of equal number are taken in the order of their fingerprints;
repeated rows are turns of their own; an empty table has no root. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import heaviest, spread_join

#: Conversations that share their beginning, and the turns of it that may be shared, less one.
BLOCK = 20
SHARED_TURNS = 4
#: Places of a conversation in one window partition.
SPAN = 4096
#: Conversation numbers of one part of a list of ends.
ENDS = 8192
#: Children of one node from which its join is split.
ROWS_PER_TASK = 100_000

NO_ENDS = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "x1", "x2"]


def shared_turns(conv_id: Column) -> Column:
    """How many turns of its block's first conversation a conversation begins with, at most."""
    return (F.crc32(conv_id.cast("string")) % SHARED_TURNS).cast("int")


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a, b (fingerprint of role and text), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )


def _along(frame: DataFrame, key: str, span: Column, order: list[Column], totals: dict[str, tuple[Column, Column]],
           combine) -> DataFrame:
    """Add running totals along ``key``, cut into spans: name -> (within a span, of a whole span).

    ``combine`` joins the total of the spans before to the total within the span.
    """
    within = Window.partitionBy(key, "span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(F.col("span").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    cut = frame.withColumn("span", span).withColumns({n: w.over(within) for n, (w, _) in totals.items()})
    # Only what has more than one span needs the spans before.
    spans = (
        frame.select("*", span.alias("span")).groupBy(key, "span").agg(*[w.alias(n) for n, (w, _) in totals.items()])
        .withColumns({f"{n}_before": b.over(before) for n, (_, b) in totals.items()})
        .withColumn("later", F.row_number().over(Window.partitionBy(key).orderBy(F.col("span").asc_nulls_first())) > 1)
        .where("later").drop("later", *totals)
    )
    joined = cut.alias("c").join(spans.alias("s"), F.expr(f"c.{key} = s.{key} and c.span <=> s.span"), "left")
    kept = [F.col(f"c.{c}") for c in frame.columns]
    return joined.select(*kept, *[combine(F.col(f"c.{n}"), F.col(f"{n}_before")).alias(n) for n in totals])


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """The turns of every rebuilt conversation: conv_id, depth (from 1), length, a, b, words.

    A conversation without turns has one row of depth and length 0.
    """
    numbered = computed_once(_along(
        turns, "conv_id", F.floor(F.col("turn") / SPAN), [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")],
        {"place": (F.count(F.lit(1)), F.sum("place"))}, lambda own, earlier: own + F.coalesce(earlier, F.lit(0)),
    ).drop("turn"))
    convs = numbered.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", shared_turns(F.col("conv_id")).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"),
    )
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = computed_once(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"),
        (F.least("h", F.coalesce("base_n", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
    ))
    first = numbered.where((F.col("place") < SHARED_TURNS) & (F.col("conv_id") % BLOCK == 0))
    shared = convs.join(first.withColumnRenamed("conv_id", "base"), "base").where("place <= taken").select(
        "conv_id", F.col("place").alias("depth"), "length", "a", "b", "words"
    )
    own = numbered.join(convs, "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "length", "a", "b", "words"
    )
    none = convs.where("length = 0").select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), "length",
        *[F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "words")],
    )
    return shared.union(own).union(none)


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Add x1, x2, the fingerprint of the conversation up to and with the turn, and y1, y2, that before it."""
    placed = turns.withColumns({
        "t1": F.when(F.col("depth") > 0, F.xxhash64("depth", "a", "b")).otherwise(0),
        "t2": F.when(F.col("depth") > 0, F.xxhash64("b", "depth", "a")).otherwise(0),
    }).drop("a", "b")
    ahead = _along(
        placed, "conv_id", F.floor(F.col("depth") / SPAN), [F.col("depth")],
        {"x1": (F.bit_xor("t1"), F.bit_xor("x1")), "x2": (F.bit_xor("t2"), F.bit_xor("x2"))},
        lambda own, earlier: own.bitwiseXOR(F.coalesce(earlier, F.lit(0))),
    )
    return ahead.select(
        "conv_id", "depth", "length", "words", "x1", "x2",
        F.col("x1").bitwiseXOR(F.col("t1")).alias("y1"), F.col("x2").bitwiseXOR(F.col("t2")).alias("y2"),
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """KEY and ends_sha256, the digest of the comma-joined ascending ``conv_id`` of each key.

    Numbers are gathered in parts of at most ``ENDS`` of them, and a task reads the
    parts of its keys in order, holding one digest and one batch at a time.
    """
    part = F.floor(F.col("conv_id") / ENDS).alias("part")
    listed = ends.groupBy(*KEY, part).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    schema = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, hashlib.sha256()
        for batch in batches:
            done = []
            columns = batch.to_pydict()
            for *own, ids in zip(*(columns[c] for c in (*KEY, "ids"))):
                if own == key:
                    running.update(b",")
                else:
                    if key is not None:
                        done.append((*key, running.hexdigest()))
                    key, running = own, hashlib.sha256()
                running.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if key is not None:
            row = [*key, running.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    ordered = listed.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids")
    return ordered.mapInArrow(digest, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    → conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    turns = computed_once(with_prefixes(rebuilt_turns(narrow_turns(conversations))))
    whole = computed_once(
        turns.where("depth = length").select("conv_id", "depth", "x1", "x2")
    )
    ends = computed_once(ends_digests(whole))
    sequences = computed_once(
        whole.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    )
    own = turns.where("depth > 0").drop("length").join(
        sequences.select("conv_id", "weight", F.col("depth").alias("length")), "conv_id"
    )
    root = sequences.select(
        "conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", "words", "x1", "x2", "y1", "y2")],
        "weight", F.col("depth").alias("length"),
    )
    prefixes = computed_once(own.unionByName(root))

    proper = prefixes.where("depth < length").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    nodes = computed_once(prefixes.groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("words").alias("words"), F.min("y1").alias("y1"), F.min("y2").alias("y2"),
    ))
    saves = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saves"))
    marked = prefixes.join(saves, ["conv_id", "depth"], "left").join(leaves, "conv_id", "left").select(
        "conv_id", *KEY, F.coalesce("saves", F.lit(0)).alias("saves"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
        (-F.col("depth")).alias("height"),
    )
    summed = _along(
        marked, "conv_id", F.floor(F.col("height") / SPAN), [F.col("height")],
        {"saved": (F.sum("saves"), F.sum("saved"))}, lambda own, earlier: own + F.coalesce(earlier, F.lit(0)),
    ).groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    children = computed_once(
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("y1").alias("x1"), F.col("y2").alias("x2"))
        .agg(F.count("*").alias("n_children"))
    )
    full = computed_once(
        nodes.join(summed, KEY).join(children, KEY, "left").join(ends, KEY, "left").select(
            *KEY, "y1", "y2", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    return _with_parents(full, children)


def _with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """Add parent_conv_id; parents of very many children are split over tasks."""
    above = ["above", "y1", "y2"]
    named = {"depth": "above", "x1": "y1", "x2": "y2"}
    parents = nodes.where("n_children > 0").select(*KEY, F.col("conv_id").alias("parent_conv_id")).withColumnsRenamed(named)
    weights = children.withColumnRenamed("n_children", "weight").withColumnsRenamed(named)
    rows = nodes.where("depth > 0").withColumn("above", F.col("depth") - 1)
    joined = spread_join(rows, parents, above, heaviest(weights, above, ROWS_PER_TASK), "conv_id")
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return joined.select(*columns).unionByName(root.select(*columns))


def op12_sequence_collapse_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of all rebuilt conversations."""
    return prefix_trie(conversations)
