"""SentencePiece encoding of whole texts by a max-plus scan over chunks, and decoding.

Texts of one chunk are encoded at once. Longer ones are cut into chunks that lie in
different rows and tasks: each gives the max-plus matrix between the states of its two
cuts, a document's matrices are combined associatively into its states at all cuts, and
then every chunk traces its own ids back, independently of the others. Ids equal those
of the library for the same model; see ``piece_bpe`` for why.

Defined cases: a null text has null ids, an empty one none; repeated rows each keep their
row; an empty table gives an empty result. Other columns stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.piece_bpe import START, boundary_states, pieces_of
from gatewarden.llm.piece_slices import slice_encoder
from gatewarden.llm.text_batches import slices

#: Code points of a chunk; longer texts are cut.
CHUNK = 65_536
_STATE = pa.struct([("over", pa.int32()), ("piece", pa.int32())])
_STATE_TYPE = "struct<over:int,piece:int>"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


#: Rows whose Python objects exist at a time; columns stay in Arrow.
ROWS = 200


def _rows(*columns: pa.Array) -> Iterator[tuple]:
    """The rows of columns as Python values, a few at a time."""
    for at in range(0, len(columns[0]), ROWS):
        yield from zip(*(c.slice(at, ROWS).to_pylist() for c in columns))


def _id_lists(rows: Iterable[list[int] | np.ndarray | None]) -> pa.Array:
    """An Arrow column of id lists, whose Python lists end as soon as they are copied."""
    parts, lengths, missing = [], [], []
    for ids in rows:
        parts.append(np.array([] if ids is None else ids, np.int32))
        lengths.append(len(parts[-1]))
        missing.append(ids is None)
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(missing, pa.bool_()))


def _ids_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The id lists of a column as numpy views."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for ok, start, end in zip(column.is_valid().to_numpy(zero_copy_only=False), offsets, offsets[1:]):
        yield values[start:end] if ok else None


def _encoded(texts: pa.Array, path: str) -> Iterator[np.ndarray | list[int] | None]:
    """Ids of every text; texts with a literal mark of the model's own go singly."""
    own = slice_encoder(path)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    for part in slices(texts):
        d = part.data
        marks = np.flatnonzero((d[:-2] == 0xE2) & (d[1:-1] == 0x96) & (d[2:] == 0x81))
        single = np.full(part.rows, not own.plain)
        single[np.searchsorted(part.offsets, marks, "right") - 1] = True
        ids, offsets = own.encode(part)
        for k in range(part.rows):
            if not valid[part.first + k]:
                yield None
            elif single[k]:
                text = d[part.offsets[k] : part.offsets[k + 1]].tobytes().decode()
                yield own.pieces.encode(own.pieces.model.normalize(text))
            else:
                yield ids[offsets[k] : offsets[k + 1]]


def _chunks(text: str, chunk: int, margin: int) -> list[dict]:
    """Chunks with ``margin`` code points of context on both sides."""
    out = []
    for number, left in enumerate(range(0, len(text), chunk)):
        right = min(left + chunk, len(text))
        low = max(0, left - margin)
        out.append({
            "chunk": number, "left": left - low, "right": right - low, "at_end": right == len(text),
            "slice": text[low : right + margin],
        })
    return out


def _giant_ids(giant: DataFrame, path: str, chunk: int) -> DataFrame:
    """(row_no, ids) of stored rows (row_no, text) longer than a chunk."""
    part = pa.struct([
        ("chunk", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("at_end", pa.bool_()), ("slice", pa.string()),
    ])

    @F.arrow_udf("array<struct<chunk:int,left:int,right:int,at_end:boolean,slice:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        own = pieces_of(path)
        return pa.array(
            [_chunks(own.model.normalize(t), chunk, own.longest) for (t,) in _rows(texts)], pa.list_(part)
        )

    @F.arrow_udf(f"array<struct<entry:{_STATE_TYPE},leave:{_STATE_TYPE}>>")
    def transfer(parts: pa.Array, lefts: pa.Array, rights: pa.Array, numbers: pa.Array, ends: pa.Array) -> pa.Array:
        own = pieces_of(path)
        out = []
        for text, left, right, number, end in _rows(parts, lefts, rights, numbers, ends):
            entries = own.crossing(text, left) if number else [(0, START)]
            out.append([
                {"entry": {"over": a[0], "piece": a[1]}, "leave": {"over": b[0], "piece": b[1]}}
                for a, b in own.transfer(text, left, right, entries, end)
            ])
        return pa.array(out, pa.list_(pa.struct([("entry", _STATE), ("leave", _STATE)])))

    def states(key: tuple[Any, ...], group: pa.Table) -> pa.Table:
        """One document's matrices, a few states for each of its chunks, to its states at every cut."""
        group = group.sort_by("chunk")
        matrices = []
        for links in group["links"].to_pylist():
            matrix: dict = {}
            for x in links:
                entry, leave = (x["entry"]["over"], x["entry"]["piece"]), (x["leave"]["over"], x["leave"]["piece"])
                matrix.setdefault(entry, {})[leave] = 0.0
            matrices.append(matrix)
        # The one state at the text's end that the start reaches.
        reached = {(0, START)}
        for matrix in matrices:
            reached = {x for s in reached for x in matrix.get(s, {})}
        found = boundary_states(matrices, (0, START), min(reached))
        return pa.table({
            "row_no": pa.array([key[0].as_py()] * len(matrices), pa.int64()),
            "chunk": group["chunk"].cast(pa.int32()),
            "entry": pa.array([{"over": a, "piece": b} for a, b in found[:-1]], _STATE),
            "leave": pa.array([{"over": a, "piece": b} for a, b in found[1:]], _STATE),
        })

    @F.arrow_udf("array<int>")
    def traced(
        parts: pa.Array, lefts: pa.Array, rights: pa.Array, entries: pa.Array, leaves: pa.Array
    ) -> pa.Array:
        own = pieces_of(path)
        return _id_lists(
            own.between(text, left, right, (a["over"], a["piece"]), (b["over"], b["piece"]))
            for text, left, right, a, b in _rows(parts, lefts, rights, entries, leaves)
        )

    chunks = computed_once(giant.select("row_no", F.inline(cut("text"))))
    links = chunks.select("row_no", "chunk", transfer("slice", "left", "right", "chunk", "at_end").alias("links"))
    cuts = computed_once(
        links.groupBy("row_no").applyInArrow(
            states, f"row_no long, chunk int, entry {_STATE_TYPE}, leave {_STATE_TYPE}"
        )
    )
    return (
        chunks.join(cuts, ["row_no", "chunk"])
        .select("row_no", "chunk", traced("slice", "left", "right", "entry", "leave").alias("own"))
        .groupBy("row_no")
        .agg(F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct("chunk", "own"))), lambda x: x["own"]
        )).alias("ids"))
    )


def encode(docs: DataFrame, model: str | None = None, text: str = "text", name: str = "ids", chunk: int = CHUNK) -> DataFrame:
    """The documents with one more column, the ids of their whole texts."""
    path = model or default_model()

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _id_lists(_encoded(texts, path))

    # The model puts a space in front, so a chunk has room for one code point less.
    is_long = F.coalesce(F.char_length(text) > chunk - 1, F.lit(False))
    short = docs.where(~is_long).withColumn(name, encoded(text))
    row, ids = f"{name}_row", f"{name}_long"
    giant = computed_once(docs.where(is_long).withColumn(row, F.monotonically_increasing_id()))
    found = _giant_ids(giant.select(F.col(row).alias("row_no"), F.col(text).alias("text")), path, chunk)
    long = giant.join(found.select(F.col("row_no").alias(f"{row}_no"), F.col("ids").alias(ids)), F.col(row) == F.col(f"{row}_no"))
    return short.unionByName(long.withColumn(name, F.col(ids)).select(*docs.columns, name))


def decode(encoded: DataFrame, model: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with one more column, the text of their ids."""
    path = model or default_model()

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        own = pieces_of(path)
        return pa.array([None if x is None else own.decode(x.tolist()) for x in _ids_of(column)], pa.string())

    return encoded.withColumn(name, text(ids))


def op5_sentencepiece(docs: DataFrame) -> DataFrame:
    """One row per document: number and CRC-32 of its ids, and whether decoding gives its text back.

    A literal U+2581 cannot come back: the model writes a space for it.
    """
    @F.arrow_udf("bigint")
    def crc(column: pa.Array) -> pa.Array:
        return pa.array([
            None if x is None else zlib.crc32(x.astype("<u4").tobytes()) for x in _ids_of(column)
        ], pa.int64())

    both = decode(encode(docs.select("doc_id", "text")))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), crc("ids").alias("ids_crc32"),
        F.xxhash64("decoded").alias("decoded_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("restored"),
    )
