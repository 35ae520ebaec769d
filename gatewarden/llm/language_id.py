"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network (``byte_gru``) is trained in numpy on windows of a bounded sample of
labelled documents. Every byte position of every text is then labelled, and a
document's probabilities are the mean over its positions.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties
go to the label first in alphabetical order; repeated rows each keep their row; an
empty table, or one without labels to learn from, gives ``und`` for every row.
Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.llm.byte_gru import PAD, WINDOW, ByteGru, pooled, train
from gatewarden.llm.text_batches import slices, texts_of

#: Documents the network learns from at most; chosen by hash of the id.
TRAINING_DOCUMENTS = 6_000
WINDOWS_PER_DOCUMENT = 3
STEPS = 300
FOLDS = 5
UNDETERMINED = "und"


def is_held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: remainder 0 of the id's CRC-32, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _windows_of(text: str) -> list[bytes]:
    data = text.encode()
    room = len(data) - WINDOW
    if room <= 0:
        return [data] if len(data) >= 8 else []
    return [data[room * k // (WINDOWS_PER_DOCUMENT - 1) :][:WINDOW] for k in range(WINDOWS_PER_DOCUMENT)]


def learn_languages(docs: DataFrame, documents: int = TRAINING_DOCUMENTS, steps: int = STEPS) -> ByteGru | None:
    """Train on ``text`` and ``lang`` of a bounded sample of ``docs``; None if nothing is labelled."""
    @F.arrow_udf("array<binary>")
    def windows(texts: pa.Array) -> pa.Array:
        return pa.array([_windows_of(t) for t in texts_of(texts)], pa.list_(pa.binary()))

    usable = docs.where(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = (
        usable.select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    )
    # The sample has a fixed bound, so its ids may be broadcast to the scan of texts.
    rows = (
        usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
        .select("doc_id", "lang", F.explode(windows("text")).alias("bytes"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "bytes")
        .limit(documents * WINDOWS_PER_DOCUMENT)
        .toPandas()
    )
    if rows.empty:
        return None
    labels = tuple(sorted(rows["lang"].unique()))
    data = np.full((len(rows), WINDOW), PAD, np.int16)
    for row, own in zip(data, rows["bytes"]):
        row[: len(own)] = np.frombuffer(own, np.uint8)
    target = rows["lang"].map({label: k for k, label in enumerate(labels)}).to_numpy(np.int64)
    return train(data, target, labels, steps)


_PREDICTED = "struct<lang_pred:string,score:double,label_bytes:map<string,bigint>>"


def with_language(docs: DataFrame, model: ByteGru | None, name: str = "language", text: str = "text") -> DataFrame:
    """The documents with a struct: label, score, and how many bytes were given each label."""
    if model is None:
        return docs.withColumn(name, _nothing())

    @F.arrow_udf(_PREDICTED)
    def predicted(texts: pa.Array) -> pa.Array:
        labels = np.array(model.labels)
        best, score, counts = [], [], []
        for part in slices(texts):
            probabilities, labelled = pooled(model, part.data, part.offsets)
            best += labels[probabilities.argmax(1)].tolist()
            score += np.clip(probabilities.max(1), 0, 1).tolist()
            counts += [[(x, int(c)) for x, c in zip(model.labels, row) if c] for row in labelled]
        fields = [
            pa.array(best, pa.string()), pa.array(score, pa.float64()),
            pa.array(counts, pa.map_(pa.string(), pa.int64())),
        ]
        return pa.StructArray.from_arrays(fields, ["lang_pred", "score", "label_bytes"])

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(name, F.when(has_letter, predicted(text)).otherwise(_nothing()))


def _nothing() -> Column:
    return F.struct(
        F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")).alias("label_bytes"),
    )


def op4_language_id(docs: DataFrame) -> DataFrame:
    """One row per document: fold, predicted language, score and bytes by label."""
    model = learn_languages(docs)
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
        "language.lang_pred", "language.score", F.to_json("language.label_bytes").alias("label_bytes"),
    )
