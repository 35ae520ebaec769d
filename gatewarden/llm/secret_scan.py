"""Secrets in texts: fixed patterns, and weak parts that only count together.

A keyword assignment, an access identifier or a long hexadecimal run is a
secret by itself. Weaker parts (a short identifier, an undelimited token, a
short assigned value, an endpoint) are common in clean text, so they are
reported only when an interval join finds their complement within the same
scope: an identifier with a secret, and an endpoint with both.

Defined cases: a null text is an empty one; repeated rows each get their own
result; an empty table gives an empty result. Extra columns are not read.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.llm.text_batches import texts_of, unused_names

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
#: Code points between two parts of one credential at most; also the join's block.
SCOPE = 200

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # the same maximal runs, long ones only
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

WEAK_ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{4,13}|(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,32})(?![A-Za-z0-9])")
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"(?:https?|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+"
    r"|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])"
)

_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("weak", pa.bool_())])
FOUND_TYPE = (
    "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,"
    "spans:array<struct<kind:int,start:bigint,end:bigint,weak:boolean>>>"
)
_FOUND = pa.struct([
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.list_(_SPAN)),
])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns; a match that is too short is dropped."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(2, *m.span()) for m in _LONG_HEX.finditer(text)]
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    """``kind:start:end``, comma-joined, by start and then kind as listed."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0], x[2])))


def _mixed_classes(token: str) -> bool:
    return (
        any(c.isdigit() for c in token)
        and any(c.islower() for c in token)
        and any(c.isupper() for c in token)
    )


def weak_parts(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Candidates outside the fixed spans, which mean nothing alone."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted((s, e) for _, s, e in taken):  # their union, as ranges that do not touch
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)

    def free(s: int, e: int) -> bool:
        at = bisect.bisect_right(ends, s)
        return at == len(starts) or e <= starts[at]

    for m in WEAK_ACCESS.finditer(text):
        if free(*m.span()):
            yield 3, *m.span()
    for m in WEAK_SECRET.finditer(text):
        if _mixed_classes(m[0]) and free(*m.span()):
            yield 4, *m.span()
    for m in ASSIGN.finditer(text):
        if 6 <= len(m[2]) < MIN_ASSIGN and any(c.isdigit() for c in m[2]) and free(*m.span()):
            yield 4, *m.span()
    for m in ENDPOINT.finditer(text):
        if free(*m.span()):
            yield 5, *m.span()


def _found(text: str) -> dict:
    base = base_spans(text)
    parts = list(weak_parts(text, base))
    # Links need an identifier and a secret somewhere in the text.
    kinds = {k for k, _, _ in base} | {k for k, _, _ in parts}
    if not (kinds & {1, 3} and kinds & {0, 2, 4}):
        parts = []
    return {
        "n_assign": sum(k == 0 for k, _, _ in base),
        "n_access": sum(k == 1 for k, _, _ in base),
        "n_hex": sum(k == 2 for k, _, _ in base),
        "base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(),
        "spans": [
            {"kind": k, "start": s, "end": e, "weak": k > 2}
            for k, s, e in sorted({*base, *parts}, key=lambda x: (x[1], x[0], x[2]))
        ],
    }


def with_parts(docs: DataFrame, name: str = "found", text: str = "text") -> DataFrame:
    """The documents with one more column: counts, digest and all parts of each whole text."""
    @F.arrow_udf(FOUND_TYPE)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([_found(t) for t in texts_of(texts)], _FOUND)

    return docs.withColumn(name, found(F.col(text)))


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complement lies within ``scope`` code points.

    ``parts`` has the columns of ``keys`` below, kind, start, end and weak. Both
    sides are cut into blocks of ``scope``; an interval is compared only with
    those that share a block with it, so the work grows with the text. Returns
    key and array of spans.
    """
    keys = ["doc_id", "text_key"]
    def blocks(margin):
        return F.explode(F.sequence(
            F.floor(F.greatest(F.col("start") - margin, F.lit(0)) / scope),
            F.floor((F.col("end") + margin) / scope),
        ))

    parts = parts.distinct()
    left = parts.where("weak").withColumn("block", blocks(0)).alias("l")
    right = parts.select(
        *keys, F.col("kind").alias("other"), F.col("start").alias("from"), F.col("end").alias("to"),
        blocks(scope).alias("block"),
    ).alias("r")
    near = (
        F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("l.text_key") == F.col("r.text_key"))
        & (F.col("l.block") == F.col("r.block"))
        & (F.col("r.from") <= F.col("l.end") + scope)
        & (F.col("r.to") >= F.col("l.start") - scope)
    )
    identifier, secret = F.col("other").isin(1, 3), F.col("other").isin(0, 2, 4)
    kind = F.col("kind")
    return (
        left.join(right, near)
        .select(*[F.col(f"l.{k}") for k in keys], "l.kind", "l.start", "l.end", "r.other")
        .groupBy(*keys, "kind", "start", "end")
        .agg(F.bool_or(identifier).alias("with_id"), F.bool_or(secret).alias("with_secret"))
        .where(
            F.when(kind == 3, F.col("with_secret"))
            .when(kind == 4, F.col("with_id"))
            .otherwise(F.col("with_id") & F.col("with_secret"))
        )
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    )


def with_spans(
    docs: DataFrame, name: str, text: str = "text", carried: list[str] | None = None, scope: int = SCOPE
) -> DataFrame:
    """Documents with a struct: the counts, the digest and the sorted spans, linked ones too.

    ``carried`` names the input columns to keep (all by default). The parts are
    found once and kept with them in the shared folder.
    """
    carried = docs.columns if carried is None else carried
    found, key, link_id, link_key, linked = unused_names(
        [*docs.columns, name], "found", "text_key", "link_id", "link_key", "linked"
    )
    kept = computed_once(
        with_parts(docs, found, text).withColumn(key, F.xxhash64(text)).select(*carried, found, key)
    )
    # Only texts with a weak part take part in the join.
    some_weak = kept.where(F.exists(f"{found}.spans", lambda s: s["weak"]))
    parts = (
        some_weak.select("doc_id", F.col(key).alias("text_key"), F.explode(f"{found}.spans").alias("s"))
        .select("doc_id", "text_key", "s.*")
    )
    links = linked_parts(parts, scope).select(
        F.col("doc_id").alias(link_id), F.col("text_key").alias(link_key), F.col("linked").alias(linked)
    )
    joined = kept.join(
        links, F.col("doc_id").eqNullSafe(F.col(link_id)) & (F.col(key) == F.col(link_key)), "left"
    )
    strong = F.transform(
        F.filter(f"{found}.spans", lambda s: ~s["weak"]),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    spans = F.array_sort(F.concat(strong, F.coalesce(F.col(linked), none)))
    return joined.select(
        *carried,
        F.struct(
            *[F.col(f"{found}.{c}").alias(c) for c in ("n_assign", "n_access", "n_hex", "base_sha256")],
            spans.alias("spans"),
        ).alias(name),
    )


def spans_text(spans):
    """The sorted spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        )),
        ",",
    )


def op3_secret_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the fixed spans, and all spans."""
    # The text is dropped before the joins; only its hash goes on.
    found = with_spans(docs.select("doc_id", "text"), "secrets", carried=["doc_id"])
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", "secrets.base_sha256",
        spans_text(F.col("secrets.spans")).alias("spans"),
    )


def without_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced, and n_chars counted anew.

    Overlapping spans are replaced as one. Other columns stay.
    """
    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts.to_pylist(), spans.to_pylist()):
            if text and own:
                pieces, at = [], 0
                for s in own:
                    if s["start"] >= at:
                        pieces += [text[at : s["start"]], mask]
                    at = max(at, s["end"])
                text = "".join([*pieces, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    (own,) = unused_names(docs.columns, "secrets")
    changed = F.size(f"{own}.spans") > 0
    text = F.when(changed, masked("text", f"{own}.spans")).otherwise(F.col("text"))
    length = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return (
        with_spans(docs, own).withColumn("text", text).withColumn("n_chars", length).select(*docs.columns)
    )
