"""Main text of web pages by wrapper induction.

Pages of one host and layout share a template. One page of each is the pivot; every
other page's tree of blocks is aligned with it by simple tree matching, as rows of a
join. A slot of the pivot whose text is the same on nearly all pages of that layout,
whether they reach the slot or not, is template; the varying ones are content. What
HTML itself marks as apart (menus, headers, footers, sidebars, forms, adverts,
comments) is left out before that, and where a page has an article or main element,
only its inside counts.

A layout is the set of upper containers outside the article, with those of their
classes that enough of the host's pages have. Pages of layouts with too few witnesses
make up one more group per host, aligned by tag names alone.

Near copies are one witness: pages of a host whose texts' characters are shared by
two thirds (probability Jaccard, estimated from 64 hashes), found by bands and linked.

Defined cases: a null html is an empty page with an empty text; a null or unreadable
url is a host without a template, whose pages keep all their blocks; repeated rows
keep their rows, but near copies are one witness for a template, so a host all of
whose pages are so similar has none: template and copied article cannot be told apart
there; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewarden.functions.shared import computed_once
from gatewarden.functions.skew import lookup_join
from gatewarden.llm.components import connected
from gatewarden.llm.dom import MAIN, Matching, read_page
from gatewarden.llm.text_batches import texts_of, unused_names

#: A slot is template if this share of a layout's different pages has one text there.
CONSTANT_SHARE = 0.9
#: Fewer different pages than this tell nothing about a template.
MIN_WITNESSES = 5

#: A class counts if this share of the host's pages has it, and as many as are witnesses.
CLASS_SHARE = 0.1
#: Layout of a host's pages whose own layout has too few witnesses.
REST = 0
#: Similarity from which pages are near copies; hashes per page and per band.
NEAR = 2 / 3
HASHES = 64
BAND = 4
_CONTAINERS = frozenset("html body div section main article center table tbody tr td form frameset".split())

_SKELETON = pa.struct([
    ("depth", pa.list_(pa.int32())), ("label", pa.list_(pa.string())),
    ("hash", pa.list_(pa.int64())), ("chars", pa.list_(pa.int32())),
])
_BLOCKS = pa.struct([
    ("layout", pa.int64()), ("depth", pa.list_(pa.int32())), ("label", pa.list_(pa.string())), ("text", pa.list_(pa.string())),
])
_BLOCKS_TYPE = "struct<layout:bigint,depth:array<int>,label:array<string>,text:array<string>>"
SKELETON_TYPE = "struct<depth:array<int>,label:array<string>,hash:array<bigint>,chars:array<int>>"


def _hashed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def _with_classes(label: list[str], classes: list[str] | None) -> list[str]:
    """The labels with only those classes that count on the host."""
    counted = set(classes or ())
    out = []
    for own in label:
        tag, _, names = own.partition(".")
        some = " ".join(n for n in names.split() if n in counted)
        out.append(f"{tag}.{some}" if some else tag)
    return out


def _tags(label: list[str]) -> list[str]:
    return [own.partition(".")[0] for own in label]


def _layout(depth: list[int], label: list[str]) -> int:
    """Hash of the set of upper containers outside the article: pages of one template agree on it."""
    upper: set[str] = set()
    inside = None
    for d, own in zip(depth, label):
        if inside is not None and d > inside:
            continue
        tag = own.partition(".")[0]
        inside = d if tag in MAIN else None
        if d <= 2 and tag in _CONTAINERS:
            upper.add(f"{d}{own}")
    return _hashed("/".join(sorted(upper)))


def _skeleton(source: str) -> dict:
    page = read_page(source)
    counts = [bool(t and m) for t, m in zip(page.text, page.main)]
    return {
        "depth": page.depth, "label": page.label,
        # Only what may become main text is worth a verdict; 0 is no such text.
        "hash": [_hashed(t) if c else 0 for t, c in zip(page.text, counts)],
        "chars": [len(t) if c else 0 for t, c in zip(page.text, counts)],
    }


_SEEDS = np.random.default_rng(11).integers(0, 2**64, HASHES, np.uint64)


def signature(hashes: list[int], chars: list[int]) -> list[int]:
    """Texts drawn by their characters; two pages agree on a draw with their probability Jaccard."""
    texts = {h: c for h, c in zip(hashes, chars) if h}
    own = np.array(list(texts), np.int64)
    x = own.view(np.uint64)[:, None] ^ _SEEDS
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    wait = -np.log((x >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / np.array(list(texts.values()))[:, None]
    return own[wait.argmin(0)].tolist()


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute url, null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _near_copies(read: DataFrame) -> DataFrame:
    """(node, root) of the pages with text that are near copies of a smaller node."""
    @F.arrow_udf("array<bigint>")
    def signatures(hashes: pa.Array, chars: pa.Array) -> pa.Array:
        return pa.array(
            [signature(h, c) for h, c in zip(hashes.to_pylist(), chars.to_pylist())], pa.list_(pa.int64())
        )

    drawn = computed_once(
        read.where("has_text").groupBy("host", "node").agg(F.first("hash").alias("hash"), F.first("chars").alias("chars"))
        .select("host", "node", signatures("hash", "chars").alias("drawn"))
    )
    bands = F.array(*(F.xxhash64(F.slice("drawn", b + 1, BAND)) for b in range(0, HASHES, BAND)))
    met = drawn.select("host", "node", F.posexplode(bands).alias("band", "key"))
    bucket = ["host", "band", "key"]
    shared = met.groupBy(*bucket).agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = met.join(shared, bucket).where("node <> first").select("node", "first").distinct()
    one = drawn.select("node", "drawn")
    same = F.size(F.filter(F.zip_with("drawn", "other", lambda a, b: a == b), lambda x: x))
    near = (
        pairs.join(one, "node").join(one.select(F.col("node").alias("first"), F.col("drawn").alias("other")), "first")
        .where(same >= NEAR * HASHES)
    )
    return connected(near.select("node", "first"), "node", "first")


@dataclass(frozen=True)
class Induced:
    """What a host's pages share.

    ``classes`` (host, classes): the classes that count. ``templates`` (host, layout, depth, label,
    constant): for every layout with enough witnesses its pivot and the numbers of its constant
    nodes. ``sizes`` (host, layout, weight): how many pages with text a layout has.
    """

    classes: DataFrame
    templates: DataFrame
    sizes: DataFrame


def induced_templates(pages: DataFrame) -> Induced:
    """The templates of all hosts and layouts, one row each."""
    @F.arrow_udf(SKELETON_TYPE)
    def skeletons(sources: pa.Array) -> pa.Array:
        return pa.array([_skeleton(s) for s in texts_of(sources)], _SKELETON)

    @F.arrow_udf("struct<label:array<string>,layout:bigint>")
    def placed(depths: pa.Array, labels: pa.Array, classes: pa.Array) -> pa.Array:
        out = []
        for depth, label, counted in zip(depths.to_pylist(), labels.to_pylist(), classes.to_pylist()):
            own = _with_classes(label, counted)
            out.append({"label": own, "layout": _layout(depth, own)})
        return pa.array(out, pa.struct([("label", pa.list_(pa.string())), ("layout", pa.int64())]))

    @F.arrow_udf("array<struct<node:int,hash:bigint>>")
    def aligned(
        a_depth: pa.Array, a_label: pa.Array, b_depth: pa.Array, b_label: pa.Array, b_hash: pa.Array
    ) -> pa.Array:
        out = []
        for own_depth, own_label, depth, label, hashes in zip(
            *(x.to_pylist() for x in (a_depth, a_label, b_depth, b_label, b_hash))
        ):
            pairs = Matching(own_depth, own_label, depth, label).pairs()
            out.append([{"node": a, "hash": hashes[b]} for a, b in pairs if hashes[b]])
        return pa.array(out, pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64())])))

    read = computed_once(
        pages.select(host_of(F.col("url")).alias("host"), skeletons("html").alias("s"))
        .where(F.col("host").isNotNull()).select("host", "s.*")
        .withColumn("node", F.xxhash64("host", "hash"))
        .withColumn("has_text", F.exists("hash", lambda x: x != 0))
    )
    names = F.array_distinct(F.flatten(F.transform("label", lambda x: F.split(F.regexp_replace(x, r"^[^.]*\.?", ""), r"\s+"))))
    seen = read.select("host", F.explode(F.array_union(names, F.array(F.lit("")))).alias("name")).groupBy("host", "name").count()
    # Every page has the empty name.
    totals = seen.where("name = ''").select("host", F.col("count").alias("pages"))
    classes = computed_once(
        seen.where((F.col("name") != "") & (F.col("count") >= MIN_WITNESSES)).join(totals, "host")
        .where(F.col("count") >= CLASS_SHARE * F.col("pages"))
        .groupBy("host").agg(F.sort_array(F.collect_list("name")).alias("classes"))
    )
    copies = _near_copies(read).select("node", F.col("root").alias("copied"))
    own = computed_once(
        read.where("has_text").join(classes, "host", "left")
        .withColumn("p", placed("depth", "label", "classes"))
        .join(copies, "node", "left")
        .select("host", "depth", "hash", "p.*", "node", F.coalesce("copied", "node").alias("witness"))
    )
    template = ["host", "layout"]
    many = computed_once(
        own.groupBy(*template).agg(F.count_distinct("witness").alias("n"))
        .where(F.col("n") >= MIN_WITNESSES).select(*template, F.lit(True).alias("known"))
    )
    own = computed_once(
        own.join(many, template, "left")
        .withColumn("layout", F.when(F.col("known"), F.col("layout")).otherwise(F.lit(REST).cast("long")))
        .withColumn("label", F.when(F.col("known"), F.col("label")).otherwise(
            F.transform("label", lambda x: F.substring_index(x, ".", 1))))
        .drop("known")
    )
    pivots = computed_once(
        own.groupBy(*template).agg(
            F.min_by(F.struct("depth", "label"), F.struct("node", "depth", "label")).alias("pivot"),
            F.count_distinct("witness").alias("witnesses"),
        ).where(F.col("witnesses") >= MIN_WITNESSES)
    )
    slots = (
        own.join(pivots, template)
        .select(*template, "witness", F.explode(aligned("pivot.depth", "pivot.label", "depth", "label", "hash")).alias("x"))
        .select(*template, "witness", "x.node", "x.hash")
        .distinct()
        .groupBy(*template, "node", "hash").agg(F.count("*").alias("n"))
        .groupBy(*template, "node").agg(F.max("n").alias("same"))
        .join(pivots.select(*template, "witnesses"), template)
    )
    constant = slots.where(
        (F.col("same") >= MIN_WITNESSES) & (F.col("same") >= CONSTANT_SHARE * F.col("witnesses"))
    ).groupBy(*template).agg(F.sort_array(F.collect_list("node")).alias("constant"))
    # A layout without constant slots is named too, so that its pages are not taken for the rest.
    templates = computed_once(pivots.join(constant, template, "left").select(
        *template, "pivot.depth", "pivot.label", F.coalesce("constant", F.array().cast("array<int>")).alias("constant")
    ))
    sizes = own.groupBy(*template).agg(F.count("*").alias("weight"))
    return Induced(classes, templates, sizes)


@lru_cache(maxsize=64)
def _template(written: str | None) -> dict | None:
    return None if written is None else json.loads(written)


def _kept_text(depth: list[int], label: list[str], text: list[str], rest: bool, template: dict | None) -> str:
    """A page's texts in order, without those at the slots that its template holds constant."""
    dropped: set[int] = set()
    if template and template["constant"]:
        held = set(template["constant"])
        pairs = Matching(template["depth"], template["label"], depth, _tags(label) if rest else label).pairs()
        dropped = {b for a, b in pairs if a in held}
    return " ".join(t for k, t in enumerate(text) if t and k not in dropped)


def main_text(source: str, templates: list[dict] | None, classes: list[str] | None = None) -> str:
    """Blocks of the main text in page order, without those that a template holds constant."""
    own = _blocks(source, classes)
    by_layout = {t["layout"]: t for t in templates or ()}
    rest = own["layout"] not in by_layout
    return _kept_text(own["depth"], own["label"], own["text"], rest, by_layout.get(REST if rest else own["layout"]))


def _blocks(source: str, classes: list[str] | None) -> dict:
    page = read_page(source)
    label = _with_classes(page.label, classes)
    return {
        "layout": _layout(page.depth, label), "depth": page.depth, "label": label,
        "text": [t if t and m else "" for t, m in zip(page.text, page.main)],
    }


def with_main_text(pages: DataFrame, name: str = "main_text") -> DataFrame:
    """The pages with one more column, the extracted text.

    A page meets its host's classes, is read into blocks, and then meets the one template of its
    layout; each lookup is measured, and broadcast or joined with its heavy keys split.
    """
    @F.arrow_udf(_BLOCKS_TYPE)
    def blocks(sources: pa.Array, classes: pa.Array) -> pa.Array:
        return pa.array([_blocks(s, (c or "").split(" ")) for s, c in zip(texts_of(sources), classes.to_pylist())], _BLOCKS)

    @F.arrow_udf("string")
    def extracted(depths: pa.Array, labels: pa.Array, texts: pa.Array, rests: pa.Array, templates: pa.Array) -> pa.Array:
        columns = (c.to_pylist() for c in (depths, labels, texts, rests, templates))
        return pa.array([_kept_text(*own, _template(t)) for *own, t in zip(*columns)], pa.string())

    host, names, own, row, key, known, template = unused_names(
        [*pages.columns, name, "weight"], "page_host", "page_classes", "page_blocks", "page_row", "page_layout", "page_known",
        "page_template",
    )
    found = induced_templates(pages)
    hosts = computed_once(found.classes.select(F.col("host").alias(host), F.array_join("classes", " ").alias(names)))
    layouts = computed_once(found.templates.select(F.col("host").alias(host), F.col("layout").alias(key), F.lit(True).alias(known)))
    # As text, so that its true size is measured, and so that a task reads it once.
    templates = computed_once(found.templates.select(
        F.col("host").alias(host), F.col("layout").alias(key),
        F.to_json(F.struct("depth", "label", "constant")).alias(template),
    ))

    def weights(*keys: str) -> Callable[[], DataFrame]:
        sizes = found.sizes.select(F.col("host").alias(host), F.col("layout").alias(key), "weight")
        return lambda: sizes.groupBy(*keys).agg(F.sum("weight").alias("weight"))

    rows = pages.withColumn(host, host_of(pages["url"])).withColumn(row, F.monotonically_increasing_id())
    rows = lookup_join(rows, hosts, [host], weights(host), row, "left")
    rows = rows.withColumn(own, blocks("html", names)).withColumn(key, F.col(f"{own}.layout"))
    rows = lookup_join(rows, layouts, [host, key], weights(host, key), row, "left")
    rows = rows.withColumn(key, F.when(F.col(known), F.col(key)).otherwise(F.lit(REST).cast("long")))
    rows = lookup_join(rows, templates, [host, key], weights(host, key), row, "left")
    text = extracted(f"{own}.depth", f"{own}.label", f"{own}.text", F.col(known).isNull(), template)
    return rows.select(*[c for c in pages.columns if c.lower() != name.lower()], text.alias(name))


def op10_html_wrapper(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and that text's code points."""
    return with_main_text(pages.select("page_id", "url", "html"), "main_text").select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars")
    )
