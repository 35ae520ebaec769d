"""Encoding and decoding with a word BPE vocabulary, by an index of pair occurrences.

Texts are cut at ASCII white space into chunks; equal chunks of a batch are one dictionary
entry and are encoded once. A chunk is split at added tokens, normalised and pre-tokenized
into words by the vocabulary file's own components, and the words that no earlier batch
of the task had are merged together (``pair_index``). A text's ids are its chunks' ids in
order. No merge, normal form or word reaches over white space, so this is what the whole
text gives.

Defined cases: a null text is empty and has no ids; white space alone has none either;
repeated rows are encoded each; an empty table gives an empty result. Columns other than the
text are kept by ``encode`` and ``decode`` as they are, and a new column whose name is
taken (in any letter case) is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewarden.llm.pair_index import GAP, PairMerges
from gatewarden.llm.text_batches import Slice, slices, words_of

#: Bytes of text encoded together; bounds a task's arrays, not the texts.
BATCH_BYTES = 6 << 20
#: Ids a task remembers of words and chunks that it has seen.
REMEMBERED_IDS = 4_000_000

# The vocabulary file's word pattern, and what it is on lower-case printable ASCII.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

_DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    """One vocabulary with the chunks that this process has encoded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        unsupported = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback") if model.get(k)]
        if unsupported or described.get("decoder") or described.get("post_processor"):
            raise ValueError(f"this vocabulary file needs more than words and merges: {unsupported}")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.folds = _folds(described)
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = PairMerges(*(
            np.array([self.vocabulary[t] for t in side], np.int64)
            for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        ))
        added = {t["content"]: t["id"] for t in described.get("added_tokens", ())}
        if any(t[f] for t in described.get("added_tokens", ()) for f in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that are matched otherwise than as they stand")
        self.added = added
        names = "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))
        self.added_pattern = re.compile(f"({names})") if added else None
        self.tokens = [""] * (1 + max([*self.vocabulary.values(), *added.values()]))
        for token, number in chain(self.vocabulary.items(), added.items()):
            self.tokens[number] = token
        self.fixed = dict(added)  # words that are one id and are never merged
        points = np.array([ord(t) for t in self.vocabulary if len(t) == 1])
        self.symbol, self.final = (np.full(int(points.max(initial=0)) + 2, GAP, np.int64) for _ in range(2))
        for token, number in self.vocabulary.items():
            if len(token) == 1:
                self.symbol[ord(token)] = number
            if len(token) == 1 + len(self.suffix) and token.endswith(self.suffix):
                self.final[ord(token[0])] = number
        self._forget()

    def _forget(self) -> None:
        self.words, self.chunks = IdTable(), IdTable()
        self.words.add(list(self.fixed), np.array(list(self.fixed.values()), np.int32), np.ones(len(self.fixed), np.int64))

    def _words(self, chunk: str) -> list[str]:
        """A chunk's added tokens and words, in order."""
        if self.folds and chunk.isascii() and "<" not in chunk and chunk.isprintable() and chunk == chunk.lower():
            return [chunk] if chunk.isalpha() else PLAIN.findall(chunk)
        out: list[str] = []
        for piece in self.added_pattern.split(chunk) if self.added_pattern else [chunk]:
            if piece in self.added:
                out.append(piece)
            elif piece:
                normal = self.normalizer.normalize_str(piece) if self.normalizer else piece
                out += [word for word, _ in self.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def _merge(self, words: list[str]) -> None:
        """Encode new words (none empty) together and remember them."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.minimum(points, len(self.symbol) - 1)
        symbols = self.symbol[points]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[points[last]]
        known = symbols != GAP
        word = np.repeat(np.arange(len(words)), sizes)[known]
        ids, sizes = self.merges.merged(symbols[known], np.bincount(word, minlength=len(words)))
        self.words.add(words, ids.astype(np.int32), sizes)

    def chunk_codes(self, chunks: list[str]) -> np.ndarray:
        """The rows of the table ``self.chunks`` that hold the ids of each chunk."""
        if len(self.words) + len(self.chunks) > REMEMBERED_IDS:
            self._forget()
        new = [c for c in chunks if c not in self.chunks.row]
        if new:
            parts = [self._words(c) for c in new]
            flat = list(chain.from_iterable(parts))
            unseen = [w for w in dict.fromkeys(flat) if w not in self.words.row]
            if unseen:
                self._merge(unseen)
            codes = np.fromiter(map(self.words.row.__getitem__, flat), np.int64, len(flat))
            ids, sizes = self.words.of(codes)
            owner = np.repeat(np.arange(len(new)), np.fromiter(map(len, parts), np.int64, len(parts)))
            totals = np.bincount(owner, weights=sizes, minlength=len(new)).astype(np.int64)
            self.chunks.add(new, ids, totals)
        return np.fromiter(map(self.chunks.row.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the rows of a slice: row i has ids[offsets[i]:offsets[i + 1]]."""
        found = words_of(part, hashes=False)
        offsets = np.zeros(part.rows + 1, np.int64)
        if not len(found.start):
            return np.zeros(0, np.int32), offsets
        sizes = found.end - found.start
        bounds = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        text = part.data[_ranges(found.start, sizes)]
        if self.folds:
            text = _lowered(text, bounds)
        coded = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(text)).dictionary_encode()
        codes = self.chunk_codes(coded.dictionary.to_pylist())
        ids, own = self.chunks.of(codes[coded.indices.to_numpy(zero_copy_only=False)])
        totals = np.zeros(len(own) + 1, np.int64)
        np.cumsum(own, out=totals[1:])
        offsets[1:] = totals[np.searchsorted(found.row, np.arange(part.rows), "right")]
        return ids, offsets

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, as a vocabulary file without a decoder has it."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _folds(described: dict) -> bool:
    """Whether the file lower-cases, splits by WORDS and has added tokens with ``<`` only.

    Chunks of printable ASCII without ``<`` then need neither its normaliser nor its splitter.
    """
    steps = (described.get("normalizer") or {}).get("normalizers", [])
    splits = [p.get("pattern", {}).get("Regex") for p in (described.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and splits == [WORDS, None]
        and all("<" in t["content"] for t in described.get("added_tokens", ()))
    )


def _lowered(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The chunks' bytes with A-Z in lower case in chunks of printable ASCII that hold no ``<``.

    Equal up to letter case, they then are one dictionary entry. Others keep their case,
    as normal forms and added tokens depend on it.
    """
    other = np.zeros(len(text) + 1, np.int64)
    np.cumsum((text < 0x21) | (text > 0x7E) | (text == 0x3C), out=other[1:])
    plain = other[bounds[1:]] == other[bounds[:-1]]
    upper = (text >= 0x41) & (text <= 0x5A) & np.repeat(plain, np.diff(bounds))
    return text + np.where(upper, np.uint8(0x20), np.uint8(0))


class IdTable:
    """Texts with their ids, one run of a flat array each."""

    def __init__(self) -> None:
        self.row: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start = self.size = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.flat)

    def add(self, texts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Enter texts that are not there yet; ``ids`` are theirs, one after another."""
        self.row.update(zip(texts, range(len(self.size), len(self.size) + len(texts))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the rows one after another, ids per row)."""
        sizes = self.size[rows]
        return self.flat[_ranges(self.start[rows], sizes)], sizes


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def _refuse(docs: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {name} already")


def encode(docs: DataFrame, text: str = "text", into: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """Add ``into``: the token ids of the whole text, array<int>."""
    _refuse(docs, into)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        own = vocabulary(tokenizer or default_tokenizer())
        rows: list[np.ndarray] = []
        for part in slices(texts, BATCH_BYTES):
            numbers, offsets = own.encode(part)
            rows += np.split(numbers, offsets[1:-1])
        return pa.array(rows, pa.list_(pa.int32()))

    return docs.withColumn(into, ids(text))


def decode(docs: DataFrame, ids: str = "ids", into: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """Add ``into``: the text of the ids; null ids are none."""
    _refuse(docs, into)

    @F.arrow_udf("string")
    def decoded(rows: pa.Array) -> pa.Array:
        own = vocabulary(tokenizer or default_tokenizer())
        return pa.array([own.decode(r or []) for r in rows.to_pylist()], pa.string())

    return docs.withColumn(into, decoded(ids))


def op11_pair_index_bpe(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, and digests of its ids and of the text they decode to.

    The ids are those of ``encode``, the texts those of ``decode``; both stay in the
    task that made them and only the digests leave it.
    """
    @F.arrow_udf(_DIGESTS)
    def digests(texts: pa.Array) -> pa.Array:
        own = vocabulary(tokenizer or default_tokenizer())
        decimal = [str(i) for i in range(len(own.tokens))]
        out = []
        for part in slices(texts, BATCH_BYTES):
            numbers, offsets = own.encode(part)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                ids = numbers[a:b].tolist()
                out.append({
                    "n_tokens": b - a,
                    "ids_sha256": hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(own.decode(ids).encode()).hexdigest(),
                })
        return pa.array(out, pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    return docs.select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")
