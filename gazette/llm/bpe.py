"""BPE encoding and decoding with batched numpy merge rounds.

Reads a word-level BPE file (byte alphabet, an end-of-word suffix on each word's
last symbol, NFC + lower-case normaliser, white space dropped).  The words of a
batch that have not been seen yet are laid out in one flat array of symbols.  A
round looks all neighbouring pairs up by binary search over the sorted pair keys
``left * vocabulary + right``, takes each word's pair of lowest rank and merges
all its occurrences, left to right; words without a known pair leave the array.
This is exact as every merge of the file makes a symbol of its own, so a pair
that a merge creates always ranks below it (checked when the file is read).

The pre-tokenizer's pattern, the special strings and the alphabet come from the
file.  Special strings inside a text become their own ids, as in the public
library with ``add_special_tokens=False``.  Decoding without a decoder in the
file joins the symbols by one space.

Defined cases: a NULL or empty text has no ids and decodes to the empty text; a
NULL list of ids decodes to the empty text; ids outside the vocabulary decode to
nothing; texts of any length are encoded whole; repeated rows, a NULL ``doc_id`` and other
columns pass through; an empty table gives no rows.
Letters are letters by the Unicode tables of the ``regex`` module; characters
that Unicode assigned only lately may split otherwise in the public library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import free_name, text_batches

#: Words whose ids a Python worker remembers; then it starts anew.  Results don't depend on it.
REMEMBERED_WORDS = 200_000
_NO_RANK = np.iinfo(np.int64).max

# The characters of Unicode's White_Space property, as \s means them in the file's pattern.
_WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def _byte_alphabet() -> list[str]:
    """The printable character of each byte in the byte-level alphabet: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    shown = [chr(b) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173 else None for b in range(256)]
    spare = iter(range(256, 512))
    return [c or chr(next(spare)) for c in shown]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in pre], spec["decoder"]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], None):
            raise ValueError(f"{path} is not a word-level BPE file of the supported kind")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if len({a + b for a, b in merges}) != len(merges):
            raise ValueError("two merges make the same symbol")
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)[order]
        alphabet = _byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + end] for c in alphabet], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.mark = os.path.commonprefix(list(self.special))  # a text without it holds no special string
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        pattern = pre[0]["pattern"]["Regex"].replace("[^\\s", "[^" + _WHITE_SPACE)
        self.words = regex.compile(pattern).findall
        # the same on ASCII text, where letters and digits are plain ranges
        self.ascii_words = re.compile(pattern.replace(_WHITE_SPACE, r"\x09-\x0D\x20").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")).findall
        symbols = {**vocab, **self.special}
        self.symbols = np.full(max(symbols.values()) + 1, None, object)
        for text, i in symbols.items():
            self.symbols[i] = text
        self.gaps = any(s is None for s in self.symbols)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str | tuple, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the count of each word."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes) - 1
        symbol = self.inner[data]
        symbol[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        rank, product = np.full(len(symbol), _NO_RANK), np.zeros(len(symbol), np.int64)
        self._look_up(np.arange(len(symbol)), symbol, word, rank, product)
        done_symbols, done_words = [], []
        while len(symbol):
            best = np.full(len(words), _NO_RANK)
            np.minimum.at(best, word, rank)
            lowest = best[word]
            over = lowest == _NO_RANK
            if over.any():
                done_symbols.append(symbol[over])
                done_words.append(word[over])
            where = np.flatnonzero((rank == lowest) & ~over)
            if len(where):  # of overlapping hits (a a a), every second one counts, from the left
                new_run = np.concatenate([[True], np.diff(where) != 1])
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - first) % 2 == 0]
            symbol[where] = product[where]
            stay = ~over
            stay[where + 1] = False
            place = np.cumsum(stay) - 1
            symbol, word, rank, product = symbol[stay], word[stay], rank[stay], product[stay]
            # only the pairs on both sides of a merged symbol are new
            merged = place[where]
            self._look_up(np.concatenate([merged, np.maximum(merged - 1, 0)]), symbol, word, rank, product)
        if not done_symbols:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        all_words = np.concatenate(done_words)
        order = np.argsort(all_words, kind="stable")
        return np.concatenate(done_symbols)[order].astype(np.int32), np.bincount(all_words, minlength=len(words))

    def _look_up(self, at: np.ndarray, symbol: np.ndarray, word: np.ndarray, rank: np.ndarray, product: np.ndarray) -> None:
        """Rank and product of the pairs that begin at ``at``, by binary search over the sorted keys."""
        rank[at[at == len(symbol) - 1]] = _NO_RANK
        at = at[at < len(symbol) - 1]
        key = symbol[at] * self.size + symbol[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[found] == key) & (word[at] == word[at + 1])
        rank[at] = np.where(known, self.ranks[found], _NO_RANK)
        product[at] = self.merged[found]

    def _pieces(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        if text.isascii():
            return self.ascii_words(text.lower())
        return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())  # capital sigma, wherever it stands

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the count of each text."""
        if len(self.place) > REMEMBERED_WORDS:
            self._forget()
        found: list[list] = []  # of each text: words, and special strings as one-tuples of their id
        for text in texts:
            if not text:
                found.append([])
            elif self.special and self.mark in text and self.cut.search(text):
                out: list = []
                at = 0
                for m in self.cut.finditer(text):
                    out += self._pieces(text[at : m.start()])
                    out.append((self.special[m[0]],))
                    at = m.end()
                found.append(out + self._pieces(text[at:]))
            else:
                found.append(self._pieces(text))
        fresh = [w for w in dict.fromkeys(chain.from_iterable(found)) if w not in self.place]
        words, marks = [w for w in fresh if type(w) is str], [w for w in fresh if type(w) is not str]
        self._remember(words, *self.merge(words))
        self._remember(marks, np.array([m[0] for m in marks], np.int32), np.ones(len(marks), np.int64))
        per_text = np.array([len(w) for w in found], np.int64)
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(found)), np.int64, per_text.sum())
        begin = self.starts[places]
        length = self.starts[places + 1] - begin
        stops = np.concatenate([[0], np.cumsum(length)])
        source = np.arange(stops[-1]) + np.repeat(begin - stops[:-1], length)
        ends = np.cumsum(per_text)
        return self.flat[source], stops[ends] - stops[ends - per_text]

    def _remember(self, words: list, ids: np.ndarray, counts: np.ndarray) -> None:
        if words:
            first = len(self.starts) - 1
            self.place.update({w: first + i for i, w in enumerate(words)})
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.flat = np.concatenate([self.flat, ids])

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.symbols))]
        symbols = self.symbols[ids].tolist()
        return " ".join(s for s in symbols if s is not None) if self.gaps else " ".join(symbols)


@lru_cache(maxsize=2)
def _load(path: str) -> WordBpe:
    return WordBpe(path)


def _add_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) and ``out``: the ids of ``text``.  ``path`` is the vocabulary file's place on every worker."""
    text_batches(df.sparkSession)
    kept = [c for c in keep or df.columns if c != out]
    given = free_name(kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(path)
        for batch in batches:
            ids, counts = bpe.encode_batch(batch.column(given).to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, out])

    return df.select(*kept, F.col(text).cast("string").alias(given)).mapInArrow(run, _add_column(df.select(*kept), out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and ``out``: the text of ``ids``, special strings included."""
    text_batches(df.sparkSession)
    kept = [c for c in df.columns if c != out]
    given = free_name(kept, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(path)
        for batch in batches:
            lists = batch.column(given)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            some = lists.is_valid().to_numpy(zero_copy_only=False)
            texts = [bpe.decode(flat[a:b]) if ok else "" for a, b, ok in zip(offsets[:-1], offsets[1:], some)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, out])

    return df.select(*kept, F.col(ids).cast("array<int>").alias(given)).mapInArrow(run, _add_column(df.select(*kept), out, T.StringType()))


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and then ``decode`` in one pass of one worker: the columns ``keep`` (all), ``ids`` and ``decoded``."""
    text_batches(df.sparkSession)
    kept = [c for c in keep or df.columns if c not in ("ids", "decoded")]
    given = free_name(kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(path)
        for batch in batches:
            ids, counts = bpe.encode_batch(batch.column(given).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            texts = [bpe.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists, pa.array(texts, pa.string())], names=[*kept, "ids", "decoded"])

    base = df.select(*kept)
    schema = T.StructType([*base.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return df.select(*kept, F.col(text).cast("string").alias(given)).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, and its ``ids`` if wanted."""
    both = round_trip(docs, path, keep=["doc_id"])
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )
