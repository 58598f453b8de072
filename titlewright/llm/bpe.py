"""Byte-level BPE encoding and decoding with a lexicon of the corpus's frequent words.

Words are what white space leaves, with the one space before them. Where every space of a text stands between two other
characters, each word's encoding is independent of its neighbours, so a text is encoded word by word; any other text is
encoded by the tokenizer's own splitting rule as a whole. Words are counted over all documents; the most frequent ones are
encoded once and compiled into a transducer that every worker maps into memory. Other words are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlewright.llm.arrow import longs, map_arrow
from titlewright.llm.files import create_bytes, open_fs
from titlewright.llm.transducer import Transducer, compile_words, packed
from titlewright.session import discard, materialize, scratch

#: Fixed value: the splitting rule of byte-level BPE tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNEVEN = re.compile(r" \s|\s ")
_OTHER_SPACE = re.compile("[" + "".join(re.escape(chr(i)) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n") + "]")
#: Marks that don't begin a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
_PLAIN_WORDS = bytes(i if chr(i).isalnum() or i > 127 else 32 for i in range(256))
_WORKER: dict = {}


def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it is visible, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else extra))
        extra += b not in shown
    return out


def uneven(text: str) -> bool:
    """Whether a space begins or ends the text or stands beside other white space. The usual texts need no pattern for it."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return True
    return _OTHER_SPACE.search(text) is not None and _UNEVEN.search(text) is not None


class Vocabulary:
    """Merges and ids of a byte-level BPE tokenizer file without normaliser or prefix space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        chars = byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.start = [ids[c] for c in chars]
        self.pairs, self.merged = {}, []
        for rank, merge in enumerate(spec["model"]["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs.setdefault(ids[x] << 32 | ids[y], rank)
            self.merged.append(ids[x + y])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None

    def merge(self, word: bytes) -> list[int]:
        """Merges the pair of least rank, the leftmost of equals, until none is left."""
        ids = list(map(self.start.__getitem__, word))
        if len(ids) > 64:
            return self._merge_long(ids)
        get, merged, none = self.pairs.get, self.merged, 1 << 40
        ranks = [get(x << 32 | y, none) for x, y in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            ids[i] = new = merged[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | new, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, in n log n steps."""
        n = len(ids)
        before, after, get = list(range(-1, n - 1)), [*range(1, n), -1], self.pairs.get
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (rank := get(ids[k] << 32 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (rank, k, ids[k], ids[after[k]]))
        return [i for i in ids if i >= 0]


class _Memo(dict):
    """Packed ids of keys, computed on demand. When there are too many they become the old generation, from which keys that are
    asked for again return; the generation before goes."""

    def __init__(self, make, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 100:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    def __init__(self, path: str, lexicon: Transducer | None = None, memo: int = 330_000):
        self.vocab, self.lexicon = Vocabulary(path), lexicon
        self.split = regex.compile(SPLIT)
        self.words, self.tokens = _Memo(self._word, memo), _Memo(self._token, memo // 4)
        self.marks = {m: self._token(m) for m in _MARKS}

    def _token(self, token: str) -> bytes:
        if token[0] == " " and token[1:].isalpha():
            return self.words[token[1:]]
        return array("I", self.vocab.merge(token.encode("utf-8", "surrogatepass"))).tobytes()

    def _word(self, word: str) -> bytes:
        """A word with the space before it. Letters alone are one token; so are they before a mark, which is another."""
        if word.isalpha():
            raw = (" " + word).encode()
            got = self.lexicon.get(raw) if self.lexicon else None
            return array("I", self.vocab.merge(raw)).tobytes() if got is None else got
        mark = self.marks.get(word[-1:])
        if mark is not None and (rest := word[:-1]).isalpha():
            return self.words[rest] + mark
        return self._plain(" " + word)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.split.findall(text)))

    def _piece(self, text: str) -> bytes:
        if uneven(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        return self._plain(first) + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text; the strings of added tokens become those tokens."""
        special = self.vocab.special
        if special is None or not special.search(text):
            return self._piece(text)
        out, at = [], 0
        for m in special.finditer(text):
            out += [self._piece(text[at : m.start()]), packed([self.vocab.added[m[0]]])]
            at = m.end()
        return b"".join([*out, self._piece(text[at:])])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _count_rows(it, most: int = 400_000):
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in it:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(text.translate(_PLAIN_WORDS).split())
                if len(counts) > most:
                    yield out()
                    counts.clear()
    yield out()


def frequent_words(docs: DataFrame, words: int) -> list[bytes]:
    """The most frequent words without their marks, `words` at most, counted over all documents: all those that are at least as
    frequent as a bound, which is the least one (among steps of a sixteenth of a doubling) that gives no more than that. Ties are
    in or out together; repeated rows count each time; null and empty texts have no words; words of over 64 bytes or of one
    occurrence are left to the merging of texts, however long these are; an empty table gives none."""
    src = docs.select(F.col("text").cast("binary").alias("text"))
    counts = map_arrow(src, _count_rows, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1 and length(word) <= 64")
    counts = materialize(counts, "words")
    step = F.floor(F.log2("n") * 16)
    held, bound = 0, None
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # about a thousand steps at most
        held += row["count"]
        if held > words:
            break
        bound = row["step"]
    found = [] if bound is None else sorted(bytes(r[0]) for r in counts.where(step >= bound).select("word").collect())
    discard(counts)
    return found


def _letters(word: bytes) -> bool:
    try:
        return word.decode().isalpha()
    except UnicodeDecodeError:
        return False


def _encode_rows(it, path: str, name: str, full: bool):
    if _WORKER.get("name") != name:
        _WORKER.clear()
        system, file = open_fs(name)
        if isinstance(system, fs.LocalFileSystem):  # a mounted folder: workers of one machine share the mapped pages
            with open(file, "rb") as f:
                _WORKER.update(name=name, encoder=Encoder(path, Transducer(f)))
        else:
            with system.open_input_file(file) as f:
                _WORKER.update(name=name, encoder=Encoder(path, Transducer(f.read())))
    encoder = _WORKER["encoder"]
    for batch in it:
        texts = batch.column(1)
        for lo in range(0, len(texts), 256):
            ids = [encoder.encode(t or "") for t in texts.slice(lo, 256).to_pylist()]
            n = len(ids)
            columns = [batch.column(0).slice(lo, n), longs(np.array([len(x) // 4 for x in ids])), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())]
            columns += [pa.array([hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def bpe(docs: DataFrame, path: str, lexicon_words: int = 262_144, full: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with full, the ids, for every row.

    path: the tokenizer's file, the same on all machines. lexicon_words bounds the lexicon, a file of a few MB in the shared
    folder; what is outside it is merged word by word, so the bound has no effect on results. Null and empty texts
    have no tokens. Repeated rows are encoded alike, null ids stay null, other columns are ignored, an empty table gives none.
    """
    spark = docs.sparkSession
    src = docs.select("doc_id", "text")
    encoder = Encoder(path)
    entries = {b" " + w: packed(encoder.vocab.merge(b" " + w)) for w in frequent_words(src, lexicon_words) if _letters(w)}
    name = scratch(spark, "lexicon")  # read for as long as the result is; goes when the driver ends
    create_bytes(spark, name, compile_words(entries))
    kind = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * full
    return map_arrow(src.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), lambda it: _encode_rows(it, path, name, full), kind)
