"""Byte-level BPE with an index of pair occurrences.

Encoding takes the distinct pieces of a batch of texts together. All their symbols lie in one
array; an index maps the rank of each mergeable pair to all places where it stands. The lowest
active rank is taken from a heap, merged at all its places at once, and the lists of the pairs
that come into being beside those places are extended. Places that have changed meanwhile are
skipped when their rank comes up.

Texts are cut at single spaces before anything that is not white space. The splitting pattern of
the vocabulary always has a boundary there, so pieces can be encoded by themselves and remembered.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import small_batches

#: Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a worker remembers; beyond that it starts anew, which changes the speed only.
CACHE_PIECES = 600_000


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies, as char -> byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Bytes of each id, merges by rank, and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        chars, ids = printable_bytes(), spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(chars[c] for c in token) for token, i in ids.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.byte_id = np.zeros(256, np.int32)
        for char, b in chars.items():
            self.byte_id[b] = ids[char]
        self.left = np.array([ids[a] for a, _ in merges], np.int32)
        self.right = np.array([ids[b] for _, b in merges], np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        born = {int(m): r for r, m in enumerate(self.merged)}
        if len(born) < len(merges) or any(max(born.get(int(a), -1), born.get(int(b), -1)) >= r for r, (a, b) in enumerate(zip(self.left, self.right))):
            raise ValueError("merging all places of a rank at once needs ranks that rise with each merge")
        codes = self.left.astype(np.int64) << 32 | self.right
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        # Merge priority follows the ids, so libraries that rank by id agree.
        self.ids_follow_ranks = bool((np.diff(self.merged) > 0).all()) and int(self.byte_id.max()) < int(self.merged.min())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge."""
        codes = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.order[at], -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_all(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after another, and where each word ends; by one pair index."""
    lengths = np.array([len(w) for w in words], np.int64)
    n = int(lengths.sum())
    if not n:
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    symbols = np.append(vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)], np.int32(-2))
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    ends = np.cumsum(lengths)
    full = lengths > 0
    after[ends[full] - 1] = n  # place n ends every word
    before[(ends - lengths)[full]] = -1

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def file(places: np.ndarray) -> None:
        """Add places to the lists of the pairs that stand there."""
        rank = vocab.ranks(symbols[places], symbols[after[places]])
        places, rank = places[rank >= 0], rank[rank >= 0]
        by = np.argsort(rank, kind="stable")
        places, rank = places[by], rank[by]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        firsts = [0, *cuts.tolist()] if len(rank) else []
        for a, b in zip(firsts, [*firsts[1:], len(rank)]):
            r = int(rank[a])
            if r not in index:
                index[r] = []
                heapq.heappush(active, r)
            index[r].append(places[a:b])

    file(np.flatnonzero(after[:n] < n).astype(np.int32))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        a, b = vocab.left[r], vocab.right[r]
        at = at[(symbols[at] == a) & (symbols[after[at]] == b)]
        if a == b and len(at) > 1:  # in a run of equal symbols, every other pair from the left
            at = np.sort(at)
            fresh = np.append(True, after[at[:-1]] != at[1:])
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        then = after[gone]
        symbols[at], symbols[gone] = vocab.merged[r], -1
        after[at] = then
        inner = then < n
        before[then[inner]] = at[inner]
        previous = before[at]
        file(np.unique(np.concatenate([at[inner], previous[previous >= 0]])))
    alive = symbols[:n] >= 0
    return symbols[:n][alive], np.append(0, np.cumsum(alive))[ends]


@lru_cache(maxsize=4)
def library(path: str):
    """The same vocabulary in the tiktoken library, for operators that only consume tokens."""
    import tiktoken

    vocab = vocabulary(path)
    if not vocab.ids_follow_ranks:
        raise ValueError("the library ranks merges by id, which this vocabulary does not follow")
    plain = {b: i for i, b in vocab.bytes_of.items() if b.decode("utf-8", "replace") not in vocab.special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=plain, special_tokens=vocab.special)


def library_ids(text: str, path: str) -> np.ndarray:
    """Ids of a whole text; strings that spell a special token become that token."""
    return library(path).encode_to_numpy(text, allowed_special="all")


class Encoder:
    """Ids of whole texts, as little-endian 32-bit numbers; remembers the pieces it has seen.

    A piece that follows a space is kept under its own text, the head of a text under the text
    after a line feed; no piece after a space begins with white space, so the two cannot meet.
    """

    def __init__(self, path: str):
        self.vocab, self.known = vocabulary(path), {}
        self.words = regex.compile(PATTERN).findall
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.vocab.special, key=len, reverse=True))) + ")") if self.vocab.special else None
        self.odd = re.compile(r" (?:\s|$)").search
        self.cut = re.compile(r" (?=\S)").split

    def pieces(self, text: str) -> list[str]:
        found = self.cut(text) if self.odd(text) else text.split(" ")
        found[0] = "\n" + found[0]
        return found

    def sections(self, text: str) -> list[str]:
        """The text between special tokens, and those tokens at the odd places."""
        if self.specials is None or not any(s in text for s in self.vocab.special):
            return [text]
        return self.specials.split(text)

    def learn(self, texts: Iterable[str]) -> None:
        """Encode the pieces that are not known yet, all together."""
        seen: set[str] = set()
        for text in texts:
            for section in self.sections(text)[::2]:
                seen.update(self.pieces(section))
        if len(self.known) + len(seen) > CACHE_PIECES:
            self.known.clear()
        new = [p for p in seen if p not in self.known]
        parts = [self.words(p[1:] if p[0] == "\n" else " " + p) for p in new]
        distinct = list({w for part in parts for w in part})
        ids, ends = merge_all([w.encode() for w in distinct], self.vocab)
        flat, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
        spelled = {w: flat[a:b] for w, a, b in zip(distinct, [0, *ends], ends)}
        self.known.update(zip(new, (b"".join(map(spelled.__getitem__, part)) for part in parts)))

    def ids(self, text: str) -> bytes:
        """The ids of a text whose pieces are known."""
        found = []
        for k, section in enumerate(self.sections(text)):
            if k % 2:
                found.append(self.vocab.special[section].to_bytes(4, "little"))
            elif section:
                found.extend(map(self.known.__getitem__, self.pieces(section)))
        return b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process; what it remembers outlives a task."""
    return Encoder(path)


def _encode_batches(path: str, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in small_batches(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            own.learn(texts)
            ids = [own.ids(t) for t in texts]
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, out])

    return run


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns and the ids of each whole text.

    Null and empty texts have no ids. Strings that spell a special token become that token, as in
    the tokenizers library. A column already called ``out`` is replaced.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_encode_batches(path, text, out), schema)


def _decode_batches(path: str, ids: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.empty(max(vocabulary(path).bytes_of) + 1, object)
        table[:] = b""
        for i, spelled in vocabulary(path).bytes_of.items():
            table[i] = spelled
        for batch in batches:
            texts = [None if x is None else b"".join(table[np.asarray(x, np.int64)].tolist()).decode("utf-8", "replace") for x in (y.values.to_numpy() if y.is_valid else None for y in batch.column(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return run


def decode(encoded_docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the text of each list of ids, special tokens spelled out (null: null)."""
    encoded_docs = encoded_docs.drop(out)
    schema = T.StructType([*encoded_docs.schema.fields, T.StructField(out, T.StringType())])
    return encoded_docs.mapInArrow(_decode_batches(path, ids, out), schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Round trip of every document: number of ids, and digests of ids and decoded text."""
    both = decode(encode(docs.select("doc_id", "text"), path).select("doc_id", "ids"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
