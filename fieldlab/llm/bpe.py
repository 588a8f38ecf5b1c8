"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding.

The vocabulary file is that of a byte-level tokenizer in the ``tokenizers`` JSON format. Its path is a parameter and
each Python worker reads it once.

Nulls are empty texts with no ids. Repeated rows and ties need no rule, as each row is encoded alone. Other columns
are kept, whatever their names, but for the output columns, which are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.llm.frames import arrow_map, free, texts_of

#: Fixed value: the public pre-tokenizer pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Encoded words a worker remembers; when full, it starts anew.
REMEMBERED = 600_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


#: Bits of an id, and of a place in a word, in the packed numbers below.
_ID, _PLACE = 20, 40


def merged(symbols: list[int], ranks: dict[int, int]) -> list[int]:
    """Apply merges to the symbols of one word, the lowest rank first, the leftmost of equal ranks first.

    ``ranks`` has, by ``left << 20 | right``, ``rank << 20 | merged id``; the queue holds that and the left symbol's place in one
    number each.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    find = ranks.get
    queue = []
    for i in range(n - 1):
        merge = find(symbols[i] << _ID | symbols[i + 1])
        if merge is not None:
            queue.append(merge << _PLACE | i)
    heapq.heapify(queue)
    while queue:
        top = heapq.heappop(queue)
        merge, i = top >> _PLACE, top & ((1 << _PLACE) - 1)
        j = after[i]
        if symbols[i] < 0 or j >= n or find(symbols[i] << _ID | symbols[j]) != merge:
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = merge & ((1 << _ID) - 1), -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            made = find(symbols[i] << _ID | symbols[k])
            if made is not None:
                heapq.heappush(queue, made << _PLACE | i)
        k = before[i]
        if k >= 0:
            made = find(symbols[k] << _ID | symbols[i])
            if made is not None:
                heapq.heappush(queue, made << _PLACE | k)
    return [s for s in symbols if s >= 0]


class Remembered(dict):
    """Packed ids by word; at most ``REMEMBERED`` of them."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = merged([self.tokenizer.of_byte[b] for b in word.encode()], self.tokenizer.ranks)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            self[word] = packed
        return packed


class Tokenizer:
    """Ids of texts and texts of ids by one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary = told["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.of_byte = [vocabulary[c] for c in letters]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in told["model"]["merges"]]
        self.ranks = {
            vocabulary[a] << _ID | vocabulary[b]: rank << _ID | vocabulary[a + b] for rank, (a, b) in reversed([*enumerate(pairs)])
        }
        self.specials = {t["content"]: t["id"] for t in told.get("added_tokens") or []}
        size = 1 + max([*vocabulary.values(), *self.specials.values()])
        self.strings = [b""] * size
        for token, i in vocabulary.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.specials.items():
            self.strings[i] = token.encode()
        self.split = regex.compile(PATTERN).findall
        ordered = sorted(self.specials, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.remembered = Remembered(self)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens become their ids."""
        packed = []
        for piece in self.apart.split(text) if self.apart and self.apart.search(text) else (text,):
            if piece in self.specials:
                packed.append(np.array([self.specials[piece]], "<u4").tobytes())
            else:
                packed.extend(map(self.remembered.__getitem__, self.split(piece)))
        return np.frombuffer(b"".join(packed), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's strings one after the other; bytes that are not UTF-8 become the replacement character."""
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _replaced(df: DataFrame, **new: str) -> tuple[DataFrame, T.StructType]:
    kept = df.drop(*new)
    schema = T.StructType(list(kept.schema.fields))
    for name, kind in new.items():
        schema = schema.add(name, T.ArrayType(T.IntegerType()) if kind == "array<int>" else kind)
    return kept, schema


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the ids (array of int) of a whole text column and the text decoded from them, in one pass."""
    kept, schema = _replaced(df.withColumn("__bpe_text", F.col(text)), **{ids: "array<int>", decoded: "string"})
    schema = T.StructType([f for f in schema.fields if f.name != "__bpe_text"])

    def run(batch: pa.RecordBatch):
        tok, step = tokenizer(path), 64
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            found = [tok.encode(t) for t in texts_of(part.column("__bpe_text"))]
            flat = np.concatenate(found).astype(np.int32)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in part.schema.names if n != "__bpe_text"]
                + [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([tok.decode(f) for f in found], pa.string())],
                names=schema.names,
            )

    return arrow_map(kept, run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of a whole text column as an array of int."""
    spare = free("_decoded", df)
    return encode_decode(df, path, text, ids, spare).drop(spare)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of a column of ids; null ids are none."""
    kept, schema = _replaced(df, **{decoded: "string"})

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tok = tokenizer(path)
        made = [tok.decode(np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=schema.names)

    return arrow_map(kept, run, schema)


@F.pandas_udf(T.StringType())
def ids_sha256(ids):
    """Lowercase hex digest of ids as little-endian unsigned 32-bit integers."""
    import hashlib

    return ids.map(lambda x: hashlib.sha256(np.asarray(x, "<u4").tobytes()).hexdigest())
