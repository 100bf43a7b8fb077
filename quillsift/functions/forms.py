"""Match forms, words and n-gram keys in Arrow batches: what T2, T3 and T16 say, read from bytes."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLAIN = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for c in range(256))
_U, _KNOWN, _CHUNK = np.uint64, 200_000, 256


def words(text: str | None) -> list[bytes]:
    """Every byte but ASCII letters and digits of the lower-cased text parts words."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def form(text: str | None) -> str:
    """T2."""
    return b" ".join(words(text)).decode("ascii")


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KNOWN:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_HASHES = _Hashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def gram_keys(said: list[bytes], n: int, raw: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Keys (64 and 31 bits) of the n-grams of a list of words: each once, in ascending order; all in order if ``raw``."""
    if len(said) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    w = np.fromiter(map(_HASHES.__getitem__, said), _U, len(said))
    v, m = _mix(w + _U(0x9E3779B97F4A7C15)), len(said) - n + 1
    h, g = np.zeros(m, _U), np.zeros(m, _U)
    for k in range(n):
        h = (h ^ (h >> _U(29))) * _U(0x9E3779B97F4A7C15) + w[k : k + m]
        g = (g ^ (g >> _U(31))) * _U(0xD6E8FEB86659FD93) + v[k : k + m]
    h, i = _mix(h).view(np.int64), (_mix(g) >> _U(33)).astype(np.int32)
    if not raw:
        order = np.argsort(h, kind="stable")
        h, i = h[order], i[order]
        first = np.ones(m, bool)
        first[1:] = (h[1:] != h[:-1]) | (i[1:] != i[:-1])
        h, i = h[first], i[first]
    return h, i


def grams(records: DataFrame, text: str, n: int, raw: bool = False, least: int = 0) -> DataFrame:
    """T16 as rows (id, h, i): a key of 95 bits for each distinct n-gram of a text; for each place of one if ``raw``. Texts of
    fewer than ``least`` words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                keys = [gram_keys(w if len(w := words(t)) >= least else [], n, raw) for t in part.column(1).to_pylist()]
                ids = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), [len(h) for h, _ in keys])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate([h for h, _ in keys])), pa.array(np.concatenate([i for _, i in keys]))], names=["id", "h", "i"])

    kind = records.schema["id"].dataType.simpleString()
    return records.select("id", F.col(text).cast("string")).mapInArrow(run, f"id {kind}, h long, i int")


def placed_grams(records: DataFrame, text: str, n: int) -> DataFrame:
    """Rows (id, h, i, pos) of each distinct n-gram of a text with its first place."""

    def first(said: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, i = gram_keys(said, n, True)
        _, at = np.unique(h, return_index=True)
        return h[at], i[at], at.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                keys = [first(words(t)) for t in part.column(1).to_pylist()]
                ids = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), [len(k[0]) for k in keys])))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(np.concatenate([k[c] for k in keys])) for c in range(3)]], names=["id", "h", "i", "pos"])

    kind = records.schema["id"].dataType.simpleString()
    return records.select("id", F.col(text).cast("string")).mapInArrow(run, f"id {kind}, h long, i int, pos int")


def _digest(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def packed(x: Column) -> Column:
    """Text, compressed, to travel to its pairs."""
    return _each(lambda t: None if t is None else zlib.compress(t.encode("utf-8", "surrogatepass")), "binary")(x)


def unpacked(x: bytes | None) -> str:
    return "" if x is None else zlib.decompress(x).decode("utf-8", "surrogatepass")


def _each(fn, kind: str):
    @F.pandas_udf(kind)
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series([fn(x) for x in xs], dtype="object")

    return run


def form_key(x: Column) -> Column:
    """A key of the match form; null for an empty one."""
    return _each(lambda t: _digest(b" ".join(w)) if (w := words(t)) else None, "binary")(x)


def long_form_key(least: int):
    """A key of the match form of ``least`` words and more."""
    return _each(lambda t: _digest(b" ".join(w)) if len(w := words(t)) >= max(1, least) else None, "binary")


def prefix_key(x: Column) -> Column:
    """B1's key: the first 15 words and the number of words in forties; null without words."""
    return _each(lambda t: _digest(b"%d|" % (len(w) // 40) + b" ".join(w[:15])) if (w := words(t)) else None, "binary")(x)


def gram_count(n: int):
    """How many distinct n-grams a text has."""
    return _each(lambda t: len(gram_keys(words(t), n)[0]), "long")


def packed_bag(text: str | None) -> bytes:
    """The distinct words of a text, sorted, and how often each comes, compressed."""
    n = Counter(words(text))
    said = sorted(n)
    return zlib.compress(b" ".join(said) + b"\n" + b" ".join(b"%d" % n[w] for w in said))


@lru_cache(maxsize=64)
def unpacked_bag(bag: bytes) -> tuple[dict[bytes, int], int]:
    said, counts = (x.split() for x in zlib.decompress(bag).split(b"\n"))
    n = list(map(int, counts))
    return dict(zip(said, n, strict=True)), sum(n)


def bag(x: Column) -> Column:
    return _each(packed_bag, "binary")(x)


def shared_of(x: bytes, y: bytes) -> float:
    """V8: twice the common words over all words of two bags; 0 without a common word."""
    (few, n), (many, m) = sorted((unpacked_bag(x), unpacked_bag(y)), key=lambda v: len(v[0]))
    common = sum(min(k, many[w]) for w, k in few.items() if w in many)
    return 2 * common / (n + m) if common else 0.0


def common_share(x: Column, y: Column) -> Column:
    """V8 of two columns of ``bag``."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([shared_of(p, q) for p, q in zip(a, b, strict=True)], dtype="float64")

    return run(x, y)
