"""Best-fit packing of token sequences by the numbers of pieces of each length.

Best fit, largest first, depends on nothing but how many pieces there are of each length, at most ``size`` numbers. The driver adds
those up and packs them: a run says that the pieces of one length from a rank on go, so many to a sequence, to consecutive
sequences. Bins of the same room that follow each other are one group, and of the groups that a length meets all but the last
are filled alike, so runs and groups grow with the lengths, not with the table. Each piece then finds its place by its length and
its rank among all pieces of that length: its number in its partition, after those of the partitions before. So all pieces are
packed against all others, whatever partition they come from, and no bin is settled or held back before its time.

Partitions and numbers in them are settled once, in a table in the shared folder, whatever is lost later.

Defined cases: a null or empty text is its end id alone; only texts of more than ``size`` ids are cut; repeated rows and doc_ids
are packed each on its own; a null doc_id stays null; an empty table gives an empty result; columns of other names are
left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsift.llm.tokens import crc, encoded, vocabulary
from quillsift.scratch import small_batches, staged

SIZE = 2048
#: Limits of the tree of nodes that packed before; nothing reads them any more, a test of that form still sets them.
HANDED, CHUNK = 25_000, 200_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: With the partition, and how many pieces of the same length come before in it.
NUMBERED = f"{PIECES}, part int, nth bigint"
_KINDS = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_RANKS = 40


def _cut(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encoded(path, b["text"]), strict=True):
                out += [(doc_id, k // size, k, len(part := ids[k : k + size]), crc(part)) for k in range(0, len(ids), size)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _KINDS, strict=True)], names=[f.name for f in _KINDS])

    return run


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """``NUMBERED`` pieces of each whole text, in one scan."""
    cut, number = _cut(path, size), _number(size)
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda batches: number(cut(batches)), NUMBERED)


def runs(counts: dict[int, int], capacity: int = SIZE) -> tuple[np.ndarray, int]:
    """Best fit of ``counts`` pieces by length, largest first, each to the fullest sequence that takes it: runs (length, first rank,
    pieces a sequence, first sequence, offset in each), ascending, and the number of sequences."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence of a group, how many
    open_, made, out = 0, 0, []  # open_: bit r is set if a group has room r
    for n in sorted(counts, reverse=True):
        rank, left = 0, counts[n]
        while left:
            fits = open_ >> n
            if fits:
                r = n + (fits & -fits).bit_length() - 1
                first, many = room[r].pop()
                if not room[r]:
                    open_ &= ~(1 << r)
            else:
                r, first, many = capacity, made, -(-left // (capacity // n))
                made += many
            per = r // n
            full = min(many, left // per)
            rest = left - full * per if full < many else 0  # for one more sequence
            out.append((n, rank, per, first, capacity - r))
            for at, m, free in ((first, full, r - per * n), (first + full, int(rest > 0), r - rest * n), (first + full + (rest > 0), many - full - (rest > 0), r)):
                if m and free:
                    room[free].append((at, m))
                    open_ |= 1 << free
            rank, left = rank + full * per + rest, left - full * per - rest
    return np.array(sorted(out), np.int64).reshape(-1, 5), made


def places(found: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences and offsets of pieces by their lengths and their ranks among all of that length."""
    run = found[np.searchsorted((found[:, 0] << _RANKS) + found[:, 1], (lengths << _RANKS) + ranks, side="right") - 1]
    nth = ranks - run[:, 1]
    return run[:, 3] + nth // run[:, 2], run[:, 4] + nth % run[:, 2] * lengths


def numbers(lengths: np.ndarray) -> np.ndarray:
    """Of each, how many of the same length stand before it."""
    order = np.argsort(lengths, kind="stable")
    ordered, out = lengths[order], np.empty(len(lengths), np.int64)
    out[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered, side="left")
    return out


def best_fit(sizes: list[int], capacity: int = SIZE) -> list[list[int]]:
    """Bins of item indices."""
    found, made = runs(Counter(sizes), capacity)
    bins: list[list[int]] = [[] for _ in range(made)]
    lengths = np.array(sizes, np.int64)
    sequences, offsets = places(found, lengths, numbers(lengths)) if sizes else (lengths, lengths)
    for i in np.argsort(offsets, kind="stable").tolist():
        bins[sequences[i]].append(i)
    return bins


def _number(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            lengths = b["length"].to_numpy()
            nth = numbers(lengths) + before[lengths]
            before += np.bincount(lengths, minlength=size + 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth)], names=[*b.schema.names, "part", "nth"])

    return run


def _place(found: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                at = places(found, b["length"].to_numpy(), b["nth"].to_numpy())
                yield pa.RecordBatch.from_arrays([*(b[f.name] for f in _KINDS), *map(pa.array, at)], names=[*(f.name for f in _KINDS), "sequence_id", "offset"])

    return run


def pack(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``PIECES`` with sequence_id and offset."""
    return pack_numbered(items.select(*[f.name for f in _KINDS]).mapInArrow(_number(size), NUMBERED), size)


def pack_numbered(items: DataFrame, size: int = SIZE) -> DataFrame:
    """``NUMBERED`` pieces with sequence_id and offset in place of their numbers."""
    now = staged(items, "pieces")
    counts = staged(now.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pieces-by-length")
    found, _ = runs({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)  # one row a length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = now.join(starts.hint("merge"), ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
    return ranked.mapInArrow(_place(found), f"{PIECES}, sequence_id bigint, offset bigint")


def best_fit_packing(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text), placed."""
    return pack_numbered(pieces(docs, path, size), size)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """The contract's placement of all ``documents``."""
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), vocabulary("word_bpe_49k.json"))
