"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts earlier are removed.

Earlier is a smaller doc_id, or an earlier start in the same document; strings are judged on the input. Equal whole texts
are one document for the search: their later copies are covered throughout.

To let equal strings meet without sorting the corpus in one place, each string of LENGTH bytes is keyed by the least
hash of the 32-byte grams in it. Neighbouring strings mostly share that gram; such a run, a context of LENGTH bytes and
more, moves as a whole, and only if its key occurs again. Contexts of equal bytes are settled by the earliest. The others
are concatenated in blocks (whole keys, about ``BLOCK`` bytes), whose Burrows-Wheeler transform yields the classes of
equal strings by threshold-bounded interval expansion (``bwt``). A key with more than ``HOT`` contexts is split: its
distinct contexts become single strings, keyed by the hash of their LENGTH bytes.

Defined cases: a null text is empty; texts below LENGTH bytes lose nothing; rows of one doc_id are ordered by the hash of
their text, null doc_ids come last, and rows that repeat doc_id and text are one document (each gets its result);
an empty table gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quillsift.llm import bwt
from quillsift.scratch import small_batches, staged

LENGTH, GRAM, BLOCK, HOT = 100, 32, 400_000, 50_000
_U = np.uint64


def _encode(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def runs(raw: np.ndarray, length: int, most: int = 1 << 23) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first string and number of strings of each run that has one leftmost gram of least hash."""
    strings = len(raw) - length + 1
    if strings > most:  # places take 24 bits
        parts = [runs(raw[k : k + most + length - 1], length, most) for k in range(0, strings, most)]
        return tuple(np.concatenate(x) for x in zip(*((key, start + k * most, count) for k, (key, start, count) in enumerate(parts)), strict=True))
    if strings < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = min(GRAM, length)
    h, n = raw.astype(_U) + _U(1), 1
    base = 0x9E3779B97F4A7C15
    while 2 * n <= gram:
        h = h[:-n] * _U(base) + h[n:]
        base, n = base * base % (1 << 64), 2 * n
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    low = (h & ~_U(0xFFFFFF)) | np.arange(len(h), dtype=_U)
    width, m = length - n + 1, 1
    while 2 * m <= width:
        low = np.minimum(low[:-m], low[m:])
        m *= 2
    if m < width:
        low = np.minimum(low[: len(low) - (width - m)], low[width - m :])
    starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    key = h[(low[starts] & _U(0xFFFFFF)).astype(np.int64)]
    return key.view(np.int64), starts, np.diff(np.append(starts, len(low)))


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list = []
            n = 0

            def made() -> pa.RecordBatch:
                keys, ids, places = (np.concatenate(x) for x in zip(*held, strict=True))
                return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids), pa.array(places)], names=["key", "uid", "place"])

            for uid, t in zip(b["uid"].to_pylist(), b["text"], strict=True):
                keys, starts, counts = runs(np.frombuffer(_encode(t.as_py()), np.uint8), length)
                if len(keys):
                    held.append((keys, np.full(len(keys), uid, np.int64), starts * 512 + counts))
                    n += len(keys)
                if n > 100_000:
                    yield made()
                    held, n = [], 0
            if held:
                yield made()

    return run


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, t, marks in zip(b["uid"].to_pylist(), b["text"], b["marks"], strict=True):
                raw, found = _encode(t.as_py()), marks.values
                keys, places = found.field("key"), found.field("place").to_numpy(zero_copy_only=False)
                starts, counts = places // 512, places % 512
                parts = [raw[s : s + c + length - 1] for s, c in zip(starts.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(parts), uid, np.int64)), pa.array(starts), pa.array(parts, pa.binary())], names=["key", "uid", "start", "bytes"])

    return run


def _merged(uid: np.ndarray, start: np.ndarray, count: np.ndarray, length: int) -> pa.RecordBatch:
    """Byte ranges of runs of removed strings, joined where they touch."""
    by = np.lexsort((start, uid))
    uid, start, stop = uid[by], start[by], (start + count - 1 + length)[by]
    new = np.ones(len(uid), bool)
    new[1:] = uid[1:] != uid[:-1]
    far = np.cumsum(new) << 40  # so that one document's ranges end before the next one's begin
    new[1:] |= (start + far)[1:] > np.maximum.accumulate(stop + far)[:-1]
    at = np.flatnonzero(new)
    stops = np.maximum.reduceat(stop, at) if len(at) else stop
    return pa.RecordBatch.from_arrays([pa.array(uid[at]), pa.array(start[at]), pa.array(stops)], names=["uid", "start", "stop"])


def _blocks(length: int, block: int):
    """Ranges to remove, from contexts sorted by key, bytes, uid, start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        owners: list[tuple[int, int]] = []
        gone: list[tuple[int, int, int]] = []
        held, last = 0, None

        def settle() -> pa.RecordBatch:
            cls, part, offset = bwt.repeats(parts, length)
            own = np.array(owners, np.int64)
            uid, start = own[part, 0], own[part, 1] + offset
            by = np.lexsort((start, uid, cls))
            later = np.zeros(len(by), bool)
            later[1:] = cls[by][1:] == cls[by][:-1]
            uid, start = uid[by][later], start[by][later]
            more = np.array(gone, np.int64).reshape(-1, 3)
            return _merged(np.concatenate((uid, more[:, 0])), np.concatenate((start, more[:, 1])), np.concatenate((np.ones(len(uid), np.int64), more[:, 2])), length)

        for b in batches:
            for key, uid, start, data in zip(b["key"].to_pylist(), b["uid"].to_pylist(), b["start"].to_pylist(), b["bytes"].to_pylist(), strict=True):
                if last == (key, data):
                    gone.append((uid, start, len(data) - length + 1))
                    continue
                if parts and held >= block and key != last[0]:
                    yield settle()
                    parts, owners, gone, held = [], [], [], 0
                last = (key, data)
                parts.append(data)
                owners.append((uid, start))
                held += len(data) + 1
                if len(gone) > 500_000:
                    done = np.array(gone, np.int64)
                    yield _merged(done[:, 0], done[:, 1], done[:, 2], length)
                    gone = []
        if parts:
            yield settle()

    return run


def _windows(length: int):
    """Single strings of the contexts of hot keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, start, data in zip(b["uid"].to_pylist(), b["start"].to_pylist(), b["bytes"].to_pylist(), strict=True):
                parts = [data[i : i + length] for i in range(len(data) - length + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), uid, np.int64)), pa.array(np.arange(start, start + len(parts))), pa.array(parts, pa.binary())], names=["uid", "start", "bytes"])

    return run


def covered(texts: DataFrame, length: int = LENGTH, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """uid, start, stop: byte ranges (they may overlap) to remove from distinct ``texts`` (uid, text)."""
    anchors = texts.mapInArrow(_anchors(length), "key bigint, uid bigint, place bigint")
    again = anchors.withColumn("f", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("f > 1")
    again = again.select("uid", F.struct("key", "place").alias("x")).groupBy("uid").agg(F.collect_list("x").alias("marks"))
    found = texts.join(again, "uid").select("uid", "text", "marks").mapInArrow(_contexts(length), "key bigint, uid bigint, start bigint, bytes binary")
    found = staged(found, "suffix-contexts")
    busy = found.groupBy("key").count().where(F.col("count") > hot).select("key")
    ranges = "uid bigint, start bigint, stop bigint"
    if not busy.head(1):
        return _settled(found, length, block, ranges)
    busy = staged(busy, "suffix-hot")
    calm = found.join(busy, "key", "left_anti")
    much = found.join(busy, "key", "left_semi")
    firsts = staged(much.groupBy("key", "bytes").agg(F.min(F.struct("uid", "start")).alias("x")), "suffix-firsts")
    same = much.join(firsts, ["key", "bytes"]).where("uid <> x.uid or start <> x.start").select("uid", "start", (F.col("start") + F.octet_length("bytes")).alias("stop"))
    single = firsts.select(F.col("x.uid").alias("uid"), F.col("x.start").alias("start"), "bytes").mapInArrow(_windows(length), "uid bigint, start bigint, bytes binary")
    single = single.groupBy("bytes").agg(F.min(F.struct("uid", "start")).alias("x"), F.count(F.lit(1)).alias("f")).where("f > 1").join(single, "bytes").select(F.xxhash64("bytes").alias("key"), "uid", "start", "bytes")
    return _settled(calm, length, block, ranges).unionByName(same).unionByName(_settled(single, length, block, ranges))


def _settled(found: DataFrame, length: int, block: int, ranges: str) -> DataFrame:
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n, "key").sortWithinPartitions("key", "bytes", "uid", "start").mapInArrow(_blocks(length, block), ranges)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for uid, t, spans in zip(b["uid"].to_pylist(), b["text"], b["spans"], strict=True):
            raw, kept, at, n = _encode(t.as_py()), [], 0, 0
            start, stop = (spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
            done = _merged(np.zeros(len(start), np.int64), start, stop - start, 1)
            for s, e in zip(done["start"].to_pylist(), done["stop"].to_pylist(), strict=True):
                kept.append(raw[at:s])
                at, n = e, n + 1
            kept.append(raw[at:])
            left = b"".join(kept)
            out.append((uid, len(raw) - len(left), n, hashlib.sha256(left).hexdigest(), left))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["uid", "n_removed", "n_spans", "kept_sha256", "kept"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, hot: int = HOT, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (``with_bytes``) kept: the bytes that stay of each whole text."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    digest = staged(slim.select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "suffix-digest")
    ids = digest.select("doc_id", "sha").distinct()
    odd = digest.where("doc_id is null").head(1) or ids.groupBy("doc_id").count().where("count > 1").head(1)
    if odd:  # ids that do not order the texts: number them, in parallel
        ranked = ids.orderBy(F.col("doc_id").asc_nulls_last(), "sha").rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
        ids = staged(docs.sparkSession.createDataFrame(ranked, "doc_id long, sha string, uid long"), "suffix-ids")
        known = slim.withColumn("sha", F.sha2("text", 256)).alias("t").join(ids.alias("i"), F.col("t.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("t.sha") == F.col("i.sha")))
        named = known.groupBy("i.uid").agg(F.first("t.text").alias("text"))
    else:
        ids = ids.withColumn("uid", F.col("doc_id"))
        named = slim.select(F.col("doc_id").alias("uid"), "text")
    classes = ids.groupBy("sha").agg(F.min("uid").alias("rep"), F.max("uid").alias("top")).where("rep < top").select("sha", "rep")
    copies = staged(ids.join(classes, "sha").where("uid <> rep").select("uid"), "suffix-copies")
    texts = named.join(copies, "uid", "left_anti")
    if not odd and digest.count() != ids.count():
        texts = texts.dropDuplicates(["uid"])
    spans = covered(texts, length, block, hot).groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = texts.join(spans, "uid").select("uid", "text", "spans").mapInArrow(_cut, "uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    if not with_bytes:
        cut = cut.drop("kept")
    rows = digest.join(ids.withColumnsRenamed({"doc_id": "i_id", "sha": "i_sha"}), F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("sha") == F.col("i_sha")))
    rows = rows.join(copies.withColumn("copy", F.lit(True)), "uid", "left").join(cut, "uid", "left")
    gone = F.col("copy").isNotNull() & (F.col("n_bytes") >= length)
    out = [
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if with_bytes:
        whole = slim.select(F.col("doc_id").alias("w_id"), F.sha2("text", 256).alias("w_sha"), F.col("text").cast("binary").alias("raw")).dropDuplicates(["w_id", "w_sha"])
        rows = rows.join(whole, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("sha") == F.col("w_sha")), "left")
        out.append(F.when(gone, F.lit(b"")).otherwise(F.coalesce("kept", "raw")).alias("kept"))
    return rows.select(*out)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of all ``documents``."""
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), with_bytes=False)
