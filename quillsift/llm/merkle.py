r"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A paragraph is a line; a section is a run of paragraphs that ends where a paragraph's hash is 0 modulo 4 (or at the
end); a paragraph's pieces are runs of about eight words whose ends depend on the last bytes before a space only
(where there is none for 128 bytes, they are cut on from the last). So an
edit changes the branches that it touches and shifts no others. A node's digest is BLAKE2b of its children's digests,
a piece's of its bytes. The fingerprint is text: the root (128 bits), then each section's and paragraph's digest and
the pieces with their lengths, shortened to 32 bits. Equal roots mean equal texts; ``changed`` walks down differing
branches only; ``likeness`` is the Dice coefficient of the pieces, weighed by their bytes.

Neighbours in doc_id order meet by range partitions: bounds come from a quantile sketch of doc_id, and the first
document of each range is sent to the range before it as well. No window over the table, no join of texts.

Defined cases: a null text counts as empty; texts of no characters have equal fingerprints and likeness 1, and 0
with any other; rows with equal doc_id follow each other by text; null doc_ids come last; a sole document is its own
next; an empty table gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.scratch import small_batches

_SECTION = 4
_PIECE = 8
_LONGEST = 128


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Ends of pieces: every line end, and spaces chosen by the four bytes before them."""
    at = np.flatnonzero(raw == 32)
    at = at[at >= 4]
    mixed = (raw[at - 1].astype(np.uint32) * 2654435761 + raw[at - 2] * np.uint32(40503) + raw[at - 3] * np.uint32(9973) + raw[at - 4] * np.uint32(271)).astype(np.uint32)
    chosen = at[(mixed >> 13) % _PIECE == 0]
    ends = np.union1d(chosen, np.flatnonzero(raw == 10)) + 1
    gaps = np.diff(np.concatenate(([0], ends, [len(raw)])))
    if len(gaps) and gaps.max() > _LONGEST:  # no such place for long: cut on from the last one
        starts = np.concatenate(([0], ends))
        more = [np.arange(s + _LONGEST, s + g, _LONGEST) for s, g in zip(starts.tolist(), gaps.tolist(), strict=True) if g > _LONGEST]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode("utf-8", "surrogatepass")
    ends = [*_cuts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
    sections, section, top, par, names, start = [], [], [], b"", [], 0
    shown: list[str] = []
    for end in ends:
        piece = raw[start:end]
        if piece:
            d = _digest(piece)
            par += d
            names.append(f"{d[:4].hex()}{len(piece):x}")
        if end == len(raw) or piece.endswith(b"\n"):
            d = _digest(b"p" + par)
            section.append(d)
            shown.append(f"{d[:4].hex()}." + "-".join(names))
            par, names = b"", []
            if end == len(raw) or d[5] % _SECTION == 0:
                s = _digest(b"s" + b"".join(section))
                top.append(s)
                sections.append(f"{s[:4].hex()}:" + ",".join(shown))
                section, shown = [], []
        if end == len(raw):
            break
        start = end
    return _digest(b"d" + b"".join(top)).hex() + "/" + "/".join(sections)


def _pieces(fp: str) -> Counter:
    return Counter(x for s in fp.split("/")[1:] for p in s.partition(":")[2].split(",") for x in p.partition(".")[2].split("-") if x)


def likeness(a: str, b: str) -> float:
    if a[:32] == b[:32]:
        return 1.0
    x, y = _pieces(a), _pieces(b)
    weight = lambda c: sum(int(k[8:], 16) * n for k, n in c.items())
    total = weight(x) + weight(y)
    return 2 * weight(x & y) / total if total else 1.0


def changed(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a``, counted from 0, whose branches are not in ``b``; equal sections are skipped whole."""
    if a[:32] == b[:32]:
        return []
    other = [s.partition(":") for s in b.split("/")[1:]]
    same, pars = {s[0] for s in other}, {p.partition(".")[0] for s in other for p in s[2].split(",")}
    return [(i, j) for i, s in enumerate(a.split("/")[1:]) if s.partition(":")[0] not in same for j, p in enumerate(s.partition(":")[2].split(",")) if p.partition(".")[0] not in pars]


def _range(key: Column, bounds: list[int], lo: int, hi: int) -> Column:
    """Index of the range that a key falls in, by bisection."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key <= bounds[mid], _range(key, bounds, lo, mid)).otherwise(_range(key, bounds, mid + 1, hi))


def with_next(docs: DataFrame) -> DataFrame:
    """bucket, extra, doc_id, text: ranges in order, each followed by the first document of the next range."""
    small_batches(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    q = slim.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    bounds = sorted(set(q))
    slim = slim.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(_range(F.col("doc_id"), bounds, 0, len(bounds))))
    firsts = {r["bucket"]: r["first"] for r in slim.groupBy("bucket").agg(F.min("doc_id").alias("first")).collect()}  # one row a range
    order = sorted(firsts)
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True)) if order else {}
    lead, prev = F.lit(False), F.lit(-1)
    if order:
        size = max(order) + 1
        first = F.element_at(F.array(*[F.lit(firsts.get(i)).cast("long") for i in range(size)]), F.col("bucket") + 1)
        lead, prev = F.col("doc_id").eqNullSafe(first), F.element_at(F.array(*[F.lit(before.get(i, -1)) for i in range(size)]), F.col("bucket") + 1)
    own, more = F.struct(F.col("bucket"), F.lit(0).alias("extra")), F.struct(prev.alias("bucket"), F.lit(1).alias("extra"))
    spread = slim.withColumn("to", F.explode(F.when(lead, F.array(own, more)).otherwise(F.array(own))))
    out = spread.select("to.bucket", "to.extra", "doc_id", "text").repartitionByRange(n, "bucket")
    return out.sortWithinPartitions("bucket", "extra", F.col("doc_id").asc_nulls_last(), "text")


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])
        out.clear()
        return made

    for b in batches:
        for bucket, extra, doc_id, text in zip(b["bucket"].to_pylist(), b["extra"].to_pylist(), b["doc_id"].to_pylist(), b["text"], strict=True):
            if extra and (held is None or held[0] != bucket):
                continue  # a further row of the first document's id
            text = text.as_py()
            fp = fingerprint(text)
            if held and held[0] == bucket:
                _, own_id, own, own_fp = held
                k = len(own) // 4
                edited = own[: len(own) - k] + text[:k]
                edited_fp = fingerprint(edited) if k else own_fp
                out.append((own_id, len(own), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_fp, edited_fp, likeness(own_fp, edited_fp), likeness(own_fp, fp)))
            held = None if extra else (bucket, doc_id, text, fp)
            if len(out) >= 500:
                yield batch()
    if out:
        yield batch()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each whole text, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([fingerprint(x.as_py()) for x in b["text"]], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id", F.lit("").alias("fingerprint")).schema)


def op8_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """The contract's comparison of all ``documents`` with their edited texts and their next documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_next(docs).mapInArrow(_rows, SCHEMA)
