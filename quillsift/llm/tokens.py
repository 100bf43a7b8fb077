"""Token-ID output: one zstandard dictionary, one frame a document, and an index for access to single documents.

Texts are encoded by the tokenizers library. Both public vocabularies encode each pre-token on its own, so a
text's ids are those of its pre-tokens in order: the library's model encodes each distinct one once, and its ids are
remembered. Texts with any character outside Latin letters, digits, usual punctuation and spaces, or with the start of a
special token, are given to the tokenizer whole.

Files (``QTOK``), each written under a hidden name and renamed, so a repeated task replaces like by like:
magic, header (version, bytes an id, dictionary hash, documents), frames one after another, index (doc_id, null flag,
offset, size and ids of each document), position of the index, magic. The dictionary lies beside them once, named by
its hash; readers refuse a file of another dictionary. It is trained on the serialized ids of at most ``SAMPLE`` whole
documents, those of smallest hash of doc_id.

Defined cases: a null text counts as empty and has the end id only; rows with equal doc_id follow each other by text; null
doc_ids come last; repeated rows are documents of their own; an empty table gives no files and an empty result; columns
of other names are left alone.
"""

from __future__ import annotations

import hashlib
import io
import os
import re
import struct
import urllib.parse
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsift.scratch import fresh_path, small_batches, staged

END = 0
#: Documents that the dictionary is trained on, and its bytes.
SAMPLE, DICT_BYTES = 1000, 65536
SHARD_BYTES = 16 << 20
_UNSAFE = re.compile("[^\t\n\r -~ -įı-ɏ]|<\\|")
#: fixed values: the pre-tokenizer patterns of the two public vocabularies, as their files state them
_BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Entries of a generation of remembered ids.
_CACHED = 400_000
#: Two spaces of any kind in a row, one of them U+0020: only then do pre-tokens depend on what is before a space.
_SPACED = ("  ", *(x for c in "\t\n\r\xa0" for x in (" " + c, c + " ")))


def _byte_chars() -> dict[int, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in plain)}


_BYTE_CHARS = _byte_chars()


class Encoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = os.path.basename(path).startswith("word_bpe")
        known = self.lower or os.path.basename(path).startswith("byte_bpe")
        self.split = regex.compile(_WORD_SPLIT if self.lower else _BYTE_SPLIT).findall if known else None
        tokenize = self.tokenizer.model.tokenize

        class Ids(dict):
            """Packed ids of pre-tokens, and of chunks: what stands between two spaces, the first space with it.

            When it is full, its entries are the old generation: those met again move back, the others go next time.
            """

            old: dict[str, bytes] = {}

            def __missing__(inner, chunk: str) -> bytes:  # noqa: N805
                got = inner.old.get(chunk)
                if got is None:
                    parts = None if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()) else self.split(chunk)
                    if parts is None or len(parts) == 1:
                        got = array("I", [t.id for t in tokenize(chunk.encode().decode("latin-1").translate(_BYTE_CHARS))]).tobytes()
                    else:
                        got = b"".join(map(inner.__getitem__, parts))
                if len(inner) >= _CACHED:
                    inner.old = dict(inner)
                    inner.clear()
                inner[chunk] = got
                return got

        self.chunks = Ids()

    def _ids(self, text: str) -> np.ndarray:
        if self.split is None or _UNSAFE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if self.lower:
            parts = text.lower().split()
        elif any(x in text for x in _SPACED):
            parts = self.split(text)
        else:
            parts = text.replace(" ", "\0 ").split("\0")
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, parts)), np.uint32)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(t) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each process and vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(path: str, texts: pa.Array, step: int = 1_500_000) -> Iterator[np.ndarray]:
    """Ids of each text with the end id, in slices of about ``step`` characters."""
    own, held, n = encoder(path), [], 0
    for i in range(len(texts)):
        t = texts[i].as_py() or ""
        held.append(t)
        n += len(t)
        if n >= step or i == len(texts) - 1:
            for ids in own.batch(held):
                yield np.append(ids, np.uint32(END)).astype(np.uint32)
            held, n = [], 0


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


# Files

MAGIC = b"QTOK1\r\n\0"
_HEAD = struct.Struct("<8sHH16sQ")


def _dict(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def dict_hash(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Shard:
    """Builds one file in memory."""

    def __init__(self, dictionary: bytes, width: int):
        self.packer, self.kind = zstandard.ZstdCompressor(level=3, dict_data=_dict(dictionary) if dictionary else None), "<u2" if width == 2 else "<u4"
        self.hash, self.width, self.body, self.index, self.tokens = dict_hash(dictionary), width, io.BytesIO(), [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self.packer.compress(ids.astype(self.kind).tobytes())
        self.index.append((doc_id or 0, doc_id is None, _HEAD.size + self.body.tell(), len(frame), len(ids)))
        self.body.write(frame)
        self.tokens += len(ids)

    def bytes(self) -> bytes:
        cols = zip(*self.index, strict=True)
        index = b"".join(np.array(c, k).tobytes() for c, k in zip(cols, ("<i8", "u1", "<u8", "<u4", "<u4"), strict=True))
        head = _HEAD.pack(MAGIC, 1, self.width, self.hash, len(self.index))
        body = self.body.getvalue()
        return head + body + index + struct.pack("<Q", len(head) + len(body)) + MAGIC


class Reader:
    """One file's documents: all in order, or single ones by place through the index."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, _, width, want, n = _HEAD.unpack_from(data)
        if magic != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a whole token file")
        if want != dict_hash(dictionary):
            raise ValueError(f"written with dictionary {want.hex()}")
        (at,) = struct.unpack("<Q", data[-16:-8])
        self.data, self.kind = data, "<u2" if width == 2 else "<u4"
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dict(dictionary) if dictionary else None)
        cols = []
        for k in ("<i8", "u1", "<u8", "<u4", "<u4"):
            cols.append(np.frombuffer(data, k, n, at))
            at += cols[-1].nbytes
        self.doc_ids, self.nulls, self.offsets, self.sizes, self.counts = cols

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[int(self.offsets[i]) : int(self.offsets[i]) + int(self.sizes[i])]
        return np.frombuffer(self.unpacker.decompress(frame), self.kind).astype(np.uint32)


def _store(path: str):
    """File system and path in it; local paths and file: URIs without further libraries."""
    parts = urllib.parse.urlparse(path)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), parts.path
    return pyarrow.fs.FileSystem.from_uri(path)


def put(folder: str, name: str, data: bytes) -> None:
    fs, at = _store(folder)
    fs.create_dir(at, recursive=True)
    hidden = f"{at}/_{name}-{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(hidden) as f:
        f.write(data)
    fs.move(hidden, f"{at}/{name}")


def sample_dictionary(docs: DataFrame, path: str, width: int, rows: int = SAMPLE) -> bytes:
    """Trained on the ids of ``rows`` whole documents at most."""
    some = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(f"<u{width}").tobytes() for x in encoded(path, b["text"])], pa.binary())], names=["ids"])

    # at most ``rows`` numbers: small for any input
    got = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").mapInArrow(run, "ids binary").collect()
    return train_dictionary(sorted(bytes(r["ids"]) for r in got)) if got else b""


def write_tokens(docs: DataFrame, folder: str, path: str, width: int = 2, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the files; returns shard, pid, seq, n_docs, n_tokens of each, in ascending doc_id order by (pid, seq)."""
    spark = docs.sparkSession
    small_batches(spark)
    dictionary = sample_dictionary(docs, path, width)
    put(folder, f"dictionary-{dict_hash(dictionary).hex()}.zdict", dictionary)
    shared = spark.sparkContext.broadcast(dictionary)  # DICT_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, shard = TaskContext.get().partitionId(), 0, None
        made = []

        def close() -> None:
            nonlocal shard, seq
            name = f"tokens-{pid:06d}-{seq:05d}.qtok"
            put(folder, name, shard.bytes())
            made.append((name, pid, seq, len(shard.index), shard.tokens))
            seq, shard = seq + 1, None

        for b in batches:
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encoded(path, b["text"]), strict=True):
                shard = shard or Shard(shared.value, width)
                shard.add(doc_id, ids)
                if shard.body.tell() >= shard_bytes:
                    close()
        if shard:
            close()
        if made:
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=["shard", "pid", "seq", "n_docs", "n_tokens"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(n, F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    return staged(ordered.mapInArrow(run, "shard string, pid long, seq long, n_docs long, n_tokens long"), "token-shards")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    fs, at = _store(folder)
    (found,) = (f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(at)) if f.path.endswith(".zdict"))
    with fs.open_input_stream(found) as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                r = Reader(data.as_py(), shared.value)
                ids = [crc(r.ids(i)) for i in range(len(r.counts))]
                before = np.cumsum(r.counts, dtype=np.int64) - r.counts
                docs = pa.array(r.doc_ids, pa.int64(), mask=r.nulls.astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py().rsplit("/", 1)[-1]] * len(ids)), docs, pa.array(before), pa.array(r.counts.astype(np.int64)), pa.array(ids, pa.int64())], names=["shard", "doc_id", "own", "n_tokens", "ids_crc32"])

    if not fs.get_file_info(pyarrow.fs.FileSelector(at))[1:]:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.qtok").load(folder).select("path", "content")
    rows = files.mapInArrow(run, "shard string, doc_id long, own long, n_tokens long, ids_crc32 long")
    starts = manifest.select("shard", (F.sum("n_tokens").over(Window.orderBy("pid", "seq")) - F.col("n_tokens")).alias("before"))  # one row a file
    return rows.join(starts, "shard").select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_output(spark, sf_dir: str) -> DataFrame:
    """Writes all ``documents`` as token files, reads them back and returns each document's digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = fresh_path(spark, "op3-tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, vocabulary("byte_bpe_50k.json")))
