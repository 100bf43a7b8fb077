r"""N-gram Jaccard join by universe-partition pigeonhole.

A document is the set of its distinct ``n``-word shingles; two link when 100 * |A and B| >= percent * |A or B|. Exact
copies (by their word sequence) are one class, stood for by the least doc_id, so they never meet as pairs.

Sets fall into size bands (each 1.5 times as wide as the one before); a set also takes part in the next band if it
could link with a member. In each band the universe of shingle hashes is split into segments. Linked sets differ in at
most H shingles, so few of their segments differ. A segment is matched exactly, or up to one shingle by its subset's
one-deletion neighbourhood, which then counts for two differences; ``allocate`` chooses how many segments of either
kind a band has, by a cost model of signatures and chance meetings over the band's number of sets.

Of its exact segments a set signs the H + 1 + X fullest (ties by hash, alike in all sets): linked sets then share X + 1
signatures at least. Once the frequency of every signature is known, a set with c shared ones takes part only if c > X,
with its c - X rarest: the rarest signature that two linked sets share is among these for both. This is exact, and leaves
neither empty segments nor passages that many documents share as large meeting places.

Inside a meeting place every set is paired with the least one only. Then, where the members of a place still lie in
several components, each meets a few drawn members of other components, and what is still apart meets all others. So no link
between components is lost, and a group of n near copies costs about n pairs.

A pair becomes a row, and is verified on the whole texts, only if its parity sketches allow it: each shingle flips one of the ``2 ** k`` bits of its
set's sketch, so the bits in which two sketches differ are at most the shingles in which the sets differ. With ``WIDTH`` bits
a difference that links may have, few pairs pass that do not link, and none that link are lost.

Defined cases: a text without words (null, empty) has an empty set and links with nothing; a text of fewer than n words
is one shingle; rows that share a doc_id are one node of the graph; a null doc_id links with nothing and has a null
component; an empty table gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsift.llm.components import components
from quillsift.scratch import dropped, small_batches, staged

GROWTH, SLACK = 1.5, 0.1
#: Bits of a sketch for each difference that linked sets may have; members drawn from each end of a place's order.
WIDTH, DRAWS = 16, 4
_U = np.uint64
_KNOWN = 150_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KNOWN:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case: bytes.lower and bytes.split treat ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    """The exact set."""
    if not words:
        return set()
    return {tuple(words)} if len(words) < n else set(zip(*(words[i:] for i in range(n)), strict=False))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def hashed(words: list[bytes], n: int) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, _U)
    w = np.fromiter(map(_HASHES.__getitem__, words), _U, len(words))
    k = min(n, len(w))
    h = np.zeros(len(w) - k + 1, _U)
    for i in range(k):
        h = h * _U(0x9E3779B97F4A7C15) + (w[i : len(w) - k + 1 + i] ^ (w[i : len(w) - k + 1 + i] >> _U(29)))
    return np.unique(_mix(h + _U(k)))


@dataclass(frozen=True)
class Scheme:
    """A band of sizes from lo to hi - 1: ``two`` segments with one-deletion neighbourhoods, then ``one`` exact ones, X to spare."""

    index: int
    lo: int
    hi: int
    two: int
    one: int
    spare: int


def differences(a: int, b: int, percent: int) -> int:
    """Most shingles that linked sets of these sizes can differ in."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(largest: int) -> list[tuple[int, int]]:
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo + 1, math.ceil(lo * GROWTH))
        out.append((lo, hi))
        lo = hi
    return out


def allocate(index: int, lo: int, hi: int, sets: int, percent: int) -> Scheme:
    """The cheapest numbers of segments of both kinds for a band of so many sets."""
    most = differences(hi - 1, hi - 1, percent)
    best = None
    for two in range((most + 1) // 2 + 1 if most < 24 else 1):
        need = most + 1 - 2 * two
        spare = math.ceil(SLACK * (most + 1)) if need > 0 else 0
        one = need + spare if need > 0 else 0
        per = (lo + hi) / 2 / max(1, 2 * two + one)
        signed = two * (1 + 2 * per) + (need + spare if need > 0 else 0)
        chance = two * math.exp(-4 * per) * (1 + 4 * per) + one * math.exp(-2 * per)
        cost = sets * signed + 5 * sets * sets / 2 * chance
        if (two or one) and (best is None or cost < best[0]):
            best = (cost, Scheme(index, lo, hi, two, one, spare))
    return best[1]


def schemes_of(size: int, schemes: list[Scheme], percent: int) -> list[Scheme]:
    """The set's own band, and the next if a set of it could link."""
    own = next(s.index for s in schemes if size < s.hi)
    more = own + 1 < len(schemes) and 100 * size >= percent * schemes[own + 1].lo
    return schemes[own : own + 1 + more]


def segments(h: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, ...]:
    """Of one set: each segment's signature and size; and for its shingles their hash, segment, the segment's sum and salt."""
    units, n = 2 * scheme.two + scheme.one, scheme.two + scheme.one
    unit = ((h >> _U(32)) * _U(units)) >> _U(32)
    seg = np.where(unit < 2 * scheme.two, unit >> _U(1), unit - _U(scheme.two)).astype(np.int64)
    value = _mix(h * _U(0xD6E8FEB86659FD93) + _U(scheme.index))
    ends = np.concatenate(([0], np.searchsorted(seg, np.arange(n), side="right")))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(value, dtype=_U)))
    total = np.diff(sums[ends])
    salt = _mix((np.arange(n, dtype=_U) + _U(1)) * _U(0x2545F4914F6CDD1D) + _U(scheme.index << 40))
    return _mix(total + salt), np.diff(ends), value, seg, total, salt


def signatures(h: np.ndarray, scheme: Scheme, percent: int) -> tuple[np.ndarray, int]:
    """Signatures of one set: those of one-deletion segments, then the exact ones; and how many the first are."""
    size = len(h)
    whole, count, value, seg, total, salt = segments(h, scheme)
    first = np.zeros(0, _U)
    if scheme.two:
        inside = seg < scheme.two
        first = np.unique(np.concatenate((whole[: scheme.two], _mix(total[seg[inside]] - value[inside] + salt[seg[inside]]))))
    left = differences(size, min(scheme.hi - 1, size * 100 // percent), percent) - 2 * scheme.two
    rest = np.zeros(0, _U)
    if left >= 0:
        rest, full = whole[scheme.two :], count[scheme.two :]
        rest = rest[np.lexsort((rest, -full))[: left + 1 + scheme.spare]]
    return np.concatenate((first, rest)), len(first)


def sketch(h: np.ndarray, percent: int) -> np.ndarray:
    """Parity of the shingles that fall on each bit; the number of bits, a power of two, grows with the set."""
    most = WIDTH * differences(len(h), len(h), percent)
    bits = max(64, 1 << max(0, most - 1).bit_length())
    odd = np.bincount((h & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


#: SQL: bits in which the sketches x and y differ, the longer one folded onto the other's length.
_APART = (
    "aggregate(sequence(0, least(size(x), size(y)) - 1), 0, (n, i) -> n + bit_count("
    "(case when size(x) > size(y) then x[i] ^ x[i + size(y)] else x[i] end) ^ (case when size(y) > size(x) then y[i] ^ y[i + size(x)] else y[i] end)))"
)


def _allowed(x: str, y: str, percent: int) -> str:
    """SQL: the pair of ``x`` and ``y`` (size, vec) may link, by sizes and sketches."""
    fits = f"100 * least({x}.size, {y}.size) >= {percent} * greatest({x}.size, {y}.size)"
    apart = _APART.replace("(x)", f"({x}.vec)").replace("(y)", f"({y}.vec)").replace("x[", f"{x}.vec[").replace("y[", f"{y}.vec[")
    return f"case when {fits} then {apart} <= ({x}.size + {y}.size) * {100 - percent} div {100 + percent} else false end"


def _census(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, keys, vecs = [], [], []
            for t in b["text"]:
                w = words_of(t.as_py())
                h = hashed(w, n)
                sizes.append(len(h))
                keys.append(hashlib.sha256(b" ".join(w)).digest()[:16] if w else None)
                vecs.append(sketch(h, percent) if w else None)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(vecs, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "key", "vec"])

    return run


def _sign(n: int, schemes: list[Scheme], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs, ids, tags, held = [], [], [], 0

            def made() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(tags))], names=["sig", "id", "tag"])

            for doc_id, t in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                h = hashed(words_of(t.as_py()), n)
                for s in schemes_of(len(h), schemes, percent) if len(h) else ():
                    got, two = signatures(h, s, percent)
                    sigs.append(got)
                    ids.append(np.full(len(got), doc_id, np.int64))
                    tags.append(np.where(np.arange(len(got)) < two, 0, 1) + 2 * s.index + (len(h) << 8))
                    held += len(got)
                if held > 100_000:
                    yield made()
                    sigs, ids, tags, held = [], [], [], 0
            if sigs:
                yield made()

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, set()
        for b in batches:
            keep = []
            for a, x, y in zip(b["a"].to_pylist(), b["text_a"], b["text_b"], strict=True):
                if a != last:
                    last, mine = a, shingles(words_of(x.as_py()), n)
                other = shingles(words_of(y.as_py()), n)
                both = len(mine & other)
                keep.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts link, counted on the exact sets."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").sortWithinPartitions("a").select("a", "b", "text_a", "text_b").mapInArrow(_verify(n, percent), "a bigint, b bigint")


def _mixed(places: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the places that hold several components, with the least component there."""
    named = places.join(labels, "id", "left").select("sig", "id", "center", F.coalesce("component", "id").alias("comp"))
    ends = named.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sig", "lo")
    return named.join(ends, "sig")


def _drawn(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members (with size, vec) of different components that may link: each set with ``DRAWS`` times two members,
    drawn anew in each place. Those that the sketches rule out never become rows."""
    ends = []
    for k in range(DRAWS):
        row = F.struct(F.xxhash64("id", "sig", F.lit(k)).alias("h"), "id", "comp", "size", "vec")
        ends += [F.min(row).alias(f"lo{k}"), F.max(row).alias(f"hi{k}")]
    drawn = F.array_distinct(F.array(*[F.col(f"{e}{k}").dropFields("h") for k in range(DRAWS) for e in ("lo", "hi")]))
    chosen = mixed.groupBy("sig").agg(*ends).select("sig", drawn.alias("chosen"))
    met = mixed.where("comp <> lo").withColumn("me", F.struct("size", "vec")).join(chosen, "sig")
    met = met.select("id", F.explode(F.expr(f"transform(filter(chosen, x -> x.comp <> comp and {_allowed('x', 'me', percent)}), x -> x.id)")).alias("x"))
    return met.select(F.least("id", "x").alias("a"), F.greatest("id", "x").alias("b")).distinct()


def _stars(places: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a place's center and each other member (with size, vec) that may link with it."""
    hubs = places.where("id = center").select("sig", F.struct("size", "vec").alias("v"))
    others = places.where("id <> center").select("sig", "id", "center", F.struct("size", "vec").alias("u"))
    return others.join(hubs, (others["sig"] == hubs["sig"]) & F.expr(_allowed("u", "v", percent))).select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()


def _core(slim: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of rows whose doc_id is null or has one text."""
    census = staged(slim.mapInArrow(_census(n, percent), "doc_id bigint, n_shingles bigint, key binary, vec array<bigint>"), "jaccard-census")
    known = census.where("doc_id is not null and key is not null")
    classes = known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top")).where("rep < top").select("key", "rep")
    copies = staged(known.join(classes, "key").where("doc_id <> rep").select("doc_id", "rep").distinct(), "jaccard-copies")

    top = known.agg(F.max("n_shingles")).first()[0] or 0
    spans = bands(max(1, int(top)))
    which = F.lit(len(spans) - 1)
    for i in range(len(spans) - 2, -1, -1):
        which = F.when(F.col("n_shingles") < spans[i][1], i).otherwise(which)
    counts = {r["k"]: r["count"] for r in known.groupBy(which.alias("k")).count().collect()}  # one row a band
    schemes = [allocate(i, lo, hi, counts.get(i, 0) + counts.get(i - 1, 0), percent) for i, (lo, hi) in enumerate(spans)]

    reps = slim.where("doc_id is not null").join(copies.select("doc_id"), "doc_id", "left_anti")
    signed = reps.mapInArrow(_sign(n, schemes, percent), "sig bigint, id bigint, tag bigint")
    met = signed.withColumn("f", F.count(F.lit(1)).over(Window.partitionBy("sig"))).where("f > 1")
    met = staged(met, "jaccard-met")
    by_set = Window.partitionBy("id", "tag")
    spare = F.element_at(F.array(*[F.lit(s.spare) for s in schemes]), (F.expr("(tag & 255) div 2") + 1).cast("int"))
    exact = met.where("tag % 2 = 1").withColumn("c", F.count(F.lit(1)).over(by_set)).withColumn("r", F.row_number().over(by_set.orderBy("f", "sig"))).where(F.col("r") <= F.col("c") - spare)
    kept = staged(exact.select("sig", "id").unionByName(met.where("tag % 2 = 0").select("sig", "id")), "jaccard-kept")
    dropped(met)
    centers = kept.groupBy("sig").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("f")).where("f > 1").select("sig", "center")
    places = staged(kept.join(centers, "sig"), "jaccard-places")
    dropped(kept)

    wanted = places.select(F.col("id").alias("doc_id")).distinct()
    sizes = staged(known.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), "vec").dropDuplicates(["id"]), "jaccard-sketches")

    stars = staged(_stars(places.join(sizes, "id"), percent), "jaccard-stars")
    texts = staged(slim.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"]), "jaccard-texts")
    sure = staged(linked(stars, texts, n, percent), "jaccard-links")
    labels = staged(components(sure), "jaccard-labels")

    mixed = staged(_mixed(places, labels), "jaccard-mixed")
    some = staged(linked(_drawn(mixed.join(sizes, "id"), percent), texts, n, percent), "jaccard-some")
    if some.head(1):
        sure = sure.unionByName(some)
        labels = staged(components(sure), "jaccard-labels")
        mixed = staged(_mixed(places, labels), "jaccard-mixed")
    # what is still apart meets all others
    mixed = mixed.where("id <> center").join(sizes, "id")
    apart = F.expr(f"u.comp <> v.comp and (v.comp = v.lo or u.id < v.id) and {_allowed('u', 'v', percent)}")
    more = mixed.where("comp <> lo").alias("u").join(mixed.alias("v"), (F.col("u.sig") == F.col("v.sig")) & apart)
    more = more.select(F.least("u.id", "v.id").alias("a"), F.greatest("u.id", "v.id").alias("b")).distinct()
    extra = staged(linked(more, texts, n, percent), "jaccard-more")
    final = components(sure.unionByName(extra)) if extra.head(1) else labels
    final = staged(final, "jaccard-final")
    for table in (places, sizes, texts, mixed):
        dropped(table)

    met = census.drop("vec").join(copies, "doc_id", "left").withColumn("node", F.coalesce("rep", "doc_id"))
    return met.join(final, met["node"] == final["id"], "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = slim.select("doc_id", F.sha2("text", 256).alias("sha")).where("doc_id is not null").groupBy("doc_id").agg(F.min("sha").alias("lo"), F.max("sha").alias("hi"))
    if not rows.where("lo <> hi").head(1):
        return _core(slim, n, percent)
    # doc_ids with several texts: each text of each doc_id is a set of its own, and a doc_id ties its texts together
    named = slim.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)).groupBy("doc_id", "sha").agg(F.first("text").alias("text"))
    named = staged(named.withColumn("uid", F.monotonically_increasing_id()), "jaccard-uids")
    found = staged(_core(named.select(F.col("uid").alias("doc_id"), "text"), n, percent), "jaccard-by-text")
    tied = named.where("doc_id is not null").groupBy("doc_id").agg(F.min("uid").alias("a")).join(named, "doc_id").select("a", F.col("uid").alias("b"))
    joined = found.join(named.where("doc_id is not null").select("uid"), F.col("doc_id") == F.col("uid"), "left_semi").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))
    labels = components(tied.unionByName(joined).where("a <> b"))
    node = named.join(labels, named["uid"] == labels["id"], "left").select("doc_id", "sha", "uid", F.coalesce("component", "uid").alias("comp"))
    node = staged(node.join(found.select(F.col("doc_id").alias("uid"), "n_shingles"), "uid"), "jaccard-nodes")
    least = node.where("doc_id is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    node = node.join(least, "comp", "left").select(F.col("doc_id").alias("n_id"), "sha", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    given = slim.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    return given.join(node, given["doc_id"].eqNullSafe(node["n_id"]) & (given["sha"] == node["sha"])).select("doc_id", "n_shingles", "component_id")


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """The contract's join of all ``documents``: three words, 90 per cent."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 3, 90)


OP4_SQL = r"""
with recursive t as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]) end) as g from t)),
n as (select doc_id, count(*) as n from s group by 1),
i as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
d as (select a, b from e union all select b, a from e),
r as (select doc_id as id, doc_id as c from documents union select d.b, r.c from r join d on d.a = r.id)
select documents.doc_id, coalesce(n.n, 0)::bigint as n_shingles, (select min(c) from r where r.id = documents.doc_id)::bigint as component_id
from documents left join n on n.doc_id = documents.doc_id"""
