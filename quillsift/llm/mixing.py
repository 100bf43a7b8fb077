"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Each source gets a target number of words: its weight's share of all words, never above ``cap`` times what it has,
the excess going to the others by weight. A document's expected number of copies is its source's target over its
source's words. The whole part is taken as it is; the fractional parts are rounded by the pivotal method: two
fractional documents of one source meet, words move from one to the other at random (keeping both expectations and
their joint sum of words) until one of them is whole, and the other stays to meet the next. Groups of about
``fan`` documents are folded on their own, each leaves one fractional document at most, and these residuals are folded
again in groups of ``fan``: a reduction tree of depth log(documents). So the words of a source end within one document
of its target. Draws are hashes of the two documents and the seed: reruns agree.

Defined cases: a null or empty text has size 0 and copies of no words; a null source is a source of its own, the last;
rows that repeat in full are separate documents that may round differently; an empty table gives an empty result;
further columns of any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.scratch import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Decimal digits of the draw: hashes are taken modulo 2**52.
_SPAN = 1 << 52


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """source, source_size, n_docs, target: the water level over sources, from (source, size) rows.

    Sources are ranked by code point, null last, and weigh ``weights`` in turn. Only one row a source is windowed.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("top", cap * F.col("source_size").cast("double"))
    before = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    nought = F.lit(0.0)
    total = F.sum("source_size").over(everything).cast("double")
    level = (total - F.coalesce(F.sum("top").over(before), nought)) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), nought))
    per = per.withColumn("full", F.col("top") / F.col("w") <= level).withColumn("total", total)
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("top"))).over(everything), nought)
    return per.select("source", "source_size", "n_docs", F.when(F.col("full"), F.col("top")).otherwise(left * F.col("w") / free).alias("target"))


def _draw(a: Column, b: Column, level: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(a, b, F.lit(level), F.lit(seed)), F.lit(_SPAN)) / F.lit(float(_SPAN))


def _fold(items: Column, level: int, seed: int) -> Column:
    """struct(cur, out): one array of fractional documents, in order, folded by the pivotal method."""
    kind = "struct<h:bigint,id:bigint,size:bigint,whole:bigint,p:double>"
    start = F.struct(F.expr(f"cast(null as {kind})").alias("cur"), F.expr("cast(array() as array<struct<id:bigint,size:bigint,copies:bigint>>)").alias("out"))

    def done(x: Column, up: int) -> Column:
        return F.array(F.struct(x.id.alias("id"), x.size.alias("size"), (x.whole + F.lit(up)).alias("copies")))

    def at(x: Column, p: Column) -> Column:
        return F.struct(x.h.alias("h"), x.id.alias("id"), x.size.alias("size"), x.whole.alias("whole"), p.alias("p"))

    def meet(acc: Column, e: Column) -> Column:
        c, none = acc.cur, F.expr(f"cast(null as {kind})")
        room_c, mass_c, room_e, mass_e = c.size * (1 - c.p), c.size * c.p, e.size * (1 - e.p), e.size * e.p
        rise, fall = F.least(room_c, mass_e), F.least(mass_c, room_e)
        up = _draw(c.h, e.h, level, seed) * (rise + fall) < fall

        def both(cur: Column, out: Column) -> Column:
            return F.struct(cur.alias("cur"), F.concat(acc.out, out).alias("out"))

        grown = (
            F.when(room_c == mass_e, both(none, F.concat(done(c, 1), done(e, 0))))
            .when(room_c < mass_e, both(at(e, e.p - rise / e.size), done(c, 1)))
            .otherwise(both(at(c, c.p + rise / c.size), done(e, 0)))
        )
        shrunk = (
            F.when(mass_c == room_e, both(none, F.concat(done(c, 0), done(e, 1))))
            .when(mass_c < room_e, both(at(e, e.p + fall / e.size), done(c, 0)))
            .otherwise(both(at(c, c.p - fall / c.size), done(e, 1)))
        )
        return F.when(c.isNull(), F.struct(e.alias("cur"), acc.out.alias("out"))).when(up, grown).otherwise(shrunk)

    return F.aggregate(items, start, meet)


def mix(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, fan: int = 48, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for each row of (doc_id, source, size).

    ``sizes`` is read twice: pass a staged table where it is costly. Rows of size 0 get their whole copies only.
    """
    per = staged(source_targets(sizes, weights, cap), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        sizes.alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.doc_id", "d.source", "d.size", "s.n_docs", share.alias("share"))
        .withColumn("whole", F.floor("share")).withColumn("p", F.col("share") - F.col("whole"))
        .withColumn("h", F.xxhash64("doc_id", "source", "size", F.lit(seed)))
    )
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    settled = rows.where(~open_).select("source", F.struct(F.col("doc_id").alias("id"), "size", F.col("whole").alias("copies")).alias("x"))
    groups = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / fan))
    left = rows.where(open_).select(
        "source", F.pmod(F.col("h"), groups).alias("g"),
        F.struct("h", F.col("doc_id").alias("id"), "size", "whole", "p").alias("x"),
    )
    parts, level = [settled], 0
    most = per.agg(F.max("n_docs")).first()[0] or 0
    while True:
        folded = left.groupBy("source", "g").agg(F.sort_array(F.collect_list("x")).alias("items"))
        folded = staged(folded.select("source", "g", _fold(F.col("items"), level, seed).alias("f")), f"mix-{level}")
        parts.append(folded.select("source", F.explode("f.out").alias("x")))
        most, level = -(-most // fan), level + 1
        left = folded.where("f.cur is not null").select("source", F.floor(F.col("g") / fan).alias("g"), F.col("f.cur").alias("x"))
        if most <= 1:
            break
    toss = F.when(_draw(F.col("x.h"), F.lit(0), level, seed) < F.col("x.p"), 1).otherwise(0)
    parts.append(left.select("source", F.struct("x.id", "x.size", (F.col("x.whole") + toss).alias("copies")).alias("x")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.select("source", F.col("x.id").alias("doc_id"), F.col("x.size").alias("size"), F.col("x.copies").alias("copies"))
    return (
        out.alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.doc_id", "d.source", "d.size", "s.source_size", "s.target", "d.copies")
    )


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, text, any more), each as often as the mix takes it.

    Rows of one doc_id, source and size are numbered, by text and then at will, to give each its own copies.
    """
    key = ["doc_id", "source", "size"]
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    taken = mix(sizes, weights, cap, seed=seed).select(*[F.col(k).alias(f"mix__{k}") for k in key], F.col("copies").alias("mix__copies"))
    copies = F.explode(F.expr("sequence(1L, mix__copies)"))
    if not sizes.where("doc_id is null").head(1) and not sizes.groupBy("doc_id").count().where("count > 1").head(1):
        met = docs.join(taken.where("mix__copies > 0"), docs["doc_id"] == taken["mix__doc_id"])
        return met.withColumn("mix__copy", copies).select(*[docs[c] for c in docs.columns])
    taken = taken.withColumn("mix__k", F.row_number().over(Window.partitionBy(*[f"mix__{k}" for k in key]).orderBy(F.col("mix__copies").desc())))
    size = word_count(F.col("text"))
    rows = docs.withColumn("mix__n", size)
    rows = rows.withColumn("mix__r", F.row_number().over(Window.partitionBy("doc_id", "source", "mix__n").orderBy(F.xxhash64("text"))))
    met = rows.join(taken, rows["doc_id"].eqNullSafe(taken["mix__doc_id"]) & rows["source"].eqNullSafe(taken["mix__source"]) & (rows["mix__n"] == taken["mix__size"]) & (rows["mix__r"] == taken["mix__k"]))
    out = met.where("mix__copies > 0").withColumn("mix__copy", copies)
    return out.select(*[rows[c] for c in docs.columns])


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of the mix over all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "op10-sizes")
    return mix(sizes).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
