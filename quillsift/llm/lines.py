r"""Line dedup by content-defined line chunks, in DataFrame operations only.

A text is its ``\n``-split lines. A line with a word is a boundary unless its hash is 0 modulo ``divisor`` (a rolling window
of one line, so nothing around a line shifts it). A chunk reaches from one boundary line to the next, both included: it
has two lines at least, and its own content alone decides that it is a chunk. So a passage that occurs again has the same
chunks wherever it stands, all but a line without a boundary at its edge lies in one, and a run of two lines or more goes
unseen only if it has fewer than two boundaries (of 3 lines 4 %, of 4 lines 0.7 % at divisor 8). Of every chunk that
occurs again, in the same or in another text, the first occurrence (by doc_id, then place) stays and the lines of the
others go, each after the chunk's bytes have been compared with the first one's. Chunks overlap in their boundary lines; a
line that goes has an equal one at an earlier place, so of equal lines the first always stays.

Only (document, place, hash, length) rows are grouped over the corpus; texts move to be cut, and chunks that occur
again to be compared. The join with first occurrences is an inner equi-join that Spark can split where a chunk is hot.

Defined cases: a null text counts as empty; an empty text has one empty line; texts of one line stay whole; rows that
repeat a doc_id and its text are one document (both rows get its result); a null doc_id comes first; an empty table
gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.scratch import staged

DIVISOR = 8


def _cut(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, k (a hash of the text), l (lines), and c: array of struct(start, end) of chunks."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("k"), F.split(text, "\n").alias("l"))
    bound = f"conv(substring(md5(l[i]), 1, 7), 16, 10) % {divisor} <> 0 and translate(l[i], ' \t\x0b\x0c\r', '') <> ''"
    ends = lines.withColumn("b", F.expr(f"filter(sequence(0, size(l) - 1), i -> {bound})"))
    pairs = "case when size(b) > 1 then transform(sequence(0, size(b) - 2), j -> struct(b[j] as start, b[j + 1] as end)) else cast(array() as array<struct<start:int,end:int>>) end"
    return ends.select("doc_id", "k", "l", F.expr(pairs).alias("c"))


_BODY = "array_join(slice(l, x.start + 1, x.end - x.start + 1), '\\n')"


def repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, k, start, end of every chunk to remove."""
    places = (
        _cut(docs, divisor)
        .select("doc_id", "k", F.expr(f"inline(transform(c, x -> struct(x.start as start, x.end as end, xxhash64({_BODY}) as ch, octet_length({_BODY}) as len)))"))
    )
    first = F.struct("doc_id", "k", "start")
    again = places.groupBy("ch", "len").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")).where("n > 1")
    again = staged(again, "line-again")  # a table, so that Spark can split the join where a chunk is hot
    hits = places.join(again, ["ch", "len"]).select("doc_id", "k", F.struct("start", "end", "ch", "len", (first == F.col("first")).alias("lead")).alias("x"))
    marks = hits.groupBy("doc_id", "k").agg(F.collect_set("x").alias("marks")).withColumnsRenamed({"doc_id": "m_id", "k": "m_k"})
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", text.alias("text")).withColumn("k", F.xxhash64("text"))
    met = lines.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("k") == F.col("m_k"))).select("doc_id", "k", "marks", F.split("text", "\n").alias("l"))
    bodies = met.select("doc_id", "k", F.expr(f"inline(transform(marks, x -> struct(x.start as start, x.end as end, x.ch as ch, x.len as len, x.lead as lead, {_BODY} as body)))"))
    bodies = staged(bodies, "line-chunks")
    lead = staged(bodies.where("lead").groupBy("ch", "len").agg(F.min("body").alias("body")), "line-leads")
    rest = bodies.where("not lead").alias("r")
    same = (F.col("r.ch") == F.col("f.ch")) & (F.col("r.len") == F.col("f.len"))
    return rest.join(lead.alias("f"), same).where(F.col("r.body") == F.col("f.body")).select("r.doc_id", "r.k", "r.start", "r.end")


def line_dedup(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """The rows of ``docs`` with their text cut, and line__n_lines, line__n_removed, line__n_chunks."""
    gone = repeated_chunks(docs, divisor).groupBy("doc_id", "k").agg(F.collect_set(F.struct("start", "end")).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "line__id", "k": "line__k", "gone": "line__gone"})
    text = F.coalesce(F.col("text"), F.lit(""))
    met = docs.join(gone, docs["doc_id"].eqNullSafe(F.col("line__id")) & (F.xxhash64(text) == F.col("line__k")), "left")
    met = met.withColumn("line__l", F.split(text, "\n"))
    left = met.withColumn(
        "line__i", F.expr("case when line__gone is not null then array_except(sequence(0, size(line__l) - 1), flatten(transform(line__gone, x -> sequence(x.start, x.end)))) end"),
    )
    cut = F.expr("case when line__gone is null then text else array_join(transform(line__i, i -> line__l[i]), '\\n') end")
    n = F.size("line__l").cast("long")
    removed = F.expr("case when line__gone is null then 0L else cast(size(line__l) - size(line__i) as bigint) end")
    return left.select(
        *[cut.alias("text") if c == "text" else docs[c] for c in docs.columns],
        n.alias("line__n_lines"), removed.alias("line__n_removed"), F.expr("cast(coalesce(size(line__gone), 0) as bigint)").alias("line__n_chunks"),
    )


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, n_chunks and the remaining text of all ``documents``."""
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", F.col("line__n_lines").alias("n_lines"), F.col("line__n_removed").alias("n_removed"), F.greatest("line__n_chunks", F.lit(0)).alias("n_chunks"), F.coalesce("text", F.lit("")).alias("text"))


OP9_SQL = f"""
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
i as (select doc_id, unnest(range(1, len(l) + 1)) as i, unnest(l) as line from l),
b as (select doc_id, i as start, lead(i) over (partition by doc_id order by i) as stop from i where ('0x' || substr(md5(line), 1, 7))::bigint % {DIVISOR} <> 0 and translate(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13), '') <> ''),
c as (select b.doc_id, start, stop, array_to_string(l[start:stop], chr(10)) as body from b join l on b.doc_id = l.doc_id where stop is not null),
g as (select doc_id, start, stop from (select *, row_number() over (partition by body order by doc_id, start) as n from c) where n > 1),
x as (select distinct doc_id, unnest(range(start, stop + 1)) as i from g),
o as (select i.doc_id, count(*) as n_lines, count(x.i) as n_removed, coalesce(string_agg(line, chr(10) order by i.i) filter (x.i is null), '') as text from i left join x on i.doc_id = x.doc_id and i.i = x.i group by 1)
select o.*, coalesce(k.n, 0)::bigint as n_chunks from o left join (select doc_id, count(*) as n from g group by 1) k on o.doc_id = k.doc_id"""
