"""Quality rules with adaptive thresholds, in DataFrame operations only.

Each document's signals are whole numbers. Per language and source, a mergeable quantile sketch holds each signal: a
histogram whose buckets keep the ``BITS`` leading bits of a value (so a quantile is off by less than 1/32 of itself),
merged by adding counts, of bounded size for any number of rows. The 10th, 50th and 90th percentile of a group are drawn
towards those of its language, and these towards those of all: with n documents a percentile counts n / (n + ``PRIOR``), the
wider one the rest. So every group's own sketch takes part, the more the larger it is, without a switch by size.

A signal that most documents have is limited to the median plus ``REACH`` times the spread between the 10th percentile and the
median (mirrored for lower limits). One that is 0 in most documents and harmless in some (repeats) is sketched over the
documents that have any, and limited to their 90th percentile plus ``RARE`` times its distance from their median. A
limit is at least ``floor`` from the median, or from 0 for the rare ones. Documents that fail the base rules take no part.

Defined cases: a null text has no words and fails the base; null languages or sources form groups of their own; repeated
rows count as often as they come; an empty table gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsift.scratch import staged

BITS = 6
#: name, SQL of the signal in 1/10,000 or 1/100, kind of limit, its least distance. The floor of symbol_rate (1 %) decides
#: wherever symbols are unusual: its median and spread are 0 there.
SIGNALS = (
    ("symbol_rate", "n_symbols * 10000 div greatest(word_chars, 1)", "high", 100),
    ("dup_line_rate", "n_dup_lines * 10000 div greatest(n_lines, 1)", "rare", 1000),
    ("repeat_rate", "n_repeat_words * 10000 div greatest(n_words, 1)", "rare", 500),
    ("caps_rate", "n_caps * 10000 div greatest(word_chars, 1)", "high", 100),
    ("word_len", "word_chars * 100 div greatest(n_words, 1)", "high", 50),
    ("word_len_low", "word_chars * 100 div greatest(n_words, 1)", "low", 50),
)
REACH, RARE, PRIOR = 6, 2, 50
_WS = r"[\x20\x09-\x0D]+"


def signals(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text, in one scan and without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, _WS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    base = docs.select("doc_id", "lang", "source", words.alias("w"), lines.alias("l"), F.length(F.translate(text, "#*$%&|<>", "")).alias("plain"), F.length(text).alias("n_code"), F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"), F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ!", "")).alias("uncapped"))
    windows = F.expr(
        "case when size(w) >= 3 then sort_array(transform(sequence(0, size(w) - 3), i -> struct(concat_ws(' ', w[i], w[i+1], w[i+2]) as t, i as i)))"
        " else cast(array() as array<struct<t:string,i:int>>) end"
    )
    twice = F.expr(
        "case when size(s) < 2 then cast(array() as array<int>) else"
        " sort_array(transform(filter(s, (x, k) -> (k > 0 and s[k-1].t = x.t) or (k < size(s) - 1 and s[k+1].t = x.t)), x -> x.i)) end"
    )
    covered = F.expr("aggregate(r, struct(0L as n, -3 as last), (a, i) -> struct(a.n + least(3, i - a.last) as n, i as last), a -> a.n)")
    return (
        base.withColumn("s", windows).withColumn("r", twice)
        .select(
            "doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"), "word_chars",
            (F.col("n_code") - F.col("plain")).cast("long").alias("n_symbols"),
            (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"), F.size("l").cast("long").alias("n_lines"),
            (F.col("n_code") - F.col("uncapped")).cast("long").alias("n_caps"),
        )
        .withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    )


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, signal, bucket, n: the sketch of every group, from rows of ``signals``."""
    stack = ", ".join(f"'{name}', {sql}" for name, sql, _, _ in SIGNALS)
    rare = ", ".join(f"'{name}'" for name, _, kind, _ in SIGNALS if kind == "rare")
    long = counts.where("not base_failed").selectExpr("lang", "source", f"stack({len(SIGNALS)}, {stack}) as (signal, v)").where(f"v > 0 or signal not in ({rare})")
    cut = f"greatest(0, length(bin(v)) - {BITS})"
    return long.selectExpr("lang", "source", "signal", f"shiftleft(shiftright(v, {cut}), {cut}) as bucket").groupBy("lang", "source", "signal", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _quantiles(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Of the merged sketch of each key: documents, and 10th, 50th and 90th percentile of each signal."""
    merged = sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "signal")
    ranked = merged.withColumn("upto", F.sum("n").over(by.orderBy("bucket"))).withColumn("total", F.sum("n").over(by))
    at = [F.min(F.when(F.col("upto") * 10 >= F.col("total") * q, F.col("bucket"))).alias(f"q{q}") for q in (1, 5, 9)]
    return ranked.groupBy(*keys, "signal").agg(F.first("total").alias("total"), *at).select(*keys, "signal", F.struct("total", "q1", "q5", "q9").alias(name))


def _far(kind: str, floor: int) -> str:
    """SQL of a limit from the percentiles q1, q5, q9."""
    if kind == "rare":
        return f"greatest(q9 + {RARE} * (q9 - q5), {floor})"
    return f"q5 + greatest({REACH} * (q5 - q1), {floor})" if kind == "high" else f"q5 - greatest({REACH} * (q9 - q5), {floor})"


def limits(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """lang, source and one limit a signal: a row for each group that has a sketch."""
    own, lang, every = (_quantiles(sketch, keys, name) for keys, name in ((["lang", "source"], "own"), (["lang"], "by_lang"), ([], "every")))
    groups = sketch.select("lang", "source").distinct().withColumn("signal", F.explode(F.array(*[F.lit(x[0]) for x in SIGNALS])))
    met = (
        groups.alias("g")
        .join(own.alias("o"), F.col("g.lang").eqNullSafe(F.col("o.lang")) & F.col("g.source").eqNullSafe(F.col("o.source")) & (F.col("g.signal") == F.col("o.signal")), "left")
        .join(lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.signal") == F.col("l.signal")), "left")
        .join(every.alias("e"), F.col("g.signal") == F.col("e.signal"), "left")
    )
    blend = lambda near, far, q: f"case when {near}.total is null then {far} else ({near}.total * {near}.{q} + {prior} * ({far})) div ({near}.total + {prior}) end"
    met = met.select("g.lang", "g.source", "g.signal", *[F.expr(blend("own", blend("by_lang", f"every.{q}", q), q)).alias(q) for q in ("q1", "q5", "q9")])
    pick = [F.expr(f"max(case when signal = '{name}' then {_far(kind, floor)} end) as max_{name}") for name, _, kind, floor in SIGNALS]
    return met.groupBy("lang", "source").agg(*pick)


def judge(counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """The counts with ``kept``: the base rules, then every limit of the document's group, joined."""
    ok = " and ".join(f"{sql} {'>=' if kind == 'low' else '<='} coalesce(max_{name}, {sql})" for name, sql, kind, _ in SIGNALS)
    met = counts.alias("d").join(bounds.alias("b"), F.col("d.lang").eqNullSafe(F.col("b.lang")) & F.col("d.source").eqNullSafe(F.col("b.source")), "left")
    return met.select("d.*", *[f"max_{name}" for name, _, _, _ in SIGNALS], F.expr(f"not base_failed and {ok}").alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, its group's limits, base_failed and kept."""
    counts = staged(signals(docs), "quality-signals")
    return judge(counts, limits(sketches(counts)))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The contract's columns over all ``documents``."""
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    signal = {name: sql.replace(" div ", " // ") for name, sql, _, _ in SIGNALS}
    stack = " union all ".join(f"select lang, source, '{name}' as signal, ({signal[name]}) as v from c where not base_failed" + f" and ({signal[name]}) > 0" * (kind == "rare") for name, _, kind, _ in SIGNALS)
    names = ", ".join(f"'{name}'" for name in signal)
    quant = lambda keys, name: f"""{name} as (select {keys}signal, max(total)::bigint as total, min(case when upto*10 >= total*1 then bucket end) as q1, min(case when upto*10 >= total*5 then bucket end) as q5, min(case when upto*10 >= total*9 then bucket end) as q9
      from (select *, sum(n) over (partition by {keys}signal order by bucket) as upto, sum(n) over (partition by {keys}signal) as total from (select {keys}signal, bucket, count(*) as n from b group by all)) group by {keys}signal)"""  # noqa: E731
    far = ", ".join(f"max(case when signal = '{name}' then {_far(kind, floor)} end) as max_{name}" for name, _, kind, floor in SIGNALS)
    ok = " and ".join(f"({signal[name]}) {'>=' if kind == 'low' else '<='} coalesce(max_{name}, ({signal[name]}))" for name, _, kind, _ in SIGNALS)
    blend = lambda near, wide, q: f"case when {near}.total is null then {wide} else ({near}.total * {near}.{q} + {PRIOR} * ({wide})) // ({near}.total + {PRIOR}) end"
    pick = ", ".join(f"{blend('o', blend('l', f'e.{q}', q), q)} as {q}" for q in ("q1", "q5", "q9"))
    return rf"""
with t as (select doc_id, lang, source, coalesce(text, '') as text from documents),
a as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
  list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) as l from t),
tri as (select doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from a)),
k as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as n from tri) where n > 1),
r as (select doc_id, count(distinct j)::bigint as n from (select doc_id, unnest([i, i+1, i+2]) as j from k) group by 1),
c as (select a.doc_id, lang, source, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
  coalesce(r.n, 0)::bigint as n_repeat_words, len(l)::bigint as n_lines, length(regexp_replace(text, '[^A-Z!]+', '', 'g'))::bigint as n_caps,
  (len(w) < 50 or 100 * coalesce(r.n, 0) > 50 * len(w)) as base_failed from a left join r on a.doc_id = r.doc_id),
s as ({stack}),
b as (select lang, source, signal, (v >> greatest(0, length(bin(v)) - {BITS})::bigint) << greatest(0, length(bin(v)) - {BITS})::bigint as bucket from s),
{quant("lang, source, ", "qo")}, {quant("lang, ", "ql")}, {quant("", "qe")},
g as (select lang, source, unnest([{names}]) as signal from (select distinct lang, source from b)),
m as (select g.lang, g.source, g.signal, {pick} from g left join qo o on g.lang is not distinct from o.lang and g.source is not distinct from o.source and g.signal = o.signal
  left join ql l on g.lang is not distinct from l.lang and g.signal = l.signal left join qe e on g.signal = e.signal),
lim as (select lang, source, {far} from m group by 1, 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (not base_failed and {ok}) as kept
from c left join lim on c.lang is not distinct from lim.lang and c.source is not distinct from lim.source"""


OP2_SQL = _oracle()
