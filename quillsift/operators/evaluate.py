"""Evaluation (E8, E9, A13-A16): joins of predictions with labels, and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.functions import patterns as P


def ratios(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision (0 without predictions), recall (1 without positives) and F1."""
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(1.0)
    return p, r, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def entity_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Hits by exact span and type, (id, start, stop, type), of each type and overall ('all')."""
    keys = ["id", "start", "stop", "type"]
    both = gold.select(*keys, F.lit(1).alias("g")).distinct().join(predicted.select(*keys, F.lit(1).alias("p")).distinct(), keys, "full")
    sums = both.rollup("type").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    p, r, f1 = ratios(F.col("tp"), F.col("fp"), F.col("fn"))
    return sums.select(F.coalesce("type", F.lit("all")).alias("type"), "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def coverage_sample(entities: DataFrame, most: int = 50) -> DataFrame:
    """Up to ``most`` records, each the one that adds most entity types not covered so far (a sampling operator; the limit is its feature)."""
    types = entities.groupBy("id").agg(F.collect_set("type").alias("types"))
    chosen, covered = [], []
    for _ in range(most):
        new = F.size(F.array_except("types", F.array(*[F.lit(t) for t in covered]).cast("array<string>")))
        best = types.where(~F.col("id").isin(*chosen) if chosen else F.lit(True)).orderBy(new.desc(), "id").first()
        if best is None or not set(best["types"]) - set(covered):
            break
        chosen.append(best["id"])
        covered += sorted(set(best["types"]) - set(covered))
    return types.where(F.col("id").isin(*chosen) if chosen else F.lit(False)).select("id", F.array_join(F.array_sort("types"), " | ").alias("types"))


def pair_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Counts and ratios of predicted pairs (a, b) against gold pairs (a, b, verdict); pairs under manual review count for nothing."""
    order = lambda df, *more: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more).distinct()
    met = order(gold, "verdict").join(order(predicted).withColumn("p", F.lit(1)), ["a", "b"], "left").where("verdict in ('positive', 'negative')")
    yes, hit = F.col("verdict") == "positive", F.col("p").isNotNull()
    sums = met.agg(F.count_if(yes & hit).alias("tp"), F.count_if(~yes & hit).alias("fp"), F.count_if(yes & ~hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"))
    p, r, f1 = ratios(F.col("tp"), F.col("fp"), F.col("fn"))
    return sums.select("tp", "fp", "fn", "tn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def corpus_mismatches(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """(id, label) expected and missed, or found and not expected."""
    e, p = expected.select("id", "label").distinct(), predicted.select("id", "label").distinct()
    return e.exceptAll(p).withColumn("error", F.lit("missed")).unionByName(p.exceptAll(e).withColumn("error", F.lit("unexpected")))


def family_errors(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """Families (id, family) that were split or merged."""
    met = expected.select("id", F.col("family").alias("e")).join(predicted.select("id", F.col("family").alias("p")), "id")
    split = met.groupBy("e").agg(F.countDistinct("p").alias("n")).where("n > 1").select(F.col("e").alias("family"), F.lit("split").alias("error"), "n")
    merged = met.groupBy("p").agg(F.countDistinct("e").alias("n")).where("n > 1").select(F.col("p").alias("family"), F.lit("merged").alias("error"), "n")
    return split.unionByName(merged)


def signal_validation(pairs: DataFrame, baseline: DataFrame, gold: DataFrame) -> DataFrame:
    """Of each signal's pairs (signal, a, b): gold hits, and those that the baseline lacks, with a recommendation."""
    met = pairs.distinct().join(gold, ["a", "b"], "left").join(baseline.select("a", "b", F.lit(1).alias("known")).distinct(), ["a", "b"], "left")
    new = F.col("known").isNull()
    out = met.groupBy("signal").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("verdict") == "positive").alias("gold_positive"), F.count_if(F.col("verdict") == "negative").alias("gold_negative"),
        F.count_if(F.col("verdict").isNull()).alias("unlabelled"), F.count_if(new).alias("incremental"), F.count_if(new & (F.col("verdict") == "positive")).alias("incremental_positive"), F.count_if(new & (F.col("verdict") == "negative")).alias("incremental_negative"),
    )
    lost, won = F.col("incremental_negative"), F.col("incremental_positive")
    advice = F.when((won > 0) & (lost == 0), "consider_candidate_route").when(lost > won, "reject_for_topic_noise").otherwise("keep_disabled")
    return out.withColumn("recommendation", advice)


def append_gold(gold: DataFrame, new: DataFrame, skip_seen: bool = False) -> DataFrame:
    """Gold pairs with new ones; a pair that is there already is an error, or left out."""
    order = lambda df: df.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    old, add = order(gold), order(new).dropDuplicates(["a", "b"])
    if not skip_seen and (twice := add.join(old, ["a", "b"], "left_semi").first()):
        raise ValueError(f"labelled before: {twice['a']}, {twice['b']}")
    return old.unionByName(add.join(old, ["a", "b"], "left_anti"))


def gold_verdict(verdict: Column, advised: Column, pair_class: Column) -> Column:
    """A reviewer's words as positive, negative or manual; of words that are not listed the pair's class decides."""
    v = F.trim(F.coalesce(verdict, F.lit("")))
    return (
        F.when(v.isin(*P.GOLD_MANUAL) | (F.trim(F.coalesce(advised, F.lit(""))) == "Needs manual review"), "manual").when(v.isin(*P.GOLD_POSITIVE), "positive")
        .when(v.isin(*P.GOLD_NEGATIVE), "negative").when(F.trim(F.coalesce(pair_class, F.lit(""))) == "Possible template reuse", "positive").otherwise("negative")
    )


def signatures(sentences: DataFrame) -> DataFrame:
    """B14's keys: assay workflows and endpoint bundles of (id, seq, sentence)."""
    from quillsift.functions.text import match_form

    found = lambda p: F.transform(F.regexp_extract_all(F.col("sentence"), F.lit(P.java(p, True)), F.lit(0)), match_form)
    assay, ends = F.array_join(found(P.ASSAY), " > "), F.array_join(F.array_sort(F.array_distinct(found(P.ENDPOINT))), " + ")
    rows = sentences.select("id", F.explode(F.array(F.struct(F.lit("assay_workflow").alias("signal"), assay.alias("key"), F.size(found(P.ASSAY)).alias("n")), F.struct(F.lit("endpoint_bundle").alias("signal"), ends.alias("key"), F.size(found(P.ENDPOINT)).alias("n")))).alias("x"))
    return rows.where("x.n >= 2").select("id", "x.signal", "x.key").distinct()


def ranked(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with their place in the order of ``keys``."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(*keys)))
