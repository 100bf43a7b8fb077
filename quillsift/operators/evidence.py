"""From candidate pairs to priorities (X3-X5, V10, V13, V15, V17, C1-C8): one row a pair, ladders as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift import thresholds as H
from quillsift.functions import patterns as P
from quillsift.functions.similarity import title_similarity
from quillsift.functions.text import let, match_form, reverse_substitutions
from quillsift.operators.blocking import title_pairs

_RANK = {c: i for i, c in enumerate(H.CONFIDENCES)}


#: X1's match types that are shared text without an equal section.
DISTINCTIVE = ("multiple_distinctive_sentences", "rare_exact_phrase", "substantial_shared_text", "partial_or_reordered_reuse")


def rank(values: tuple[str, ...], x: Column) -> Column:
    """Place of a word in an ordered vocabulary, -1 if it is none of it."""
    return (F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), x), F.lit(0)) - 1).cast("int")


def labels(**conditions: Column) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()]))


def reuse_confidence(match_type: Column, sentences: Column, coverage: Column) -> Column:
    """X1's ladder of confidence."""
    return (
        F.when(match_type.isin("exact_full_abstract", "exact_results_section"), "very_high")
        .when((sentences >= 3) | (coverage >= H.HIGH_COVERAGE), "high")
        .when((sentences >= 2) | (coverage >= H.MEDIUM_COVERAGE), "medium")
        .otherwise("low")
    )


def reuse_severity(confidence: Column, relation: Column) -> Column:
    """X1's and X2's ladder of severity, by how expected the overlap is."""
    sure = confidence.isin("very_high", "high")
    return F.when(relation == "expected", "low").when(relation == "possible", F.when(sure, "medium").otherwise("low")).otherwise(F.when(sure, "high").otherwise("medium"))


def reuse_match_type(e: dict[str, Column]) -> Column:
    """X1's order of decisions, from flags and measures of a pair; null where nothing is found. ``same_section``: any equal section."""
    kind = (
        F.when(e["same_text"], "exact_full_abstract")
        .when(e["same_results"], "exact_results_section")
        .when(e["same_methods"], "exact_methods_section")
        .when(e["sentences"] >= 2, "multiple_distinctive_sentences")
        .when((e["rare_words"] > H.RARE_PHRASE_WORDS) | ((e["rare_words"] == H.RARE_PHRASE_WORDS) & (e["rare_similarity"] >= H.RARE_PHRASE_SIMILARITY)), "rare_exact_phrase")
        .when(e["coverage"] >= H.HIGH_COVERAGE, "substantial_shared_text")
        .when(e["coverage"] >= H.MEDIUM_COVERAGE, "partial_or_reordered_reuse")
    )
    lone = (e["sentences"] == 1) & (e["coverage"] < H.LONE_COVERAGE) & kind.isin("substantial_shared_text", "partial_or_reordered_reuse")
    return F.when(~lone | e.get("same_section", F.lit(False)), kind)


def template_confidence(masked: Column, original: Column, substitutions: Column, section: Column) -> Column:
    """X2's ladder of confidence."""
    very = (masked >= 0.95) & (original >= 0.65) & (substitutions >= 2)
    high = ((masked >= H.TEMPLATE_MASKED) | (section >= H.TEMPLATE_SECTION)) & (original >= H.TEMPLATE_ORIGINAL) & ((substitutions >= 1) | (section >= H.TEMPLATE_SECTION))
    return F.when(very, "very_high").when(high, "high").otherwise("medium")


def template_triggers(e: dict[str, Column]) -> Column:
    """X2's triggers of a pair: global, local in three ways, assay, short title."""
    local = (
        ((e["local_masked"] >= H.LOCAL_MASKED) & (e["local_original"] >= H.LOCAL_ORIGINAL))
        | ((e["run_masked"] >= H.LOCAL_SEQUENCE) & (e["run_original"] >= H.LOCAL_ORIGINAL))
        | ((e["local_masked"] >= H.MODERATE_MASKED) & (e["local_original"] >= H.MODERATE_ORIGINAL) & (e["masked"] >= H.MODERATE_GLOBAL) & (e["shared_words"] >= H.MODERATE_WORDS))
    ) & (e["original"] >= H.LOCAL_GLOBAL_ORIGINAL)
    whole = (e["original"] >= H.TEMPLATE_ORIGINAL) & ~e["methods_only"] & ((e["masked"] >= H.TEMPLATE_MASKED) | e["sections"])
    return labels(masked_skeleton=whole, local_substitution=local, assay_workflow=e["assay"], short_title=e["short_title"])


def section_scores(scores: Column) -> Column:
    """Of a map label -> similarity the weighted mean of the labels that have a weight, the greatest of results and conclusions,
    the labels alike enough, how many of those are results or conclusions, and whether methods alone are alike."""
    named = F.map_entries(scores)
    of = lambda word: F.filter(named, lambda s: F.contains(match_form(s["key"]), F.lit(word)))
    parts = [(of(word), weight) for word, weight in H.SECTION_WEIGHTS.items()]
    total = sum((F.size(v) * weight for v, weight in parts), F.lit(0.0))
    hit = sum((F.aggregate(v, F.lit(0.0), lambda a, s: a + s["value"]) * weight for v, weight in parts), F.lit(0.0))
    top = lambda v: F.coalesce(F.array_max(F.transform(v, lambda s: s["value"])), F.lit(0.0))
    value = F.array_distinct(F.concat(of("result"), of("conclusion")))
    alike = lambda v: F.filter(v, lambda s: s["value"] >= H.TEMPLATE_SECTION)
    high = F.size(alike(value))
    return F.struct(
        F.when(total > 0, hit / total).otherwise(0.0).alias("weighted"), top(value).alias("high"), F.array_sort(F.transform(alike(named), lambda s: s["key"])).alias("matched"),
        high.alias("n_high"), ((F.size(named) > 0) & (high == 0) & (top(of("method")) >= H.TEMPLATE_SECTION)).alias("methods_only"),
    )


def template_findings(pairs: DataFrame) -> DataFrame:
    """X2's ladders over measured pairs: those with a trigger, with match type, confidence and severity."""
    names = ("local_masked", "local_original", "run_masked", "run_original", "masked", "original", "shared_words", "assay", "short_title")
    by_section = (F.col("v10.n_high") >= 2) & (F.col("v10.high") >= H.TEMPLATE_SECTION)
    found = pairs.withColumn("triggers", template_triggers({n: F.col(n) for n in names} | {"methods_only": F.col("v10.methods_only"), "sections": by_section})).where(F.size("triggers") > 0)
    local = F.array_contains("triggers", "local_substitution")
    rung = template_confidence(F.col("masked"), F.col("original"), F.col("substitutions"), F.col("v10.high"))
    sure = F.when(F.col("assay") | (local & (rung == "medium") & (F.col("local_masked") >= H.LOCAL_HIGH)), "high").otherwise(rung)
    kind = (
        F.when(F.col("masked") == 1.0, "exact_masked_skeleton").when(by_section, "shared_high_value_sections").when(local, "local_entity_substitution")
        .when(F.col("assay"), "shared_assay_protocol").when(F.col("short_title"), "title_related_duplicate").otherwise("entity_value_substitution")
    )
    grave = F.when(F.col("expected"), "low").when(F.col("confidence").isin("very_high", "high") & (F.col("v10.high") >= 0.90), "high").otherwise("medium")
    return found.withColumn("confidence", sure).select(
        "a", "b", kind.alias("match_type"), "confidence", grave.alias("severity"), F.array_join("triggers", " | ").alias("triggers"), "masked", "original", "ngram", F.col("v10.weighted").alias("section_score"), F.col("v10.high").alias("high_section_score"),
        F.array_join("v10.matched", " | ").alias("sections"), "substitutions", "changes", "local_masked", "local_original",
    )


def assay_signature(text: Column) -> Column:
    """Kinds of assays that a text names."""
    low = match_form(text)
    has = lambda *xs: F.array_max(F.array(*[F.contains(low, F.lit(x)) for x in xs]))
    return labels(**{name: has(*words) for name, words in P.ASSAY_GROUPS.items()})


def relation(shared_trials: Column, companion: Column, shared_authors: Column, shared_affiliations: Column) -> Column:
    """How much an overlap is to be expected."""
    return F.when((F.size(shared_trials) > 0) | companion, "expected").when((F.size(shared_authors) > 0) | (F.size(shared_affiliations) > 0), "possible").otherwise("none")


def strongest_section(sims: Column) -> Column:
    """The greatest (similarity, label, exact) of an array of such structs."""
    return F.array_max(sims)


def merged_findings(findings: DataFrame) -> DataFrame:
    """One row a pair of rows (a, b, check_type, match_type, confidence, score, sections): the surest first, greatest score, all sections."""
    order = F.struct((-rank(H.CONFIDENCES, F.col("confidence"))).alias("r"), "check_type", "match_type")
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    return findings.groupBy(lo.alias("a"), hi.alias("b")).agg(
        F.min(order).alias("m"), F.max("score").alias("score"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("sections", " \\| "))))), " | ").alias("sections"),
        F.array_join(F.array_sort(F.collect_set("check_type")), " | ").alias("check_types"),
    ).select("a", "b", F.col("m.check_type").alias("check_type"), F.col("m.match_type").alias("match_type"), F.element_at(F.array(*[F.lit(c) for c in H.CONFIDENCES]), 1 - F.col("m.r")).alias("confidence"), "score", "sections", "check_types")


def context_severity(confidence: Column, context: Column) -> Column:
    """Severity by the wording of a pair's context."""
    low, sure = F.lower(context), confidence.isin("high", "very_high")
    has = lambda *xs: F.greatest(*[F.contains(low, F.lit(x)) for x in xs])
    related = has("shared trial id:", "declared related analysis", "explicitly declare a related study")
    return F.when(related, "low").when(has("overlapping authors:", "shared affiliations:"), F.when(sure, "medium").otherwise("low")).otherwise(F.when(sure, "high").otherwise("medium"))


def context_class(context: Column) -> Column:
    """The class that goes with it."""
    low = F.lower(context)
    related = F.contains(low, F.lit("shared trial id:")) | F.contains(low, F.lit("declared related analysis")) | F.contains(low, F.lit("explicitly declare a related study"))
    return F.when(related, "possible_companion_analysis").otherwise("possible_template_reuse")


def title_comparison(records: DataFrame) -> DataFrame:
    """Pairs of like titles with both similarities, from (id, title, masked_title)."""
    left = records.select(F.col("id").alias("a"), F.col("title").alias("ta"), F.col("masked_title").alias("ma"))
    right = records.select(F.col("id").alias("b"), F.col("title").alias("tb"), F.col("masked_title").alias("mb"))
    met = title_pairs(records).join(left, "a").join(right, "b")
    return met.select("a", "b", (match_form(F.col("ma")) == match_form(F.col("mb"))).alias("exact_masked_title"), title_similarity("ma", "mb").alias("masked_similarity"), title_similarity("ta", "tb").alias("original_similarity"))


def direct_evidence(e: dict[str, Column]) -> Column:
    """Labels of direct evidence; equal empty texts are no evidence."""
    return labels(
        exact_original_body=e["exact_body"] & e["has_body"], exact_results_section=e["exact_results"], substantial_shared_original_block=e["block"] >= H.SHARED_BLOCK_WORDS,
        strong_masked_body_with_original_support=(e["masked"] >= H.MASKED_BODY) & (e["original"] >= H.ORIGINAL_SUPPORT), entity_normalized_template=e["template"],
        distinctive_shared_text=e["reuse"], masked_title_template_with_original_support=e["exact_title"] & (e["original_title"] >= H.ORIGINAL_SUPPORT),
    )


def tiered_score(pairs: DataFrame) -> DataFrame:
    """Adds primary_score, supporting_score, review_score and evidence_state to rows of
    (direct: array, exact_title, title_similarity, masked, exact_methods, section_score)."""
    weight = F.create_map(*[x for k, v in H.PRIMARY_WEIGHTS.items() for x in (F.lit(k), F.lit(v))])
    primary = F.coalesce(F.array_max(F.transform(F.col("direct"), lambda d: weight[d])), F.lit(0.0))
    lacks = lambda name: ~F.array_contains("direct", name)
    titled = (F.col("exact_title") & lacks("masked_title_template_with_original_support")) | (F.col("title_similarity") >= 0.90)
    body = (F.col("masked") >= 0.75) & lacks("strong_masked_body_with_original_support")
    nought = F.lit(0.0)
    support = F.greatest(F.when(titled, 0.10).otherwise(nought), F.when(body, 0.15).otherwise(nought), F.when(F.col("exact_methods"), H.SECTION_SUPPORT["method"]).otherwise(nought), F.coalesce("section_score", nought))
    out = pairs.withColumn("primary_score", primary).withColumn("supporting_score", support)
    review = F.when(F.col("primary_score") > 0, F.least(F.lit(1.0), F.col("primary_score") + F.least("supporting_score", F.lit(H.SUPPORT_CAP)))).otherwise(0.0)
    return out.withColumn("review_score", review).withColumn("evidence_state", F.when(F.col("primary_score") > 0, "primary").when(F.col("supporting_score") > 0, "supporting_only").otherwise("none"))


def section_support(label: Column, similarity: Column) -> Column:
    """What a like section adds, by its label."""
    out = F.lit(H.SECTION_SUPPORT_OTHER)
    for key, value in reversed(H.SECTION_SUPPORT.items()):
        out = F.when(F.contains(F.lower(label), F.lit(key)), value).otherwise(out)
    return F.when(similarity >= H.SECTION_SUPPORT_GATE, out).otherwise(0.0)


def overlap(left: Column, right: Column) -> Column:
    """Same, partial, different, or unknown where a side is empty."""
    return (
        F.when((F.size(left) == 0) | (F.size(right) == 0), "unknown")
        .when((F.size(F.array_except(left, right)) == 0) & (F.size(F.array_except(right, left)) == 0), "same")
        .when(F.arrays_overlap(left, right), "partial").otherwise("different")
    )


def sample_sizes(text: Column) -> Column:
    """Numbers of people that a text names."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(P.java(P.SAMPLE_SIZE, True)), F.lit(1)))


def interpretation(trial: Column, database: Column, population: Column, period: Column, size: Column, endpoints: Column, companion: Column) -> Column:
    """What the shared context of two studies suggests."""
    aligned = trial | (database & (population | period | size)) | (population & (period | size))
    return (
        F.when(aligned & (companion | endpoints.isin("partial", "different")), "likely_companion_analysis")
        .when(aligned, "likely_same_study")
        .when(companion | database | population | period, "possible_related_study")
        .otherwise("no_structured_context")
    )


def study_context(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs (a, b) with what they share, from values: id, text, trial_id, registry, date, population, endpoint, drug, treatment_class (arrays)."""
    kinds = ("trial_id", "registry", "date", "population", "endpoint", "treatment")
    v = values.withColumn("treatment", F.array_union("drug", "treatment_class")).withColumn("sizes", sample_sizes(F.col("text"))).withColumn("companion", F.col("text").rlike(P.java(P.COMPANION, True)))
    side = lambda s, key: v.select(F.col("id").alias(key), *[F.col(k).alias(f"{s}_{k}") for k in (*kinds, "sizes", "companion")])
    met = pairs.join(side("l", "a"), "a").join(side("r", "b"), "b")
    both = {k: F.array_sort(F.array_intersect(f"l_{k}", f"r_{k}")) for k in (*kinds, "sizes")}
    some = {k: F.size(x) > 0 for k, x in both.items()}
    ends, companion = overlap(F.col("l_endpoint"), F.col("r_endpoint")), F.col("l_companion") | F.col("r_companion")
    return met.select(
        "a", "b", *[F.array_join(x, " | ").alias(f"shared_{k}") for k, x in both.items()],
        F.array_join(F.array_sort(F.array_except("l_endpoint", "r_endpoint")), " | ").alias("left_only_endpoints"), F.array_join(F.array_sort(F.array_except("r_endpoint", "l_endpoint")), " | ").alias("right_only_endpoints"),
        overlap(F.col("l_population"), F.col("r_population")).alias("same_population"), ends.alias("endpoint_overlap"), companion.alias("companion"),
        interpretation(some["trial_id"], some["registry"], some["population"], some["date"], some["sizes"], ends, companion).alias("interpretation"),
    )


def pair_class(has_primary: Column, exact: Column, context: Column) -> Column:
    """C4."""
    related = context != "no_structured_context"
    return (
        F.when(~has_primary, "insufficient_evidence").when(exact & related, "possible_related_duplicate").when(context == "likely_companion_analysis", "possible_companion_analysis")
        .when(related, "possible_related_work").otherwise("possible_template_reuse")
    )


def priority(kind: Column, score: Column) -> Column:
    """C5."""
    return (
        F.when(kind == "insufficient_evidence", "None").when(kind.isin("possible_companion_analysis", "possible_related_work"), "Low")
        .when(score >= H.HIGH_PRIORITY, "High").when(score >= H.MEDIUM_PRIORITY, "Medium").otherwise("Low")
    )


def substitutions(left: Column, right: Column) -> Column:
    """What stands for what, of two arrays of one entity type: sorted rests side by side, 'none' where one is shorter."""
    at = lambda xs, i: F.coalesce(F.get(xs, i), F.lit("none"))

    def zipped(v: Column) -> Column:
        n = F.greatest(F.size(v["l"]), F.size(v["r"]))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(at(v["l"], i), F.lit(" -> "), at(v["r"], i)))).otherwise(F.array().cast("array<string>"))

    return let(F.struct(F.array_sort(F.array_except(left, right)).alias("l"), F.array_sort(F.array_except(right, left)).alias("r")), zipped)


def enriched(pairs: DataFrame) -> DataFrame:
    """Pairs with score, context, class and priority in one row, from rows of ``tiered_score`` with ``interpretation``."""
    exact = F.array_contains("direct", "exact_original_body") | F.array_contains("direct", "exact_results_section")
    out = pairs.withColumn("pair_class", pair_class(F.col("primary_score") > 0, exact, F.col("interpretation")))
    return out.withColumn("priority", priority(F.col("pair_class"), F.col("review_score")))


def directional(pairs: DataFrame) -> DataFrame:
    """Two rows for each pair with a priority, one from either side."""
    kept = pairs.where("priority <> 'None'")
    swapped = kept.select(F.col("b").alias("a"), F.col("a").alias("b"), *[reverse_substitutions(F.col(c)).alias(c) if c == "substitutions" else F.col(c) for c in kept.columns if c not in ("a", "b")])
    return kept.select("a", "b", *[c for c in kept.columns if c not in ("a", "b")]).unionByName(swapped)
