r"""Text functions as Column expressions (T1-T3, T5, T7-T19, T21), T14 as an Arrow-batched one: elsewhere no Python on the executors."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsift.functions import forms, hints
from quillsift.functions import patterns as P


def let(x: Column, use) -> Column:
    """``use`` of a value that is computed once: an expression inside a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def squeeze(x: Column) -> Column:
    """Runs of white space become one space; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def match_form(x: Column) -> Column:
    """Lower case, everything but ASCII letters and digits becomes one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^0-9a-z]+", " "))


def tokens(x: Column) -> Column:
    """The words of the match form."""
    return F.filter(F.split(match_form(x), " "), lambda t: t != "")


def feature_sentences(x: Column) -> Column:
    """T5: split after ., ! or ? and white space."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"(?<=[.!?])\s+"), lambda s: s != "")


def label(x: Column) -> Column:
    """A section label without outer punctuation, each word capitalised, joining words in lower case."""
    bare = F.regexp_replace(F.regexp_replace(squeeze(x), r"^[:\-. ]+|[:\-. ]+$", ""), " +", " ")
    cut = F.regexp_replace(bare, r"(?<=[^\p{L} ])(?=\p{L})", "\u0001 ")  # a word begins after any sign that is no letter
    titled = F.replace(F.initcap(cut), F.lit("\u0001 "), F.lit(""))
    for word in ("And", "Of", "In", "On", "For", "With", "To"):
        titled = F.replace(titled, F.lit(f" {word} "), F.lit(f" {word.lower()} "))
    return titled


def first_nonempty(*xs: Column) -> Column:
    """The first value that is neither null nor blank, else empty."""
    return F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in xs], F.lit(""))


def join_nonempty(sep: str, *xs: Column) -> Column:
    """The values that are neither null nor blank, joined."""
    return F.array_join(F.filter(F.array(*[F.trim(x) for x in xs]), lambda v: v.isNotNull() & (v != "")), sep)


def ordered_distinct(xs: Column) -> Column:
    """First occurrences in order."""
    return F.array_distinct(xs)


def to_pipe(xs: Column) -> Column:
    """List as text."""
    return F.array_join(F.filter(xs, lambda v: v.isNotNull() & (F.trim(v) != "")), " | ")


def safe_int(x: Column) -> Column:
    """A whole number from text with thousands separators, else null."""
    return F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("double").cast("int")


def year_of(x: Column) -> Column:
    """The first year from 1900 to 2099, else empty."""
    return F.regexp_extract(F.coalesce(x, F.lit("")), r"(19|20)\d{2}", 0)


def snippet(x: Column, start: Column, stop: Column, around: int = 80) -> Column:
    """Text about [start, stop) with so many characters on both sides, squeezed."""
    lo = F.greatest(start - around, F.lit(0))
    return squeeze(F.substring(x, lo + 1, stop + around - lo))


def section_of(sections: Column, needle: Column) -> Column:
    """Label of the first section (array of struct(section, text)) that has the text."""
    return F.coalesce(F.get(F.transform(F.filter(sections, lambda s: F.contains(F.lower(s["text"]), F.lower(needle))), lambda s: s["section"]), F.lit(0)), F.lit(""))


def block_key(*xs: Column) -> Column:
    """A key for grouping equal texts."""
    return F.sha2(F.concat_ws("\u0000", *xs), 256)


def doi(x: Column) -> Column:
    """Without resolver or scheme, in lower case."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), r"^(https?://doi\.org/|doi:)", "")


def mask(x: Column) -> Column:
    """Registrations and gene-like names in given case, the rest lower-cased and replaced in turn by placeholders."""

    def replaced(out: Column, fixed: Column, pattern: str, name: str, fold: bool = True) -> Column:
        try_it = hints.may(pattern, fixed["low"], fixed["odd"])
        if pattern == P.GENE or (hints.DIGIT,) in hints.clauses(pattern):
            try_it = try_it & fixed["digit"]
        return let(F.struct(out.alias("x"), try_it.alias("t")), lambda v: F.when(v["t"], F.regexp_replace(v["x"], P.java(pattern, fold), f"<{name}>")).otherwise(v["x"]))

    def masked(v: Column) -> Column:
        # what a pattern needs is looked for in the text as it came: placeholders put in by another one bring no digits, and no literals but their names
        out = replaced(replaced(v["x"], v, P.TRIAL, "TRIAL_ID"), v, P.GENE, "GENE", False)
        out = F.lower(out)
        for pattern, name in ((P.URL, "URL"), (P.EMAIL, "EMAIL"), *((d, "DATE") for d in P.DATES), (P.PVALUE, "PVAL"), (P.PERCENT, "PCT"), (P.DRUG, "DRUG"), (P.NUMBER, "NUM")):
            out = replaced(out, v, pattern, name)
        return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))

    text = F.coalesce(x, F.lit(""))
    return let(F.struct(text.alias("x"), F.lower(text).alias("low"), text.rlike(hints.ODD).alias("odd"), text.rlike(r"(?U)\d").alias("digit")), masked)


def content_class(article_type: Column, title: Column, text: Column, skeleton: Column) -> Column:
    """Whether a record can be compared at all."""
    boiler, placeholders = re.compile(P.BOILERPLATE), frozenset(w.encode() for w in P.PLACEHOLDER_WORDS)

    def kind(article: str | None, head: str | None, body: str | None, masked: str | None) -> str:
        said = forms.form(" ".join(v for v in (article, head, body) if v is not None))
        if "trial in progress" in said:
            return "trials_in_progress"
        if "late breaking" in said:
            return "late_breaking_placeholder"
        w = forms.words(boiler.sub(" ", forms.form(masked)))
        content = sum(t not in placeholders for t in w)
        if not content:
            return "empty_or_unusable"
        if content < 5 or content / len(w) < 0.35:
            return "administrative_boilerplate"
        return "valid_short" if content < 25 else "comparable"

    @F.pandas_udf("string")
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([kind(*v) for v in zip(a, b, c, d, strict=True)], dtype="object")

    return run(article_type, title, text, skeleton)


def entity_shape(skeleton: Column) -> Column:
    """For each kind of placeholder its count, in fives; NOPLACEHOLDER without any."""
    found = F.regexp_extract_all(skeleton, F.lit("<(" + "|".join(P.PLACEHOLDERS) + ")>"), F.lit(1))

    def shape(names: Column) -> Column:
        parts = F.transform(F.array_sort(F.array_distinct(names)), lambda k: F.concat(k, F.floor(F.size(F.filter(names, lambda x: x == k)) / 5).cast("string")))
        return F.when(F.size(names) == 0, "NOPLACEHOLDER").otherwise(F.array_join(parts, ":"))

    return let(found, shape)


def shingles(words: Column, n: int) -> Column:
    """The set of n-grams of an array of words, each joined by spaces."""

    def grams(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))

    return let(words, grams)


def quotation(prefix: Column, block_type: Column) -> Column:
    """Whether what follows ``prefix`` stands in a quotation, by the marks still open."""
    count = lambda mark: F.length(prefix) - F.length(F.replace(prefix, F.lit(mark), F.lit("")))
    single = F.size(F.regexp_extract_all(prefix, F.lit(r"(?U)(?<!\w)'|'(?!\w)"), F.lit(0)))
    return (
        F.when(block_type == "blockquote", "blockquote")
        .when((count("```") / 3) % 2 == 1, "code_fence")
        .when((count('"') % 2 == 1) | (count("“") > count("”")) | (single % 2 == 1), "quoted")
        .otherwise("not_quoted")
    )


def merge_gene_masks(masked: Column) -> Column:
    """Proteins count as genes; a gene's suffix stands apart."""
    return F.regexp_replace(F.replace(masked, F.lit("<PROTEIN>"), F.lit("<GENE>")), r"<GENE>-(?=\w)", "<GENE> ")


def estimated_tokens(x: Column) -> Column:
    """A cautious count of model tokens."""
    words = F.size(F.filter(F.split(F.coalesce(x, F.lit("")), r"\s+"), lambda w: w != ""))
    return (F.greatest(F.ceil(F.length(F.coalesce(x, F.lit(""))) / 3), F.ceil(words * 1.5)) + 16).cast("long")


def reverse_substitutions(x: Column) -> Column:
    """T21: 't: a -> b; ...' read from the other side."""
    return F.array_join(F.transform(F.split(x, "; "), lambda p: F.regexp_replace(p, r"^([^:]*): (.*) -> (.*)$", "$1: $3 -> $2")), "; ")
