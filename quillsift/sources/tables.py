"""Tabular and JSON inputs, and the sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StructType

from quillsift.functions import patterns as P
from quillsift.functions.text import doi, match_form
from quillsift.operators.evaluate import gold_verdict


def phrase_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """rule_id, query, expected, papers of a dictionary file; equal rules once."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    named = raw.toDF(*[c.replace("﻿", "").strip() for c in raw.columns])
    rows = named.select(F.col("Fingerprint - Tortured Phrase").alias("query"), F.coalesce("Expected Text", F.lit("")).alias("expected"), F.col("Nb Retrieved Papers").alias("papers")).where("trim(query) <> ''")
    return rows.withColumn("rule_id", rule_id(F.col("query"), F.col("expected"))).dropDuplicates(["rule_id"])


def rule_id(query: Column, expected: Column) -> Column:
    """A stable name of a rule."""
    return F.concat(F.lit("TP-"), F.substring(F.sha2(F.concat(match_form(query), F.lit("\u0000"), match_form(expected)), 256), 1, 12))


def rule_catalogue(spark: SparkSession) -> DataFrame:
    """The trace rules as a table."""
    check_rules(P.TRACE_RULES)
    return spark.createDataFrame([(*r[:7], list(r[7])) for r in P.TRACE_RULES], "rule_id string, category string, signal_level string, severity string, priority_eligible boolean, requires_validation boolean, confidence double, patterns array<string>")


def check_rules(rules) -> None:
    """Refuses a catalogue with missing, repeated or unknown values."""
    import re

    if len({r[0] for r in rules}) != len(rules):
        raise ValueError("a rule's name comes twice")
    for name, category, level, severity, _, _, confidence, patterns in rules:
        if not (category and patterns and level in ("strong", "contextual", "supporting") and severity in ("low", "medium", "high") and 0 <= confidence <= 1):
            raise ValueError(f"rule {name} is not valid")
        for p in patterns:
            re.compile(p, re.I)


def catalogue_checksum(rules=P.TRACE_RULES) -> str:
    """Of a catalogue's content."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()


def authorship_checks(spark: SparkSession, path: str) -> DataFrame:
    """Key (normal DOI), abstract_id, check_name, level, comment of a DOI-keyed file."""
    kind = "map<string, struct<abstract_id:string,title:string,checks:array<struct<check_name:string,result:struct<level:string,comment:string,supporting_data:array<string>>>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("key", "v"))
    return raw.select(doi(F.col("key")).alias("key"), "v.abstract_id", F.explode("v.checks").alias("c")).select("key", "abstract_id", "c.check_name", "c.result.level", "c.result.comment")


def gold_labels(spark: SparkSession, path: str) -> DataFrame:
    """Pairs (a, b), ids without the prefix rw, with their verdict; the columns of classes may be missing."""
    rows = spark.read.csv(path, header=True)
    a, b = (F.regexp_replace(F.trim(F.col(c)), "^rw", "") for c in ("abstract_id_a", "abstract_id_b"))
    other = [F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("recommended_pair_class", "pair_class")]
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), gold_verdict(F.col("reviewed_verdict"), *other).alias("verdict"))


def registry_cache(spark: SparkSession, path: str, now: str | None = None, days: int = 30) -> DataFrame:
    """Lookups that may be used: verified or not found, and not older than ``days``."""
    rows = spark.read.json(path, schema="trial_id string, status string, looked_up string")
    fresh = F.datediff(F.lit(now) if now else F.current_date(), F.to_date("looked_up")) <= days
    return rows.where(F.col("status").isin("verified", "not_found") & fresh).select(F.upper("trial_id").alias("trial_id"), "status").dropDuplicates(["trial_id"])


def registry_lookup(ids: DataFrame, client: Callable[[], Callable[[str], str]]) -> DataFrame:
    """S15, live: each distinct trial_id once, by a client made in each task; what fails stays lookup_failed."""
    import pandas as pd

    def run(batches):
        look = client()
        for b in batches:
            out = []
            for x in b["trial_id"]:
                try:
                    status = look(x)
                except Exception:  # noqa: BLE001  a lookup that fails is a result
                    status = "lookup_failed"
                out.append(status if status in ("verified", "not_found") else "lookup_failed")
            yield pd.DataFrame({"trial_id": b["trial_id"], "status": out})

    return ids.select("trial_id").distinct().mapInPandas(run, "trial_id string, status string")


def flat(df: DataFrame) -> DataFrame:
    """K1: every column as text: yes or no, lists joined by |, sections as 'label: text'."""
    cols = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, BooleanType):
            c = F.when(c, "Yes").when(~c, "No")
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
            names = f.dataType.elementType.fieldNames()
            c = F.array_join(F.transform(c, lambda x, n=names: F.concat_ws(": ", *[x[k].cast("string") for k in n])), " || ")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c.cast("array<string>"), " | ")
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """K1, K6: written whole or not at all by Spark's committer."""
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def _in_order(x: Column, kind: DataType) -> Column:
    """``x`` with the keys of all its objects in order; nulls stay."""
    if isinstance(kind, StructType):
        named = sorted(kind.fields, key=lambda f: f.name)
        return F.when(x.isNotNull(), F.struct(*[_in_order(x[f.name], f.dataType).alias(f.name) for f in named])) if named else x
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda e: _in_order(e, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.transform(F.map_keys(x), lambda k: F.struct(k.alias("k"))))
        return F.map_from_arrays(F.transform(entries, lambda e: e["k"]), F.transform(entries, lambda e: _in_order(F.element_at(x, e["k"]), kind.valueType)))
    return x


def json_lines(df: DataFrame) -> DataFrame:
    """K2: value: a JSON object for each row, keys in order at every depth, nulls written as such."""
    fields = [_in_order(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """K2: one object a line."""
    json_lines(df).write.mode("overwrite").text(path)
