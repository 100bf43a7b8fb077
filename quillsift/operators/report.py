"""Reports (K3-K5, A17-A22): nested documents and review tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.functions.text import doi
from quillsift.operators.evidence import rank
from quillsift.operators.risk import gated_level

SCHEMA_VERSION = "1.0"


def _items(df: DataFrame, key: str, name: str) -> DataFrame:
    """One array of structs a key, in the order of their columns."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != key]))).alias(name))


def abstract_reports(rolled: DataFrame, findings: DataFrame, pairs: DataFrame) -> DataFrame:
    """K3: one JSON text a record: its risk, findings and pairs."""
    sides = pairs.select(F.col("a").alias("id"), F.col("b").alias("other"), "pair_class", "priority").unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other"), "pair_class", "priority"))
    met = rolled.join(_items(findings, "id", "findings"), "id", "left").join(_items(sides, "id", "pairs"), "id", "left")
    return met.select("id", F.to_json(F.struct(F.lit(SCHEMA_VERSION).alias("schema"), *[c for c in met.columns])).alias("report"))


def summary_report(rolled: DataFrame, pairs: DataFrame, families: DataFrame, issues: DataFrame) -> DataFrame:
    """K3: the run's counts as one JSON text."""
    counts = rolled.agg(F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("risk") == r).alias(r.lower()) for r in ("High", "Medium", "Low", "None")])
    n = pairs.agg(F.count_if("priority <> 'None'").alias("pairs")).crossJoin(families.agg(F.countDistinct("family").alias("families"))).crossJoin(issues.agg(F.count(F.lit(1)).alias("issues")))  # single rows
    return counts.crossJoin(n).select(F.to_json(F.struct(F.lit(SCHEMA_VERSION).alias("schema"), "*")).alias("report"))


def integration(records: DataFrame, checks: DataFrame) -> DataFrame:
    """K4: (key, report) of records (id, doi, title) and checks (id, check_name, level, comment, failed); a key that comes twice is an error."""
    key = F.coalesce(F.nullif(doi(F.col("doi")), F.lit("")), F.col("id").cast("string"))
    level = gated_level(F.col("level"), F.col("failed"))
    items = checks.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("check_name", F.struct(level.alias("level"), "comment").alias("result")))).alias("checks"))
    named = records.withColumn("key", key).join(items, "id", "left")
    once = F.count(F.lit(1)).over(Window.partitionBy("key"))
    body = F.to_json(F.struct(F.col("id").cast("string").alias("abstract_id"), "title", "checks"))
    return named.withColumn("n", once).select("key", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("key comes twice: "), "key"))).otherwise(body).alias("report"))


def triage_tables(rolled: DataFrame, findings: DataFrame) -> dict[str, DataFrame]:
    """K5: the workbook's sheets, each as a table."""
    queue = lambda r: rolled.where(F.col("risk") == r).orderBy(F.desc("n_active"), "id")
    return {
        "dashboard": rolled.groupBy("risk").count(), "high_risk": queue("High"), "moderate_risk": queue("Medium"), "low_risk": queue("Low"), "all_abstracts": rolled.orderBy("id"),
        "check_detail": findings.orderBy("id", "check_type"),
        "how_this_works": rolled.sparkSession.createDataFrame([("High", "two kinds of active findings, or one of high severity"), ("Medium", "medium severity, several low ones, or a template family"), ("Low", "one low finding"), ("None", "nothing active")], "risk string, meaning string"),
    }


def search(rows: DataFrame, needle: str = "", risk: str | None = None, fields: tuple[str, ...] = ("id", "title", "authors", "why")) -> DataFrame:
    """Rows of a risk whose fields contain a text, whatever its case."""
    out = rows.where(F.col("risk") == risk) if risk else rows
    hit = F.lit(False)
    for f in fields:
        if f in rows.columns:
            hit = hit | F.contains(F.lower(F.col(f).cast("string")), F.lit(needle.strip().lower()))
    return out.where(hit) if needle.strip() else out


REPORT = "struct<abstract_id:string,title:string,checks:array<struct<check_name:string,result:struct<level:string,comment:string>>>>"


def report_rows(reports: DataFrame) -> DataFrame:
    """A row for each check of keyed reports (key, report)."""
    return reports.select("key", F.from_json("report", REPORT).alias("r")).select("key", F.col("r.abstract_id").alias("abstract_id"), F.col("r.title").alias("title"), F.explode_outer("r.checks").alias("c")).select("key", "abstract_id", "title", F.col("c.check_name").alias("check_name"), F.upper("c.result.level").alias("level"), F.col("c.result.comment").alias("comment"))


def validation_rows(findings: DataFrame) -> DataFrame:
    """Findings that someone or something has validated."""
    return findings.where("validated_by is not null and trim(validated_by) <> ''").select("id", "check_type", "finding_type", "validated_by", "status")


def merged_reports(content: DataFrame, authorship: DataFrame) -> DataFrame:
    """Both reports' levels (abstract_id, level, reason) by abstract, from either side, with distinct reasons."""
    side = lambda df, s: df.groupBy("abstract_id").agg(F.max(rank(("LOW", "MEDIUM", "HIGH"), F.upper("level"))).alias(f"{s}_rank"), F.collect_set("reason").alias(f"{s}_reasons"))
    met = side(content, "content").join(side(authorship, "author"), "abstract_id", "full")
    none = F.array().cast("array<string>")
    reasons = F.array_join(F.array_sort(F.array_union(F.coalesce("content_reasons", none), F.coalesce("author_reasons", none))), " | ")
    word = lambda c: F.when(F.col(c) == 2, "HIGH").when(F.col(c) == 1, "MEDIUM").when(F.col(c) == 0, "LOW").otherwise("UNKNOWN")
    return met.select("abstract_id", word("content_rank").alias("content_level"), word("author_rank").alias("authorship_level"), reasons.alias("reasons"))


def authorship_summary(rows: DataFrame) -> DataFrame:
    """Per abstract the highest risk and how many checks have each level."""
    level = F.upper("level")
    top = F.max(rank(("LOW", "MEDIUM", "HIGH"), level))
    return rows.groupBy("abstract_id").agg(F.when(top == 2, "High").when(top == 1, "Medium").when(top == 0, "Low").otherwise("Unknown").alias("risk"), *[F.count_if(level == x).alias(x.lower()) for x in ("HIGH", "MEDIUM", "LOW")])


def manifest(files: DataFrame) -> Column:
    """A hash of (path, content) of all files, in order."""
    return F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat_ws(":", "path", F.sha2(F.col("content"), 256))))), 256)


def run_metadata(files: DataFrame, values: dict[str, object]) -> DataFrame:
    """Name and value of what a run was made of."""
    spark = files.sparkSession
    given = spark.createDataFrame([(k, str(v)) for k, v in sorted(values.items())] or [("", "")], "name string, value string").where("name <> ''")
    return given.unionByName(files.agg(manifest(files).alias("value")).select(F.lit("input_manifest").alias("name"), "value"))
