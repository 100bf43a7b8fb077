"""From raw documents to packed training sequences: toxicity, line dedup, near duplicates, mixing, packing.

Every stage takes the rows that its predecessor kept, and its decisions take effect: toxic documents go, repeated line chunks
are cut out of texts (what loses all lines goes), one document of each near-duplicate group stays, a source's documents come as often as its target
asks for, and what is left is packed. Counted as part of the subpackage ``quillsift.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm import jaccard, lines, mixing, packing, toxicity
from quillsift.llm.tokens import vocabulary
from quillsift.scratch import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the severity cut; the model is fitted from ``labels``."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep_toxic=False).select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line chunks that occurred before; n_chars follows the text. One that loses all its lines goes."""
    cut = lines.line_dedup(docs).where("line__n_removed < line__n_lines")
    n_chars = F.when(F.col("line__n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars")
    return cut.select(*[n_chars if c == "n_chars" else c for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document of least doc_id."""
    found = jaccard.jaccard_join(docs, 5, 80)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' targets ask for."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, placed in sequences of 2048."""
    return packing.best_fit_packing(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_lines),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Models, hashed draws and tokenizers: not SQL. tests/llm/test_pipeline.py holds it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage's result being a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
