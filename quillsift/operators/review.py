"""Model-assisted review (L1-L3, L6, L7, T20): batching, strict reading of answers, fusion of hits. The model is a client that the caller gives."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift import thresholds as H

HIT = "id string, start int, stop int, category string, matched_text string, occurrence string, status string"


def tokens_of(text: str) -> int:
    """T19 in Python."""
    return max(-(-len(text) // 3), -(-3 * len(text.split()) // 2)) + 16


def batches_of(rows: list[tuple[str, str]], budget: int = H.BATCH_TOKENS, most: int = H.BATCH_RECORDS) -> list[list[tuple[str, str]]]:
    """L1: records in order, as many to a request as its budget and size allow; one too large is alone."""
    out, used = [], 0
    for row in rows:
        n = tokens_of(row[1])
        if not out or len(out[-1]) == most or used + n > budget:
            out.append([])
            used = 0
        out[-1].append(row)
        used += n
    return out


def read_answer(text: str) -> dict | None:
    """The first JSON object of an answer, also from a fence or encoded twice; None if there is none."""
    body = re.sub(r"^\s*```[a-z]*\s*|\s*```\s*$", "", text or "")
    for _ in range(2):
        start = body.find("{") if not body.lstrip().startswith('"') else body.find('"')
        if start < 0:
            return None
        try:
            value, _end = json.JSONDecoder().raw_decode(body[start:])
        except ValueError:
            return None
        if isinstance(value, dict):
            return value
        body = value if isinstance(value, str) else ""
    return None


def accepted(answer: dict | None, batch: list[tuple[str, str]]) -> list[tuple] | None:
    """L2: hits of an answer that names exactly the batch's records and quotes text that each has once; None refuses it."""
    texts = dict(batch)
    rows = (answer or {}).get("records")
    if not isinstance(rows, list) or sorted(str(r.get("id")) for r in rows if isinstance(r, dict)) != sorted(texts):
        return None
    out = []
    for r in rows:
        for hit in r.get("hits", []):
            quote, source = hit.get("text"), texts[r["id"]]
            if not quote or not hit.get("category") or source.count(quote) != 1:
                return None
            start = source.index(quote)
            name = hashlib.sha256(f"{r['id']}\0{start}\0{quote}\0{hit['category']}".encode()).hexdigest()[:16]
            out.append((r["id"], start, start + len(quote), hit["category"], quote, name, "candidate"))
    return out


def discover(records: DataFrame, client: Callable[[], Callable[[list[tuple[str, str]]], str]], budget: int = H.BATCH_TOKENS) -> DataFrame:
    """L1: hits of a model in (id, text): requests are tried again, then halved; a record that fails alone gets a row that says so."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()

        def solve(batch: list[tuple[str, str]]) -> list[tuple]:
            if tokens_of(" ".join(t for _, t in batch)) <= budget or len(batch) > 1:
                for _ in range(H.BATCH_ATTEMPTS):
                    try:
                        if (got := accepted(read_answer(ask(batch)), batch)) is not None:
                            return got
                    except Exception:  # noqa: BLE001  a failed request is tried again
                        continue
            if len(batch) == 1:
                return [(batch[0][0], None, None, None, None, None, "validation_failed")]
            half = len(batch) // 2
            return solve(batch[:half]) + solve(batch[half:])

        for b in batches:
            rows = [(str(i), t or "") for i, t in zip(b["id"], b["text"], strict=True)]
            out = [h for part in batches_of(rows, budget) for h in solve(part)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in HIT.split(", ")]).astype({"start": "Int32", "stop": "Int32"})

    return records.select("id", "text").mapInPandas(run, HIT)


def _preference(hit) -> tuple:
    return {"known": 0, "semantic": 1, "novel": 2}.get(hit.source, 3), -hit.confidence, getattr(hit, "rule_id", None) or "", hit.category


def _renamed(hit, known) -> bool:
    """Whether a hit is a strong known one under another category: they overlap, and what lies outside has no letter or digit."""
    if hit.category == known.category or not (hit.start < known.stop and known.start < hit.stop):
        return False
    text, lo, hi = getattr(hit, "matched_text", None) or "", max(hit.start, known.start) - hit.start, min(hit.stop, known.stop) - hit.start
    return not any(c.isalnum() for c in text[:lo] + text[hi:])


def fuse(hits: DataFrame) -> DataFrame:
    """L3: of hits (id, section, block, category, start, stop, source, confidence) that overlap in one block and category the preferred
    stays: known, then semantic, then novel; the surer; the first by rule. With signal_level, hits that no rule knows go where they only
    rename a strong known one (matched_text tells what they add). Sections are the same whatever their case."""
    schema = hits.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [c for c in ("start", "stop", "category", "rule_id") if c in pdf.columns]
        rows = list(pdf.sort_values(keys, kind="stable").itertuples())
        strong = [r for r in rows if r.source == "known" and getattr(r, "signal_level", None) == "strong"]
        kept: list = []
        for r in rows:
            if r.source != "known" and any(_renamed(r, k) for k in strong):
                continue
            met = [n for n, k in enumerate(kept) if k.category == r.category and k.start < r.stop and r.start < k.stop]
            best = min(met, key=lambda n: _preference(kept[n]), default=None)
            if best is None:
                kept.append(r)
            elif _preference(r) < _preference(kept[best]):
                kept[best] = r
        return pdf.loc[sorted(r.Index for r in kept)]

    return hits.groupBy("id", F.lower("section").alias("_section"), "block").applyInPandas(run, schema)


def validated(findings: DataFrame, results: DataFrame) -> DataFrame:
    """Findings with the status that a validator (finding_id, verdict) gave; without an answer they stay as they are."""
    new = F.when(F.col("verdict") == "yes", "confirmed").when(F.col("verdict") == "no", "rejected").when(F.col("verdict") == "unsure", "uncertain").when(F.col("verdict").isNotNull(), "validation_failed")
    return findings.join(results, "finding_id", "left").withColumn("status", F.coalesce(new, "status")).drop("verdict")


def cached_answers(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with answers kept under the hash of model and content; null where there is none yet."""
    return requests.withColumn("key", request_key(F.col("model"), F.col("content"))).join(cache, "key", "left")


def request_key(model: Column, content: Column) -> Column:
    return F.sha2(F.concat_ws("\u0000", model, content), 256)
