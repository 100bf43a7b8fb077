"""Markup files to records (S1-S10): whole files by Spark's binary source, parsed in Arrow batches by the standard library.

The parser resolves no external entities and opens no connection; a document type that declares entities is refused. A
file that can't be parsed becomes a failed record with its reason.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType


_S = StringType()
SECTION = StructType([StructField("section", _S), StructField("text", _S)])
WARNING = StructType([StructField("code", _S), StructField("message", _S)])
BLOCK = StructType([StructField("section", _S), StructField("block_type", _S), StructField("text", _S), StructField("start", LongType()), StructField("stop", LongType())])
RECORD = StructType(
    [StructField(c, _S) for c in ("record_id", "source_file", "root", "parse_status", "doi", "title", "journal", "article_type", "year", "primary_author", "presenter", "abstract_text", "raw_text")]
    + [StructField(c, ArrayType(_S)) for c in ("authors", "affiliations", "keywords", "excluded_sections")]
    + [StructField("sections", ArrayType(SECTION)), StructField("blocks", ArrayType(BLOCK)), StructField("warnings", ArrayType(WARNING))]
)
#: fixed values: headings by which a paragraph is divided
HEADINGS = ("Background", "Introduction", "Objective", "Objectives", "Aim", "Aims", "Purpose", "Methods", "Method", "Materials and Methods", "Patients and Methods", "Study Design", "Design", "Setting", "Participants", "Interventions", "Results", "Result", "Findings", "Discussion", "Conclusion", "Conclusions", "Interpretation", "Funding", "Trial Registration", "Clinical Trial Information", "Research Sponsor", "Significance")
_HEADING = re.compile(r"(?:^|(?<=[.!?]\s)|(?<=\n))\s*(" + "|".join(sorted(HEADINGS, key=len, reverse=True)) + r")\s*:\s*", re.I)
EXCLUDED = {"aff": "affiliations", "contrib-group": "authors", "ref-list": "references", "table-wrap": "tables", "author_list": "authors"}
_BLOCKS = {"p": "paragraph", "title": "heading", "label": "heading", "list-item": "list_item", "preformat": "preformatted", "disp-quote": "blockquote"}


def _name(node) -> str:
    return node.tag.rsplit("}", 1)[-1] if isinstance(node.tag, str) else ""


def _text(node, skip: dict | None = None) -> str:
    """Text in document order, without excluded subtrees."""
    if node is None:
        return ""
    parts = [node.text or ""]
    for child in node:
        if not (skip and _name(child) in skip):
            parts.append(_text(child, skip))
        parts.append(child.tail or "")
    return "".join(parts)


def squeeze(x: str | None) -> str:
    return " ".join((x or "").split())


def _all(node, *names: str) -> list:
    return [n for n in node.iter() if _name(n) in names]


def _first(node, *names: str):
    """The first node of the first name that occurs."""
    return next((n for name in names for n in node.iter() if _name(n) == name), None)


def canonical(text: str) -> str:
    """A heading as shown."""
    shown = squeeze(text).strip(":-. ").title()
    for word in ("And", "Of", "In", "On", "For", "With", "To"):
        shown = shown.replace(f" {word} ", f" {word.lower()} ")
    return shown


def divide(text: str, fallback: str = "Abstract") -> list[tuple[str, str]]:
    """A paragraph cut at its headings; neighbours of one label become one."""
    marks, out = list(_HEADING.finditer(text)), []
    head = text[: marks[0].start()] if marks else text
    if squeeze(head):
        out.append((fallback, squeeze(head)))
    for m, after in zip(marks, [*marks[1:], None], strict=True):
        out.append((canonical(m.group(1)), squeeze(text[m.end() : after.start() if after else len(text)])))
    return merged([x for x in out if x[1]])


def merged(sections: list[tuple[str, str]]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for label, text in sections:
        if out and out[-1][0] == label:
            out[-1] = (label, out[-1][1] + " " + text)
        else:
            out.append((label, text))
    return out


def sections_of(abstract, ids: set[str]) -> list[tuple[str, str]]:
    """Explicit sections, else paragraphs divided by headings, without paragraphs that are only an id."""
    if abstract is None:
        return []
    explicit = [n for n in abstract.iter() if _name(n) == "sec"]
    if explicit:
        rows = [(canonical(_text(_first(s, "title", "label"))) or "Abstract", squeeze(" ".join(_text(n, EXCLUDED) for n in s if _name(n) not in ("title", "label")))) for s in explicit]
        return merged([r for r in rows if r[1]])
    parts = [squeeze(_text(p, EXCLUDED)) for p in abstract if _name(p) in ("p", "list", "preformat")] or [squeeze(_text(abstract, EXCLUDED))]
    kept = [p for i, p in enumerate(parts) if p and not re.fullmatch(r"e\d+", p) and not (i == 0 and p in ids)]
    out: list[tuple[str, str]] = []
    for p in kept:
        out += divide(p, out[-1][0] if out else "Abstract")
    return merged(out)


def blocks_of(abstract) -> tuple[list[tuple], str]:
    """Blocks with their places in the raw text, where they are joined by blank lines; no text is lost."""
    rows, at, section, raw = [], 0, "Abstract", []
    for n in abstract.iter() if abstract is not None else ():
        kind = _BLOCKS.get(_name(n))
        if not kind:
            continue
        text = "".join(n.itertext()) if kind != "list_item" or not any(_name(c) == "p" for c in n) else ""
        if kind == "heading":
            section = canonical(text) or section
        if text.strip():
            rows.append((section, kind, text, at, at + len(text)))
            raw.append(text)
            at += len(text) + 2
    return rows, "\n\n".join(raw)


def _person(node) -> str:
    """S9."""
    get = lambda *names: squeeze(_text(_first(node, *names)))
    return squeeze(" ".join((get("prefix"), get("given-names", "first_name"), get("middle_name"), get("surname", "last_name"), get("suffix")))) or get("collab")


def _distinct(xs) -> list[str]:
    return list(dict.fromkeys(x for x in xs if x))


def _record(node, root: str, path: str, stem: str) -> dict:
    """One article of either kind; the first place that has a value gives it."""
    kinds = {n.get("pub-id-type") or n.get("custom-type") or n.get("id_type") or "": squeeze(_text(n)) for n in _all(node, "article-id", "article_id") if squeeze(_text(n))}
    doi = kinds.get("doi", "")
    record_id = next((x for x in (kinds.get("manuscript"), kinds.get("submission-id"), node.get("ms_no"), node.get("tracking_no"), kinds.get("abstract-id"), doi, stem) if x), stem)
    abstract = _first(node, "abstract")
    rows = sections_of(abstract, {record_id, *kinds.values()})
    blocks, raw = blocks_of(abstract)
    people = [n for n in _all(node, "contrib") if n.get("contrib-type", "author") == "author"] or _all(node, "author")
    authors = _distinct(_person(n) for n in people)
    speakers = [_person(n) for n in _all(node, "contrib") if n.get("contrib-type") == "presenter"]
    dates = [*_all(node, "pub-date", "copyright-year"), *_all(node, "date")]
    year = next((m.group() for n in dates if (m := re.search(r"(19|20)\d{2}", _text(n)))), "")
    title = squeeze(_text(_first(node, "article-title", "article_title")))
    words = [squeeze(_text(n)) for n in _all(node, "kwd")] + [n.get("name", "") for t in _all(node, "attr_type") if t.get("name") == "Keywords" for n in _all(t, "attribute")]
    data = {
        "record_id": record_id, "source_file": path, "root": root, "parse_status": "parsed", "doi": doi, "title": title, "journal": squeeze(_text(_first(node, "journal-title", "full_journal_title", "publisher_name"))),
        "article_type": node.get("article-type") or squeeze(_text(_first(node, "publication_type", "subject"))), "year": year, "primary_author": authors[0] if authors else "", "presenter": speakers[0] if speakers else "",
        "abstract_text": " ".join(t for _, t in rows), "raw_text": raw or squeeze(_text(abstract)), "authors": authors, "affiliations": _distinct(squeeze(_text(n)) for n in _all(node, "aff", "affiliation")),
        "keywords": _distinct(words), "excluded_sections": sorted({EXCLUDED[_name(n)] for n in node.iter() if _name(n) in EXCLUDED}), "sections": [dict(zip(("section", "text"), r, strict=True)) for r in rows],
        "blocks": [dict(zip(("section", "block_type", "text", "start", "stop"), b, strict=True)) for b in blocks],
    }
    missing = [k for k in ("doi", "title", "abstract_text", "journal", "year") if not data[k]] + (["authors"] if not authors else [])
    return data | {"warnings": [{"code": f"missing_{k}", "message": f"no {k.replace('_', ' ')}"} for k in missing]}


def _bare(path: str, stem: str, status: str, code: str, message: str, raw: str = "", root: str = "") -> dict:
    empty = {f.name: [] if isinstance(f.dataType, ArrayType) else "" for f in RECORD}
    return empty | {"record_id": stem, "source_file": path, "root": root, "parse_status": status, "raw_text": raw, "warnings": [{"code": code, "message": message}]}


def parse(path: str, content: bytes) -> list[dict]:
    """Records of one file; never raises."""
    stem = re.sub(r"\.[^.]*$", "", path.rsplit("/", 1)[-1])
    try:
        if re.search(rb"<!ENTITY", content, re.I):
            raise ET.ParseError("declares entities")
        tree = ET.fromstring(content)
    except (ET.ParseError, ValueError, LookupError) as error:
        return [_bare(path, stem, "failed", "parse_error", str(error)[:200])]
    root = _name(tree)
    if root == "article":
        out = [_record(tree, root, path, stem)]
        for k, sub in enumerate(_all(tree, "sub-article")):
            name = sub.get("id") or str(k + 1)
            out.append(_record(sub, "sub-article", f"{path}#{name}", f"{stem}#{name}"))
        return out
    if root == "article_set":
        return [_record(n, root, path, f"{stem}_{k}" if k else stem) for k, n in enumerate(n for n in tree if _name(n) == "article")] or [_bare(path, stem, "parsed", "no_article", "empty set", root=root)]
    return [_bare(path, stem, "parsed", "unexpected_root", root, squeeze(_text(tree)), root)]


def parse_files(files: DataFrame) -> DataFrame:
    """Records from (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r for path, content in zip(b["path"], b["content"], strict=True) for r in parse(path, bytes(content))]
            if rows:
                yield pd.DataFrame(rows, columns=[f.name for f in RECORD])

    return files.mapInPandas(run, RECORD)


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every *.xml file below a folder, on any file system that Spark reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).load(folder)
    return parse_files(files.select("path", "content"))


def trial_ids(*texts: Column) -> Column:
    """Registrations of one registry, in upper case, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.concat_ws(" ", *texts), F.lit(r"(?iU)\bNCT\d{8}\b"), F.lit(0)), F.upper))


def block_offsets(blocks: DataFrame) -> DataFrame:
    """S8 for given blocks (id, seq, text): places in the text that joins them by blank lines."""
    before = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 2).over(before), F.lit(0))
    return blocks.withColumn("start", start).withColumn("stop", start + F.length("text"))


def page_text(html: Column) -> Column:
    """Text of a web page: without scripts, styles, comments and tags, with the usual entities resolved."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for name, char in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


