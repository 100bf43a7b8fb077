"""Sentence splitters that need state (T4, T6), as plain Python for use inside Arrow batches."""

from __future__ import annotations

import re

_ABBREVIATIONS = {"dr", "mr", "mrs", "ms", "prof", "vs", "e.g", "i.e", "etc", "al", "fig", "no", "st", "approx", "ca", "cf", "jr", "sr", "inc", "dept"}
_END = re.compile(r"[.!?]+[\"'”’)\]]*(?=\s|$)")


def split(text: str | None) -> list[str]:
    """T4: sentences of squeezed text; abbreviations, initials and decimals do not end one."""
    text, out, start = " ".join((text or "").split()), [], 0
    for m in _END.finditer(text):
        word = text[start : m.start()].rsplit(" ", 1)[-1].lstrip("([\"'“").lower()
        after = text[m.end() :].lstrip()
        if m.group().startswith(".") and len(m.group()) == 1 and (word in _ABBREVIATIONS or re.fullmatch(r"[a-z](\.[a-z])*", word) or (after and (after[0].islower() or after[0] in ",;:"))):
            continue
        out.append(text[start : m.end()].strip())
        start = m.end()
    if text[start:].strip():
        out.append(text[start:].strip())
    return out


def spans(text: str) -> list[tuple[int, int]]:
    """(start, stop) of sentences; an end inside an open quotation counts only with its closing mark."""
    out, start, quoted = [], 0, False
    for m in re.finditer(r"[“”\"]|[.!?]+[”\"]?(?=\s|$)|\n{2,}", text):
        mark = m.group()
        if mark in "“”\"":
            quoted = mark == "“" or (mark == '"' and not quoted)
            continue
        closing = mark[-1] in "”\""
        if closing:
            quoted = False
        if not quoted:
            out.append((start, m.end()))
            start = m.end()
    out.append((start, len(text)))
    trimmed = ((a + len(text[a:b]) - len(text[a:b].lstrip()), b - (len(text[a:b]) - len(text[a:b].rstrip()))) for a, b in out)
    return [(a, b) for a, b in trimmed if a < b]
