"""The pipeline's stages against plain Python on a small table."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm.helpers import lines, words
from tests.llm.test_operators import lines_by_hand, linked_by_hand

NAMES = ["toxicity", "line_dedup", "ngram_jaccard", "mix_sources", "best_fit_packing"]


def test_stages(spark, tmp_path):
    rows = []
    for k in range(60):
        text = lines(k, 6) + ("\n" + lines(500, 8) if k % 3 == 0 else "")
        if k % 10 == 9:
            text = "\n".join(x + " scum oaf vile" for x in text.split("\n"))
        rows.append((k, text, "en", ["a", "b", None][k % 3], len(text)))
    rows += [(60 + k, rows[k][1] + " tail", "en", "a", 1) for k in range(3)] + [(70, None, None, "b", None), (71, "", "en", "b", 0), (72, words(3, 5), "en", "b", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 0, int(k % 10 == 9)) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/out{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append([r.asDict() for r in docs.collect()])
        assert k == 4 or docs.columns == columns
    clean = {r[0] for r in rows} - {k for k in range(60) if k % 10 == 9}
    assert {r["doc_id"] for r in kept[0]} == clean
    want = lines_by_hand(sorted((r["doc_id"], r["text"]) for r in kept[0]))
    whole = {r["doc_id"]: len((r["text"] or "").split("\n")) for r in kept[0]}
    assert {r["doc_id"]: r["text"] or "" for r in kept[1]} == {k: v[0] for k, v in want.items() if v[1] < whole[k]}
    groups = linked_by_hand([(r["doc_id"], r["text"]) for r in kept[1]], 5, 80)
    assert {r["doc_id"] for r in kept[2]} == {k for k, (_, c) in groups.items() if k == c}
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in kept[2]}
    copies = Counter(r["doc_id"] for r in kept[3])
    assert set(copies) <= set(sizes) and max(copies.values()) <= 3
    taken = sum(sizes[k] * n for k, n in copies.items())
    assert abs(taken - sum(sizes.values())) <= 3 * max(sizes.values())
    placed = defaultdict(int)
    for r in kept[4]:
        placed[r["doc_id"]] += r["piece"] == 0
    assert placed == dict(copies)


def test_empty_and_null_tables(spark, tmp_path):
    for name, rows in (("none", []), ("nulls", [(None, None, None, None, None), (1, None, None, None, None), (2, "a b c", None, None, 5), (2, "a b c", None, None, 5)])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, None, None), (None, 1, 1)][: len(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert len(got) == 0 if not rows else {r["doc_id"] for r in got} <= {None, 1, 2} and got
