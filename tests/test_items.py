"""The item view: what its join with the labels carries."""

import pyarrow as pa
import pyarrow.parquet as pq

from newsloom.sources.items import items


def joined_columns(node):
    """Names of the columns of the documents' side of the plan's joins."""
    sides = [node.children().apply(0)] if node.nodeName() == "Join" else []
    below = [node.children().apply(k) for k in range(node.children().size())]
    return [s.output().apply(k).name() for s in sides for k in range(s.output().size())] + [c for b in below for c in joined_columns(b)]


def test_no_text_meets_the_labels(spark, tmp_path):
    """Titles are cut before the join, so a shuffle for it carries no whole text; scores come from the labels as before."""
    docs = {"doc_id": [0, 1, None], "text": ["one\n" + "long " * 50, "two", None], "lang": ["en", "es", "de"], "source": ["src0", "src1", "src1"], "n_chars": [254, 3, 0]}
    pq.write_table(pa.table(docs), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [1, 1, None], "quality": [1, 1, 1], "toxic": [0, 0, 0]}), tmp_path / "labels.parquet")
    short = items(spark, str(tmp_path), desc=False)
    names = joined_columns(short._jdf.queryExecution().optimizedPlan())
    assert "pos" in names and "text" not in names
    rows = {r["pos"]: r for r in items(spark, str(tmp_path)).collect()}
    assert {k: (r["title"], r["title_en"], r["desc"], r["score"]) for k, r in rows.items() if k is not None} == {0: ("one", None, docs["text"][0], None), 1: ("two", "TWO", "two", (7, 5, 3))}
    assert len(rows) == 3 and rows[None]["score"] is None
    assert short.columns == [c for c in items(spark, str(tmp_path)).columns if c != "desc"]
