"""The pipeline's stages on the test tables, each against brute force or its own rule, and the entry."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from terrace.llm.common import staged, table

from ..conftest import SF001
from .helpers import words
from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute as brute_groups

ROOT = Path(__file__).parents[2]


def test_stages_in_order(spark):
    import corpus_pipeline

    docs = table(spark, SF001, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"] and corpus_pipeline.ORACLE_SQL is None
    columns, result = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF001), f"test-{name}")
        assert out.columns[: len(columns)] == columns and (out.columns == columns or name == "mixing")
        result[name] = (docs.collect(), out.collect())
        docs = out

    before, after = result["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF001, "labels").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert sum(labels.get(i) == 0 for i in gone) <= 1

    before, after = result["line_dedup"]
    expected = brute_lines([(r["doc_id"], r["text"], r["source"]) for r in before])
    assert {r["doc_id"]: r["text"] for r in after} == {
        r["doc_id"]: expected[r["doc_id"]] for r in before if words(expected[r["doc_id"]]) or expected[r["doc_id"]] == r["text"]
    }

    before, after = result["near_dedup"]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before], 5)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, (_, c) in groups.items() if i == c)

    before, after = result["decontamination"]
    items = [" ".join(words(r["text"].lower())) for r in table(spark, SF001, "benchmark").collect()]
    kept = {r["doc_id"] for r in after}
    for r in before:
        text = " ".join(words(r["text"].lower()))
        if any(i in text for i in items):
            assert r["doc_id"] not in kept

    before, after = result["mixing"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += len(words(r["text"]))
    for r in after:
        assert 0 < r["mix_words"] <= 2 * len(words(r["text"]))
        taken[r["source"]] += r["mix_words"]
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 0.03 * sum(sizes.values())


def test_run_equals_the_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF001)
    assert out.filter(F.col("mix_words").isNull()).count() == 0 and out.count() > 50


def test_entry_without_the_subpackage(tmp_path):
    """With both folders and the pipeline gone, the entry imports and lists the other queries."""
    code = f"""
import shutil, sys
shutil.copytree({str(ROOT)!r}, {str(tmp_path / "repo")!r}, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
sys.path.insert(0, {str(tmp_path / "repo")!r})
import __spark_entry__ as e
names = set(e.queries())
assert "fact_sales" in names and not any(n.startswith("op") or n == "pipeline" for n in names - {{"ordered_vs_billed"}}), names
assert set(e.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
