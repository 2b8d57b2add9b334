"""The stages of the pipeline on documents, and what is left when the subpackage goes."""

import os
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from siltbed.llm import op7_quality_rules as op7
from siltbed.llm.common import written

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and stored output of every stage, over documents and the awkward rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(COLUMNS)
    docs = docs.unionByName(brute.awkward(spark).select(COLUMNS))
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SF_DIR), "test-stage"))
    return found


def rows(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


def test_stages_keep_the_columns(stages):
    assert [df.columns for df in stages[:-1]] == [COLUMNS] * 5


def test_rules_reject_what_fails(stages):
    def passes(text):
        m = dict(zip(op7.MEASURES, op7.measure_text((text or "").encode())))
        return not any(eval(r.fails.replace("AND", "and"), {}, m) for r in op7.RULES)

    assert Counter(rows(stages[1])) == Counter(r for r in rows(stages[0]) if passes(r[1]))


def test_one_row_per_text_stays(stages):
    texts = defaultdict(list)
    for r in rows(stages[1]):
        texts[r[1]].append(r)
    kept = rows(stages[2])
    assert sorted(r[1] for r in kept) == sorted(texts)
    assert all(r[0] == max((x[0] for x in texts[r[1]]), key=lambda i: (i is not None, i)) for r in kept)


def test_one_row_per_near_group_stays(stages):
    before = rows(stages[2])
    found = brute.near_components([r[:2] for r in before])
    groups = {row: number for row, (_, _, number) in zip(before, found)}
    ids = {number: id_ for _, id_, number in found}
    kept = rows(stages[3])
    assert sorted(groups[r] for r in kept) == sorted(set(groups.values()))
    assert all(r[0] == ids[groups[r]] for r in kept)


def test_mix_meets_its_targets(stages):
    before, after = rows(stages[3]), rows(stages[4])
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r[3]] += len(brute.words(r[1]))
    for r in after:
        taken[r[3]] += len(brute.words(r[1]))
        assert r[4] == len(r[1])
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 1
    whole = {r[:2] for r in before}
    cut = [r for r in after if r[:2] not in whole]
    assert len(cut) <= len(sizes)


def test_packing_covers_every_row(stages):
    from siltbed.llm.op3_packing import encoder

    encode = encoder()
    expected = Counter((r[0], len(encode((r[1] or "").encode())) + 1) for r in rows(stages[4]))
    pieces = stages[5].groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert {(r["doc_id"], r["doc_tokens"]): r["n"] for r in pieces} == {k: k[1] * n for k, n in expected.items()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_the_rest_works_without_the_subpackage(tmp_path):
    repo = Path(corpus_pipeline.__file__).parent
    for name in ("siltbed", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(repo / name) if name.endswith(".py") else None
    (tmp_path / "siltbed").mkdir()
    for part in (repo / "siltbed").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "siltbed" / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((repo / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, pipeline, known = done.stdout.split()
    assert int(count) > 70 and pipeline == "False" and known == "True"
