"""The pipeline's stages, each on its own input, and without the optional part."""

import os
import subprocess
import sys

import corpus_pipeline
import numpy as np
from test_dedup import near_by_force
from test_text import windows_by_force

from docindex.llm import exact_dedup, quality
from docindex.workspace import materialise

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, documents):
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES
    scores = {r.doc_id: r.predicted for r in quality.quality(documents, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = materialise(first(spark, documents, SF), "t")
    assert sorted(pairs(good)) == sorted((i, t) for i, t in pairs(documents) if scores[i])

    single = materialise(second(spark, good, SF), "t")
    best = {}
    for i, t in pairs(good):
        best.setdefault((t or "").encode().translate(None, exact_dedup.BLANK), []).append((-len(t or ""), i))
    assert sorted(r.doc_id for r in single.collect()) == sorted(min(b)[1] for b in best.values())

    apart = materialise(third(spark, single, SF), "t")
    gone = {i for group in near_by_force(pairs(single)) for i in group[1:]}
    assert sorted(r.doc_id for r in apart.collect()) == sorted(i for i, _ in pairs(single) if i not in gone)

    clean = materialise(fourth(spark, apart, SF), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {row[0] for row in windows_by_force(pairs(apart), items) if row[5]}
    assert bad and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in pairs(apart) if i not in bad)

    for df in (good, single, apart, clean):
        assert df.columns == documents.columns
    rows = last(spark, clean, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in pairs(clean)) and all(r.exact for r in rows)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows))
    assert np.all([r.n_bytes > 0 for r in rows])


def test_odd_and_empty_rows(spark, edges, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0
        edges = materialise(stage(spark, edges, SF), "t")
    assert edges.count() > 5


def test_the_rest_works_without_this_part(tmp_path):
    for name in ("docindex", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name)
    os.unlink(tmp_path / "docindex")
    os.mkdir(tmp_path / "docindex")
    for name in os.listdir(os.path.join(ROOT, "docindex")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "docindex", name), tmp_path / "docindex" / name)
    os.unlink(tmp_path / "__spark_entry__.py")
    with open(os.path.join(ROOT, "__spark_entry__.py")) as source, open(tmp_path / "__spark_entry__.py", "w") as copy:
        copy.write(source.read())
    code = "import __spark_entry__ as e; n = set(e.queries()); assert 'facet_terms' in n and 'pipeline' not in n and not any(x.startswith('op') for x in n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
