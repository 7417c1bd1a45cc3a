"""The pipeline's stages against plain versions, each on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_near_limit import brute as near_brute
from test_packing import compare as packing_compare
from test_quality_rules import verdict
from test_secrets import brute as secret_brute

from schemaflow.llm import quality_bayes, registry
from schemaflow.llm.common import stored, table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == COLUMNS and out.schema.simpleString() == docs.schema.simpleString()
        before, after = ({r.doc_id: r for r in d.collect()} for d in (docs, out))
        assert after.keys() <= before.keys() and len(after) == out.count()
        seen.append((name, before, after))
        docs = out
    (_, before, after) = seen[0]
    assert after == {i: r for i, r in before.items() if verdict(r.text or "")}
    (_, before, after) = seen[1]
    frame = spark.createDataFrame(list(before.values()), table(spark, SF, "documents").schema)
    fitted = quality_bayes.fit(frame, table(spark, SF, "labels"), F.lit(False))
    kept = {r.doc_id for r in quality_bayes.judge(frame, fitted).filter("__q.kept").collect()}
    assert after == {i: before[i] for i in kept}
    (_, before, after) = seen[2]
    rows = sorted(before.items())
    roots = near_brute([r.text for _, r in rows], corpus_pipeline.NEAR_PERCENT)
    assert corpus_pipeline.NEAR_PERCENT == 80
    assert after == {i: r for at, (i, r) in enumerate(rows) if roots[at] == at}
    (_, before, after) = seen[3]
    assert after.keys() == before.keys()
    for i, r in after.items():
        old = before[i].text
        assert not [s for s in secret_brute(r.text) if s[2] != "assign"]
        assert (r.text == old) == (not secret_brute(old)) and r.n_chars == len(r.text)
    rows = [(r.doc_id, r.text) for r in seen[3][2].values()]
    packing_compare(docs, rows)


def test_run_is_all_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "secret_scans", "best_fit_packing"
    ]
    assert registry.QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-run")
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    want = Counter(tuple(r[n] for n in names) for r in docs.collect())
    assert Counter(tuple(r[n] for n in names) for r in corpus_pipeline.run(spark, SF).collect()) == want


def test_empty_tables(spark):
    empty = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.collect() == [], name
