from __future__ import annotations

import os
import subprocess
import sys

sys.path.insert(0, os.path.dirname(__file__))

from helpers import ODD, rows_of  # noqa: E402
from test_text_rules import components, plain_fingerprint, plain_hits, plain_repetition  # noqa: E402

import corpus_pipeline  # noqa: E402
from rankforge.llm import queries  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_against_plain_versions(spark, small_dir):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{small_dir}/benchmark.parquet'").fetchall()
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, texts = docs.columns, dict(rows_of(small_dir))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = spark.createDataFrame(stage(spark, docs, small_dir).collect(), docs.schema)
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        assert all(texts[d] == t for d, t in after.items())
        if name == "quality rules":
            want = {d for d, t in before.items() if len(t) > 6000 and d in after or len(t) <= 6000 and plain_repetition(t)[-1]}
        elif name == "near-duplicates":
            found = components([(d, plain_fingerprint(t)) for d, t in before.items()], 2)
            want = {d for (d, _), c in found.items() if d == c}
        elif name == "decontamination":
            want = {d for d, t in before.items() if not plain_hits(t, items)[1]}
        else:
            labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{small_dir}/labels.parquet'").fetchall())
            want = after.keys()
            clean = [d for d in before if labels.get(d) == 0]
            assert sum(d in after for d in clean) >= 0.98 * len(clean)
        assert after.keys() == set(want), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).collect()
    assert {r.doc_id for r in packed} == after.keys()
    ran = queries.pipeline(spark, small_dir).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(ran) == key(packed)


def test_stages_on_odd_rows(spark, small_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, x, "s", None) for i, t, x in ODD], schema)
    for docs_ in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs_, small_dir)
            assert out.schema.simpleString() == docs.schema.simpleString()
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs_, small_dir).collect()


def test_stages_keep_every_column_of_the_caller(spark, small_dir):
    """Columns named as the stages name their own, in any case, come out as they went in."""
    names = ["repetition", "TOXICITY", "Contamination", "key", "KEPT_ID", "_kept_key", "__score", "__repetition", "__key", "__found", "fp", "group", "score"]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs.doc_id * 100 + k)
    for stage, run in corpus_pipeline.STAGES[:-1]:
        out = run(spark, docs, small_dir)
        assert out.columns == docs.columns, stage
        rows = out.drop("text").collect()
        assert rows and all(r[name] == r.doc_id * 100 + k for r in rows for k, name in enumerate(names)), stage


def test_the_rest_works_without_this_part(tmp_path):
    """As if the subpackage and the pipeline were not there."""
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('rankforge.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "q, s = e.queries(), e.oracle_sql()\n"
        "assert 'flagship_knn_top10' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op') and '_' in n and n[2].isdigit()]\n"
        "assert set(s) <= set(q)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_all_operators_and_the_pipeline_are_registered():
    import re

    from __spark_entry__ import oracle_sql
    from __spark_entry__ import queries as registered

    own = [n for n in registered() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in own) == [*range(1, 14)] and "pipeline" in registered()
    assert {"op4_zip_warc", "op7_url_rules", "op11_importance_resampling", "op12_fair_queueing", "op13_suffix_collocations"} <= oracle_sql().keys()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "near-duplicates", "decontamination", "packing"]
