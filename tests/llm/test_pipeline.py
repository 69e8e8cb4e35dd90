import importlib.util

import corpus_pipeline
from pathweave.llm import pii, rule_quality
from tests.llm import test_line_dedup, test_packing, test_similar_docs
from tests.llm.helpers import SF, table


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, "documents")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        out.write.parquet(path := f"{tmp_path}/{n}")
        out, before = spark.read.parquet(path), [(r.doc_id, r.text) for r in docs.collect()]
        rows = out.collect()
        if name == "quality":
            model = rule_quality.learn(docs, table(spark, "labels"))
            good = {r.doc_id for r in rule_quality.score(docs, model).collect() if r.predicted}
            assert {r.doc_id for r in rows} == good
        elif name == "lines":
            want = {d: t for d, t, _, _ in test_line_dedup.brute(before)}
            assert {r.doc_id for r in rows} == set(want)
            assert sum(r.text != want[r.doc_id] for r in rows) <= 0.01 * len(rows)
        elif name == "near duplicates":
            kept, _ = test_similar_docs.brute(before)
            assert sorted(r.doc_id for r in rows) == kept
        elif name == "personal data":
            same = {r.doc_id: r.text for r in pii.pseudonymise(docs, corpus_pipeline.KEY).collect()}
            assert {r.doc_id: r.text for r in rows} == same
        else:
            assert test_packing.check(rows, dict(before)) < 0.1
        docs = out


def test_odd_rows_and_clashing_names(spark):
    schema = "doc_id long, text string, _id long, _hash string, _of long, document string, n_chars long, n_lines int, kinds string"
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text), (2, text), (3, None), (None, "alone in here\nmail to someone@example.org now"), (4, ""), (5, "w " * 200_000)]
    docs = spark.createDataFrame([(i, t, 7, "h", 8, "d", -1, 9, "k") for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        for table_ in (docs, docs.limit(0)):
            out = stage(spark, table_, SF)
            assert out.dtypes == docs.dtypes, name
            got = out.collect()
            assert all(tuple(r)[2:6] + tuple(r)[7:] == (7, "h", 8, "d", 9, "k") for r in got), name
            if table_ is docs:
                ids = sorted(r.doc_id or 0 for r in got)
                assert ids == ([0, 1, 3, 5] if name == "near duplicates" else [0, 1, 2, 2, 3, 4, 5]), name
                assert all(r.n_chars in (len(r.text or ""), -1) for r in got), name


def test_registered_as_a_query():
    import __spark_entry__

    assert importlib.util.find_spec("corpus_pipeline")
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
