import zlib

import numpy as np

from pathweave.llm import rule_quality
from tests.llm.helpers import docs, table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    df, labels = table(spark, "documents", SF), table(spark, "labels", SF)
    rows = rule_quality.classify(df, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99


def test_rules_compile_to_what_they_mean(spark):
    df = table(spark, "documents")
    x = rule_quality.with_statistics(df.select("doc_id", rule_quality._text())).select("doc_id", "_stats.*").toPandas().set_index("doc_id")
    random = np.random.default_rng(3)
    values = x[list(rule_quality.FEATURES)].to_numpy()
    model = rule_quality.fit(values, (values[:, 3] + 0.01 * random.random(len(x)) < 0.01).astype(float))
    assert model.rules
    margin = model.intercept + sum(w * r.values(values) for r, w in model.rules)
    got = {r.doc_id: r.score for r in rule_quality.score(df, model).collect()}
    assert np.allclose([got[i] for i in x.index], 1 / (1 + np.exp(-margin)))


def test_odd_rows_labels_and_tables(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "x"), (3, "x"), (4, "word " * 100_000), (5, "\n")]
    df = docs(spark, [(*r, 0.5, 3) for r in rows], "score double, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (2, None), (3, 0), (3, 1), (None, 1), (77, 0)], "doc_id long, quality int")
    for labels in (none, some):
        got = rule_quality.classify(df, labels).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert rule_quality.classify(docs(spark, []), labels).collect() == []
    assert all(r.score == 0.5 for r in rule_quality.classify(df, none).collect())
    kept = rule_quality.keep_good(df, none)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
