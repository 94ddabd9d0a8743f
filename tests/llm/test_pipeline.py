"""The stages of the pipeline on the smallest tables, each against a plain version on its own input."""

from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from hexmart.llm import quality
from hexmart.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.conftest import SF


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{number}")
        after = docs.collect()
        if number < 4:
            assert docs.columns == columns, name
        texts = {r.doc_id: r.text for r in before}
        if number == 0:
            scored = quality.classify(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{SF}/labels.parquet")).collect()
            assert {r.doc_id for r in after} == {r.doc_id for r in scored if r.predicted}
        if number == 1:
            assert {r.doc_id for r in after} == {d for d, v in brute.near_components(texts.items(), 5, 80).items() if v[2]}
        if number == 2:
            want = {d: n - k for d, n, k, _ in brute.repeated_words(texts.items(), 50)}
            assert {r.doc_id: len(brute.tokens(r.text)) for r in after} == want
        if number == 3:
            assert max(Counter(r.doc_id for r in after).values()) <= 3 and {(r.doc_id, r.text) for r in after} <= set(texts.items())
        if number == 4:
            assert sum(r.length for r in after) == sum(len(brute.tokens(r.text)) for r in before)
            size = Counter()
            for r in after:
                size[r.bin_id] += r.length
            assert max(size.values()) <= 2048
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)
