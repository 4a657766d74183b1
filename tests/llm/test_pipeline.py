from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import twice
from kinloom.llm import decontaminate, quality_ratio
from test_operators import check_mix


def test_pipeline_equals_brute_force(spark, sf, texts):
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    known = brute.ratios(texts, good)
    left = [(i, t) for i, t in texts if brute.verdict(t, known, quality_ratio.THRESHOLD)]
    groups = brute.jaccard_groups(left, 5, 80)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    for item in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        own = decontaminate.bare_words(item.text.encode())
        left = [(i, t) for i, t in left if decontaminate.align(own, decontaminate.bare_words(t.encode()))[0] < 0.6 * 2 * len(own)]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in left} and len(rows) == len(left)
    check_mix(rows, 40)
    clean = {i: len(brute.words(t)) for i, t in left if not brute.secrets(t)[4]}
    assert {r.doc_id: r.size for r in rows if r.doc_id in clean} == clean


def test_stages_keep_columns_and_bear_odd_rows(spark, sf, odd, none):
    for given in (odd, twice(odd), none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, sf)
            assert out.columns == given.columns, name
            assert out.count() <= given.count()
    kept = corpus_pipeline.near_copies(spark, twice(odd), sf)
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert ids == [1, 3, 3, 4, 4, 5, 5, 6, 7, 8, 10, 11, 12, 14]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "mixing sources to target weights"]
    assert corpus_pipeline.mix(spark, none, sf).count() == 0


def test_a_planted_secret_is_masked(spark, sf, odd):
    masked = corpus_pipeline.secrets(spark, odd, sf)
    assert masked.where(F.col("text").contains("AKIA")).count() == 0
