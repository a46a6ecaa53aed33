import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gapscope.llm import quality_pu, quality_rules
from gapscope.llm.queries import vocabulary

from .conftest import SF
from .test_mixing import brute_targets
from .test_near_dup import brute

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after every stage over a whole small table."""
    docs = spark.read.parquet(os.path.join(BIG, "documents.parquet"))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], BIG).cache())
    return out


def test_stages_are_as_dealt(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-duplicates", "mixing", "bpe"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_rules_and_classifier_keep_clean_documents(spark, steps):
    labels = spark.read.parquet(os.path.join(BIG, "labels.parquet"))
    kept = quality_rules.judge_quality(steps[0]).where("kept")
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in steps[1].collect())
    good = [df.join(labels.where("quality = 1"), "doc_id").count() for df in steps[1:3]]
    junk = steps[2].join(labels.where("quality = 0"), "doc_id").count()
    assert good[1] >= 0.98 * good[0] and junk <= 0.1 * labels.where("quality = 0").count()
    scorer, _ = quality_pu.learn(steps[1], labels)
    scored = quality_pu.score_quality(steps[1], scorer).where(F.col("score") >= 0.5)
    assert Counter(r.doc_id for r in scored.collect()) == Counter(r.doc_id for r in steps[2].collect())


def test_one_document_of_each_class_stays(steps):
    texts = {r.doc_id: r.text for r in steps[2].collect()}
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(set(brute(texts).values()))


def test_mixture(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    words = lambda r: len([w for w in (r.text or "").encode().split()])
    size, taken = Counter(), Counter()
    for r in before.values():
        size[r.source] += words(r)
    copies = Counter(r.doc_id for r in steps[4].collect())
    assert max(copies.values()) <= 2 and all(r == before[r.doc_id] for r in steps[4].collect())
    for r in steps[4].collect():
        taken[r.source] += words(r)
    longest = max(map(words, before.values()))
    for source, target in zip(sorted(size), brute_targets([size[s] for s in sorted(size)])):
        assert target - longest <= taken[source] <= target + longest


def test_tokens(steps):
    library = Tokenizer.from_file(vocabulary())
    assert Counter(r.doc_id for r in steps[5].collect()) == Counter(r.doc_id for r in steps[4].collect())
    for r in steps[5].collect():
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.decoded == r.text


def test_every_case_goes_through(spark, plain):
    docs = plain
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF)
    assert docs.columns == [*columns, "ids", "decoded"] and docs.collect() is not None
    docs = plain.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_run_is_registered(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0
