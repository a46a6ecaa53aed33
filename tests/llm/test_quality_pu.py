import math

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import quality_pu
from gapscope.llm.common import held_out
from gapscope.llm.queries import op1_quality_pu

BIG = "/root/testdata/sf0.01"


def auc(label, score):
    label, score = np.array(label), np.array(score)
    wins = (score[label == 1][:, None] > score[label == 0]).mean()
    return wins + 0.5 * (score[label == 1][:, None] == score[label == 0]).mean()


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(6)
    for share in (0.3, 0.7, 0.95):
        n = 5000
        positive = rng.normal(2, 1, n)
        unlabelled = np.where(rng.random(n) < share, rng.normal(2, 1, n), rng.normal(-3, 1, n))
        assert share - 0.05 < quality_pu.estimate_prior(positive, unlabelled) < share + 0.12


def test_prior_is_of_all_documents(docs, labels, monkeypatch):
    """Beyond the sample, every document outside the held-out fold counts for the prior, but those trained on."""
    seen = []
    bound = quality_pu.prior_bound
    monkeypatch.setattr(quality_pu, "prior_bound", lambda p, cuts, passed, n: seen.append((cuts, passed, n)) or bound(p, cuts, passed, n))
    quality_pu.learn(docs, labels, unlabelled=20)
    free = docs.where(F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1)).count()
    (cuts, passed, n), = seen
    assert n == free - 10 and len(cuts) == len(passed) and (np.diff(passed) <= 0).all() and 20 < passed[0] <= n


def test_counts_are_those_of_the_margins(docs):
    rng = np.random.default_rng(8)
    dim = quality_pu.BUCKETS + quality_pu.N_SHAPE
    scorer = quality_pu.Scorer(rng.normal(0, 1, dim), 0.1, np.zeros(dim), np.ones(dim))
    margins = scorer.margin(np.array([quality_pu.features(r.text) for r in docs.select("text").collect()]))
    cuts = np.quantile(margins, [0.05, 0.33, 0.5, 0.9]) + 1e-7
    passed, n = quality_pu.count_reaching(docs, "text", scorer, cuts)
    assert n == len(margins) and passed.tolist() == quality_pu.reaching(margins, cuts).tolist()


def test_risk_is_learned_without_negatives():
    rng = np.random.default_rng(7)
    dim = quality_pu.BUCKETS + quality_pu.N_SHAPE
    good = lambda n: rng.normal(0, 1, (n, dim)) * (np.arange(dim) >= quality_pu.BUCKETS)
    bad = good(1000)
    bad[:, quality_pu.BUCKETS] -= 8
    scorer, prior = quality_pu.train(good(3000), np.concatenate([good(3000), bad]))
    assert 0.74 < prior < 0.9
    test, worse = good(300), good(300)
    worse[:, quality_pu.BUCKETS] -= 8
    assert (scorer.margin(test) > 0).mean() > 0.95
    assert (scorer.margin(test)[:, None] > scorer.margin(worse)).mean() > 0.99


def test_held_out_accuracy_of_the_query(spark):
    rows = op1_quality_pu(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert auc([r.quality for r in held], [r.score for r in held]) > 0.97
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_the_held_out_fold_and_zeros_change_nothing(docs, labels):
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).where((F.col("quality") == 1) | held)
    (a, p), (b, q) = quality_pu.learn(docs, labels), quality_pu.learn(docs, other)
    assert p == q and np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def test_samples_are_bounded(docs, labels, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality_pu, "train", lambda p, u: sizes.append((len(p), len(u))) or (None, 0))
    quality_pu.learn(docs, labels, positives=7, unlabelled=11)
    assert sizes == [(7, 11)]


def test_every_case_and_clashing_columns(tricky, labels):
    scorer, _ = quality_pu.learn(tricky, labels)
    out = quality_pu.score_quality(tricky, scorer)
    assert out.columns == [*[c for c in tricky.columns if c.lower() != "score"], "score"]
    rows = out.collect()
    assert len(rows) == tricky.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1  # null and empty alike
    kept = quality_pu.keep_good(tricky, scorer, threshold=0.0)
    assert kept.columns == tricky.columns and kept.count() == tricky.count()


def test_empty_tables(docs, labels):
    scorer, prior = quality_pu.learn(docs, labels.limit(0))
    assert prior == 0.5 and {r.score for r in quality_pu.score_quality(docs.limit(5), scorer).collect()} == {0.5}
    scorer, _ = quality_pu.learn(docs.limit(0), labels)
    assert quality_pu.score_quality(docs.limit(0), scorer).count() == 0


def test_nulls_and_repeats_in_labels(spark, docs, labels):
    odd = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 0), (5, None, None)], labels.schema))
    (a, _), (b, _) = quality_pu.learn(docs, labels), quality_pu.learn(docs, odd)
    assert np.allclose(a.weights, b.weights)


def test_rows_that_repeat_a_sampled_id_do_not_come_to_the_driver(spark, docs, labels, monkeypatch):
    """A third of all rows are copies, in id or in all, of one sampled document: one row for each id is learned from."""
    seen = []
    train = quality_pu.train
    monkeypatch.setattr(quality_pu, "train", lambda p, u: seen.append((len(p), len(u))) or train(p, u))
    one = labels.where("quality = 1").join(docs, "doc_id").where(~held_out(F.col("doc_id"))).select(*docs.columns).limit(1)
    hot = one.crossJoin(spark.range(100)).withColumn("text", F.when(F.col("id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.col("id"))))
    quality_pu.learn(docs.unionByName(hot.drop("id")), labels, positives=3, unlabelled=9)
    quality_pu.learn(hot.drop("id"), labels)
    assert seen == [(3, 9), (1, 1)]


def plain_risk(scorer, prior, positive, unlabelled):
    """The non-negative unbiased risk, term by term."""
    loss = lambda z: sum(math.log1p(math.exp(-abs(v))) + max(v, 0.0) for v in z) / len(z)
    p, u = scorer.margin(positive), scorer.margin(unlabelled)
    return prior * loss(-p) + max(0.0, loss(u) - prior * loss(p))


def test_the_risk_is_that_of_all_unlabelled_rows(spark, docs, labels):
    """Mean costs and slope over all rows equal a plain loop; the risk over all rows is never more than that of the sample's scorer."""
    scorer, _ = quality_pu.learn(docs, labels, unlabelled=30)
    x = np.array([quality_pu.features(r.text) for r in docs.collect()])

    def whole(scorers):
        z = scorers[0].margin(x)
        up = 1 / (1 + np.exp(-z))
        return (np.array([np.logaddexp(0, s.margin(x)).mean() for s in scorers]),
                np.append(up @ ((x - scorers[0].mean) / scorers[0].scale), up.sum()) / len(x))

    other = quality_pu.Scorer(scorer.weights / 2, 0.1, scorer.mean, scorer.scale)
    (costs, slope), (plain_costs, plain_slope) = quality_pu.mean_costs(docs, "text", [scorer, other]), whole([scorer, other])
    assert np.allclose(costs, plain_costs, atol=1e-6) and np.allclose(slope, plain_slope, atol=1e-6)
    rng = np.random.default_rng(3)
    wanted = {r.doc_id for r in labels.where("quality = 1").collect()}
    good = np.array([quality_pu.features(r.text) for r in docs.collect() if r.doc_id in wanted])
    gains = []
    for n in (25, 50, 100, 150):
        some = x[rng.choice(len(x), n, replace=False)]
        count = lambda s, cuts: (quality_pu.reaching(s.margin(x), cuts), len(x))
        alone, prior = quality_pu.train(good, quality_pu.Corpus(some, count))
        tilted, same = quality_pu.train(good, quality_pu.Corpus(some, count, whole))
        assert prior == same
        gains.append(plain_risk(alone, prior, good, x) - plain_risk(tilted, prior, good, x))
    assert min(gains) > -1e-6 and max(gains) > 1e-3
