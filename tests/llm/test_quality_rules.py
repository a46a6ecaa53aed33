import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapscope.llm import quality_rules
from gapscope.llm.queries import op2_quality_rules

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts_of_random_texts(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "b", "é", "#|", "a\n", "\n", "b\x1c"], rng.integers(0, 40))) for _ in range(400)]
    texts += ["a b c d e", "a a a a a a", "a b c d e a b c d e", "x\ny\nx\n\n \n", "<>" * 9, "\xa0 \x85"]
    rows = quality_rules.judge_quality(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r in rows:
        assert counts(r) == brute(r.text), repr(r.text)


def test_every_case_and_clashing_columns(tricky):
    out = quality_rules.judge_quality(tricky)
    own = [c for c in tricky.columns if c.lower() not in quality_rules.ADDED]
    assert out.columns == [*own, *quality_rules.ADDED]
    rows = out.collect()
    assert len(rows) == tricky.count()
    for r in rows:
        assert counts(r) == brute(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and r.kept is not None
    assert quality_rules.judge_quality(tricky.limit(0)).count() == 0
    narrow = quality_rules.judge_quality(tricky, carry=["doc_id"])
    assert sorted(map(str, narrow.drop("doc_id").collect())) == sorted(map(str, out.select(*quality_rules.ADDED).collect()))


def by_hand(patterns, rounds):
    """The same estimates, one document at a time."""
    docs = [v for v, n in patterns for _ in range(n)]
    belief = [(1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for v in docs]
    for _ in range(rounds):
        prior = (sum(belief) + 1) / (len(docs) + 2)
        tables = [{x: [(1 + sum(p if c else 1 - p for p, v in zip(belief, docs) if v[r] == x))
                       / (3 + sum(p if c else 1 - p for p in belief)) for c in (0, 1)] for x in (-1, 0, 1)} for r in range(len(docs[0]))]
        belief = []
        for v in docs:
            good, bad = prior, 1 - prior
            for t, x in zip(tables, v):
                bad, good = bad * t[x][0], good * t[x][1]
            belief.append(good / (good + bad))
    return prior, tables


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.tuples(*[st.sampled_from([-1, 0, 1])] * 3), st.integers(1, 9), min_size=1, max_size=8))
def test_estimate_is_expectation_maximisation(patterns):
    prior, tables = quality_rules.estimate(list(patterns.items()), 5)
    expected, expected_tables = by_hand(list(patterns.items()), 5)
    assert math.isclose(prior, expected, rel_tol=1e-9)
    for t, e in zip(tables, expected_tables):
        assert all(np.allclose(t[v], e[v]) for v in t)


def test_estimate_finds_the_accuracies():
    rng, patterns = np.random.default_rng(5), Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        patterns[tuple(int(rng.choice([-1, 0, 1], p=[.05, .75, .2] if good else [.6, .35, .05])) for _ in range(5))] += 1
    prior, tables = quality_rules.estimate(sorted(patterns.items()))
    assert abs(prior - 0.8) < 0.03
    assert all(abs(t[-1][0] - 0.6) < 0.05 and abs(t[-1][1] - 0.05) < 0.02 for t in tables)


def test_query_keeps_clean_and_drops_junk(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op2_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts) and all(counts(r) == brute(texts[r.doc_id]) for r in rows)
    big = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{big}/labels.parquet")
    judged = op2_quality_rules(spark, big).where(~F.col("base_failed")).join(labels, "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) <= 0.01 * found[1, True] and found.get((0, True), 0) <= 0.1 * found[0, False]
