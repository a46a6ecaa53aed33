import numpy as np
import pytest

from gapscope.llm import near_dup
from gapscope.llm.queries import op7_near_dup

from .conftest import SF


def plain_sets(texts):
    return {i: frozenset(near_dup.shingles(t)[0].tolist()) for i, t in texts.items()}


def brute(texts, similar=0.8):
    """Class of every id by trying all pairs (plain Jaccard similarity; equal texts are linked)."""
    sets, up = plain_sets(texts), {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if (texts[a] or "") == (texts[b] or "") or (x and y and len(x & y) >= similar * len(x | y)):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


def classes(spark, texts, **options):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: r.class_id for r in near_dup.near_duplicates(df, **options).collect()}


def edited(rng, words, n):
    out = list(words)
    for i in rng.choice(len(out), n, replace=False):
        out[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(out)


def test_shingles():
    h, tf = near_dup.shingles("a b c d e a b c d e")
    assert len(h) == 5 and sorted(tf.tolist()) == [1, 1, 1, 1, 2]
    assert len(near_dup.shingles("a b")[0]) == 1 and len(near_dup.shingles(None)[0]) == len(near_dup.shingles(" \n")[0]) == 0
    assert near_dup.shingles("a\x1cb")[0].tolist() != near_dup.shingles("a b")[0].tolist()  # not one of the six blanks
    assert near_dup.shingles("a \n b")[0].tolist() == near_dup.shingles("a b")[0].tolist()


def test_similarity_is_the_larger_of_both():
    a, b = (np.array([1, 2, 3, 4], np.uint64), np.array([1, 2, 1, 1.0])), (np.array([2, 3, 9], np.uint64), np.array([1, 3, 1.0]))
    assert near_dup.similarity(a, b) == pytest.approx(max(2 / (5 + 5 - 2), 2 / 5))
    assert near_dup.similarity(a, a) == 1 and near_dup.similarity(a, (np.empty(0, np.uint64), np.empty(0))) == 0


def test_rarity_does_not_fade_with_the_corpus():
    """Counts as a corpus of ``n`` texts of 300 shingles brings them: rare shingles stay apart from frequent ones."""
    rng = np.random.default_rng(31)
    h = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 2000, dtype=np.uint64)
    cells = near_dup.DF_BUCKETS // near_dup.DF_ROWS
    for n in (10**4, 10**6, 10**8, 10**10):
        others = rng.poisson(n * 300 / cells, near_dup.DF_BUCKETS)
        df = np.where(np.arange(2000) < 1000, 1, n // 100)
        found = others.copy()
        for row in near_dup.df_buckets(h[:1000]):
            np.add.at(found, row, 1)
        for i in (1000, 1001, 1002):  # a few frequent shingles beside them
            for row in near_dup.df_buckets(h[i:i + 1]):
                found[row] += df[i]
        got = near_dup.rarity_of(h, near_dup.rarities(np.minimum(found, n), n))
        assert got[:1000].mean() > 0.7 and got[:1000].min() > 0.5
        assert np.abs(got[1000:1003] - np.log(100) / np.log(n)).max() < 0.05


def test_rarity_table_counts_texts(spark):
    rng = np.random.default_rng(32)
    common = " ".join(f"c{i}" for i in range(9))  # five shingles in every second text
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 200)) + (" " + common if i % 2 else "") for i in range(800)]
    rarity = near_dup.rarity_table(spark.createDataFrame([(t,) for t in texts + [None, " "]], "text string"))
    alone = near_dup.rarity_of(near_dup.shingles(texts[0])[0], rarity)
    shared = near_dup.rarity_of(near_dup.shingles(common)[0], rarity)
    assert alone.mean() > 0.85 and np.abs(shared - np.log(2) / np.log(800)).max() < 0.03
    assert near_dup.rarity_table(spark.createDataFrame([], "text string")).shape == (near_dup.DF_BUCKETS,)


def test_samples_collide_with_the_weighted_similarity():
    rng, got, want = np.random.default_rng(12), [], []
    for _ in range(60):
        h = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
        share = rng.random()
        keep = rng.random(300) < share
        w1, w2 = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
        other = np.where(keep, h, rng.integers(0, 1 << 63, 300, dtype=np.uint64))
        samples = near_dup.sample(np.concatenate([h, other]), np.concatenate([w1, w2]), np.array([0, 300]))
        got.append((samples[0] == samples[1]).mean())
        common = np.minimum(w1, w2)[keep].sum()
        want.append(common / (w1.sum() + w2.sum() - common))
    assert abs(np.mean(np.array(got) - want)) < 0.02 and np.corrcoef(got, want)[0, 1] > 0.95


def test_query_is_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.class_id for r in op7_near_dup(spark, SF).collect()} == brute(texts)


def test_hub_with_far_copies_and_chains(spark):
    """Copies at many distances of one original, some only linked through others; and unrelated texts."""
    rng = np.random.default_rng(13)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 30, n)]
    base, texts = word(120), {}
    for i in range(150):
        texts[1000 + i] = edited(rng, base, int(rng.integers(0, 12)))
    at = word(100)
    for i in range(12):  # each the next one's near copy, the ends far apart
        texts[10 + i] = " ".join(at)
        at = edited(rng, at, 2).split()
    texts |= {2000 + i: " ".join(word(60)) for i in range(30)}
    got, want = classes(spark, texts), brute(texts)
    assert got == want


def test_shared_passage_does_not_join(spark):
    """A passage in every text, a third of it: buckets are shared, classes are not."""
    rng = np.random.default_rng(14)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: passage + " " + " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 60)) for i in range(120)}
    texts[500] = texts[7] + " end"
    got = classes(spark, texts)
    assert got == brute(texts) and got[500] == 7 and len(set(got.values())) == 120


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "BROADCAST_NODES", 0)
    rng = np.random.default_rng(15)
    base = [f"w{x}" for x in rng.integers(0, 1 << 30, 150)]
    texts = {i: edited(rng, base, int(rng.integers(0, 14))) for i in range(70)}
    assert classes(spark, texts) == brute(texts)


def test_every_case_and_keeping_one(tricky):
    rows = near_dup.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add(r.class_id)
    assert of[1] == {1} and of[2] == of[3] == {2} and of[4] == {4}  # null is empty; blanks are another text
    assert of[None] == {1, 2}
    kept = near_dup.keep_one(tricky)
    assert kept.columns == tricky.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6, 7, 8, 9]
    assert near_dup.near_duplicates(tricky.limit(0)).count() == 0 and near_dup.keep_one(tricky.limit(0)).count() == 0


def test_scratch_tables_are_removed(spark, docs):
    import os

    from gapscope.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    near_dup.classes(docs.select("text"))
    new = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert new <= {"labels"}
