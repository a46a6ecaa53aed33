import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import toxicity
from gapscope.llm.queries import op3_toxicity

BIG = "/root/testdata/sf0.01"


def slow_kernel(a, b, name=lambda triple: triple):
    """Kernel of two windows, triple by triple; each is divided by the length of a vector of as many different triples."""
    def vector(s):
        out, size = {}, 0.0
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, len(s)):
                    if j - i - 1 <= toxicity.GAP and k - j - 1 <= toxicity.GAP and (s[i], s[k]) != ("^", "$"):
                        weight = toxicity.DECAY ** (k - i - 2)
                        triple = name(s[i] + s[j] + s[k])
                        out[triple] = out.get(triple, 0) + weight
                        size += weight * weight
        return {t: v / np.sqrt(size) for t, v in out.items()}
    x, y = vector(a), vector(b)
    return sum(v * y.get(t, 0) for t, v in x.items())


def slow_windows(text):
    """Runs of words of each sentence with 3 to WINDOW letters, joined."""
    out = []
    for sentence in re.split(r"\n|(?<=[.!?])\s", text):
        words = [w for w in (re.sub(r"[\W_]", "", w).lower() for w in sentence.split()) if w]
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                joined = "".join(words[i:j])
                if toxicity.LEAST <= len(joined) <= toxicity.WINDOW:
                    out.append(f"^{joined}$")
    return out


def hashed(triple):
    return int(toxicity.hashed(*np.array([[ord(c)] for c in triple], np.uint32))[0])


def test_kernel_is_the_slow_one():
    words = ["^idiot$", "^idiiot$", "^idxiot$", "^banana$", "^aaaaaaa$", "^the$"]
    got = toxicity.Landmarks.of(words).kernel(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(slow_kernel(a, b, hashed), abs=1e-5)
            assert got[i, j] == pytest.approx(slow_kernel(a, b), abs=0.02)  # two triples may share a hash


def test_folded_weights_give_the_sum_over_landmarks():
    words, rng = ["^idiot$", "^moron$", "^hello$"], np.random.default_rng(8)
    marks, amounts = toxicity.Landmarks.of(words), rng.normal(size=3)
    machine = toxicity.Machine(marks.folded(amounts), 0.25, 1, 0)
    others = ["^idxiot$", "^morron$", "^halo$"]
    assert np.allclose(machine.values_of(others), marks.kernel(others) @ amounts + 0.25, atol=1e-4)


def test_windows_cross_word_borders_but_not_sentences():
    assert toxicity.pieces("i.d-i*o_t") == ["^idiot$"]
    assert "^idiot$" in toxicity.all_windows("you I D I O T there a b") and "^idiot$" in toxicity.all_windows("an i  d \t i   o t!")
    assert toxicity.all_windows("id.\niot") == ["^iot$"] and toxicity.all_windows("id. iot") == ["^iot$"]
    assert toxicity.all_windows("") == [] and toxicity.all_windows("a b .. \n -") == []
    text = "You id-iot! Als ob, (so) viele wörter é\nin a row a b c d. Longest words go on 日本語 x2 __ end"
    assert sorted(toxicity.all_windows(text)) == sorted(slow_windows(text))


def test_long_words_are_cut():
    for n in (toxicity.WINDOW, toxicity.WINDOW + 1, 40, 1000):
        word = "".join(chr(97 + i * i % 26) for i in range(n))
        cuts = toxicity.pieces(word)
        assert cuts == toxicity.all_windows(word) and all(len(c.strip("^$")) <= toxicity.WINDOW for c in cuts)
        assert cuts[0][0] == "^" and cuts[-1][-1] == "$" and word.startswith(cuts[0].strip("^$")) and word.endswith(cuts[-1].strip("^$"))


def test_sums_along_the_letters_give_the_kernel_values(monkeypatch):
    monkeypatch.setattr(toxicity, "BATCH_WORDS", 7)
    monkeypatch.setattr(toxicity, "BATCH_CHARS", 60)
    machine = toxicity.Machine(np.random.default_rng(4).normal(size=toxicity.HASHED).astype(np.float32), -0.5, 1.0, 0.0)
    texts = ["you id iot there, aaaaaaa aa a", None, "", "x" * 90 + " and more words of it. " * 9, "é ü", "one two three"]
    want = [max(machine.values_of(w)) if t and (w := toxicity.all_windows(t)) else machine.bias for t in texts]
    assert np.allclose(machine.worst(texts), want, atol=1e-6)
    for t in texts:
        got = machine.worst_windows(t or "")
        assert not t or not got or max(got)[0] == pytest.approx(machine.worst([t])[0])
        assert all(v == pytest.approx(machine.values_of([w])[0]) for v, w in got)


@pytest.fixture(scope="module")
def machine():
    rng = np.random.default_rng(9)
    syllables = ["the", "an", "er", "ou", "ti", "on", "re", "sh", "ea", "nd", "or", "bl"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    clean = [". ".join(" ".join(word() for _ in range(8)) for _ in range(5)) for _ in range(300)]
    bad = []
    for t in clean[:120]:
        words = t.split(" ")
        words[rng.integers(len(words))] = str(rng.choice(["idiot", "moron", "pathetic", "worthless"]))
        bad.append(" ".join(words))
    return toxicity.train(clean[120:] + bad, np.array([False] * 180 + [True] * 120))


def test_gapped_and_inserted_insults(machine):
    toxic = machine.score(["you idiot here", "an id-i-o-t", "the i d i o t on", "re patheetic", "WORTHLESS.", "er worthlless on", "m.o.r.o.n"])
    assert (toxic >= 0.7).all()
    chunked = machine.score(["mo ron", "an idi ot", "you id iot here", "path etic er", "the wor thl ess one", "i  d\ti o   t"])
    assert (chunked >= 0.7).all()
    put_in = machine.score(["idxxiot", "ix dx ix ox t", "you moxron", "pa-the tyic"])
    assert (put_in >= 0.7).all()
    clean = machine.score(["the anerou on re", "tionsh ther", "", None, "a b c", "\n\n"])
    assert (clean < 0.5).all()


def test_one_label_only():
    assert toxicity.train(["a b c"], np.array([False])).score(["x"])[0] < 0.1
    assert toxicity.train([], np.array([], bool)).score(["x"])[0] < 0.1


def test_held_out_accuracy_of_the_query(spark):
    rows = op3_toxicity(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    bad, good = ([r.score for r in held if r.toxic == v] for v in (1, 0))
    assert np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad]) > 0.85
    assert np.mean([r.predicted for r in held if r.toxic == 0]) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(docs, labels):
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs, labels), toxicity.learn(docs, other)
    assert np.array_equal(a.weight, b.weight) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_every_case_and_clashing_columns(tricky, labels):
    machine = toxicity.learn(tricky, labels)
    out = toxicity.score_toxicity(tricky, machine)
    assert out.columns == [*[c for c in tricky.columns if c.lower() != "score"], "score"]
    rows = out.collect()
    assert len(rows) == tricky.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip(" \t\n\r\x0b\x0c")}) == 1
    assert toxicity.score_toxicity(tricky.limit(0), toxicity.learn(tricky.limit(0), labels.limit(0))).count() == 0


def test_what_comes_to_the_driver_is_bounded(spark, docs, labels, monkeypatch):
    """Rows that repeat a sampled id are one, and of a document with very many sentences some are taken."""
    seen = []
    monkeypatch.setattr(toxicity, "SENTENCES", 10)
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: seen.append(texts))
    one = docs.join(labels.where("toxic = 0"), "doc_id", "leftsemi").where((F.crc32(F.col("doc_id").cast("string")) % 3) != 1).limit(1)
    long = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: F.concat(F.lit("said "), i.cast("string"))), ". ")
    hot = one.crossJoin(spark.range(50)).drop("id").withColumn("text", long)
    toxicity.learn(hot, labels)
    assert len(seen) == 1 and len(seen[0]) == 1 and len(seen[0][0].split("\n")) == 10 and "said" in seen[0][0]
