from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from gapscope.llm import bpe, token_counts
from gapscope.llm.queries import op10_token_counts, vocabulary

from .conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def brute(offsets, spans, rule):
    """{section: (tokens, crossing)} by trying every token with every section."""
    counts, crossing = Counter(), Counter()
    for s, e in offsets:
        best = None
        for i, (a, b) in enumerate(spans):
            common = min(e, b) - max(s, a)
            if common > 0:
                key = (-common, i) if rule == "majority" else (max(s, a), i)
                best = min(best, (key, i, common)) if best else (key, i, common)
        where, held = (best[1], best[2]) if best else (-1, 0)
        counts[where] += 1
        crossing[where] += held < e - s
    return counts, crossing


def lines(text):
    at, out = 0, []
    for x in text.splitlines(keepends=True) if "\r" not in text else [x + "\n" for x in text.split("\n")]:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def test_spans_are_the_librarys_offsets(docs, library):
    texts = [r.text for r in docs.limit(60).collect()] + ["日本語 é́ 🏳️‍🌈\n\n\nx", "<|endoftext|>a\n"]
    for text in texts:
        ids = next(iter(bpe.codec(vocabulary()).encode([text])))
        start, end = token_counts.token_spans(vocabulary(), ids)
        assert list(zip(start.tolist(), end.tolist())) == library.encode(text, add_special_tokens=False).offsets


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_is_brute_force(rule):
    rng = np.random.default_rng(3)
    for _ in range(200):
        cuts = np.sort(rng.integers(0, 40, 12))
        start, end = cuts[:-1], cuts[1:]
        there = end > start
        start, end = start[there], end[there]
        a = rng.integers(0, 45, 5)
        spans = np.stack([a, a + rng.integers(0, 15, 5)], 1)
        mine, crosses = token_counts.allocate(start, end, spans, rule)
        counts, crossing = brute(list(zip(start, end)), spans.tolist(), rule)
        assert Counter(mine.tolist()) == counts
        assert Counter(mine[crosses].tolist()) == +crossing


def test_query_is_brute_force(spark, docs, library):
    got = {}
    for r in op10_token_counts(spark, SF).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.n_tokens, r.n_crossing)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        spans = []
        for x in text.split("\n"):
            begin = spans[-1][1] if spans else 0
            spans.append((begin, begin + len(x) + 1))
        spans[-1] = (spans[-1][0], len(text))
        spans = [s for s in spans if s[0] < s[1]]
        counts, crossing = brute(library.encode(text, add_special_tokens=False).offsets, spans, "majority")
        assert got[i] == {k: (counts[k], crossing[k]) for k in range(-1, len(spans))}


def test_every_case(tricky, library):
    rows = token_counts.attribute_tokens(tricky, vocabulary(), ["doc_id", "lang"]).collect()
    assert sum(r.section == -1 for r in rows) == tricky.count()  # no row is lost, repeated rows count each
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) for r in tricky.collect())
    assert sum(r.n_tokens for r in rows) == total
    assert {r.section for r in rows if r.doc_id in (2, 3)} == {-1}
    assert token_counts.attribute_tokens(tricky.limit(0), vocabulary(), ["doc_id"]).count() == 0


def test_given_sections(spark):
    df = spark.createDataFrame([(1, "hello world again", [(0, 5), (5, 11), None, (9, 9)]), (2, None, [(0, 3)]), (3, "a", None)],
                               "id int, text string, spans array<struct<s:int,e:int>>")
    rows = {(r.id, r.section): (r.span_start, r.span_end, r.n_tokens)
            for r in token_counts.attribute_tokens(df, vocabulary(), ["id"], spans="spans").collect()}
    assert rows == {(1, -1): (None, None, 1), (1, 0): (0, 5, 1), (1, 1): (5, 11, 1), (1, 2): (-1, -1, 0), (1, 3): (9, 9, 0),
                    (2, -1): (None, None, 0), (2, 0): (0, 3, 0), (3, -1): (None, None, 1)}


def test_unknown_rule(tricky):
    with pytest.raises(ValueError):
        token_counts.attribute_tokens(tricky, vocabulary(), ["doc_id"], rule="other")
