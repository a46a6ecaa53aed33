import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gapscope.llm import bpe
from gapscope.llm.queries import op9_bpe, vocabulary

from .conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def textbook(codec, word: bytes) -> list[int]:
    """The earliest merge, leftmost first, one at a time."""
    parts = [int(codec.byte_id[b]) for b in word]
    while True:
        ranks = [codec.merged.get(p, (bpe.NEVER, -1)) for p in zip(parts, parts[1:])]
        if not ranks or min(ranks)[0] == bpe.NEVER:
            return parts
        i = min(range(len(ranks)), key=lambda i: (ranks[i][0], i))
        parts[i:i + 2] = [ranks[i][1]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abehtinor <|>'sdZ1é日\n\t\x1c\x85\xa0.!", max_size=80), max_size=5))
def test_encode_is_the_librarys(texts):
    codec, library = bpe.codec(vocabulary()), Tokenizer.from_file(vocabulary())
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text


def test_compatible_pairs_are_those_that_merging_leaves():
    codec, rng = bpe.codec(vocabulary()), np.random.default_rng(1)
    a, b = rng.integers(0, 50256, 4000), rng.integers(0, 50256, 4000)
    short = (codec.length[a] < 20) & (codec.length[b] < 20)
    a, b = a[short], b[short]
    for l, r, fine in zip(a, b, codec.compatible(a, b)):
        assert fine == (textbook(codec, codec.token_bytes[l] + codec.token_bytes[r]) == [l, r])


def test_exact_merging_of_rows_and_of_long_words():
    codec, rng = bpe.codec(vocabulary()), np.random.default_rng(2)
    words = [bytes(rng.choice(list(b"thes ionare"), 9).tolist()) for _ in range(300)]
    rows = codec.merge_equal(words)
    for word, row in zip(words, rows):
        assert row[row >= 0].tolist() == textbook(codec, word) == codec.merge_long(word)


def test_small_cache_changes_nothing(monkeypatch, library):
    codec = bpe.ByteBpe(vocabulary())
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    texts = ["some words to encode", "and other words", None, ""] * 3
    got = [x.tolist() for x in codec.encode(texts, chunk_chars=10)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_every_case_and_clashing_columns(tricky, library):
    out = bpe.decode(bpe.encode(tricky, vocabulary()), vocabulary())
    assert sorted(out.columns) == sorted([c for c in tricky.columns if c.lower() not in ("ids", "decoded")] + ["ids", "decoded"])
    rows = out.collect()
    assert sorted(map(str, rows)) == sorted(map(str, bpe.encode_decode(tricky, vocabulary()).select(*out.columns).collect()))
    assert len(rows) == tricky.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")


def test_decode_of_null_and_broken_ids(spark):
    df = spark.createDataFrame([(None,), ([],), ([220, None, 64],), ([50256],), ([163],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(df, vocabulary()).collect()] == ["", "", " a", "<|endoftext|>", "�"]


def test_empty_table(tricky):
    assert bpe.decode(bpe.encode(tricky.limit(0), vocabulary()), vocabulary()).count() == 0


def test_query(spark, docs, library):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op9_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        e = library.encode(texts[r.doc_id], add_special_tokens=False)
        assert r.n_tokens == len(e.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
