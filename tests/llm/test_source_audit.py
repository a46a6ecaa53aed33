import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapscope.llm import source_audit, transducer
from gapscope.llm.queries import op11_source_audit

from .conftest import SF

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
NAMES = ["lang", "source", "part", "item", "value", "rank"]


def states_needed(terms):
    """States of the minimal automaton: distinct sets of endings (the empty set of no terms counts too)."""
    prefixes = {t[:i] for t in terms for i in range(len(t) + 1)} | {b""}
    return len({frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes})


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", max_size=6).map(str.encode), max_size=60))
def test_transducer_is_minimal_and_knows_its_terms(terms):
    ordered = sorted(terms)
    machine = transducer.Transducer.from_bytes(transducer.build(ordered).to_bytes())
    assert machine.size == len(ordered) and list(machine.terms()) == ordered
    assert len(machine.final) == states_needed(ordered)
    others = [t + b"x" for t in ordered] + [t[:-1] for t in ordered] + [b"\xff", b"zzz", b""]
    places = {t: i for i, t in enumerate(ordered)}
    assert machine.ordinals(ordered).tolist() == list(range(len(ordered)))
    assert machine.ordinals(others).tolist() == [places.get(t, -1) for t in others]


def test_terms_out_of_order_are_refused():
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])
    with pytest.raises(ValueError):
        transducer.build([b"a", b"a"])


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least):
    docs = [(TERM.findall(fold(r[0] or "")), r[1] or "", r[2] or "") for r in rows]
    df, uses, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for terms, lang, source in docs:
        df[lang].update(set(terms))
        uses[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, sources in groups.items():
        kept = sorted((t for t, n in df[lang].items() if n >= least), key=str.encode)
        v = len(kept)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        whole = shares(sum((uses[lang, s] for s in sources), Counter()))
        p = {s: shares(uses[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], whole[t])) for t in kept if uses[lang, s][t] and p[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, n) for n, (i, x) in enumerate(items, 1) if part == "pair" or n <= 10]
    return Counter(out)


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = op11_source_audit(spark, SF).collect()
    assert Counter(tuple(r[n] for n in NAMES) for r in rows) == Counter(con.execute(f"SELECT {', '.join(NAMES)} FROM ({source_audit.ORACLE})").fetchall())


@pytest.fixture(scope="module")
def odd(tricky):
    """Rows with ties, a language without kept terms, sources without text, null and empty names, repeated rows, a long text."""
    rng = np.random.default_rng(11)
    words = ["a", "A", "b", "é", "É", "zz", "ñandú", "a1b", "x-y", "🏳️", "ab", "abc", "\x85", "Ab"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 12))), [None, "", "en"][rng.integers(0, 3)], [None, "", "s1", "é", "s2", "S"][rng.integers(0, 6)])
            for _ in range(400)]
    rows += rows[:100] + [("rare " * 3, "xx", s) for s in "abc"] + [(None, "en", "silent"), ("", "yy", "only"), ("a " * 50_000, "en", "s1")]
    rows += [(r.text, r.lang, r.source) for r in tricky.collect()]
    return rows


@pytest.mark.parametrize("stretch,pass_bytes,distinct,chunk,sums", [
    (1 << 16, 64 << 20, 200_000, 4 << 20, 2_000_000), (2, 1, 1, 1, 0), (3, 200, 4, 50, 5)])
def test_every_case_in_stretches_and_passes(spark, odd, monkeypatch, stretch, pass_bytes, distinct, chunk, sums):
    for name, value in (("STRETCH", stretch), ("PASS_BYTES", pass_bytes), ("DISTINCT", distinct), ("CHUNK_BYTES", chunk), ("SUMS", sums)):
        monkeypatch.setattr(source_audit, name, value)
    rows = odd[-200:] if stretch < 10 else odd  # many small jobs
    df = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, n int").withColumns(
        {c: F.lit("own") for c in ("part", "Item", "rank", "place", "docs", "term")})
    got = source_audit.audit_sources(df.repartition(6))
    assert got.columns == NAMES
    assert Counter(map(tuple, got.collect())) == brute(rows, source_audit.IN_DOCUMENTS)


def test_empty_table(spark, tricky):
    assert source_audit.audit_sources(tricky.limit(0)).count() == 0


def test_shares_are_exact(spark):
    """Counts far beyond 2^63 / 10^9."""
    cases = [(n, t, v) for n in (0, 7, 10**12, 3 * 10**17) for t in (10**12, 4 * 10**17) for v in (1, 10**9) if n <= t]
    df = spark.createDataFrame(cases, "n long, t long, v long").withColumn("p", source_audit.share(F.col("n"), F.col("t"), F.col("v")))
    assert all(r.p == 1 + 10**9 * (r.n + 2) // (r.t + 2 * r.v) for r in df.collect())
