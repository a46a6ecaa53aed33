import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
from pyspark.sql import functions as F

from gapscope.llm import filter_audit
from gapscope.llm.queries import op12_filter_audit

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text, doc_id, texts):
    words = WORD.findall(text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if doc_id is not None and any(t == text and i is not None and i < doc_id for i, t in texts):
        out.add("E")
    return out


def brute(rows, good, toxic):
    """Every order, document by document."""
    texts = {(r[0], r[1] or "") for r in rows}
    docs = [(r[2] or "", fails(r[1] or "", r[0], texts), r[0] in good, r[0] in toxic) for r in rows]
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            mine = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                                                   sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return Counter((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rows = op12_filter_audit(spark, SF).collect()
    assert Counter(tuple(r[n] for n in NAMES) for r in rows) == Counter(con.execute(f"SELECT {', '.join(NAMES)} FROM ({filter_audit.ORACLE})").fetchall())


def test_every_case_against_all_orders(spark, tricky):
    """Nulls, blanks, long texts, repeated rows and ids, ids labelled twice, null and empty languages in one part."""
    rng = np.random.default_rng(12)
    words = ["a", "B", "#", "c" * 9, "ÄÖ", "x\ty"]
    more = [(int(rng.integers(0, 60)), " ".join(rng.choice(words[:int(rng.integers(1, 6))], int(rng.choice([1, 3, 220])))),
             [None, "", "en", "de"][rng.integers(0, 4)], "s") for _ in range(300)]
    more += more[:80] + [(None, *r[1:]) for r in more[:20]]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in tricky.collect()] + more
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns(
        {c: F.lit("own") for c in ("part", "Failed", "n", "good", "toxic", "node", "salt", "least", "cells")})
    marks = [(i % 60, i % 2, (i // 2) % 2) for i in range(70)] + [(None, 1, 1), (3, None, 1), (999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    good, toxic = ({i for i, *m in marks if i is not None and m[k] == 1} for k in (0, 1))
    got = filter_audit.audit(filter_audit.failure_counts(df.repartition(5), labels))
    assert got.columns == NAMES
    assert Counter(map(tuple, got.collect())) == brute(rows, good, toxic)


def test_empty_tables(spark, tricky, labels):
    assert filter_audit.audit(filter_audit.failure_counts(tricky.limit(0), labels)).count() == 0
    unlabelled = filter_audit.audit(filter_audit.failure_counts(tricky, labels.limit(0))).collect()
    assert unlabelled and {(r.good_lost, r.toxic_lost) for r in unlabelled} == {(0, 0)}


def test_potentials_of_a_game_of_three(spark):
    """Shares of a removal game with three filters, from its definition."""
    sets = {0: 4, 1: 5, 2: 7, 3: 11, 4: 2, 6: 3, 7: 6}
    counts = spark.createDataFrame([("p", s, n, 0, 0) for s, n in sets.items()], "part string, failed int, n long, good long, toxic long")
    shares = defaultdict(int)
    for order in permutations(range(3)):
        left = dict(sets)
        for k in order:
            gone = {s: n for s, n in left.items() if s >> k & 1}
            shares["XYZ"[k]] += sum(gone.values())
            left = {s: n for s, n in left.items() if s not in gone}
    rows = filter_audit.audit(counts, "XYZ").collect()
    assert len(rows) == 18 and all(r.shapley == shares[r.filter_order[r.step - 1]] for r in rows)
    assert sum(shares.values()) == 6 * (sum(sets.values()) - sets[0])
