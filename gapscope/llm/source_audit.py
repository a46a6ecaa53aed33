"""Source divergence audit: how far every source's words are from other sources' of its language.

Terms in enough documents of a language are its vocabulary.  They are sorted, cut
into stretches of a bounded number of terms, and each stretch becomes a minimal
acyclic transducer, built where its terms are; a term's ordinal is its place in the
whole sorted vocabulary.  The texts then stream through the transducers, which
recount them as ordinals: no term is shuffled again, and ordinals settle ties.

A vocabulary may grow without bound, so transducers are broadcast up to
``PASS_BYTES`` at a time and the texts of their languages are read once for each
such pass (one pass holds millions of terms).
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscope.llm.common import importable, quoted, release
from gapscope.llm.transducer import Transducer, build
from gapscope.session import Scratch

#: Fixed values of the contract: documents a term must be in, scale of shares, terms told per group.
IN_DOCUMENTS, SCALE, TOLD = 10, 1_000_000_000, 10
#: Terms, and bytes of terms, in a transducer; bytes of transducers that are broadcast at once.
STRETCH, STRETCH_BYTES, PASS_BYTES = 1 << 16, 4 << 20, 32 << 20
#: Distinct words that a task counts before it passes them on, and bytes of text it splits at once.
DISTINCT, CHUNK_BYTES = 200_000, 4 << 20
#: Counts of ordinals that a task adds up before it passes them on (16 bytes each).
SUMS = 2_000_000
#: Every byte that no term holds as a blank, A-Z as a-z.
_FOLD = bytes(b if b >= 0x80 or chr(b) in string.ascii_lowercase else b + 32 if chr(b) in string.ascii_uppercase else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters A-Z (as a-z) and of code points from U+0080."""
    return text.translate(_FOLD).split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, ...]]:
    """The columns of each row, a few rows in memory at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            yield from zip(*(c.to_pylist() for c in whole.slice(at, 200).columns))
    release()


def _bytes(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)).cast("binary"), F.lit(b""))


def document_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, docs): documents (rows) of each language that hold each term; ``texts`` has (text, lang, ...) as bytes."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, Counter] = defaultdict(Counter)
        for text, lang in _texts(batches):
            found[lang].update(set(words_of(text)))
            if sum(map(len, found.values())) > DISTINCT:
                yield from _rows(found)
                found.clear()
        yield from _rows(found)

    def _rows(found: dict[bytes, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.binary()), pa.array(list(counts), pa.binary()),
                                              pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "docs"])

    rows = texts.select("text", "lang").mapInArrow(task, "lang binary, term binary, docs long")
    return rows.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def transducers(kept: DataFrame) -> DataFrame:
    """(lang, first, n, arcs): the sorted terms of ``kept`` (lang, term) in stretches; ``first`` is a stretch's first term."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(lang: bytes, terms: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.binary()), pa.array([terms[0]], pa.binary()), pa.array([len(terms)], pa.int64()),
                                               pa.array([build(terms).to_bytes()], pa.binary())], names=["lang", "first", "n", "arcs"])

        key, terms, size = None, [], 0
        for lang, term in _texts(batches):
            if terms and (lang != key or len(terms) == STRETCH or size > STRETCH_BYTES):
                yield row(key, terms)
                terms, size = [], 0
            key = lang
            terms.append(term)
            size += len(term)
        if terms:
            yield row(key, terms)

    ordered = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(task, "lang binary, first binary, n long, arcs binary")


def with_offsets(stretches: DataFrame) -> DataFrame:
    """Adds ``offset``: terms of the language before the stretch (a row for each stretch, so few rows for a language)."""
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return stretches.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))


def recount(texts: DataFrame, stretches: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of each term in each source of its language, none without any.

    ``texts`` has (text, lang, source) as bytes; ``stretches`` is ``with_offsets``'.
    """
    spark = texts.sparkSession
    known = stretches.select("lang", "offset", F.octet_length("arcs").alias("size")).orderBy("lang", "offset").collect()  # a row for 65,536 terms
    passes: list[list] = []
    room = 0
    for s in known:
        if not passes or s["size"] > room:
            passes.append([])
            room = PASS_BYTES
        passes[-1].append((bytes(s["lang"]), s["offset"]))
        room -= s["size"]
    parts = []
    for one in passes:
        langs = sorted({lang for lang, _ in one})
        low, high = one[0], one[-1]
        key, edge = F.struct("lang", "offset"), lambda e: F.struct(F.lit(e[0]).alias("lang"), F.lit(e[1]).cast("long").alias("offset"))
        rows = stretches.where((key >= edge(low)) & (key <= edge(high))).select("lang", "offset", "arcs").collect()  # PASS_BYTES
        shared = spark.sparkContext.broadcast([(bytes(r["lang"]), r["offset"], bytes(r["arcs"])) for r in rows])
        parts.append(scratch.write(_streamed(texts.where(F.col("lang").isin(langs)), shared), "recount"))
        shared.destroy()
    if not parts:
        return spark.createDataFrame([], "lang binary, source binary, ordinal long, n long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _streamed(texts: DataFrame, shared) -> DataFrame:
    """Words of ``texts`` as ordinals of the broadcast transducers: words are counted together before they
    run through, and ordinals before they leave."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines: dict[bytes, list[tuple[int, Transducer]]] = defaultdict(list)
        for lang, offset, arcs in shared.value:
            machines[lang].append((offset, Transducer.from_bytes(arcs)))

        def run_through() -> None:
            """The words met since the last time, as ordinals."""
            for key, counts in found.items():
                words, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                for offset, machine in machines[key[0]]:
                    ordinal = machine.ordinals(words)
                    there = ordinal >= 0
                    sums[key].append((ordinal[there] + offset, n[there]))
            found.clear()

        def fold() -> int:
            """One count for each ordinal of a source; how many these are."""
            total = 0
            for key, some in sums.items():
                ordinal, n = (np.concatenate([s[k] for s in some]) for k in (0, 1))
                order = np.argsort(ordinal, kind="stable")
                ordinal, n = ordinal[order], n[order]
                first = np.flatnonzero(np.diff(ordinal, prepend=-1))
                sums[key] = [(ordinal[first], np.add.reduceat(n, first) if len(first) else n)]
                total += len(first)
            return total

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), ((ordinal, n),) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.binary()), len(n)), pa.repeat(pa.scalar(source, pa.binary()), len(n)),
                                                  pa.array(ordinal), pa.array(n)], names=["lang", "source", "ordinal", "n"])
            sums.clear()

        sums: dict[tuple[bytes, bytes], list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        found: dict[tuple[bytes, bytes], Counter] = defaultdict(Counter)
        waiting: dict[tuple[bytes, bytes], list[bytes]] = defaultdict(list)
        size = 0

        def split() -> None:
            for key, some in waiting.items():
                found[key].update(words_of(b" ".join(some)))
            waiting.clear()

        for text, lang, source in _texts(batches):
            waiting[lang, source].append(text)
            size += len(text)
            if size > CHUNK_BYTES:
                split()
                size = 0
                if sum(map(len, found.values())) > DISTINCT:
                    run_through()
                    if fold() > SUMS:
                        yield from told()
        split()
        run_through()
        fold()
        yield from told()

    return texts.select("text", "lang", "source").mapInArrow(task, "lang binary, source binary, ordinal long, n long")


def vocabulary(stretches: DataFrame) -> DataFrame:
    """(lang, ordinal, term): every stretch's transducer spelled out, where it is."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, offset, arcs in _texts(batches):
            terms = list(Transducer.from_bytes(arcs).terms())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.binary()), pa.array(range(offset, offset + len(terms)), pa.int64()),
                                              pa.array(terms, pa.binary())], names=["lang", "ordinal", "term"])

    return stretches.select("lang", "offset", "arcs").mapInArrow(task, "lang binary, ordinal long, term binary")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for any count; null where there are no terms."""
    wide = (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.nullif((total + 2 * terms).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return 1 + F.call_function("div", wide, whole)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); at most 10^18 before the division."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_values(present: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for each two sources a < b of a language: the divergences of all kept terms added up.

    ``present`` has (lang, place, ordinal, p) where a source has a term; elsewhere p is
    its ``none`` in ``groups`` (lang, place, terms, none).  A term that neither has
    gives f(none, none), so the sum is that for every term, corrected for terms that a
    has, for terms that b has (both by how many terms have the same p), and once
    more for terms that both have.
    """
    def side(df: DataFrame, x: str, *columns: str) -> DataFrame:
        return df.select("lang", F.col("place").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])

    a, b = side(groups, "a", "terms", "none"), side(groups, "b", "none")
    neither = divergence(F.col("none_a"), F.col("none_b"))
    pairs = a.join(b, "lang").where("a < b")
    base = pairs.select("lang", "a", "b", F.coalesce(F.col("terms_a") * neither, F.lit(0)).alias("value"))
    shares = present.groupBy("lang", "place", "p").agg(F.count("*").alias("k"))
    one = side(shares, "a", "p", "k").join(side(groups, "a", "none"), ["lang", "a"]).join(b, "lang").where("a <> b")
    one = one.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                     (F.col("k_a") * (divergence(F.col("p_a"), F.col("none_b")) - neither)).alias("value"))
    held = present.join(groups.select("lang", "place", "none"), ["lang", "place"])
    both = held.select("lang", "ordinal", F.col("place").alias("a"), F.col("p").alias("p_a"), F.col("none").alias("none_a")).join(
        held.select("lang", "ordinal", F.col("place").alias("b"), F.col("p").alias("p_b"), F.col("none").alias("none_b")),
        ["lang", "ordinal"]).where("a < b")
    both = both.select("lang", "a", "b", (divergence(F.col("p_a"), F.col("p_b")) - divergence(F.col("p_a"), F.col("none_b"))
                                          - divergence(F.col("none_a"), F.col("p_b")) + neither).alias("value"))
    summed = [df.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for df in (one, both)]
    return base.unionByName(summed[0]).unionByName(summed[1]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit_sources(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs in ``df``.

    Part ``pair``: item is each other source of the language, value the sum of the
    divergences of all kept terms between the two, all ranks.  Part ``term``: item is
    each kept term that the source has and uses more than its language does, value
    its divergence from the language, ranks to ``TOLD``.  Ranks count from 1 by
    value, highest first, ties in order of the item's bytes.  Null text, lang and
    source count as empty; every row is a document, repeated ones too; a language
    without kept terms has pairs of value 0 and no terms; a source without text
    has all pairs; an empty table gives no rows.  Other columns are not read.
    """
    spark = df.sparkSession
    importable(spark)
    texts = df.select(_bytes(text).alias("text"), _bytes(lang).alias("lang"), _bytes(source).alias("source"))
    with Scratch(spark) as scratch:
        kept = scratch.write(document_counts(texts).where(F.col("docs") >= IN_DOCUMENTS).select("lang", "term"), "kept-terms")
        stretches = scratch.write(with_offsets(scratch.write(transducers(kept), "stretches")), "transducers")
        counts = scratch.write(recount(texts, stretches, scratch), "counts")

        terms = stretches.groupBy("lang").agg(F.sum("n").alias("terms"))
        totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = (texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
                  .fillna(0, ["total", "terms"]))
        groups = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
        groups = scratch.write(groups.withColumn("none", share(F.lit(0), F.col("total"), F.col("terms"))), "groups")
        present = counts.join(groups, ["lang", "source"]).select(
            "lang", "place", "ordinal", "n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
        present = scratch.write(present, "present")

        pairs = pair_values(present, groups)
        both = F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("item")),
                                 F.struct(F.col("b").alias("place"), F.col("a").alias("item")))).alias("x")
        pairs = pairs.select("lang", both, "value").select("lang", "x.place", F.col("x.item").cast("long").alias("item_place"), "value")

        whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
        usual = present.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang").select(
            "lang", "ordinal", share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
        above = present.join(usual, ["lang", "ordinal"]).where("p > q").select(
            "lang", "place", F.col("ordinal").alias("item_place"), divergence(F.col("p"), F.col("q")).alias("value"))

        ranked = Window.partitionBy("lang", "place").orderBy(F.col("value").desc(), "item_place")
        pairs = pairs.withColumn("rank", F.row_number().over(ranked))
        above = scratch.write(above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOLD), "terms")
        named = groups.select("lang", F.col("place").cast("long").alias("item_place"), F.col("source").alias("item"))
        spelled = vocabulary(stretches).withColumnsRenamed({"ordinal": "item_place", "term": "item"})
        out = (pairs.join(named, ["lang", "item_place"]).withColumn("part", F.lit("pair"))
               .unionByName(above.join(spelled, ["lang", "item_place"]).withColumn("part", F.lit("term"))))
        out = out.join(groups.select("lang", "place", "source"), ["lang", "place"])
        text_of = lambda c: F.col(c).cast("string").alias(c)
        return scratch.keep(scratch.write(out.select(text_of("lang"), text_of("source"), "part", text_of("item"), "value", "rank"), "audit"))


#: The query's rows in DuckDB: every group with every kept term.
ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
uses AS (SELECT lang, source, doc, unnest(terms) AS term FROM texts),
kept AS (SELECT lang, term FROM uses GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT u.lang, u.source, u.term, count(*) AS n FROM uses u JOIN kept k ON u.lang = k.lang AND u.term = k.term
            GROUP BY u.lang, u.source, u.term),
groups AS (SELECT DISTINCT lang, source FROM texts),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, s.v
          FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON s.lang = g.lang
          LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)::HUGEINT) // (total + 2 * v)::HUGEINT AS p FROM dense),
usual AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM dense GROUP BY lang, term),
lang_shares AS (SELECT u.lang, u.term, 1 + (1000000000 * (u.n + 2)::HUGEINT) // (u.total + 2 * s.v)::HUGEINT AS q
                FROM usual u JOIN sizes s ON s.lang = u.lang),
pair_sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
              FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
              GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups a
          JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
above AS (SELECT s.lang, s.source, s.term AS item, ((p - q) * (p - q)) // (p + q) AS value
          FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND p > q),
ranked AS (
  SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT *, 'term', row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM above)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
