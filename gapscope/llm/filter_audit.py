"""Filter interaction audit: what every filter removes in every order, from coalition values and their potential.

Documents are folded into counts by (part, set of filters that they fail).  A set
of filters is a coalition; its value is the number of documents that it removes,
so a filter's step in an order is the difference of two coalitions' values.  The
Hart-Mas-Colell potential of a coalition follows from those of the coalitions one
filter smaller, P(S) = (v(S) + sum over i in S of P(S - i)) / |S|, and a filter's
Shapley value is P(all) - P(all but it).  Potentials are kept times n!, which makes
them whole numbers, and Shapley values sums over all n! orders.

Only counts leave the first steps.  Copies are counted together before anything is
shuffled by their text or id, so neither a text nor an id that holds a third of all
rows goes to one task.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscope.llm.common import WORD_GAP, quoted

#: Bits of a row's set of failed filters, in order.
LETTERS = "ABCDE"
#: Tasks that rows without an id are spread over where ids are joined.
SALTS = 1024
_ORDER_ROW = "array<struct<filter_order:string,step:int,bit:int,earlier:int,now:int>>"


def text_failures(text: Column) -> Column:
    """Bits of A to D for one text (null: empty): A under 200 words; B fewer than half of its words distinct;
    C more than 3 % of its code points A-Z; D any of ``#$%&*|``."""
    body = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(body, WORD_GAP), "")
    n = F.size(words)
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n,
             100 * F.regexp_count(body, F.lit("[A-Z]")) > 3 * F.length(body), body.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(part, failed, n, good, toxic): documents of each part by the set of filters that they fail (bits of ``LETTERS``).

    part: the language (null: empty string).  E fails where a smaller doc_id anywhere
    in the table has the same text (null: empty); a null id is neither smaller nor
    larger than another, and of rows that repeat one id with one text none fails for
    the other.  good, toxic: documents that ``labels`` marks so; of an id that is
    labelled more than once, the larger label counts.
    """
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(lang)), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("node"), text_failures(F.col(quoted(text))).alias("failed"))
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).cast("int")
    rows = rows.groupBy("doc_id", salt.alias("salt"), "part", "node", "failed").agg(F.count("*").alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.withColumn("salt", F.lit(0))
    marked = rows.join(marks, ["doc_id", "salt"], "left").fillna(0, ["good", "toxic"])
    # a text's smallest id, by way of one row for each part and label
    known = F.col("doc_id").isNotNull()
    groups = marked.groupBy("node", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("with_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("node"))
    groups = groups.withColumn("least", least)
    copies = F.col("with_id") - F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(F.struct(F.col("failed"), (F.col("n") - copies).alias("n")),
                              F.struct((F.col("failed") + 16).alias("failed"), copies.alias("n")))).alias("cell")
    return (groups.select("part", split, "good", "toxic").groupBy("part", F.col("cell.failed").alias("failed"))
            .agg(F.sum("cell.n").alias("n"), F.sum(F.col("cell.n") * F.col("good")).alias("good"),
                 F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic")))


def coalition_values(cells: Column, what: str, n_filters: int) -> Column:
    """Array by coalition (set of filters as bits): how much of ``what`` it removes, from cells (failed, ``what``, ...)."""
    removed = lambda s: F.aggregate(
        cells, F.lit(0).cast("long"), lambda total, c: total + F.when(c["failed"].bitwiseAND(s) != 0, c[what]).otherwise(0))
    return F.transform(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1)), removed)


def potentials(values: str, n_filters: int) -> Column:
    """Array by coalition: its potential times ``n_filters``!, each from those of the coalitions without one of its filters."""
    scale = factorial(n_filters)

    def following(known: Column, s: Column) -> Column:
        smaller = [F.when(s.bitwiseAND(1 << k) != 0, F.get(known, s - (1 << k))).otherwise(0) for k in range(n_filters)]
        total = sum(smaller, F.get(F.col(values), s) * scale)
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n_filters) - 1)), F.array(F.lit(0).cast("long")), following)


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for
    every part, order of the filters and step in it.

    ``counts`` is like ``failure_counts``'; no rows give no rows.  kept: documents
    left after the step; removed: those that it takes out; redundant: those that
    fail its filter and were out before; unique_fails: those that fail no other;
    good_lost, toxic_lost: labelled ones among the removed; shapley: the filter's
    removed, summed over all orders.
    """
    n = len(letters)
    whole = (1 << n) - 1
    cells = counts.groupBy("part").agg(F.sum("n").alias("all"), F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    values = cells.select("part", "all", *[coalition_values(F.col("cells"), c, n).alias(c) for c in ("n", "good", "toxic")])
    values = values.withColumn("potential", potentials("n", n))
    steps = []
    for order in permutations(range(n)):
        earlier = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(letters[i] for i in order), step, 1 << k, earlier, earlier | 1 << k))
            earlier |= 1 << k
    names = ("filter_order", "step", "bit", "earlier", "now")
    all_steps = F.from_json(F.lit(json.dumps([dict(zip(names, s)) for s in steps])), _ORDER_ROW)
    rows = values.select("*", F.explode(all_steps).alias("at"))
    bit = F.col("at.bit")
    without = F.lit(whole) - bit

    def value(what: str, coalition) -> Column:
        return F.get(F.col(what), coalition)

    removed = value("n", F.col("at.now")) - value("n", F.col("at.earlier"))
    return rows.select(
        "part", "at.filter_order", "at.step", (F.col("all") - value("n", F.col("at.now"))).alias("kept"), removed.alias("removed"),
        (value("n", bit) - removed).alias("redundant"), (value("n", F.lit(whole)) - value("n", without)).alias("unique_fails"),
        *[(value(c, F.col("at.now")) - value(c, F.col("at.earlier"))).alias(f"{c}_lost") for c in ("good", "toxic")],
        (value("potential", F.lit(whole)) - value("potential", without)).alias("shapley"))


#: The query's rows in DuckDB, one order after another: a document goes at the first of its failed filters.
ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
flagged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(doc_id) OVER (PARTITION BY body) < doc_id THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flagged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l),
steps AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step FROM orders),
gone AS (SELECT part, fails, n, good, toxic, filter_order,
           coalesce(list_min([strpos(filter_order, x) FOR x IN string_split(fails, '') IF x <> '']), 9) AS out_at
         FROM cells, orders),
told AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
           sum(CASE WHEN out_at > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN out_at = step THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN out_at < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN out_at = step THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN out_at = step THEN toxic ELSE 0 END) AS toxic_lost
         FROM gone JOIN steps USING (filter_order) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM told
"""
