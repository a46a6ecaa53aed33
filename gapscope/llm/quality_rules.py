"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at a few statistics of the whole text and votes for keeping
(+), against (-), or abstains.  Votes are counted by pattern (at
most a row per combination, whatever the size of the input); expectation-maximisation over
these counts estimates how often each rule votes which way on good and on bad
documents, and the share of good ones.  A document's verdict is the posterior
probability of good given all its votes, not whether it passes every rule.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscope.llm.common import WORD_GAP, free_name, quoted, without, words
from gapscope.session import materialize

#: Words of a window that counts as a repeat.
WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*BASE, "base_failed", "quality_posterior", "kept")
#: What each rule measures, and its bounds: good votes from or to the first (None: it never votes for good, it
#: abstains), bad votes from or to the second.  Most rules look for one
#: kind of damage, whose absence says nothing; each kind is seen by two rules or more.
RULES = {
    "symbols": ("n_symbols / word_chars", None, 0.08, "from"),
    "symbol_tails": ("n_symbol_tails / n_words", None, 0.20, "from"),
    "lone_symbols": ("n_lone_symbols / n_words", None, 0.20, "from"),
    "repeated_windows": ("n_repeat_words / n_words", None, 0.25, "from"),
    "repeated_lines": ("n_dup_lines / n_lines", None, 0.45, "from"),
    "few_distinct": ("n_distinct / sqrt(n_words)", 4.0, 2.0, "to"),
    "capitals": ("n_capitals / word_chars", None, 0.40, "from"),
    "shouting": ("n_shouts / n_words", None, 0.25, "from"),
    "short_words": ("word_chars / n_words", None, 2.0, "to"),
    "long_words": ("word_chars / n_words", None, 13.0, "from"),
    "sentence_ends": ("n_ends / n_words", 0.02, 0.002, "to"),
}
#: Rounds of expectation-maximisation, and the counts added to each estimate.
ROUNDS, SMOOTHING = 40, 1.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(word: Column, n: int = WINDOW) -> Column:
    """Words inside windows of ``n`` words that the array holds twice or more.

    Windows are compared by 64-bit hashes; only texts where some repeat are sorted.
    """
    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = let(pairs, lambda p: F.filter(p, lambda x, i: (
            F.coalesce(F.get(p, i - 1)["x"] == x["x"], F.lit(False)) | F.coalesce(F.get(p, i + 1)["x"] == x["x"], F.lit(False)))))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        steps = let(starts, lambda s: F.transform(s, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(s, i + 1) - x, F.lit(n)))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    windows = F.transform(F.sequence(F.lit(1), F.size(word) - (n - 1)), lambda i: F.xxhash64(F.slice(word, i, n)))
    return F.when(F.size(word) <= n, 0).otherwise(
        let(windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g))))


def statistics(text: Column) -> Column:
    """Struct of counts over the whole text (null: as empty); all long."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    by_word = let(words(text), lambda w: F.struct(
        F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"), repeated_window_words(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return F.struct(
        by_word.alias("word"), by_line.alias("line"),
        (F.char_length(text) - count(WORD_GAP.rstrip("+"))).alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"), count(r"\p{Lu}").alias("n_capitals"), count(r"[!?]").alias("n_shouts"),
        count(r"[#*$%&|<>]{2,}(?=[\x20\x09-\x0D]|\z)").alias("n_symbol_tails"),
        count(r"(?:^|[\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?=[\x20\x09-\x0D]|\z)").alias("n_lone_symbols"),
        count(r"[.!?](?=[\x20\x09-\x0D]|\z)").alias("n_ends"))


def with_statistics(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with a struct column ``name`` of the counts."""
    out = df.withColumn(name, statistics(F.col(quoted(text))))
    flat = {f: F.col(f"{name}.{g}{f}").cast("long") for g, fs in (
        ("word.", ("n_words", "n_distinct", "n_repeat_words")), ("line.", ("n_lines", "n_dup_lines")),
        ("", ("word_chars", "n_symbols", "n_capitals", "n_shouts", "n_symbol_tails", "n_lone_symbols", "n_ends"))) for f in fs}
    return out.withColumn(name, F.struct(*[c.alias(f) for f, c in flat.items()]))


def vote(stats: str, rule: str) -> Column:
    """1 (good), -1 (bad) or 0 (abstains; also where the measure's divisor is 0)."""
    measure, good, bad, side = RULES[rule]
    over, under = measure.split(" / ")
    root = under.startswith("sqrt(")
    below = F.col(f"{stats}.{under.removeprefix('sqrt(').removesuffix(')')}")
    ratio = F.col(f"{stats}.{over}") / F.when(below > 0, F.sqrt(below) if root else below)
    cast = F.when(ratio >= bad if side == "from" else ratio <= bad, -1)
    if good is not None:
        cast = cast.when(ratio <= good if side == "from" else ratio >= good, 1)
    return cast.otherwise(0)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over (votes, count): the share of good, and by rule and vote its probability if bad and if good.

    It starts from the share of votes for good among those cast, so that the
    two classes keep their meaning.
    """
    belief = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes)) for votes, _ in patterns]
    prior, tables = 0.5, []
    for _ in range(rounds):
        good, total = sum(b * n for b, (_, n) in zip(belief, patterns)), sum(n for _, n in patterns)
        prior = (good + SMOOTHING) / (total + 2 * SMOOTHING)
        tables = []
        for r in range(len(patterns[0][0]) if patterns else 0):
            sums = {v: [SMOOTHING, SMOOTHING] for v in (-1, 0, 1)}
            for b, (votes, n) in zip(belief, patterns):
                sums[votes[r]][0] += (1 - b) * n
                sums[votes[r]][1] += b * n
            by_class = [sum(s[c] for s in sums.values()) for c in (0, 1)]
            tables.append({v: (s[0] / by_class[0], s[1] / by_class[1]) for v, s in sums.items()})
        belief = [1 / (1 + math.exp(-max(-700.0, min(700.0, log_odds(prior, tables, votes))))) for votes, _ in patterns]
    return prior, tables


def log_odds(prior: float, tables: list[dict[int, tuple[float, float]]], votes: tuple[int, ...]) -> float:
    return math.log(prior / (1 - prior)) + sum(math.log(t[v][1] / t[v][0]) for t, v in zip(tables, votes))


def judge_quality(df: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds the base counts, base_failed, quality_posterior and kept to every row.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated
    windows.  kept: not base_failed, and a posterior of at least 0.5.  Null and
    blank texts have no words and so fail the base; repeated rows are judged
    alike (each counts in the estimate); of an empty table nothing is estimated
    and nothing returned.  Input columns named like the added ones are replaced,
    others stay, or only those of ``carry``; then texts are read once, and the
    counts written with these columns.  Without it texts are read twice, which
    takes less than writing them all again.
    """
    df = without(df, *{*ADDED} - {text.lower()})
    stats = free_name(df, "rule_stats")
    kept = [quoted(c) for c in df.columns if carry is None or c in carry]
    counted = with_statistics(df, text, stats).select(*kept, stats)
    counted = counted if carry is None else materialize(counted, "rule-stats")
    votes = F.array(*[vote(stats, r) for r in RULES])
    failed = ((F.col(f"{stats}.n_words") < 10)
              | (100 * F.col(f"{stats}.n_repeat_words") > 20 * F.col(f"{stats}.n_words")))
    patterns = counted.groupBy(votes.alias("votes")).agg(F.count("*").alias("n")).orderBy("votes").collect()
    prior, tables = estimate([(tuple(p.votes), p.n) for p in patterns])
    if not tables:
        tables = [{v: (0.5, 0.5) for v in (-1, 0, 1)} for _ in RULES]
    odds = F.lit(math.log(prior / (1 - prior)))
    for rule, t in zip(RULES, tables):
        weight = {v: F.lit(math.log(good / bad)) for v, (bad, good) in t.items()}
        cast = vote(stats, rule)
        odds = odds + F.when(cast > 0, weight[1]).when(cast < 0, weight[-1]).otherwise(weight[0])
    out = counted.withColumns({**{b: F.col(f"{stats}.{b}") for b in BASE}, "base_failed": failed,
                               "quality_posterior": 1 / (1 + F.exp(-odds))}).drop(stats)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= 0.5))


def _vote_sql(rule: str) -> str:
    measure, good, bad, side = RULES[rule]
    over, under = measure.split(" / ")
    ratio = f"{over} / {under.replace('n_words', 'nullif(n_words, 0)').replace('word_chars', 'nullif(word_chars, 0)').replace('n_lines', 'nullif(n_lines, 0)')}"
    low, high = ("<=", ">=") if side == "from" else (">=", "<=")
    for_good = f"WHEN {ratio} {low} {good} THEN 1 " if good is not None else ""
    return f"CASE WHEN {ratio} {high} {bad} THEN -1 {for_good}ELSE 0 END"


#: The query's rows in DuckDB: words and windows as rows, estimates by recursion over the patterns' votes.
ORACLE = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (SELECT row, i, array_to_string(words[i:i + 4], ' ') AS said
            FROM (SELECT row, words, unnest(range(1, len(words) - 3)) AS i FROM texts)),
repeated AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, said) > 1),
covered AS (SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS j FROM repeated) GROUP BY row),
lined AS (SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
counted AS (
  SELECT row, doc_id, len(words) AS n_words, list_unique(words) AS n_distinct, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
         len(lines) AS n_lines, CAST(len(lines) - list_unique(lines) AS BIGINT) AS n_dup_lines,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_capitals,
         len(regexp_extract_all(text, '[!?]')) AS n_shouts,
         len(list_filter(words, lambda w: regexp_matches(w, '[#*$%&|<>][#*$%&|<>]$'))) AS n_symbol_tails,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '[\\p{{L}}\\p{{N}}]'))) AS n_lone_symbols,
         len(list_filter(words, lambda w: regexp_matches(w, '[.!?]$'))) AS n_ends
  FROM texts JOIN lined USING (row) LEFT JOIN covered USING (row)),
voted AS (SELECT *, [{", ".join(map(_vote_sql, RULES))}] AS votes FROM counted),
patterns AS (SELECT votes, count(*) AS n FROM voted GROUP BY votes),
cast_votes AS (SELECT votes, n, unnest(votes) AS vote, unnest(range(len(votes))) AS rule FROM patterns),
beliefs AS (
  SELECT 0 AS round, votes, (1 + len(list_filter(votes, lambda v: v > 0))) / (2 + len(list_filter(votes, lambda v: v <> 0))) AS b FROM patterns
  UNION ALL
  SELECT round + 1, c.votes, 1 / (1 + exp(-greatest(-700, least(700, max(prior_odds) + sum(odds)))))
  FROM (SELECT round, rule, vote,
               ln((good + {SMOOTHING}) / (sum(good) OVER r + 3 * {SMOOTHING}) / ((bad + {SMOOTHING}) / (sum(bad) OVER r + 3 * {SMOOTHING}))) AS odds,
               ln((sum(good) OVER r + {SMOOTHING}) / (sum(bad) OVER r + {SMOOTHING})) AS prior_odds
        FROM (SELECT max(round) AS round, rule, vote, sum(b * n) AS good, sum((1 - b) * n) AS bad
              FROM beliefs JOIN cast_votes USING (votes) GROUP BY rule, vote)
        WINDOW r AS (PARTITION BY rule)) o
  JOIN cast_votes c USING (rule, vote) WHERE round < {ROUNDS} GROUP BY round, c.votes)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(b, 6) AS quality_posterior, NOT base_failed AND b >= 0.5 AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM voted)
JOIN (SELECT votes, b FROM beliefs WHERE round = {ROUNDS}) USING (votes)
"""
