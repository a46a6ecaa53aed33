"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded random order, passed
through up to ``passes`` times.  A document's virtual finish time is its
source's words up to and including it, divided by the source's target; sorting
all of them by that time and stopping at the total budget gives every source
its share at every moment.

The rows are written once, with a number each and their words counted; all planning
is done on the numbers, and rows are picked from the written ones.  Rows alike in
source, id and text are told apart by nothing else, so they are counted together by
the partition that wrote them, and each partition's copies take places one after the
other: a text or an id that a third of all rows share is never in one task.

Running sums never put a source, or all rows, into one task: chunks of equal rows are
dealt into cells of about ``CELL_ROWS`` rows, or a ``CELLS``-th of all if that is more
(a hot source has many cells), the cells' sums are added up in a table of a row per
cell, and windows run inside cells only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscope.llm.common import WORD, free_name, quoted, sparing_disk, without
from gapscope.session import Scratch, delete_path, fresh_dir, materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
CELL_ROWS = 2048
#: Cells, or bins of time, that all rows are dealt into at most: what a single task adds up.
CELLS = 1 << 16
#: Sources up to which their table (some 100 bytes a row) is broadcast; beyond, Spark chooses the join.
BROADCAST_SOURCES = 50_000
#: Stretches of time that a written mixture is sorted in.
STRETCHES = 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, passes: int = 2) -> DataFrame:
    """Adds source_rank, weight and target to (source, source_size, ...), a row per source.

    Targets share ``share`` of all words by weight; none exceeds ``passes`` times
    its source's words, and what is above goes to the others by weight, until
    none is above.  That is min(cap, weight * level) for one level, found over
    the sources in order of cap / weight: it is the first at which the words
    left, shared by the weights left, keep the next source within its cap.
    """
    in_order, alike = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_rank") - 1) % len(WEIGHTS) + 1)
    cap = (F.col("source_size") * passes).cast("double")
    out = (sources.withColumn("source_rank", F.row_number().over(in_order)).withColumn("weight", weight)
           .withColumn("ratio", cap / F.col("weight")))
    left = F.sum("source_size").over(alike) * F.lit(share) - passes * F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0))
    rest = F.sum("weight").over(alike) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))
    out = out.withColumn("level", left / rest)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_rank", "level"))).over(alike)["level"]
    return out.withColumn("target", F.least(cap, F.col("weight") * F.coalesce(level, F.lit(0.0)))).drop("ratio", "level")


@dataclass
class Mix:
    """A planned mix: written rows (mix_id, row, ...), and for each what the mix takes of it (mix_id, size, source_size,
    target, copies, finish)."""

    rows: DataFrame
    plan: DataFrame
    row: str
    path: str   #: of the written rows


def plan_mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             share: float = 1.5, passes: int = 2, seed: int = 17, carry: list[str] | None = None) -> Mix:
    """Writes the rows of ``df`` (its columns, or those of ``carry``) and plans what the mix takes of them; see ``mix``."""
    spark = df.sparkSession
    row = free_name(df, "mix_row")
    carried = df.columns if carry is None else [c for c in carry if c in df.columns]
    ident = F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    # a row's own columns travel as one struct, so that their names cannot clash
    staged = df.select(F.struct(*[quoted(c) for c in carried]).alias(row), F.col(quoted(source)).alias("source"),
                       n_words(F.col(quoted(text))).alias("size"), F.md5(F.concat_ws(":", F.lit(str(seed)), ident, F.md5(body))).alias("order_key"),
                       F.monotonically_increasing_id().alias("mix_id"))
    path = fresh_dir(spark, "mix-staged")
    with sparing_disk(spark):
        staged.write.parquet(path)
    staged = spark.read.parquet(path)
    rows = staged.select("mix_id", "source", "size", "order_key", F.shiftright("mix_id", 33).alias("part"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    sources = materialize(targets(sources, share, passes), "mix-sources")
    totals = sources.agg(F.sum("source_size").alias("s"), F.sum("n_rows").alias("r"), F.count("*").alias("n")).first()
    budget, n_rows = (totals.s or 0) * share, totals.r or 0
    cell_rows = max(CELL_ROWS, -(-n_rows // CELLS))
    side = F.broadcast(sources) if totals.n <= BROADCAST_SOURCES else sources
    time = lambda words: F.when(F.col("target") > 0, words / F.col("target")).otherwise(0.0)

    # chunks: the equal rows of one partition; words of the source before each, by cells in the seeded order
    chunks = rows.groupBy("source", "order_key", "part", "size").agg(F.count("*").alias("n"))
    chunks = chunks.join(side, chunks["source"].eqNullSafe(side["source"]), "left").select(
        chunks["*"], *[side[c] for c in ("source_size", "n_rows", "source_rank", "target")])
    place = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    chunks = chunks.withColumn("cell", F.floor(place * F.ceil(F.col("n_rows") / cell_rows) / F.lit(1 << 32)))
    words = F.col("n") * F.col("size")
    earlier = Window.partitionBy("source_rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = chunks.groupBy("source_rank", "cell").agg(F.sum(words).alias("cell_words"))
    cells = cells.select("source_rank", "cell", F.coalesce(F.sum("cell_words").over(earlier), F.lit(0)).alias("cell_before"))
    inside = Window.partitionBy("source_rank", "cell").orderBy("order_key", "part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.join(cells, ["source_rank", "cell"]).withColumn(
        "before", F.col("cell_before") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
    chunks = chunks.select("source", "order_key", "part", "before", "source_rank", "source_size", "target")
    among = Window.partitionBy(chunks["source_rank"], rows["order_key"], rows["part"]).orderBy("mix_id")
    at = [rows["source"].eqNullSafe(chunks["source"]), rows["order_key"] == chunks["order_key"], rows["part"] == chunks["part"]]
    narrow = rows.join(chunks, at).select(
        "mix_id", rows["order_key"], "size", "source_rank", "source_size", "target",
        (F.col("before") + F.row_number().over(among) * F.col("size")).alias("queue_words"))
    narrow = materialize(narrow, "mix-queues")

    # where the budget ends: sums by bins of time, then a running sum inside the one bin that crosses it
    copy = F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("copy")
    copies = narrow.select("*", copy).withColumn(
        "at", time(F.col("queue_words") + F.col("copy") * F.col("source_size")))
    bins = max(1, n_rows // cell_rows)
    copies = copies.withColumn("bin", F.least(F.floor(F.col("at") * bins), F.lit(4 * bins)))
    so_far = Window.orderBy("bin")
    sums = copies.groupBy("bin").agg(F.sum("size").alias("words")).withColumn("until", F.sum("words").over(so_far))
    crossing = sums.where(F.col("until") > budget).orderBy("bin").select("bin", F.col("until") - F.col("words")).first()
    keys = ["order_key", "queue_words"]
    total_order = ["at", "source_rank", *keys, "copy"]
    if crossing is None:  # the budget is not reached
        taken = F.lit(passes)
    else:
        inside = Window.partitionBy("bin").orderBy(*total_order).rowsBetween(Window.unboundedPreceding, 0)
        first_left = (copies.where(F.col("bin") == crossing[0]).withColumn("run", F.sum("size").over(inside) + crossing[1])
                      .where(F.col("run") > budget).orderBy(*total_order).select(*total_order).first())
        end = F.struct(*[F.lit(first_left[c]).cast(copies.schema[c].dataType).alias(c) for c in total_order])
        taken = sum(F.when(F.struct(time(F.col("queue_words") + k * F.col("source_size")).alias("at"), F.col("source_rank"),
                                    *keys, F.lit(k).alias("copy")) < end, 1).otherwise(0) for k in range(passes))
    plan = narrow.select("mix_id", "size", "source_size", "target", taken.cast("int").alias("copies"), time(F.col("queue_words")).alias("finish"))
    return Mix(staged.select("mix_id", row), plan, row, path)


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        share: float = 1.5, passes: int = 2, seed: int = 17, carry: list[str] | None = None) -> DataFrame:
    """Adds size, source_size, target, copies, taken and finish to every row of ``df``.

    size: words of the text (null: 0).  copies: how often the mix takes the row
    (0 to ``passes``); taken = copies * size.  finish: virtual finish time of its
    first copy.  The order within a source is that of md5(seed:doc_id:md5 of the
    text); rows alike in these follow each other and are taken one by one, so
    which of them is taken does not matter.  A null source is a source of its
    own, a null id is an id like others.  Documents without words take part
    with size 0; sources without words have target 0 and are taken whole at time
    0.  An empty table gives an empty result.  Input columns named like the
    added ones are replaced, all others stay, or only those of ``carry``.
    """
    added = {"size", "source_size", "target", "copies", "taken", "finish"} - {doc_id.lower(), text.lower(), source.lower()}
    planned = plan_mix(without(df, *added), doc_id, text, source, share, passes, seed, carry)
    return planned.rows.join(planned.plan, "mix_id").select(
        f"{planned.row}.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "finish")


def _copies(plan: DataFrame) -> DataFrame:
    """Planned rows as often as they are taken, with the finish time of each copy."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    time = F.col("finish") + (F.col("copy") - 1) * F.col("source_size") / F.col("target")
    return plan.where("copies > 0").select("*", copy).withColumn("finish", F.when(F.col("target") > 0, time).otherwise(0.0))


def mixture(df: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: each row as often as it is taken, in order of virtual finish time (globally sorted)."""
    planned = plan_mix(df, **options)
    return planned.rows.join(_copies(planned.plan), "mix_id").orderBy("finish", "mix_id").select(f"{planned.row}.*")


def write_mixture(planned: Mix, path: str, release: bool = False) -> None:
    """Writes ``mixture`` as Parquet folders ``path/stretch=N``, one stretch of time after another, with the rows' mix_id.

    Rows are picked once, then sorted a stretch at a time, so that the sort's files hold a part of the texts only; the
    rows of all stretches in their order are the mixture.  With ``release`` the plan's written rows are removed as soon
    as those that the mix takes are picked.
    """
    spark = planned.rows.sparkSession
    with Scratch(spark) as scratch, sparing_disk(spark):
        rows = scratch.write(planned.rows.join(planned.plan.where("copies > 0").drop("size"), "mix_id"), "mix-rows")
        if release:
            delete_path(spark, planned.path)
        times = _copies(rows.select("copies", "finish", "source_size", "target"))
        cuts = times.agg(F.percentile_approx("finish", [k / STRETCHES for k in range(1, STRETCHES)], 1000)).first()[0] or []
        edges = [None, *sorted(set(cuts)), None]
        for n, (low, high) in enumerate(zip(edges, edges[1:])):
            part, time = _copies(rows), F.col("finish")
            part = part if low is None else part.where(time > low)
            part = part if high is None else part.where(time <= high)
            (part.orderBy("finish", "mix_id").select(f"{planned.row}.*", "mix_id")
             .write.mode("errorifexists").parquet(f"{path}/stretch={n}"))


def taken_words(planned: Mix, own: DataFrame, mixed: DataFrame, text: str = "text") -> DataFrame:
    """``own`` (mix_id, ...) with size, source_size, target and taken instead of mix_id: the words that each row has in
    the written mixture ``mixed``."""
    words = mixed.select("mix_id", n_words(F.col(quoted(text))).alias("words")).groupBy("mix_id").agg(F.sum("words").alias("taken"))
    return (own.join(planned.plan.select("mix_id", "size", "source_size", "target"), "mix_id")
            .join(words, "mix_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0))).drop("mix_id"))


#: The query's rows in DuckDB: whole windows instead of cells, a row for every document.
ORACLE = """
WITH sized AS (
  SELECT row_number() OVER () AS id, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS order_key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
        FROM sized GROUP BY source),
weighted AS (SELECT *, CASE source_rank % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM src),
ratios AS (SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS ratio FROM weighted),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER before, 0))
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
           FROM ratios WINDOW before AS (ORDER BY ratio, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_rank, source_size, least(CAST(2 * source_size AS DOUBLE), weight * coalesce(
           (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source_rank LIMIT 1), 0)) AS target FROM levels),
queued AS (
  SELECT s.*, g.source_rank, g.source_size, g.target,
         sum(size) OVER (PARTITION BY g.source_rank ORDER BY order_key, id ROWS UNBOUNDED PRECEDING) AS queue_words
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(queue_words + copy * source_size AS DOUBLE) / target ELSE 0 END AS moment
  FROM queued, (VALUES (0), (1)) AS c(copy)),
runs AS (SELECT *, sum(size) OVER (ORDER BY moment, source_rank, order_key, queue_words, copy, id ROWS UNBOUNDED PRECEDING) AS run FROM copies)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN run <= 1.5 * (SELECT sum(size) FROM sized) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM runs GROUP BY id, doc_id, size, source_size, target
"""
