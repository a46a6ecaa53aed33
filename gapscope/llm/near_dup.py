"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded, verified.

A text is the set of its five-word shingles, each with a dampened TF-IDF weight.
Improved consistent weighted sampling draws ``SAMPLES`` (shingle, level) pairs
per text such that two texts draw the same pair with the probability of their
weighted Jaccard similarity; bands of ``ROWS`` samples are the keys of buckets.

Groups may be huge, so no bucket is ever expanded into its pairs.  Equal texts
count as one node.  First every node of a bucket is held against one centre, the
node that meets most others over all its buckets (the original that copies were
made from); then, only where a bucket still spans several components, nodes
outside its largest component are compared by their samples, block by block, and
pairs that may be similar enough are verified too.  Verification computes the
weighted Jaccard similarity of the whole texts; components of verified links are
the classes.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscope.llm.common import free_name, importable, quoted, release
from gapscope.session import Scratch, materialize

WORDS = 5
SIMILAR = 0.8
ROWS, BANDS = 4, 16
SAMPLES = ROWS * BANDS
#: How much frequency within a text and rarity among texts move a weight from 1: at most to 1.1 for rarity,
#: so that 0.8 means nearly what it means without weights, in groups of copies of any size.
DAMPING = 0.1
#: Document frequencies are counted in several rows of hash buckets, a table of fixed size: what other shingles bring to
#: a bucket is known on average and taken off, and the middle of a shingle's rows is not moved by one frequent neighbour.
DF_ROWS, DF_BITS = 4, 16
DF_BUCKETS = DF_ROWS << DF_BITS
#: Nodes of a bucket that are compared at once by samples, and the share of equal samples from which a pair is verified:
#: a pair at a similarity of 0.8 has fewer with a probability of 1e-10, next to the 2e-4 with which it shares no band.
BLOCK, MAYBE = 256, 0.45
#: Nodes up to which their list (some 50 bytes each) is broadcast to pick their texts; beyond, it is a shuffled join.
BROADCAST_NODES = 400_000
#: Shingles that are worked on at once, and distinct words whose hashes a worker keeps.
CHUNK, CACHE_WORDS = 100_000, 250_000
#: Shingles of nodes that a verifying task keeps.
KEPT = 2_000_000

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


_word_hash = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a whole text and their counts; a text of 1 to 4 words has one shingle, of none none."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # splits at the six characters between words
    h = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h, np.empty(0, np.int64)
    n = max(1, len(h) - WORDS + 1)
    g = np.full(n, _U(len(h) if len(h) < WORDS else WORDS))
    for i in range(min(WORDS, len(h))):
        g = _mixed(g * _MULT + h[i:i + n])
    g.sort()
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    return g[first], np.diff(first, append=n)


def df_buckets(h: np.ndarray) -> list[np.ndarray]:
    """A bucket in each row for every shingle hash; the rows use different bits."""
    low = (1 << DF_BITS) - 1
    return [(row << DF_BITS) + (h >> _U(row * DF_BITS) & _U(low)).astype(np.int64) for row in range(DF_ROWS)]


def rarities(found: np.ndarray, n: int) -> np.ndarray:
    """log(N / df) / log(N) by bucket, from 1 (in one text) to 0 (in all), of the ``found`` texts of each bucket among ``n``.

    A text hits a bucket by another of its shingles with the chance that the row's average shows, so df is estimated
    as (found - average) / (1 - average / N): without a bias that grows with the corpus, and never above found.
    """
    n, rows = max(2.0, n), found.reshape(DF_ROWS, -1).astype(float)
    average = np.minimum(rows.mean(axis=1, keepdims=True), n * 0.999)
    df = np.clip((rows - average) / (1 - average / n), 1, n)
    return np.clip(np.log(n / df) / np.log(n), 0, 1).astype(np.float32).ravel()


def rarity_of(h: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Mean of the middle two of a shingle's four rows."""
    a, b, c, d = (rarity[bucket] for bucket in df_buckets(h))
    low, high = np.minimum(np.minimum(a, b), np.minimum(c, d)), np.maximum(np.maximum(a, b), np.maximum(c, d))
    return np.clip((a + b + c + d - low - high) / 2, 0, 1)


def weights(h: np.ndarray, tf: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return (1 + DAMPING * np.log(tf)) * (1 + DAMPING * rarity_of(h, rarity))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the weighted and the plain Jaccard similarity of two (sorted hashes, weights):
    at the threshold, weights add links and never cost one that the shingles alone would give."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    common = np.minimum(a[1][same], b[1][at[same]]).sum()
    weighted, n = common / (a[1].sum() + b[1].sum() - common), same.sum()
    return float(max(weighted, n / (len(a[0]) + len(b[0]) - n)))


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, ...]:
    """Fixed random draws that shingles pick from by hash: start value, r, 1/r, beta; and the samples' multipliers."""
    rng = np.random.default_rng(20)
    n = 1 << 16
    r, c, beta = rng.gamma(2, 1, n), rng.gamma(2, 1, n), rng.random(n)
    odd = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
    return (*((x.astype(np.float32)) for x in (np.log(c) - r + r * beta, r, 1 / r, beta)), odd)


def sample(h: np.ndarray, w: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Samples (texts x SAMPLES, uint32) of several texts, whose (not empty) shingles begin at ``start``."""
    base, r, inverse, beta, odd = _draws()
    log_w, low = np.log(w).astype(np.float32), h.astype(np.uint32)
    out = np.empty((len(start), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        pick = ((h * odd[k]) >> _U(48)).astype(np.int64)
        level = np.floor(log_w * inverse[pick] + beta[pick])
        value = (base[pick] - r[pick] * level).view(np.int32)
        value ^= (value >> 31) & 0x7FFFFFFF  # now in the order of the floats
        mark = low ^ (level.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
        both = value.astype(np.int64) << 32 | mark
        out[:, k] = np.minimum.reduceat(both, start).astype(np.uint32)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """Bucket keys (texts x BANDS, int64)."""
    out = np.empty((len(samples), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(samples), _U(b + 1))
        for i in range(b * ROWS, (b + 1) * ROWS):
            key = _mixed(key * _MULT + samples[:, i])
        out[:, b] = key
    return out.view(np.int64)


def rarity_table(docs: DataFrame) -> np.ndarray:
    """``rarities`` by hash bucket, counted over every row of ``docs`` (text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(DF_BUCKETS + 1, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for text in batch.column(0).slice(at, 1000).to_pylist():
                    h, _ = shingles(text)
                    if len(h):
                        for buckets in df_buckets(h):
                            found[buckets] += 1  # once for each text
                        n += 1
        found[-1] = n
        _word_hash.clear()
        release()
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(found[there])], names=["bucket", "n"])

    importable(docs.sparkSession)
    rows = docs.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # DF_BUCKETS + 1 rows
    found = np.zeros(DF_BUCKETS + 1, np.int64)
    found[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return rarities(found[:-1], found[-1])


def _grouped(texts: list[str | None], rarity: np.ndarray) -> Iterator[tuple[list[int], np.ndarray]]:
    """(places, samples) of the texts that have shingles, some shingles at a time."""
    places, hs, ws, total = [], [], [], 0
    for i, text in enumerate(texts):
        h, tf = shingles(text)
        if len(h):
            places.append(i)
            hs.append(h)
            ws.append(weights(h, tf, rarity))
            total += len(h)
        if total and (total >= CHUNK or i == len(texts) - 1):
            start = np.cumsum([0, *map(len, hs[:-1])])
            yield places, sample(np.concatenate(hs), np.concatenate(ws), start)
            places, hs, ws, total = [], [], [], 0
    if total:
        yield places, sample(np.concatenate(hs), np.concatenate(ws), np.cumsum([0, *map(len, hs[:-1])]))


def signatures(docs: DataFrame, rarity) -> DataFrame:
    """(node, samples, bands) for rows (node, text); both null for texts without words."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                nodes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                once = list(dict(zip(nodes, texts)).items())  # copies within the batch are worked on once
                n, samples, bands = len(once), [None] * len(once), [None] * len(once)
                for places, found in _grouped([t for _, t in once], rarity.value):
                    for i, s, b in zip(places, found, band_keys(found)):
                        samples[i], bands[i] = s.tobytes(), b
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in once], pa.binary()), pa.array(samples, pa.binary()),
                                                  pa.array(bands, pa.list_(pa.int64()), size=n)], names=["node", "samples", "bands"])
        _word_hash.clear()
        release()

    return docs.mapInArrow(task, "node binary, samples binary, bands array<long>")


class _Features:
    """Shingles and weights by node, the last used kept up to ``KEPT`` shingles in all."""

    def __init__(self, rarity):
        self.rarity, self.known, self.total = rarity, OrderedDict(), 0

    def __call__(self, node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
        if node in self.known:
            self.known.move_to_end(node)
            return self.known[node]
        h, tf = shingles(text)
        self.known[node] = h, weights(h, tf, self.rarity.value)
        self.total += len(h)
        while self.total > KEPT and len(self.known) > 2:
            self.total -= len(self.known.popitem(last=False)[1][0])
        return self.known[node]


def verified(pairs: DataFrame, texts: DataFrame, rarity, similar: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole texts have a weighted Jaccard similarity of at least ``similar``."""
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(rarity)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
                good = [similarity(features(x, s), features(y, t)) >= similar for x, y, s, t in zip(a, b, ta, tb)]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
        _word_hash.clear()
        release()

    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a binary, b binary")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b): equal labels for connected nodes.

    Every round each node takes the smallest label around it, then its label's
    label; both are joins and minima over all links, until nothing changes.
    """
    both = scratch.write(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = scratch.write(both.groupBy("a").agg(F.min("b").alias("near")).select(
        F.col("a").alias("node"), F.lit(None).cast("binary").alias("was"), F.least("a", "near").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.select("node", F.col("label").alias("was")).join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "was", F.least("was", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        step = step.join(up, "label", "left").select("node", "was", F.least("label", "above").alias("label"))
        step = scratch.write(step, "labels")
        scratch.drop(labels)
        labels = step
        if step.where(F.col("was") != F.col("label")).isEmpty():
            scratch.drop(both)
            return labels


def block_links(members: DataFrame, rarity, similar: float) -> DataFrame:
    """Links (a, b) between nodes of one bucket and different components.

    ``members`` has (bucket, band, node, label, samples, text, outside, n, m): outside is
    true for the m of n nodes that are not in the bucket's largest component.  Nodes
    and outside nodes are each cut into blocks of some ``BLOCK``; every block of
    outside nodes meets every block, so a node is sent once for each ``BLOCK``
    nodes that ask, not for each that are there.  Pairs whose samples agree often enough are verified where they
    meet (in the first band that they share), so that only links leave the task,
    and of a node no more than one to each component of a block.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    asking = F.ceil(F.col("m") / BLOCK).cast("int")
    own, place = (F.pmod(F.xxhash64("node"), of).cast("int") for of in (blocks, asking))
    every, ask = (F.sequence(F.lit(0), of - 1) for of in (blocks, asking))
    rows = members.select("bucket", "band", "node", "label", "samples", "text", "outside", own.alias("own"), place.alias("place"),
                          every.alias("every"), ask.alias("ask"))
    rest = ["band", "node", "label", "samples", "text"]
    asks = rows.where("outside").select("bucket", F.col("place").alias("i"), F.explode("every").alias("j"), F.lit(True).alias("asks"), *rest)
    meets = rows.select("bucket", F.explode("ask").alias("i"), F.col("own").alias("j"), F.lit(False).alias("asks"), *rest)
    dealt = asks.unionByName(meets)
    dealt = dealt.repartition(F.col("bucket"), F.col("i"), F.col("j")).sortWithinPartitions("bucket", "i", "j")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(rarity)

        def links(group: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
            left, right = [g for g in group if g[0]], [g for g in group if not g[0]]
            if not left or not right:
                return
            theirs = np.array([np.frombuffer(r[4], np.uint32) for r in right])
            for _, band, x, mine, samples, text in left:
                same = theirs == np.frombuffer(samples, np.uint32)
                first = same.reshape(len(right), BANDS, ROWS).all(2).argmax(1)
                share, reached = same.mean(1), {mine}
                maybe = np.flatnonzero((share >= MAYBE) & (first == band))
                for j in maybe[np.argsort(-share[maybe], kind="stable")]:
                    _, _, y, label, _, other = right[j]
                    if label not in reached and similarity(features(x, text), features(y, other)) >= similar:
                        reached.add(label)
                        yield min(x, y), max(x, y)

        def batch_of(found: set) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

        key, group, found = None, [], set()
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            for bucket, i, j, *rest in zip(*[batch.column(c).to_pylist() for c in range(9)]):
                if (bucket, i, j) != key:
                    found.update(links(group))
                    key, group = (bucket, i, j), []
                    if len(found) > 20_000:
                        yield batch_of(found)
                        found = set()
                group.append(tuple(rest))
        found.update(links(group))
        _word_hash.clear()
        release()
        yield batch_of(found)

    return dealt.mapInArrow(task, "a binary, b binary").distinct()


def node_of(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(node, label) of the texts of ``docs`` (text) that are similar to another text; a node is the md5 of a text."""
    spark = docs.sparkSession
    importable(spark)
    rarity = spark.sparkContext.broadcast(rarity_table(docs.select("text")))
    noded = docs.select(node_of(F.col("text")).alias("node"), "text")
    with Scratch(spark) as scratch:
        signed = scratch.write(signatures(noded, rarity).where(F.col("bands").isNotNull())
                               .groupBy("node").agg(F.first("samples").alias("samples"), F.first("bands").alias("bands")), "signatures")
        banded = signed.select("node", F.posexplode("bands").alias("band", "bucket"))
        sizes = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        shared = scratch.write(banded.join(sizes, "bucket"), "buckets")

        # first: every node against its bucket's centre
        weight = shared.groupBy("node").agg(F.sum("n").alias("met"))
        centre = shared.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("met", "node"))["node"].alias("centre"))
        tried = shared.join(centre, "bucket").where(F.col("node") != F.col("centre")).select(
            F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
        tried = scratch.write(tried, "pairs")
        nodes = scratch.write(weight.select("node"), "nodes")
        wanted = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
        texts = scratch.write(noded.join(wanted, "node").dropDuplicates(["node"]), "texts")
        links = scratch.write(verified(tried, texts, rarity, similar), "links")
        labels = components(links, scratch)

        # then: what is left of buckets that span several components
        labelled = shared.join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("m"))
        spans = parts.groupBy("bucket").agg(
            F.max(F.struct("m", "label"))["label"].alias("largest"), (F.sum("m") - F.max("m")).alias("m"),
            F.count("*").alias("parts")).where("parts > 1")
        members = labelled.where("n > 2").join(spans, "bucket").withColumn("outside", F.col("label") != F.col("largest"))
        members = members.join(signed.select("node", "samples"), "node").join(texts, "node").select(
            "bucket", "band", "node", "label", "samples", "text", "outside", "n", "m")
        more = scratch.write(block_links(members, rarity, similar), "links")
        if not more.isEmpty():
            labels = components(links.union(more), scratch)
        return scratch.keep(labels).select("node", "label")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id) for every row: class_id is the smallest doc_id among the documents of one class.

    A class is a component of links between documents whose five-word shingles
    have a Jaccard similarity, dampened TF-IDF weighted or plain, of at least
    ``similar``; equal texts are always linked.  Null texts count as empty; texts without
    words are like their equals only; texts of 1 to 4 words are one shingle.
    Repeated rows stay, each with its class; null ids are members but never
    name a class that has another id.  An empty table has no classes.
    """
    rows = df.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    labels = classes(rows.select("text"), similar)
    members = rows.select("doc_id", node_of(F.col("text")).alias("node"))
    # a node's smallest id, then its class's: copies are counted together before anything is joined
    least = members.groupBy("node").agg(F.min("doc_id").alias("least")).join(labels, "node", "left").select(
        "node", "least", F.coalesce("label", "node").alias("label"))
    least = materialize(least, "nodes")
    ids = least.groupBy("label").agg(F.min("least").alias("class_id"))
    named = least.join(ids, "label").select("node", "class_id")
    return members.join(named, "node").select("doc_id", "class_id")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row of every class, that of its smallest doc_id (any one of rows that repeat it), with the columns of ``df``."""
    columns = [quoted(c) for c in df.columns]
    labels = classes(df.select(F.col(quoted(text)).alias("text")), similar)
    node, best = free_name(df, "dup_node"), free_name(df, "dup_best")
    rows = df.withColumn(node, node_of(F.col(quoted(text))))
    first = F.min(F.struct(F.col(quoted(doc_id)).isNull().alias("none"), F.col(quoted(doc_id)).alias("id")))
    least = rows.groupBy(node).agg(first.alias("least")).join(labels.withColumnRenamed("node", node), node, "left")
    least = materialize(least.withColumn("label", F.coalesce("label", node)), "nodes")
    kept = least.groupBy("label").agg(F.min(F.struct("least", node)).alias(best)).select(
        F.col(f"{best}.{node}").alias(node), F.col(f"{best}.least.id").alias(best))
    return (rows.join(kept, node).where(F.col(quoted(doc_id)).eqNullSafe(F.col(best)))
            .dropDuplicates([node]).select(*columns))
