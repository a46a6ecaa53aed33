"""Byte-level BPE: speculate with greedy longest matches, verify adjacent pairs, merge exactly only on failure.

A byte-level BPE vocabulary assigns ids in the order of its merges, so a token's
id is also the time at which it comes into being.  A sequence of tokens is the
encoding of its bytes exactly when every token encodes to itself and every
adjacent pair is *compatible* (no merge across the boundary would have happened
before the two sides were complete).  Hence:

1. ``propose``   longest match over a trie, all words of a batch at once;
2. ``compatible`` tests all adjacent pairs of the batch at once;
3. ``merge_equal`` exact merging, for words with a failing pair only (``merge_long``
   for those of many bytes).

Words (pre-tokens) repeat, so each worker keeps the encodings of recent distinct
words in a cache of bounded size; a miss costs work, never a different result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm.common import importable, release, without

#: Fixed value: how text splits before the merges; white space is Unicode's White_Space property.
PRETOKEN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"""
            r"""|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""")
NEVER = np.int64(1) << 40
#: Distinct words whose encodings a worker keeps (some 200 bytes each).
CACHE_WORDS = 200_000
#: Bytes up to which failing words are merged in rows of a matrix.
LONG_WORD = 64


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in vocabulary files: itself if printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Codec of one vocabulary file (tokenizers' JSON, byte-level, ids in merge order)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * self.size
        for word, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in word)
        for word, i in self.special.items():
            self.token_bytes[i] = word.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]

        # splits: what two tokens a token is made of (a single byte: itself twice); born: the time it comes into being
        self.left = np.arange(self.size, dtype=np.int64)
        self.right = np.arange(self.size, dtype=np.int64)
        self.born = np.full(self.size, -1, np.int64)
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            i, l, r = vocab[a + b], vocab[a], vocab[b]
            self.merged.setdefault((l, r), (rank, i))
            if self.born[i] < 0:
                self.born[i], self.left[i], self.right[i] = rank, l, r
        keys = np.array([l << 20 | r for l, r in self.merged], np.int64)
        order = np.argsort(keys)
        self.pair_key = keys[order]
        self.pair_rank = np.array([v[0] for v in self.merged.values()], np.int64)[order]
        self.pair_token = np.array([v[1] for v in self.merged.values()], np.int64)[order]

        self.length = np.array([len(t) for t in self.token_bytes], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self._build_trie({i for i in vocab.values()})
        # a token encodes to itself if its halves do and meet nothing earlier than its own merge
        made = np.flatnonzero(self.born >= 0)
        self.whole = np.ones(self.size, bool)
        self.whole[made] = self._quiet(self.left[made], self.right[made], self.born[made])
        for i in made[np.argsort(self.born[made])]:
            self.whole[i] &= self.whole[self.left[i]] and self.whole[self.right[i]]

        self.pretoken = regex.compile(PRETOKEN)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def _build_trie(self, ids: set[int]) -> None:
        nodes: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in sorted(ids):
            at = 0
            for b in self.token_bytes[i]:
                at = nodes.setdefault((at, b), len(ends))
                if at == len(ends):
                    ends.append(-1)
            ends[at] = i
        keys = np.array([n << 8 | b for n, b in nodes], np.int64)
        order = np.argsort(keys)
        self.edge_key, self.edge_to = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.ends = np.array(ends, np.int64)

    def _rank(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        key = l << 20 | r
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def _quiet(self, l: np.ndarray, r: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Whether nothing merges across the boundary of ``l`` and ``r`` before time ``until``.

        Walks back in time: the younger side (the right one, if both are of one
        age, as merges go from left to right) splits, and its half at the
        boundary must not have merged with the other side before that.
        """
        l, r, until = l.copy(), r.copy(), until.copy()
        good = np.ones(len(l), bool)
        live = np.arange(len(l))
        while len(live):
            a, b = l[live], r[live]
            clash = self._rank(a, b) < until[live]
            good[live[clash]] = False
            on = ~clash & ((self.born[a] >= 0) | (self.born[b] >= 0))
            live, a, b = live[on], a[on], b[on]
            back = self.born[a] > self.born[b]
            until[live] = np.where(back, self.born[a], self.born[b] + 1)
            l[live] = np.where(back, self.right[a], a)
            r[live] = np.where(back, b, self.left[b])
        return good

    def compatible(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """For adjacent proposed tokens: whether exact merging leaves this boundary in place."""
        return self._quiet(l, r, np.full(len(l), NEVER)) & self.whole[l] & self.whole[r]

    def propose(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches over ``data[begin[i]:end[i]]``: (word index, token), in order."""
        at, found_word, found_token = begin.copy(), [], []
        live = np.flatnonzero(at < end)
        while len(live):
            node, pos, stop = np.zeros(len(live), np.int64), at[live], end[live]
            best, best_pos = np.full(len(live), -1), pos.copy()
            walk = np.arange(len(live))
            while len(walk):
                key = node[walk] << 8 | data[pos[walk]]
                e = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
                on = self.edge_key[e] == key
                walk, e = walk[on], e[on]
                node[walk] = self.edge_to[e]
                pos[walk] += 1
                hit = self.ends[node[walk]]
                best[walk] = np.where(hit >= 0, hit, best[walk])
                best_pos[walk] = np.where(hit >= 0, pos[walk], best_pos[walk])
                walk = walk[pos[walk] < stop[walk]]
            found_word.append(live)
            found_token.append(best)
            at[live] = best_pos
            live = live[at[live] < end[live]]
        if not found_word:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        word, token = np.concatenate(found_word), np.concatenate(found_token)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def merge_equal(self, words: list[bytes]) -> np.ndarray:
        """Exact encodings of words of one byte length, all at once (a row each, ended by -1s):
        the earliest merge, leftmost first, until none applies."""
        parts = self.byte_id[np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)]
        out = np.full(parts.shape, -1, np.int64)
        rows, key = np.arange(len(words)), parts[:, :-1] << 20 | parts[:, 1:]
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        time = np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)
        while len(rows):
            width = parts.shape[1]
            here = time.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            mine = np.arange(len(rows))
            on = time[mine, here] < NEVER if width > 1 else np.zeros(len(rows), bool)
            if not on.all():
                out[rows[~on], :width] = parts[~on]
                rows, parts, time, here = rows[on], parts[on], time[on], here[on]
                mine = np.arange(len(rows))
            if not len(rows):
                break
            parts[mine, here] = self._joined(parts[mine, here], parts[mine, here + 1])
            keep = np.arange(width - 1)[None, :]
            parts = np.take_along_axis(parts, keep + (keep > here[:, None]), 1)
            keep = keep[:, :-1]
            time = np.take_along_axis(time, keep + (keep >= here[:, None]), 1) if width > 2 else time[:, :0]
            for side in (here - 1, here):  # the pairs that the new token is in
                there = np.flatnonzero((side >= 0) & (side < width - 2))
                i = side[there]
                time[there, i] = self._rank(parts[there, i], parts[there, i + 1])
        return out

    def _joined(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        return self.pair_token[np.searchsorted(self.pair_key, l << 20 | r)]

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one long word: a heap of pending merges over a linked list, n log n."""
        n = len(word)
        parts = [int(self.byte_id[b]) for b in word]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, ...]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (m := self.merged.get((parts[i], parts[after[i]]))):
                heapq.heappush(heap, (m[0], i, parts[i], parts[after[i]], m[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, token = heapq.heappop(heap)
            j = after[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = token, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def learn(self, words: list[str]) -> None:
        """Put the encodings of these distinct words into the cache."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        end = np.cumsum(size)
        word, token = self.propose(np.frombuffer(b"".join(raw), np.uint8).astype(np.int64), end - size, end)
        inner = np.flatnonzero(word[1:] == word[:-1])
        good = np.ones(len(raw), bool)
        good[word[~self.whole[token]]] = False
        if len(inner):
            pairs, where = np.unique(token[inner] << 20 | token[inner + 1], return_inverse=True)
            fine = self.compatible(pairs >> 20, pairs & 0xFFFFF)
            good[word[inner[~fine[where]]]] = False
        flat = token.astype("<i4").tobytes()
        stop = np.cumsum(np.bincount(word, minlength=len(raw))) * 4
        cut = [0, *stop.tolist()]
        for i, w in enumerate(words):
            self.cache[w] = flat[cut[i]:cut[i + 1]]
        bad = np.flatnonzero(~good)
        bad = bad[np.argsort(size[bad], kind="stable")]
        for same in np.split(bad, np.flatnonzero(np.diff(size[bad])) + 1):
            if len(same) and size[same[0]] <= LONG_WORD:
                exact = self.merge_equal([raw[i] for i in same])
                flat, cut = exact[exact >= 0].astype("<i4").tobytes(), (4 * np.cumsum((exact >= 0).sum(1))).tolist()
                for i, a, b in zip(same.tolist(), [0, *cut], cut):
                    self.cache[words[i]] = flat[a:b]
            else:
                for i in same:
                    self.cache[words[i]] = np.array(self.merge_long(raw[i]), "<i4").tobytes()

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens stay whole."""
        if self.special_split is None or not any(s in text for s in self.special):
            return self.pretoken.findall(text)
        out = []
        for part in self.special_split.split(text):
            out += [part] if part in self.special else self.pretoken.findall(part)
        return out

    def encode(self, texts: list[str | None], chunk_chars: int = 1_000_000) -> Iterator[np.ndarray]:
        """Ids of each text (null: empty), whole texts, a million characters at a time."""
        for word, i in self.special.items():
            self.cache[word] = np.array([i], "<i4").tobytes()
        at = 0
        while at < len(texts):
            first, chars = at, 0
            while at < len(texts) and (at == first or chars < chunk_chars):
                chars += len(texts[at] or "")
                at += 1
            split = [self.split(t) if t else [] for t in texts[first:at]]
            if len(self.cache) > CACHE_WORDS:
                self.cache = {w: self.cache[w] for w in self.special}
            new = {w for words in split for w in words} - self.cache.keys()
            if new:
                self.learn(list(new))
            for words in split:
                yield np.frombuffer(b"".join(map(self.cache.__getitem__, words)), "<i4")

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens, gathered from the table of all tokens."""
        size = self.length[ids]
        shift = np.repeat(self.start[ids] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(ids) else ids
        return self.blob[shift + np.arange(len(shift))]

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes_of(ids).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def _with(df: DataFrame, source: str, added: dict[str, T.DataType], convert) -> DataFrame:
    """``df`` with the ``added`` columns made from column ``source`` by ``convert(array) -> arrays``."""
    importable(df.sparkSession)
    df = without(df, *{n.lower() for n in added} - {source.lower()})
    place = next(i for i, c in enumerate(df.columns) if c.lower() == source.lower())
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in added.items()]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*part.columns, *convert(part.column(place))], names=[*part.schema.names, *added])
        release()

    return df.mapInArrow(task, schema)


def _encoded(path: str, column: pa.Array) -> pa.Array:
    parts = list(codec(path).encode(column.to_pylist()))
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _decoded(path: str, column: pa.Array) -> pa.Array:
    c = codec(path)
    whole = (x if isinstance(x, np.ndarray) else np.array([i for i in x or [] if i is not None], np.int64) for x in _lists(column))
    return pa.array([c.decode(x) for x in whole], pa.string())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds column ``ids`` (array<int>): the encoding of the whole text, as the vocabulary's own library gives it.

    A null text counts as empty: no ids.  Strings of the vocabulary's special
    tokens become those tokens.  An input column named like ``ids`` is replaced;
    every other column and every row (repeats too) stays.  ``path`` must exist on
    every executor.
    """
    return _with(df, text, {ids: T.ArrayType(T.IntegerType())}, lambda column: [_encoded(path, column)])


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds column ``text``: the text of a sequence of ids, special tokens included.

    Null or no ids give the empty text, null ids inside the array are left out;
    bytes that are no UTF-8 become U+FFFD.
    """
    return _with(df, ids, {text: T.StringType()}, lambda column: [_decoded(path, column)])


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one Python task, with one vocabulary in memory."""
    def both(column: pa.Array) -> list[pa.Array]:
        found = _encoded(path, column)
        return [found, _decoded(path, found)]

    return _with(df, text, {ids: T.ArrayType(T.IntegerType()), decoded: T.StringType()}, both)


def _lists(column: pa.Array) -> Iterator:
    """The values of a list array, as numpy slices where nothing is null."""
    flat, cut = column.values, column.offsets.to_numpy()
    if flat.null_count:
        yield from column.to_pylist()
        return
    values = flat.to_numpy(zero_copy_only=False)
    for i, there in enumerate(column.is_valid().to_pylist()):
        yield values[cut[i]:cut[i + 1]] if there else None


def digests(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, by ``encode_decode``."""
    coded = encode_decode(df.select("doc_id", "text"), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
