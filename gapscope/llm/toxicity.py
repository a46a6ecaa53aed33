"""Toxicity: support vector machine with a subsequence string kernel, over Nyström landmarks.

The kernel sees windows: every run of words of a sentence with at most ``WINDOW``
letters together, single words included, as its letters between marks of the two
ends; blanks and signs within fall away, so that an insult split into chunks or
spelled out is the same window as the plain one.  Two windows are alike by the
letter triples that they hold in order, with up to ``GAP`` letters in between;
every letter of a gap costs a factor ``DECAY``.  So a window with letters put in or
left out stays close to the plain one.  The kernel is normalised by the windows'
lengths and evaluated at ``LANDMARKS`` windows only (Nyström); the machine is
linear in these features.

A sentence is decided by its worst window, a document by its worst sentence.
Labels are of documents: all sentences of a clean document are clean, and of a
toxic one at least one is toxic, which one is found in rounds (each round labels
the sentence that the machine of the round before finds worst; the first, the one
with the word most typical of toxic documents).  The machine is trained on the
worst windows of labelled sentences, and on toxic ones with letters put in.

At scoring time the machine's sum over landmarks is folded into one weight per
hashed triple.  Weights of triples are added up along the letters of a text, and a
window's value is a difference of such sums, whatever its length.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscope.llm.common import importable, learning_labels, quoted, release, without

#: Bound of the labelled documents that are learned from, per label.
SAMPLE = 1500
#: Sentences of a labelled document that are learned from at most.
SENTENCES = 5000
GAP, DECAY = 2, 0.7
#: Letters of a window; a longer word is cut into windows of as many letters, each beginning ``STEP`` letters later.
WINDOW, STEP = 16, 6
#: Letters that a window needs to be judged.
LEAST = 3
LANDMARKS = 280
#: Share of toxic documents that scores are calibrated to: above the usual, as a miss is worse than a false alarm.
SHARE = 0.4
HASHED = 1 << 18
ROUNDS = 4
#: Characters and windows that are judged at once.
BATCH_CHARS, BATCH_WORDS = 400_000, 60_000
_SENTENCE = re.compile(r"[.!?\n]+")
_SIGNS = re.compile(r"[\W_]+")
_SIGN, _BLANK, _LINE, _STOP = range(4)
_FIRST, _SECOND, _THIRD = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x9E3779B1)


@functools.cache
def folding() -> np.ndarray:
    """By code point: the letter or digit in lower case, or what else it is."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (one := chr(c)).isalnum():
            low = one.lower()
            table[c] = ord(low[0])
    table[[32, 9, 11, 12, 13]] = _BLANK
    table[10] = _LINE
    table[[ord(c) for c in ".!?"]] = _STOP
    return table


@dataclass
class Letters:
    """The letters of a text, and its words (long ones cut) as places among them."""

    code: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray  # number of the sentence a word is in
    begins: np.ndarray  # the word begins where it starts (not so for later cuts of a long one)
    ends: np.ndarray
    at: np.ndarray  # place of the word's first letter in the text

    @classmethod
    def of(cls, text: str) -> Letters:
        kind = folding()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        place = np.flatnonzero(kind > _STOP)
        line, blank = kind == _LINE, kind == _BLANK
        breaks = line.copy()
        breaks[1:] |= blank[1:] & (kind[:-1] == _STOP)
        word = np.cumsum(line | blank)[place]
        start = np.flatnonzero(np.diff(word, prepend=-1))
        end = np.append(start[1:], len(place))
        cuts = np.maximum(0, -(-(end - start - WINDOW) // STEP)) + 1 if len(start) else start
        of = np.repeat(np.arange(len(start)), cuts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        begin = start[of] + nth * STEP
        stop = np.minimum(begin + WINDOW, end[of])
        return cls(kind[place], begin, stop, np.cumsum(breaks)[place[start]][of], nth == 0, stop == end[of], place[start][of])

    def windows(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of all windows that begin with one of the words ``first`` to ``last`` - 1."""
        from_, to, word = [], [], np.arange(first, last)
        for more in range(WINDOW):
            word = word[word + more < len(self.start)]
            other = word + more
            fits = (self.end[other] - self.start[word] <= WINDOW) & (self.sentence[other] == self.sentence[word])
            if more:  # cuts of long words are windows of their own only
                fits &= self.begins[word] & self.ends[word] & self.begins[other] & self.ends[other]
            word = word[fits]
            if not len(word):
                break
            from_.append(word)
            to.append(word + more)
        if not from_:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        from_, to = np.concatenate(from_), np.concatenate(to)
        enough = self.end[to] - self.start[from_] >= LEAST
        return from_[enough], to[enough]

    def window(self, first: int, last: int) -> str:
        letters = "".join(map(chr, self.code[self.start[first]:self.end[last]]))
        return "^" * int(self.begins[first]) + letters + "$" * int(self.ends[last])


def all_windows(text: str) -> list[str]:
    """The windows of a text."""
    read = Letters.of(text)
    return [read.window(a, b) for a, b in zip(*read.windows(0, len(read.start)))]


def pieces(word: str) -> list[str]:
    """The windows of a single word."""
    word = word if word.isalnum() else _SIGNS.sub("", word)
    if len(word) <= WINDOW:
        return [f"^{word}$"] if len(word) >= LEAST else []
    cuts = range(0, len(word) - WINDOW + STEP, STEP)
    return ["^" * (i == 0) + word[i:i + WINDOW] + "$" * (i + WINDOW >= len(word)) for i in cuts]


@functools.cache
def triples(n: int, begins: bool, ends: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (3 x T) of the triples of an n-character window within the gap (not of both marks), and their weights, normalised."""
    found = [(i, j, k) for i in range(n) for j in range(i + 1, min(n, i + 2 + GAP)) for k in range(j + 1, min(n, j + 2 + GAP))
             if not (begins and ends and i == 0 and k == n - 1)]
    at = np.array(found, np.int64).reshape(-1, 3).T
    weight = DECAY ** (at[2] - at[0] - 2).astype(np.float64)
    return at, weight / np.sqrt((weight * weight).sum())


def hashed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    a, b, c = map(np.atleast_1d, (a, b, c))  # arrays overflow without a warning
    return (((a * _FIRST ^ b) * _SECOND ^ c) * _THIRD) >> np.uint32(14)


def kernel_rows(windows: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For windows of one shape at a time: their places in ``windows``, by row the triples' hashes, and the triples' weights."""
    shapes = defaultdict(list)
    for i, w in enumerate(windows):
        shapes[len(w), w[0] == "^", w[-1] == "$"].append(i)
    for shape, rows in sorted(shapes.items()):
        at, weight = triples(*shape)
        for cut in range(0, len(rows), 20_000):
            mine = np.array(rows[cut:cut + 20_000])
            code = np.frombuffer("".join([windows[i] for i in mine]).encode("utf-32-le", "surrogatepass"), "<u4")
            code = code.reshape(len(mine), shape[0]).astype(np.uint32)
            yield mine, hashed(code[:, at[0]], code[:, at[1]], code[:, at[2]]), weight


@dataclass
class Landmarks:
    """Normalised triple vectors of the landmarks, over the hashes that any of them has."""

    hashes: np.ndarray  # sorted; a last column stands for all others
    vectors: np.ndarray  # landmarks x (hashes + 1), 0 in the last column

    @classmethod
    def of(cls, words: list[str]) -> Landmarks:
        rows = list(kernel_rows(words))
        hashes = np.unique(np.concatenate([h.ravel() for _, h, _ in rows]))
        vectors = np.zeros((len(words), len(hashes) + 1), np.float32)
        for row, h, w in rows:
            np.add.at(vectors, (row[:, None], np.searchsorted(hashes, h)), np.broadcast_to(w, h.shape))
        return cls(hashes, vectors)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of windows with every landmark."""
        out, by_hash = np.zeros((len(words), len(self.vectors))), np.ascontiguousarray(self.vectors.T)
        for rows, h, w in kernel_rows(words):
            for cut in range(0, len(rows), 200):
                part = slice(cut, cut + 200)
                at = np.minimum(np.searchsorted(self.hashes, h[part]), len(self.hashes) - 1)
                at = np.where(self.hashes[at] == h[part], at, len(self.hashes))
                out[rows[part]] = np.einsum("t,rtm->rm", w, by_hash[at])
        return out

    def folded(self, amounts: np.ndarray) -> np.ndarray:
        """By hash, the landmarks' vectors summed up with these amounts."""
        out = np.zeros(HASHED, np.float32)
        out[self.hashes] = (amounts @ self.vectors)[:-1]
        return out


@dataclass
class Machine:
    """Weight by hashed triple, bias, and the line from a document's worst value to its log-odds."""

    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def values_of(self, windows: list[str]) -> np.ndarray:
        """The machine's value of every window."""
        value = np.full(len(windows), self.bias)
        for rows, h, w in kernel_rows(windows):
            value[rows] = self.weight[h] @ w + self.bias
        return value

    def judge(self, read: Letters, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The machine's value of windows of a text, from sums along its letters."""
        low = read.start[first].min()
        code = np.concatenate([np.zeros(6, np.uint32), read.code[low:read.end[last].max()], np.zeros(8, np.uint32)])
        n, gaps = len(code) - 6, 2 * GAP + 1
        sums = np.zeros((gaps, n + 1))  # by letters left out: weights of the triples that begin before a place
        for g in range(GAP + 1):
            pair = (code[:n] * _FIRST ^ code[1 + g:n + 1 + g]) * _SECOND
            for h in range(GAP + 1):
                third = code[2 + g + h:n + 2 + g + h] if 2 + g + h < 6 else np.append(code[2 + g + h:], np.zeros(2 + g + h - 6, np.uint32))
                sums[g + h, 1:] += self.weight[((pair ^ third) * _THIRD) >> np.uint32(14)]
        sums *= (DECAY ** np.arange(gaps))[:, None]
        sums = np.cumsum(sums, axis=1)
        a, b = read.start[first] - low + 6, read.end[last] - low + 6
        total = np.zeros(len(a))
        for g in range(gaps):
            total += sums[g, np.maximum(a, b - 2 - g)] - sums[g, a]
        begins, ends, size = read.begins[first], read.ends[last], b - a
        for g in range(GAP + 1):
            for h in range(GAP + 1):
                fits, decay = size >= 2 + g + h, DECAY ** (g + h)
                opening = self.weight[hashed(np.uint32(ord("^")), code[a + g], code[a + g + h + 1])]
                closing = self.weight[hashed(code[b - 2 - g - h], code[b - 1 - h], np.uint32(ord("$")))]
                total += decay * fits * (opening * begins + closing * ends)
        norm = shape_norms()[size, begins.astype(int), ends.astype(int)]
        return total / norm + self.bias

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Value of the worst window of every whole text (without any: the bias, as for a window unlike all)."""
        out = np.full(len(texts), -np.inf)
        for at, joined, begins in batches(texts):
            read = Letters.of(joined)
            for cut in range(0, len(read.start), BATCH_WORDS):
                first, last = read.windows(cut, min(cut + BATCH_WORDS, len(read.start)))
                if len(first):
                    mine = at + np.searchsorted(begins, read.at[first], "right") - 1
                    np.maximum.at(out, mine, self.judge(read, first, last))
        return np.where(np.isinf(out), self.bias, out)

    def worst_windows(self, text: str) -> list[tuple[float, str]]:
        """By sentence of a text, its worst window and that one's value."""
        best: dict[int, tuple[float, str]] = {}
        read = Letters.of(text)
        for cut in range(0, len(read.start), BATCH_WORDS):
            first, last = read.windows(cut, min(cut + BATCH_WORDS, len(read.start)))
            if len(first):
                value, sentence = self.judge(read, first, last), read.sentence[first]
                order = np.lexsort((value, sentence))
                for i in order[np.append(np.diff(sentence[order]) != 0, True)]:
                    one = float(value[i]), read.window(first[i], last[i])
                    best[sentence[i]] = max(one, best.get(sentence[i], one))
        return list(best.values())

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worst(texts) + self.offset, -30, 30)))


@functools.cache
def shape_norms() -> np.ndarray:
    """By letters and marks of the ends: what a window's sum of weights is divided by."""
    out = np.ones((WINDOW + 1, 2, 2))
    for n in range(LEAST, WINDOW + 1):
        for begins in (0, 1):
            for ends in (0, 1):
                out[n, begins, ends] = 1 / triples(n + begins + ends, bool(begins), bool(ends))[1].max()  # the least gap weighs 1
    return out


def batches(texts: list[str | None]) -> Iterator[tuple[int, str, np.ndarray]]:
    """Texts joined by line ends: number of the first, the joined text, and where each begins in it."""
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to] or "") < BATCH_CHARS):
            size += len(texts[to] or "")
            to += 1
        some = [t or "" for t in texts[at:to]]
        yield at, "\n".join(some), np.cumsum([0, *(len(t) + 1 for t in some[:-1])])
        at = to


def put_in(window: str, letters: str, rng: np.random.Generator) -> list[str]:
    """The window with a letter put in between any two, and with ``GAP`` letters at one place, as far as they fit."""
    plain, out = window.strip("^$"), []
    some = lambda n: "".join(rng.choice(list(letters), n))
    if 2 * len(plain) - 1 <= WINDOW:
        out += ["^" + "".join(c + some(1) for c in plain[:-1]) + plain[-1] + "$" for _ in range(2)]
    if len(plain) + GAP <= WINDOW:
        out += ["^" + plain[:i] + some(n) + plain[i:] + "$" for i in range(1, len(plain)) for n in (1, GAP)]
    return out


def support_vectors(x: np.ndarray, y: np.ndarray, count: np.ndarray, cost: float = 5e3, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine of squared hinge loss, both classes of equal weight, by Newton steps on the rows inside the margin."""
    weight = cost * 0.5 * count * np.where(y > 0, 1 / count[y > 0].sum(), 1 / count[y < 0].sum())
    x1 = np.append(x, np.ones((len(x), 1)), 1)
    ridge, w, inside = np.eye(x1.shape[1]), np.zeros(x1.shape[1]), np.ones(len(y), bool)
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        active = x1[inside] * weight[inside][:, None]
        aim = np.linalg.solve(ridge + 2 * x1[inside].T @ active, 2 * active.T @ y[inside])
        loss = lambda v: v @ ridge @ v + (2 * weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum()
        step = 1.0
        while step > 1e-3 and loss(w + step * (aim - w)) > loss(w):
            step /= 2
        w = w + step * (aim - w)
        now = y * (x1 @ w) < 1
        if step == 1.0 and (now == inside).all():
            break
        inside = now
    return w[:-1], float(w[-1])


def calibrate(value: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Line from values to log-odds: logistic regression with softened targets, where ``share`` of all are toxic."""
    n1, n0 = max(1, toxic.sum()), max(1, (~toxic).sum())
    target, weight = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)), np.where(toxic, share / n1, (1 - share) / n0)
    a, b = 1.0, 0.0
    for _ in range(4000):
        d = weight * (1 / (1 + np.exp(-np.clip(a * value + b, -30, 30))) - target)
        a, b = a - 2.0 * float((d * value).sum()), b - 2.0 * float(d.sum())
    return max(a, 1e-3), b


def train(texts: list[str], toxic: np.ndarray, share: float = SHARE) -> Machine:
    """Learns from labelled documents; scores are as if ``share`` of all were toxic; with one label only, every score is that label's share."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Machine(np.zeros(HASHED, np.float32), 0.0, 0.0, -6.0 if not toxic.any() else 6.0)
    once: dict[str, str] = {}  # one object for each distinct word
    bags = [[tuple(once.setdefault(w, w) for w in s.lower().split()) for s in _SENTENCE.split(t) if s.strip()] for t in texts]
    # counted over distinct sentences, as documents may be copies of each other
    in_toxic, in_clean, n1, n0 = Counter(), Counter(), 0, 0
    for counter, side in ((in_toxic, toxic), (in_clean, ~toxic)):
        sentences = {s for bag, mine in zip(bags, side) if mine for s in bag}
        for s in sentences:
            counter.update({p for w in s for p in pieces(w)})
        n1, n0 = (len(sentences), n0) if counter is in_toxic else (n1, len(sentences))
    # how much more often in toxic documents' sentences, at least: both counts are taken a standard deviation to the wrong side
    typical = {w: np.log((c - np.sqrt(c)) / n1) - np.log((in_clean[w] + np.sqrt(in_clean[w]) + 1) / n0)
               for w, c in in_toxic.items() if c > 1}
    clean_words = sorted(in_clean, key=lambda w: (-in_clean[w], w))
    if not clean_words:
        return Machine(np.zeros(HASHED, np.float32), 0.0, 0.0, -6.0)

    # landmarks: the words most typical of toxic documents (by evidence), and common and rare clean ones
    evidence = sorted((w for w, v in typical.items() if v > np.log(3)), key=lambda w: (-typical[w], w))
    some = clean_words[:LANDMARKS // 4] + clean_words[LANDMARKS // 4::max(1, len(clean_words) // (LANDMARKS // 4))]
    marks = list(dict.fromkeys(evidence[:LANDMARKS // 2] + some))[:LANDMARKS]
    landmarks = Landmarks.of(marks)
    gram = landmarks.kernel(marks)
    values, axes = np.linalg.eigh(gram)
    root = axes[:, values > 1e-6] / np.sqrt(values[values > 1e-6])  # K^(-1/2) without null directions

    machine = None
    rng, letters = np.random.default_rng(0), "".join(sorted({c for w in clean_words[:200] for c in w.strip("^$")}))
    bad_texts, clean_texts = [t for t, bad in zip(texts, toxic) if bad], [t for t, bad in zip(texts, toxic) if not bad]
    bad_bags = [bag for bag, bad in zip(bags, toxic) if bad]
    sparse = clean_words[::max(1, len(clean_words) // 4000)]
    hard: dict[str, None] = {}
    often_clean = in_clean
    for _ in range(ROUNDS):
        found = Counter()
        # the worst sentence of a toxic document is labelled toxic, and others that are surely so, by their worst window
        if machine is None:
            least, sure = np.log(4), np.log(12)
            judged = [[max(((typical.get(p, -9.0), p) for w in s for p in pieces(w)), default=(-9.0, "")) for s in bag] for bag in bad_bags]
        else:
            judged, judged_clean = map(machine.worst_windows, bad_texts), [machine.worst_windows(t) for t in clean_texts]
            seen = {w: v for sentences in judged_clean for v, w in sentences}
            often_clean = Counter(w for sentences in judged_clean for _, w in sentences)
            tops = [max(sentences)[0] for sentences in judged_clean if sentences] or [0.0]
            least, sure = max(0.0, np.quantile(tops, 0.9)), max(0.5, np.quantile(tops, 0.99))
            hard.update(dict.fromkeys(sorted(seen, key=lambda w: (-seen[w], w))[:3000]))
        for sentences in judged:
            found.update(w for i, (v, w) in enumerate(sorted(sentences, reverse=True)) if v > (sure if i else least))
        # a window that clean sentences have (nearly) as often is none
        found = Counter({w: c for w, c in found.items() if c / n1 > 4 * often_clean[w] / n0})
        positive = sorted(found)
        negative = [w for w in dict.fromkeys([*hard, *sparse]) if w not in found]
        if not positive or not negative:
            break
        often = np.sqrt([found[p] for p in positive])  # sentences that a window stands for
        changed = {v: often[i] / 2 for i, p in enumerate(positive) if found[p] > 1 for v in put_in(p, letters, rng)}
        changed = {v: c for v, c in changed.items() if v not in found and v not in in_clean}
        x = landmarks.kernel(positive + list(changed) + negative) @ root
        x = np.append(x, np.zeros((1, x.shape[1])), 0)  # a window unlike all is clean
        w, b = support_vectors(x, np.array([1.0] * (len(positive) + len(changed)) + [-1.0] * (len(negative) + 1)),
                               np.concatenate([often, list(changed.values()), np.ones(len(negative)), [len(negative) / 1000]]))
        machine = Machine(landmarks.folded(root @ w), b, 1.0, 0.0)
    if machine is None:
        return Machine(np.zeros(HASHED, np.float32), 0.0, 0.0, -6.0)
    slope, offset = calibrate(machine.worst(texts), toxic, share)
    return Machine(machine.weight, machine.bias, slope, offset)


def learn(docs: DataFrame, labels: DataFrame, column: str = "toxic", text: str = "text", doc_id: str = "doc_id",
          sample: int = SAMPLE) -> Machine:
    """Fits on at most ``sample`` labelled documents of each label, none of the held-out fold (those of smallest id hash).

    Of an id that rows repeat, the least text stands for it, and of a document with
    more than ``SENTENCES`` sentences those of smallest hash: that bounds what the driver gets.
    """
    chosen = [learning_labels(labels.where(F.col(column) == v), column, sample) for v in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).groupBy("doc_id").agg(F.max("label").alias("_toxic")))  # 2 * sample rows
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("_text")).join(chosen, "doc_id")
    rows = rows.groupBy("doc_id", "_toxic").agg(F.min("_text").alias("_text"))
    parts = F.split("_text", _SENTENCE.pattern)
    some = F.slice(F.array_sort(F.transform(parts, lambda s: F.struct(F.xxhash64(s).alias("hash"), s.alias("s")))), 1, SENTENCES)
    rows = rows.withColumn("_text", F.when(F.size(parts) > SENTENCES, F.array_join(some["s"], "\n")).otherwise(F.col("_text")))
    found = sorted((r["doc_id"], r["_text"] or "", r["_toxic"]) for r in rows.collect())
    return train([t for _, t, _ in found], np.array([v == 1 for _, _, v in found], bool))


def score_toxicity(df: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """Adds ``name`` (0 to 1, higher: more likely toxic) to every row, from the whole text alone.

    Null, empty and blank texts score as texts without any suspect word;
    repeated rows are scored alike; an input column of that name is replaced.
    """
    importable(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(model.value.score(part.tolist()), dtype="float64")
        release()

    return without(df, *([name] if name != text else [])).withColumn(name, score(F.col(quoted(text))))
