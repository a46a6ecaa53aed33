"""Token counts by section: encode whole documents once, join token spans to section spans.

A document is encoded once, so tokens that cross a section's border exist and
count once.  Token spans and section spans are both intervals of characters; an
interval join finds every (token, section) overlap and an explicit rule gives
each token to one section:

``majority``  the section that holds most of the token's characters, the earlier on a tie;
``start``     the first section that holds one of its characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapscope.llm.bpe import codec
from gapscope.llm.common import importable, release, without

RULES = ("majority", "start")
ADDED = ("section", "span_start", "span_end", "n_tokens", "n_crossing")


def token_spans(path: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of a text's tokens; a token of some bytes of a
    character spans that whole character (so neighbours may share it)."""
    c = codec(path)
    data = c.bytes_of(ids)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    stop = np.cumsum(c.length[ids])
    return char[stop - c.length[ids]], char[stop - 1] + 1


def line_spans(text: str) -> np.ndarray:
    """Spans of the lines of a text, each with the newline that ends it; the empty text has none."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") == 10) + 1
    ends = np.append(ends, len(text)) if not len(ends) or ends[-1] < len(text) else ends
    return np.stack([np.concatenate([[0], ends[:-1]]), ends], 1) if len(text) else np.empty((0, 2), np.int64)


def overlaps(start: np.ndarray, end: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interval join: (token, section, characters in common) for every overlap of a text.

    Tokens are in order of start and of end, so the tokens that a section meets
    are one run, found by two binary searches per section.
    """
    first = np.searchsorted(end, spans[:, 0], "right")
    n = np.maximum(np.searchsorted(start, spans[:, 1], "left") - first, 0)
    section = np.repeat(np.arange(len(spans)), n)
    token = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    common = np.minimum(end[token], spans[section, 1]) - np.maximum(start[token], spans[section, 0])
    return token[common > 0], section[common > 0], common[common > 0]


def allocate(start: np.ndarray, end: np.ndarray, spans: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token by ``rule`` (-1: none), and whether it has a character outside of that section."""
    token, section, common = overlaps(start, end, spans)
    place = np.maximum(start[token], spans[section, 0])
    order = np.lexsort((section, -common if rule == "majority" else place, token))
    token, section, common = token[order], section[order], common[order]
    best = np.flatnonzero(np.diff(token, prepend=-1))
    mine, held = np.full(len(start), -1), np.zeros(len(start), np.int64)
    mine[token[best]], held[token[best]] = section[best], common[best]
    return mine, held < end - start


def attribute_tokens(df: DataFrame, path: str, key: list[str], text: str = "text",
                     spans: str | None = None, rule: str = "majority") -> DataFrame:
    """Rows (key columns, section, span_start, span_end, n_tokens, n_crossing), one for each section of each row.

    Sections are the text's lines, or the ``spans`` column: an array of structs
    whose first two fields are start and end in characters (they may overlap,
    nest, leave gaps; ends beyond the text and null or empty spans hold what
    they overlap).  ``section`` counts from 0 in the given order.  Tokens of no
    section are counted at section -1 (spans null), which every row of input has
    and which is the only row of a null or empty text, so no input row is lost.
    The n_tokens of a row's sections sum to the number of ids of its whole text.
    ``n_crossing`` counts those of them with a character outside of the section.
    Repeated rows give repeated results.  Key columns named like the output's are
    replaced; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    importable(df.sparkSession)
    df = df.select(*key, text, *([spans] if spans else []))
    keys = without(df.select(*key), *ADDED)
    at = [i for i, k in enumerate(key) if k in keys.columns]
    schema = T.StructType([*keys.schema.fields, T.StructField("section", T.IntegerType()),
                           *[T.StructField(n, T.LongType()) for n in ADDED[1:]]])
    n_key = len(key)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for cut in range(0, whole.num_rows, 500):
                batch = whole.slice(cut, 500)
                texts = batch.column(n_key).to_pylist()
                given = batch.column(n_key + 1).to_pylist() if spans else [None] * len(texts)
                rows, out = [], []
                for i, ids in enumerate(codec(path).encode(texts)):
                    own = (line_spans(texts[i] or "") if not spans else np.array(
                        [[-1 if v is None else v for v in list(s.values())[:2]] if s else [-1, -1] for s in given[i] or []],
                        np.int64).reshape(-1, 2))
                    start, end = token_spans(path, ids)
                    mine, crosses = allocate(start, end, own, rule)
                    n = len(own) + 1  # the first is for the tokens of no section
                    rows.append(np.full(n, i))
                    edge = np.concatenate([[[-1, -1]], own])
                    out.append(np.column_stack([np.arange(-1, n - 1), edge, np.bincount(mine + 1, minlength=n),
                                                np.bincount(mine + 1, weights=crosses, minlength=n).astype(np.int64)]))
                where, table = np.concatenate(rows), np.concatenate(out)
                none = table[:, 0] < 0
                keys_of = [batch.column(k).take(pa.array(where)) for k in at]
                yield pa.RecordBatch.from_arrays(
                    [*keys_of, pa.array(table[:, 0].astype(np.int32)),
                     *[pa.array(table[:, j], mask=none) for j in (1, 2)], *[pa.array(table[:, j]) for j in (3, 4)]],
                    names=schema.names)
        release()

    return df.mapInArrow(task, schema)
