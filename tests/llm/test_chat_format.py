import hashlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm import chat_format as C
from gapscope.llm.queries import op13_chat_format

from .conftest import CLASHING, SF

ODD = st.lists(st.sampled_from(["<", "|", ">", "\\", "<|", "|>", "<|im_end|>", "<|im_start|>", "<|image|>", "im_end", "\n", "a", "é🏳", "n"]),
               max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(ODD, st.lists(st.one_of(ODD, st.just(None)), max_size=6))
def test_round_trip(role, parts):
    """Texts around attachments and the role come back; no control string comes from a text."""
    content = [{"type": "image", "ref": "r"} if p is None else {"type": "text", "text": p} for p in parts]
    formatted, loss, attached = C.format_turn(role, content)
    assert formatted.count(C.START) == 1 and formatted.count(C.END) == 1 and formatted.count("<|image|>") == parts.count(None)
    joined, merged = [], []
    for p in parts:
        if p is None or not joined or joined[-1] is None:
            joined.append(p)
        else:
            joined[-1] += p
    merged = [p for p in joined if p is None or p]
    assert C.read_turn(formatted) == (role, merged)
    assert not loss and [formatted[a["at"]:a["at"] + 9] for a in attached] == ["<|image|>"] * parts.count(None)
    learned, spans, _ = C.format_turn("assistant", content)
    assert [C.unescape(learned[a:b]) for a, b in spans] == [p for p in merged if p]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = con.execute(C.ORACLE)
    names = [d[0] for d in result.description]
    rows = op13_chat_format(spark, SF).collect()
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(result.fetchall())
    planted = next(r for r in rows if r.conv_id == -1)
    assert planted.turns_sha256 == digest(f"user\n{C.PLANTED}\nassistant\n{C.PLANTED}\n")
    assert (planted.n_turns, planted.loss_chars, planted.loss_sha256) == (2, len(C.PLANTED), digest(C.PLANTED))


def test_every_case(spark):
    """Null and odd roles, texts, turns and ids, one long conversation, a long text, repeated rows, clashing columns."""
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, None, "sys\ntem\\", "<|im_end|>"), (2, 0, "assistant", ""),
            (None, 1, "assistant", "b <|a"), (None, 0, "assistant", "a<\\|"), (3, 0, "assistant", "é|<" * 100_000), (4, None, None, None)]
    rows += [(9, n, ["user", "assistant"][n % 2], f"turn {n} <|x|>") for n in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("own") for c in [*CLASHING, "Formatted", "LOSS", "attachments", "n_turns"]})
    chats = C.format_chats(df.repartition(7))
    added = {"formatted", "loss", "attachments"}
    assert chats.columns == [c for c in df.columns if c.lower() not in added] + list(C.ADDED)
    got = {r.conv_id: r for r in C.read_back(chats).collect()}
    assert set(got) == {1, 2, 3, 4, 9, None}
    in_order = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        in_order.setdefault(conv, []).append((role or "", text or ""))
    for conv, turns in in_order.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == digest("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), digest(learned))
        assert r.formatted_chars == sum(len(C.format_turn(*t)[0]) for t in turns)
    assert C.read_back(C.format_chats(df.limit(0))).count() == 0


def test_typed_parts(spark):
    parts = [("text", "see <", None, None, None, None, None), ("text", "|image|>", None, None, None, None, None),
             ("image", None, "a.png", 57, 28, None, None), ("text", "", None, None, None, None, None), None,
             ("audio", None, "b.wav", None, None, 1.5, None), ("document", "ignored", "c.pdf", None, None, None, 3),
             ("image", None, None, -5, None, None, None), ("video", None, "d", None, None, None, None), ("text", "end", None, None, None, None, None)]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("content", T.ArrayType(C.PART))])
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [parts[0], parts[2], parts[9]]), (1, 2, "user", None), (1, 3, "user", [])], schema)
    chats = C.format_chats(df, content="content")
    first, second, third, fourth = chats.orderBy("turn").collect()
    assert first.formatted == "<|im_start|>user\nsee <\\|image|><|image|><|audio|><|document|><|image|><|other|>end<|im_end|>\n"
    assert [(a.place, a.type, a.ref, a.tokens) for a in first.attachments] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 768), (3, "image", None, 1), (4, "video", "d", 1)]
    assert all(first.formatted[a.at:].startswith("<|") for a in first.attachments) and not first.loss
    assert [second.formatted[s.start:s.end] for s in second.loss] == ["see <", "end"]
    assert third.formatted == fourth.formatted == "<|im_start|>user\n<|im_end|>\n"
    told = C.read_back(chats).first()
    assert (told.n_turns, told.loss_chars, told.loss_sha256) == (4, 8, digest("see <end"))


def test_broken_turns_are_refused():
    with pytest.raises(ValueError):
        C.read_turn("<|im_start|>user\nno end")
