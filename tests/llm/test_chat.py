"""Chat formatting: round trips, spans, attachments, and the SQL of its digests."""

from __future__ import annotations

import hashlib

import duckdb
from pyspark.sql import functions as F

from tradecast.llm import chat
from tradecast.llm.common import table

ODD = ["plain", "", None, "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "\\</s>\\", "[INST[INST]]<s", " [/INST] <s> x </s> ", "a\nb\r\n [PART] [IMAGE]",
       "[ROLE] x [/ROLE] y [END]", "é中\U0001f600 <s>", "</s" + ">" * 3, "\\" * 20_000 + "[END]", "word " * 30_000, "$1 \\$1"]
ROLES = ["user", "assistant", "system", "tool", "[INST]", None, "a\nb", "</s> \\"]


def _turns():
    out, n = [], 0
    for c in range(30):
        for t in range(1 + c % 5):
            out.append((c, t, ROLES[(n * 5 + c) % len(ROLES)], ODD[n % len(ODD)]))
            n += 1
    out += [(100, 0, "assistant", "one"), (100, 0, "assistant", "one"), (100, 0, "assistant", "<s>"), (100, None, "user", "first"),
            (None, 1, "user", "no id"), (None, 2, "assistant", "none either"), (101, 0, None, None)]
    return out


def _want(rows):
    convs: dict = {}
    for c, t, r, x in [*rows, *[(-1, *a) for a in chat.ADDED]]:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _frame(spark):
    rows = [(*r, 1, 2, "s") for r in _turns()]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, no int, start int, content string").repartition(3)


def test_digests_read_back_equal_the_input(spark):
    out = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(_frame(spark)).collect()}
    assert out == _want(_turns())


def test_escapes_reverse(spark):
    rows = spark.createDataFrame([(x,) for x in ODD if x is not None], "t string")
    back = rows.select("t", chat.unescape(chat.escape(F.col("t"))).alias("b"), chat.escape(F.col("t")).rlike(r"(?<!\\)" + chat.CONTROL).alias("bare"))
    assert all(r["t"] == r["b"] and not r["bare"] for r in back.collect())


def test_spans_lie_on_the_contents(spark):
    done = chat.format_conversations(_frame(spark).withColumn("parts", chat.text_parts(F.col("text"))))
    for r in done.select("formatted", "spans", chat.read_turns(F.col("formatted")).alias("turns")).collect():
        raw = r["formatted"].encode()
        assert len(r["spans"]) == len(r["turns"])
        for s, t in zip(r["spans"], r["turns"], strict=True):
            assert (s["role"], s["loss"]) == (t["role"], t["role"] == "assistant")
            assert r["formatted"][s["start"]:s["start"] + s["length"]] == t["content"]
            assert raw[s["byte_start"]:s["byte_start"] + s["byte_length"]].decode() == t["content"]


def _part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_typed_parts(spark):
    rows = [(1, 0, "user", [_part("text", "see [IMAGE]"), _part("image", ref="a.png", width=57, height=28), _part("text", "and\\"), _part("audio", ref="b.wav", seconds=1.5)]),
            (1, 1, "assistant", [_part("text", "a"), _part("text", "b")]),
            (1, 2, "user", [_part("document", ref="c.pdf", pages=3), _part("image", ref=None), _part("chart", "odd kind"), _part(None, None)]),
            (2, 0, "user", None), (2, 1, "user", [])]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    done = chat.format_conversations(messages)
    out = {r["conv_id"]: r for r in done.withColumn("back", F.transform(chat.read_turns(F.col("formatted")), lambda t: chat.read_parts(t["content"]))).collect()}
    assert [tuple(a) for a in out[1]["attachments"]] == [(0, 1, "image", "a.png", 3), (0, 3, "audio", "b.wav", 38), (2, 0, "document", "c.pdf", 768), (2, 1, "image", None, 1)]
    assert out[1]["attachment_tokens"] == 810 and out[2]["attachment_tokens"] == 0
    assert out[1]["formatted"] == ("[INST] see \\[IMAGE] [PART] [IMAGE] [PART] and\\ [PART] [AUDIO] [/INST]<s> a [PART] b </s>"
                                   "[INST] [DOCUMENT] [PART] [IMAGE] [PART] odd kind [PART]  [/INST]")
    assert out[2]["formatted"] == "[INST]  [/INST][INST]  [/INST]"
    got = [[tuple(p) for p in t] for t in out[1]["back"]]
    assert got == [[("text", "see [IMAGE]"), ("image", None), ("text", "and\\"), ("audio", None)], [("text", "a"), ("text", "b")],
                   [("document", None), ("image", None), ("text", "odd kind"), ("text", "")]]


def test_empty_table(spark):
    out = chat.digests(_frame(spark).limit(0)).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in out] == [(-1, 2, 21)]


def test_a_long_conversation(spark):
    rows = spark.range(20_000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn <s> ', id) AS text")
    out = {r["conv_id"]: r for r in chat.digests(rows).collect()}
    assert out[7]["n_turns"] == 20_000
    assert out[7]["loss_sha256"] == hashlib.sha256("".join(f"turn <s> {i}" for i in range(1, 20_000, 2)).encode()).hexdigest()


def test_digests_equal_sql(spark, sf_dir):
    got = sorted(tuple(r) for r in chat.digests(table(spark, sf_dir, "conversations")).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    assert got == sorted(con.sql(chat.SQL).fetchall())


def test_no_python_in_the_plan(spark, sf_dir):
    plan = chat.digests(table(spark, sf_dir, "conversations"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan
