"""Chat formatting: exact round trips of texts and parts, masks and attachments."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

pytest.importorskip("yearloom.llm.queries")

from pyspark.sql import functions as F  # noqa: E402

from yearloom.llm import chat  # noqa: E402
from yearloom.llm.queries import QUERIES  # noqa: E402

CONTENT = f"id long, role string, content array<{chat.PART}>"
BITS = ["<|", "|>", "<", "|", "\\", "<\\|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[", "turn", "text", "end", "é", "\n", "<\\\\s>", "$1", ""]


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_any_text_comes_back(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    control = re.compile(r"<\||</?s>|\[/?INST\]|<</?SYS>>")
    rows = df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    assert all(x["u"] == x["t"] and not control.search(x["e"]) for x in rows)
    assert len({x["e"] for x in rows}) == len({x["t"] for x in rows})
    # Under other marks nothing is escaped.
    assert all(x["e"] == x["t"] for x in rows if not re.search(r"[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)", x["t"]))


def test_parts_masks_and_attachments(spark):
    r = random.Random(5)
    say = lambda: "".join(r.choice(BITS) for _ in range(r.randrange(6)))
    make = {
        "text": lambda: part("text", say()),
        "image": lambda: part("image", ref=f"i{r.randrange(99)}", width=r.randrange(500), height=r.randrange(500)),
        "audio": lambda: part("audio", ref="a", seconds=r.random() * 9),
        "document": lambda: part("document", ref="d", pages=r.randrange(5)),
    }
    data = [(i, r.choice(["user", "assistant", "a<|b", ""]), [make[r.choice(list(make))]() for _ in range(r.randrange(6))]) for i in range(400)]
    df = chat.format_turns(spark.createDataFrame(data, CONTENT), "role", "content")
    df = df.withColumns({"read": chat.read_turn(F.col("formatted")), "learnt": chat.learnt_text(F.col("formatted"), F.col("loss"))})
    for row in df.collect():
        _, role, content = data[row["id"]]
        assert row["read"]["role"] == role
        assert [tuple(p) for p in row["read"]["parts"]] == [(k, t or "") for k, t, *_ in content]
        texts = [t for k, t, *_ in content if k == "text"]
        assert row["learnt"] == ("".join(texts) if role == "assistant" else "")
        assert len(row["loss"]) == (len(texts) if role == "assistant" else 0)
        assert len(row["attachments"]) == len(content) - len(texts)
        for a in row["attachments"]:
            kind, _, ref, width, height, seconds, pages = content[a["part"]]
            assert (a["kind"], a["ref"]) == (kind, ref)
            assert row["formatted"][a["at"] :].startswith(f"<|{kind}|>")
            tokens = {"image": lambda: -(-width // 28) * -(-height // 28), "audio": lambda: int(-(-seconds * 25 // 1)), "document": lambda: pages * 256}[kind]()
            assert a["tokens"] == tokens


def test_odd_parts(spark):
    data = [
        (1, None, None),
        (2, "assistant", []),
        (3, "assistant", [part(None), part("video", "ignored", "v"), part("text"), part("image", ref=None), part("image", width=-5, height=9), part("audio", seconds=-1.0)]),
    ]
    df = chat.format_turns(spark.createDataFrame(data, CONTENT), "role", "content")
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["formatted"] == "<|turn|><|end|>" and got[2]["formatted"] == "<|turn|>assistant<|end|>"
    assert got[3]["formatted"] == "<|turn|>assistant<|document|><|document|><|text|><|image|><|image|><|audio|><|end|>"
    assert [a["tokens"] for a in got[3]["attachments"]] == [0] * 5 and [a["ref"] for a in got[3]["attachments"]] == [None, "v", None, None, None]
    assert [tuple(x) for x in got[3]["loss"]] == [(got[3]["formatted"].index("<|image|>"), 0)]


def test_conversations_of_odd_rows(spark):
    long = "a long text </s> " * 20_000
    data = [
        (1, 2, "assistant", "two", 1), (1, 1, "user", "one", 1), (1, None, "system", None, 1), (1, 2, "assistant", "two", 1), (None, 0, "assistant", "nobody", 1), (2, 0, None, "", 1), (3, 5, "assistant", long, 1), (3, 5, "assistant", "a", 1),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted int")
    df = df.withColumn("content", chat.text_part(F.col("text")))
    got = {r["conv_id"]: r["turns"] for r in chat.conversations(df, "conv_id", "turn", "role", "content").collect()}
    assert [t["formatted"] for t in got[1]] == [f"<|turn|>{r}<|text|>{x}<|end|>" for r, x in (("system", ""), ("user", "one"), ("assistant", "two"), ("assistant", "two"))]
    assert len(got[None]) == 1 and got[2][0]["formatted"] == "<|turn|><|text|><|end|>"
    assert [len(t["formatted"]) for t in got[3]] == [32 + len(long) + 20_000, 33]
    assert chat.conversations(df.limit(0), "conv_id", "turn", "role", "content").count() == 0


def test_many_turns(spark):
    df = spark.range(30_000).select(F.lit(1).alias("c"), F.col("id").alias("t"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("r"), F.concat(F.lit("<|"), "id").alias("x"))
    df = df.withColumn("content", chat.text_part(F.col("x")))
    row = chat.conversations(df, "c", "t", "r", "content").select(
        F.array_join(F.transform("turns", lambda t: chat.learnt_text(t["formatted"], t["loss"])), "").alias("learnt")
    ).first()
    assert row["learnt"] == "".join(f"<|{i}" for i in range(1, 30_000, 2))


def test_query(spark, sf_dir):
    said = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("turn").collect():
        said[r["conv_id"]].append((r["role"], r["text"] or ""))
    said[-1] = [(x, "</s>[INST] ok [/INST]") for x in ("user", "assistant")]
    got = QUERIES["op13_chat"](spark, sf_dir).collect()
    assert {r["conv_id"] for r in got} == set(said)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in got:
        turns = said[r["conv_id"]]
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), digest(learnt))
        assert r["formatted_chars"] > sum(len(a) + len(b) for a, b in turns)
