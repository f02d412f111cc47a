import hashlib

from changeflow.llm import chat
from changeflow.llm.queries import TRICKY, op4_chat

SCHEMA = "conv_id long, turn long, seq long, kind string, role string, text string"


def fold(rows):
    """Brute force over one conversation's events."""
    turns = {}
    for conv, turn, seq, kind, role, text in sorted(
            rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0,
                                 [-ord(c) for c in r[3] or "message"], r[4] or "", r[5] or "")):
        kind, role, text = kind or "message", role or "", text or ""
        msgs = turns.setdefault(turn, [])
        if kind == "message" or not msgs:
            msgs.append([role, text])
        elif kind == "delta":
            msgs[-1][1] += text
        else:
            msgs[-1][1] = text
    return [tuple(m) for t in sorted(turns, key=lambda t: (t is not None, t or 0)) for m in turns[t]]


EVENTS = [(1, 0, 0, "message", "user", "hi <turn> \\l"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "assistant", "Hel"),
          (1, 1, 3, "delta", "assistant", "lo"), (1, 1, 4, "regenerate", "assistant", None), (1, 1, 5, "delta", "assistant", "B</turn>\n"),
          (1, 1, 6, "delta", "assistant", "ye"), (1, 0, 7, "edit", "user", "hey"), (1, 70, 9, None, None, None),
          (1, 2, 8, "delta", "assistant", "orphan"), (2, 0, 0, "message", "user", "x"), (2, 0, 0, "message", "user", "x"),
          (2, 1, 1, "message", "assistant", "y"), (2, 1, 2, "message", "assistant", "z"), (None, None, None, "message", "assistant", "\\b")]


def test_fold_render_and_read_back(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    rows = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert set(rows) == {1, 2, None}
    for conv, r in rows.items():
        want = fold([e for e in EVENTS if e[0] == conv])
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss_text == "".join(t for role, t in want if role == "assistant")


def test_many_turns_keep_their_order_and_extra_columns_do_not_clash(spark):
    rows = [(5, i, i, "message", "assistant" if i % 2 else "user", "t%d <" % i) for i in range(500)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("nth", F.lit(3)).withColumn("mask", F.lit(1))
    r = chat.read_back(chat.format_chats(df)).collect()[0]
    assert [t.text for t in r.turns] == [x[5] for x in rows]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_query_holds_the_tricky_conversation(spark):
    rows = {r.conv_id: r for r in op4_chat(spark, "/root/testdata/sf0.001").collect()}
    r = rows[-7]
    assert r.n_turns == 2 and r.loss_chars == len(TRICKY)
    assert r.loss_sha256 == hashlib.sha256(TRICKY.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{TRICKY}\nassistant\n{TRICKY}\n".encode()).hexdigest()
