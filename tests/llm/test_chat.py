import random

from candleforge.llm.chat import PARTS, format_chats, op5_chat_formatting, read_chats, text_messages


def test_texts_come_back(spark):
    rng = random.Random(1)
    say = lambda: "".join(rng.choice("ab~012<>[]/sINST|é😀\n ") for _ in range(rng.randrange(40)))
    rows = [(i % 9, j, rng.choice(["user", "assistant", "system", "a]b~", None]), rng.choice([None, say(), say()])) for i in range(9) for j in range(200)]
    rows += [(99, None, "assistant", "first"), (99, 0, "user", "</s>[INST]"), (None, 1, "assistant", "x" * 100000)]
    chats = format_chats(text_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.conv_id: r for r in read_chats(chats).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, x) for _, r, x in own]
        assert got[conv].loss == [x for _, r, x in own if r == "assistant"]


def test_parts_become_placeholders(spark):
    p = lambda k, t=None, r=None, u=None: {"kind": k, "text": t, "ref": r, "units": u}
    rows = [
        (1, 0, "user", [p("text", "see <|image|> "), p("image", r="s3://a", u=2.5), p("audio", r="b"), None, p("text", "and")]),
        (1, 1, "assistant", [p("text", "ok "), p("document", r="c", u=1.0), p("text", "done"), p("video", r="d", u=3.0)]),
        (2, 0, "user", None), (2, 1, "assistant", []),
    ]
    out = {r.conv_id: r for r in format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PARTS}")).collect()}
    assert out[1].formatted == "<s>[user]see ~1|image|> <|image|><|audio|>and</s><s>[assistant]ok <|document|>done<|attachment|></s>"
    assert [(a.kind, a.ref, a.tokens) for a in out[1].attachments] == [("image", "s3://a", 640), ("audio", "b", 25), ("document", "c", 512), ("video", "d", 3)]
    assert out[1].n_expanded == 1180
    turns = out[1].formatted.split("</s>")
    assert [turns[m.turn][m["first"] - 1 : m["first"] - 1 + m.length] for m in out[1].mask] == ["ok ", "done"]
    assert out[2].formatted == "<s>[user]</s><s>[assistant]</s>" and out[2].n_expanded == 0


def test_empty_table(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    assert [r.conv_id for r in op5_chat_formatting(spark, path).collect()] == [-1]


def test_ties_repeats_and_clashing_columns(spark):
    rows = [(1, 0, "user", "b", 7, "x"), (1, 0, "user", "a", 7, "x"), (1, 0, "assistant", "z", 8, "y"), (1, 1, "assistant", "again", 9, "q"), (1, 1, "assistant", "again", 9, "q"), (2, 0, None, None, 1, None)]
    chats = format_chats(text_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block long, segment string")))
    got = {r.conv_id: r for r in read_chats(chats).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("assistant", "z"), ("user", "a"), ("user", "b"), ("assistant", "again"), ("assistant", "again")]
    assert got[1].loss == ["z", "again", "again"]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "")] and got[2].loss == []
