import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import chat as c

TURNS = "conv_id long, turn long, role string, text string, block int"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>", "<~|~", "<~~/s> <~s>", "[~INST]", "<<SYS>> <</SYS>>", "a\n<|turn|>user<|says|>x<|end|>\n", "<", "🙂<|", "<|image|>", "", None]


def brute(rows, escape_chars):
    convs = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        convs[conv].append(((turn is not None, turn), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r[1]}\n{t[1]}\n" for _, r, t in turns)
        loss = "".join(t[1] for _, r, t in turns if r[1] == "assistant")
        out[conv] = (len(turns), said, loss)
    return out


def test_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t, 0) for i, t in enumerate(NASTY)]
    rows += [(2, i, "we<|says|>ird", t, 0) for i, t in enumerate(NASTY)] + [(3, None, None, None, 0), (3, 5, "assistant", "x", 0), (3, 5, "assistant", "x", 0)]
    rows += [(None, 1, "assistant", "no id", 0)] + [(9, i, "assistant", f"t{i}", 0) for i in range(500)]
    df = spark.createDataFrame(rows, TURNS)
    done = c.format_chats(c.text_turns(df)).select(
        "conv_id", c.read_turns(F.col("formatted")).alias("turns"), c.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss")
    )
    want = brute(rows, 0)
    got = {r.conv_id: (len(r.turns), "".join(f"{t.role}\n{t.text}\n" for t in r.turns), r.loss) for r in done.collect()}
    assert got == want
    assert c.format_chats(c.text_turns(df.limit(0))).count() == 0


def test_no_marker_can_be_forged(spark):
    df = spark.createDataFrame([(1, 0, "user", "".join(x or "" for x in NASTY), 0)], TURNS)
    formatted = c.format_chats(c.text_turns(df)).first().formatted
    body = formatted[len(c.TURN) : -len(c.END)]
    for control in ("</s>", "[INST]", "[/INST]", "<|end|>", "<|turn|>", "<|image|>", "<<SYS>>"):
        assert control not in body.replace(c.SAYS, "", 1), control


def test_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "see "), part("image", ref="a.png", w=28, h=15), part("text", " and "), part("audio", ref="b.wav", s=1.5), part("document", ref="c.pdf", p=3), part("odd", "[INST]"), part(None, None)]),
        (1, 1, "assistant", [part("text", "é<|"), part("image", ref="d.png", w=14, h=14), part("text", "ok")]),
        (2, 0, "user", None),
        (2, 1, "assistant", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {c.PARTS}")
    got = {r.conv_id: r for r in c.format_chats(df).withColumn("loss", c.loss_text(F.col("formatted"), F.col("loss_mask"))).collect()}
    assert got[1].formatted == "<|turn|>user<|says|>see <|image|> and <|audio|><|document|>[~INST]<|end|>\n<|turn|>assistant<|says|>é<~|<|image|>ok<|end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in got[1].attachments] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 1536), ("image", "d.png", 1)]
    assert got[1].expanded_tokens == 4 + 38 + 1536 + 1 and got[1].loss == "é<|ok"
    assert got[2].formatted == "<|turn|>user<|says|><|end|>\n<|turn|>assistant<|says|><|end|>\n" and got[2].loss == ""


def test_query_has_the_planted_conversation(spark, sf001):
    r = c.query(spark, sf001).filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars) == (2, len(said))
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_long_conversations_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(c, "LONG", 100)
    rows = [(k, i, "assistant" if i % 2 else "user", f"{NASTY[i % 12]} {i}", 0) for k, n in ((1, 700), (2, 40), (None, 300)) for i in range(n)]
    rows += [(1, None, "user", "first", 0), (1, 5, "assistant", "<|~", 0), (1, 5, "assistant", "<|", 0)]
    df = spark.createDataFrame(rows, TURNS)
    assert c._long(df).count() == 2
    done = c.format_chats(c.text_turns(df)).select("conv_id", c.read_turns(F.col("formatted")).alias("turns"), c.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    assert {r.conv_id: (len(r.turns), "".join(f"{t.role}\n{t.text}\n" for t in r.turns), r.loss) for r in done.collect()} == brute(rows, 0)


def test_ties_are_ordered_by_the_raw_text(spark):
    """An escape may sort elsewhere than what it stands for."""
    rows = [(1, 0, "user", t, 0) for t in ["<}", "<|", "<~|", "<", "[INST]", "[~", "<s>", "</s>", None, ""]]
    df = spark.createDataFrame(rows, TURNS)
    done = c.format_chats(c.text_turns(df)).select("conv_id", c.read_turns(F.col("formatted")).alias("turns"), F.lit("").alias("loss"))
    assert {r.conv_id: (len(r.turns), "".join(f"{t.role}\n{t.text}\n" for t in r.turns), r.loss) for r in done.collect()} == brute(rows, 0)


def test_a_very_long_text_and_clashing_names(spark):
    text = "</s>[INST] é " * 100_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", *[f"'x' as {n}" for n in ("head", "v", "t", "b", "block", "spans", "segment", "long_id")])
    done = c.format_chats(c.text_turns(df)).select(c.read_turns(F.col("formatted")).alias("turns"), c.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss")).first()
    assert [t.text for t in done.turns] == [text, text] and done.loss == text
