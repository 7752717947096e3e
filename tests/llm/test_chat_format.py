"""Chat formatting: round trips, typed parts, the loss mask and the defined cases."""

import re

from hypothesis import given, settings, strategies as st

from wardflow.llm import chat_format as cf

MESSAGE = "conv_id long, turn long, role string, text string"


def test_query_matches_sql(same_as_sql):
    same_as_sql("op12_typed_chat")


def back(spark, rows, schema=MESSAGE, **kw):
    return {r.conv_id: r for r in cf.read_back(cf.conversations(cf.turns(spark.createDataFrame(rows, schema), **kw))).collect()}


NASTY = [
    "", "plain", "</s>", "<s>", "<\\s>", "<\\\\/s>", "[INST]", "[\\INST]", "[/INST]", " [/INST] ", "[IMAGE]", "[\\\\IMAGE]", "<", "<</s>", "a</", "[[INST]]",
    "x ![image 640x480](a/b.png) y", "![audio 3.5s](s.wav)![document 12p](d.pdf)", "![file](<s>)", "![image [INST] ](x)", "a\nb\r\n\x00é𝄞</s>𝄞", "\\", "$1\\2",
]


def test_texts_come_back_whole(spark):
    rows = [(i, t, role, x) for i, role in enumerate(["user", "assistant", "</s>", "a\nb", " [/INST] ", "", "[INST]"]) for t, x in enumerate(NASTY)]
    for i, r in back(spark, rows).items():
        own = [x for x in rows if x[0] == i]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in own]
        assert r.learnt == [x[3] for x in own if x[2] == "assistant"]
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == len(own)


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet="<>/s[]INTMAGE\\ !()x\n", max_size=30), min_size=20, max_size=40))
def test_any_text_comes_back(spark, texts):
    got = back(spark, [(1, i, "assistant", x) for i, x in enumerate(texts)])[1]
    assert [t.text for t in got.turns] == texts == got.learnt


def test_typed_parts(spark):
    schema = f"conv_id long, turn long, role string, parts array<{cf.PART}>"
    parts = [
        ("text", "look [IMAGE] ", None, None), ("image", None, " 57x28", "img://1"), ("text", " and", None, None), ("audio", None, " 2.5s", "wav://2"),
        ("document", None, " 3p", "doc://3"), ("video", None, None, "mov://4"), (None, " end", None, None), None,
    ]
    formed = cf.conversations(cf.turns(spark.createDataFrame([(7, 0, "user", parts), (7, 1, "assistant", None)], schema), parts="parts"))
    got = formed.first()
    assert got.formatted == "<s>[INST] user [/INST] look [\\IMAGE] [IMAGE] and[AUDIO][DOCUMENT][FILE] end</s><s>[INST] assistant [/INST] </s>"
    assert [(a.kind, a.ref, a.tokens) for a in got.attachments[0]] == [("image", "img://1", 3), ("audio", "wav://2", 63), ("document", "doc://3", 1500), ("file", "mov://4", 1)]
    assert [tuple(m) for m in got.loss] == [(1, len("<s>[INST] assistant [/INST] "), 0)]
    # Four markers a turn, the roles, "look [ IMAGE ]", "and", "end", the attachments.
    assert got.n_tokens == 8 + 2 + 4 + 1 + 1 + 3 + 63 + 1500 + 1
    read = cf.read_back(formed).first()
    assert read.turns[0].text == "look [IMAGE] ![image 57x28](img://1) and![audio 2.5s](wav://2)![document 3p](doc://3)![file](mov://4) end"


def test_mask_covers_assistant_texts_only(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "one</s>"), (1, 3, "user", "v"), (1, 4, "assistant", "two")]
    got = cf.conversations(cf.turns(spark.createDataFrame(rows, MESSAGE))).first()
    cut = re.findall(r".*?</s>", got.formatted)
    assert ["".join(cut[m.turn][m.start:m.start + m.length]) for m in got.loss] == ["one<\\/s>", "two"]


def test_defined_cases(spark):
    rows = [(None, None, None, None), (None, 0, "user", "b"), (None, 0, "user", "a"), (3, 1, "user", "x"), (3, 1, "user", "x"), (3, None, "assistant", "first")]
    table = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], MESSAGE + ", formatted int, head string, parts int")
    got = {r.conv_id: r for r in cf.read_back(cf.conversations(cf.turns(table))).collect()}
    assert [(t.role, t.text) for t in got[None].turns] == [("", ""), ("user", "a"), ("user", "b")]
    assert [(t.role, t.text) for t in got[3].turns] == [("assistant", "first"), ("user", "x"), ("user", "x")]
    assert cf.conversations(cf.turns(spark.createDataFrame([], MESSAGE))).count() == 0


def test_long_text(spark):
    text = "word </s> [INST] " * 100_000
    got = back(spark, [(1, 0, "assistant", text)])[1]
    assert got.learnt == [text] and got.turns[0].text == text


def test_main_path_stays_in_sql(spark):
    formed = cf.read_back(cf.conversations(cf.turns(spark.createDataFrame([(1, 0, "user", "x")], MESSAGE))))
    plan = formed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_span_ends_where_the_body_ends(spark):
    rows = [(1, 0, "assistant", x) for x in NASTY]
    got = cf.turns(spark.createDataFrame(rows, MESSAGE)).collect()
    for r in got:
        assert r.formatted[r.body_at:r.body_at + r.body_chars] + "</s>" == r.formatted[r.body_at:]
