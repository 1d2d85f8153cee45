import hashlib
import json

from helpers import frame
from pyspark.sql import functions as F

from tripwise.llm import chat
from tripwise.llm.queries import EXTRA_TEXT, chat_digests

ODD = [EXTRA_TEXT, "", "\\", "\\\\ ###", "</turn>", "\n</turn>\n", "### user\n", "a\\</turn>\\", "日本 😀 ###", "\n\n", "x" * 50000]


def test_layouts_become_turns(spark):
    two = [("user", "q"), ("assistant", "a")]
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}, "messages", two),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "shared", two),
        ({"prompt": "q", "completion": "a", "meta": {"x": 1}}, "prompt", two),
        ({"prompt": "q", "response": "a"}, "prompt_response", two),
        ({"question": "q", "answer": "a"}, "question", two),
        ({"instruction": "q", "output": "a"}, "instruction", two),
        ({"instruction": "q", "input": "i", "output": "a"}, "instruction_input", [("user", "q\ni"), ("assistant", "a")]),
        ({"instruction": "q", "input": "", "output": None}, "instruction_input", [("user", "q"), ("assistant", "")]),
        ({"system": "s", "prompt": "q", "completion": "a"}, "prompt_system", [("system", "s"), *two]),
        ({"messages": [{"content": None, "role": None}]}, "messages", [("", "")]),
        # fields that only a later message has
        ({"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", ""), ("assistant", "a")]),
        ({"messages": []}, None, None),
        ({"nothing": 1}, None, None), ({}, None, None),
    ]
    rows = [(i, json.dumps(r), "c", "d") for i, (r, *_) in enumerate(records)] + [(90, None, "c", "d"), (91, "{broken", "c", "d")]
    df = frame(spark, rows, "id int, record string, layout string, formatted string")
    got = {r.id: r for r in chat.canonical_records(df).collect()}
    for i, (_, layout, turns) in enumerate(records):
        assert got[i].layout == layout, i
        assert (None if got[i].turns is None else [tuple(t) for t in got[i].turns]) == turns
    assert got[90].layout is None and got[91].layout is None
    assert got[0].fingerprint != got[1].fingerprint


def test_template_is_reversible(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(ODD)] + [(i, 1, "assistant", t) for i, t in enumerate(ODD)]
    rows += [(50, 0, None, None), (50, None, "assistant", "first"), (50, 0, "we:ird\nrole ###", "t"), (None, 1, "assistant", "x"),
             (51, 3, "assistant", "a"), (51, 3, "assistant", "a"), (51, 3, "assistant", "B")]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string").withColumn("layout", F.lit(1))
    table = chat.canonical_table(df)
    out = chat.format_turns(table)
    back = {r.conv_id: r for r in chat_digests(out).collect()}
    turns = {r.conv_id: [tuple(t) for t in r.t] for r in out.select("conv_id", chat.parsed_turns(F.col("formatted")).alias("t")).collect()}
    want = {}
    for c, n, role, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert turns == want
    for c, own in want.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert back[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (back[c].n_turns, back[c].loss_chars) == (len(own), len(loss))
        assert back[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.canonical_table(df.filter("false")).count() == 0


def test_typed_tables_go_by_their_schema(spark):
    df = spark.sql("SELECT array(named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', 'a')) "
                   "AS messages, 7L AS conv_id, 'x' AS record")
    r = chat.canonical_table(df).first()
    assert (r.conv_id, r.layout, [tuple(t) for t in r.turns]) == (7, "messages", [("user", "q"), ("assistant", "a")])
    assert chat.schema_paths(df.schema) == ["messages[].role", "messages[].content", "conv_id", "record"]


def test_the_schema_fingerprint_selects_the_table_mapping(spark):
    of = {p: spark.range(1).select(chat.fingerprint(F.array(*map(F.lit, p)))).first()[0] for p in (chat.TURN_ROWS, ("a", "b[].c"))}
    assert all(chat.schema_fingerprint(p) == h for p, h in of.items())
    rows = [(1, 0, "user", "q", "p", "s"), (1, 1, "assistant", "a", "p", "s")]
    turned = frame(spark, rows, "conv_id long, turn int, role string, text string, prompt string, system string")
    r = chat.canonical_table(turned).first()
    assert (r.fingerprint, r.layout, [tuple(t) for t in r.turns]) == (of[chat.TURN_ROWS], "turn_rows", [("user", "q"), ("assistant", "a")])
    # without the turn's number it is no table of turns
    assert chat.canonical_table(turned.drop("turn").withColumn("completion", F.lit("c"))).first().layout == "prompt_system"
