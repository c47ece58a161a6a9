"""Chat formatting: layouts, reversible escapes, and digests against plain hashing."""

import json
from collections import defaultdict
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from plugsites.llm import chat

LAYOUTS = [
    ({"role": "user", "text": "hi"}, [("user", "hi")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "x", "content": "b"}]}, [("user", "a"), ("x", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"completion": None, "prompt": "p"}, [("user", "p"), ("assistant", "")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "n", "output": "o"}, [("user", "i"), ("user", "n"), ("assistant", "o")]),
    ({"data": {"question": "q", "answer": 3}}, [("user", "q"), ("assistant", "3")]),
]


def test_layouts_are_told_by_their_fields():
    prints = set()
    for record, turns in LAYOUTS:
        print_, found = chat.canonical_turns(record)
        assert found == turns
        prints.add(print_)
    assert len(prints) == len(LAYOUTS) - 1  # the two instruction records are one layout
    assert chat.canonical_turns({"other": 1})[1] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "a", "é", "\n", "/"]), max_size=12))
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in chat.CONTROL)
    formatted = f"{chat.TURN}{escaped}{chat.BODY}{escaped}{chat.END}"
    assert chat.parse(formatted * 2) == [(text, text)] * 2


def plain_digests(rows):
    by = defaultdict(list)
    for key, turn, role, text in rows:
        by[key].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for key, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        learned = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        formatted = "".join(
            chat.TURN + chat.escape(r) + chat.BODY + chat.escape(t) + chat.END for r, t in turns
        )
        out[key] = (
            len(turns),
            sha256(whole.encode()).hexdigest(),
            len(learned),
            sha256(learned.encode()).hexdigest(),
            len(formatted),
        )
    return out


def test_awkward_conversations(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST] \\ <|turn|>"),
        (1, 1, "assistant", None),
        (1, 2, "assistant", "é\\<s>" * 2000),
        (2, None, None, ""),
        (None, 5, "tool", "no key"),
        (None, 4, "assistant", "no key"),
        (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"),
    ]
    records = spark.createDataFrame(
        [(k, t, json.dumps({"role": r or "", "text": x or ""}), 1) for k, t, r, x in rows]
        + [(9, 0, json.dumps({"unknown": 1}), 1), (9, 1, "no json", 1), (9, 2, None, 1)],
        "key long, position long, record string, part int",
    )
    turns = chat.turns_of(records)
    assert turns.where("part = -1").count() == 2
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(chat.formatted_turns(turns)).collect()}
    assert got == plain_digests(rows)
    assert chat.read_back(chat.formatted_turns(chat.turns_of(records.limit(0)))).count() == 0


def test_query_equals_plain_hashing(spark, folder):
    from plugsites.llm.catalog import CONTROL_CONVERSATION, QUERIES

    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op5_chat_format"](spark, folder).collect()}
    assert got == plain_digests(rows + CONTROL_CONVERSATION)


def test_roles_of_a_table_with_roles_stay(spark):
    assert chat.canonical_turns({"role": "human", "text": "a"})[1] == [("human", "a")]
    record = {"messages": [{"role": "bot", "content": "b"}]}
    assert chat.canonical_turns(record)[1] == [("bot", "b")]
    rows = [(1, 0, json.dumps({"role": "human", "text": "a"})), (1, 1, json.dumps({"role": "gpt", "text": "b"}))]
    records = spark.createDataFrame(rows, "key long, position long, record string")
    (row,) = chat.read_back(chat.formatted_turns(chat.turns_of(records))).collect()
    assert row.turns_sha256 == sha256(b"human\na\ngpt\nb\n").hexdigest() and row.loss_chars == 0


def test_loss_is_what_the_mask_says(spark):
    rows = [(1, 0, 0, "user", "<s>q", ""), (1, 1, 0, "assistant", "a\\<|b", ""), (1, 2, 0, "assistant", "é", "")]
    turns = chat.formatted_turns(spark.createDataFrame(rows, chat.TURNS))
    (row,) = chat.read_back(turns).collect()
    assert (row.loss_chars, row.loss_sha256) == (6, sha256("a\\<|bé".encode()).hexdigest())
    none = "array<struct<start:int,length:int>>"
    (row,) = chat.read_back(turns.selectExpr("key", "position", "part", "formatted", f"CAST(array() AS {none}) AS mask")).collect()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (3, 0, sha256(b"").hexdigest())


def test_query_equals_sql(spark, folder):
    from plugsites.llm.catalog import ORACLE_SQL, QUERIES
    from tests.oracle import connect, sorted_rows

    found = QUERIES["op5_chat_format"](spark, folder)
    expected = connect(folder).sql(ORACLE_SQL["op5_chat_format"])
    assert sorted_rows(found.collect(), found.columns) == sorted_rows(expected.fetchall(), expected.columns)
