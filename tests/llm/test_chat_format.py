import hashlib
import json
import random

import pytest

from loanlens.llm.chat_format import (
    LAYOUTS, Each, Layout, Said, escape, field_paths, fingerprint, format_chats, format_turn, mapping_table, parse_turns,
    read_back, unescape,
)
from loanlens.llm.common import cut_lineage
from loanlens.llm.queries import PLANTED, chat_records, op13_chat_format

SCHEMA = "conv_id long, at long, record string, part long, whole string, k0 double, mask int"


def records(spark, rows):
    """Records with columns whose names clash with those inside the operator."""
    rows = [(c, a, r if r is None or isinstance(r, str) else json.dumps(r), 1, "x", 2.0, 3) for c, a, r in rows]
    return spark.createDataFrame(rows, SCHEMA)


def turns_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["part"]):
        out.setdefault(r["conv_id"], []).extend(parse_turns(r["formatted"]))
    return out


def test_escapes_are_reversible():
    rng = random.Random(1)
    bits = ["[INST]", "[/INST]", "</s>", "<s>", "[BOT]", "[/TURN]", "[ROLE]", "\\", "[", "<", "a", "\n", "INST]", "/s>"]
    for _ in range(5000):
        turns = [("".join(rng.choices(["user", "assistant", "system", "tool", "", *bits], k=rng.choice([1, 1, 2]))),
                  "".join(rng.choices(bits, k=rng.randrange(7)))) for _ in range(rng.randrange(4))]
        assert list(parse_turns("".join(format_turn(*t)[0] for t in turns))) == turns
        for _, text in turns:
            assert unescape(escape(text)) == text
            assert not any(mark in escape(text) for mark in ("[INST]", "[/INST]", "</s>", "<s>", "[BOT]", "[ROLE]"))


def test_paths_and_fingerprints():
    value = {"id": 1, "messages": [{"role": "u", "content": "x"}, {"role": "u", "tool": {"a": None, "b": {}}}], "e": []}
    assert field_paths(value) == {"messages[]", "messages[].role", "messages[].content", "messages[].tool.a",
                                  "messages[].tool.b", "e[]"}
    assert fingerprint({"a", "b"}) == fingerprint({"b", "a"}) != fingerprint({"a.b"})
    # Every layout can be reached.
    assert {layout.name for layout in mapping_table().values()} == {layout.name for layout in LAYOUTS}


def test_layouts_become_turns(spark):
    u, a = ("user", "q"), ("assistant", "r")
    cases = [
        ({"messages": [{"role": "user", "content": "q"}, {"content": "r", "role": "assistant"}]}, [u, a]),
        ({"messages": [{"role": None, "content": None}, {"content": "x"}]}, [("", ""), ("", "x")]),
        ({"messages": []}, []),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, [u, a]),
        ({"prompt": "q", "completion": "r", "meta": {"url": 1}}, [u, a]),
        ({"system": "s", "prompt": "q", "response": "r"}, [("system", "s"), u, a]),
        ({"instruction": "i", "input": "j", "output": "r"}, [("user", "i\n\nj"), a]),
        ({"instruction": "q", "output": None}, [u, ("assistant", "")]),
        ({"prompt": 3}, [("user", "3")]),
    ]
    df = format_chats(records(spark, [(i, 0, r) for i, (r, _) in enumerate(cases)]), ["at"])
    assert turns_of(df) == {i: turns for i, (_, turns) in enumerate(cases)}


def test_own_layout(spark):
    own = Layout("dialogue", ("log[]", "log[].who", "log[].line", "title"), (Said("system", ("title",)), Each("log", "who", "line")))
    df = records(spark, [(1, 0, {"title": "t", "log": [{"who": "ann", "line": "hi"}]}), (1, 1, {"prompt": "x"})])
    row = format_chats(df, ["at"], layouts=(own,), trained=frozenset({"ann"})).collect()[0]
    assert list(parse_turns(row["formatted"])) == [("system", "t"), ("ann", "hi")]
    assert [row["formatted"][m["start"] : m["end"]] for m in row["mask"]] == ["hi"]
    assert row["unread"] == [fingerprint({"prompt"})]


def test_unread_records_and_edges(spark):
    rows = [(1, 0, None), (1, 1, ""), (1, 2, "{"), (1, 3, "[1]"), (1, 4, "3"), (1, 5, {"messages": ["x"]}),
            (1, 6, {"other": 1}), (1, 7, {}), (None, 0, {"prompt": "n"}), (2, None, {"prompt": "b"}),
            (2, 0, {"prompt": "a"}), (2, 0, {"prompt": "a"}), (3, 0, {"prompt": "w " * 100_000})]
    df = format_chats(records(spark, rows), ["at"])
    got = turns_of(df)
    assert got[1] == [] and got[None] == [("user", "n")]
    assert [t for _, t in got[2]] == ["b", "a", "a"]  # null first, repeated rows stay
    assert len(got[3][0][1]) == 200_000
    unread = [u for r in df.collect() if r["conv_id"] == 1 for u in r["unread"]]
    assert len(unread) == 8 and unread.count("no JSON") == 2
    assert format_chats(records(spark, rows).limit(0), ["at"]).collect() == []


@pytest.mark.parametrize("part_chars", [10, 1 << 20])
def test_digests_over_parts_and_tasks(spark, part_chars):
    rng = random.Random(4)
    said = {c: [(rng.choice(["user", "assistant", "tool"]), rng.choice(["", "x </s>", "\\[INST]", "é𝄞" * 9])) for _ in range(n)]
            for c, n in [(0, 400), (1, 1), (2, 3), (3, 30)]}
    rows = [(c, i, r, t) for c, turns in said.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    formatted = cut_lineage(format_chats(chat_records(df), ["turn"], part_chars=part_chars))
    assert formatted.where("conv_id = 0 AND NOT whole").count() > 1 or part_chars > 100
    got = {r["conv_id"]: r for r in read_back(formatted).collect()}
    for c, turns in said.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(format_turn(*t)[0] for t in turns)
        assert tuple(got[c])[1:] == (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole),
        )
    assert len(got) == len(said)


def test_query_has_the_planted_conversation(spark, sf):
    got = {r["conv_id"]: r for r in op13_chat_format(spark, sf).collect()}
    both = f"user\n{PLANTED}\nassistant\n{PLANTED}\n"
    assert got[-1]["turns_sha256"] == hashlib.sha256(both.encode()).hexdigest()
    assert (got[-1]["n_turns"], got[-1]["loss_chars"]) == (2, len(PLANTED))
