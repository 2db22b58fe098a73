"""Chat formatting: exact round trip, order of turns, escapes, odd rows."""

from __future__ import annotations

import hashlib
import random

from strandline.llm import chat_format as c

TURNS = "conv_id long, turn long, role string, text string"


def _back(spark, rows):
    df = spark.createDataFrame(rows, TURNS)
    return {r["conv_id"]: r for r in c.read_chats(c.format_chats(df)).collect()}


def test_round_trip_of_random_control_strings(spark):
    rng = random.Random(5)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE 61] ", "[/ROLE]", "\\", "<", "[", " ", "\n", "a", "é", "<\\s>", "[\\\\INST]", "$1"]
    rows = [(i, t, rng.choice(["user", "assistant", "system", "tool", "", "rôle]"]), "".join(rng.choices(parts, k=rng.randint(0, 12))))
            for i in range(60) for t in range(rng.randint(1, 5))]
    got = _back(spark, rows)
    for i in range(60):
        own = [(r, x) for n, _, r, x in rows if n == i]
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == own
        assert got[i]["loss_text"] == "".join(x for r, x in own if r == "assistant")
        assert got[i]["formatted"] == "".join(s["text"] for s in got[i]["segments"])


def test_machine(spark):
    chats = {1: "sua", 2: "ua", 3: "uaua", 4: "u", 5: "au", 6: "uua", 7: "us", 8: "uxa"}
    name = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    got = _back(spark, [(k, i, name[r], "hi") for k, v in chats.items() for i, r in enumerate(v)])
    assert {k: got[k]["valid"] for k in chats} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False, 8: False}


def test_odd_rows(spark):
    got = _back(spark, [(None, 0, "user", None), (1, None, None, "x"), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"), (2, 0, "assistant", "z" * 300000)])
    assert [t["text"] for t in got[None]["turns"]] == [""]
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("", "x"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[2]["loss_text"] == "z" * 300000 and got[1]["loss_text"] == ""


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], TURNS)
    assert c.read_chats(c.format_chats(df)).count() == 0
    more = spark.createDataFrame([(1, 0, "user", "q", "s", "t", "x")], TURNS + ", segments string, t string, turns string")
    assert c.read_chats(c.format_chats(more)).first()["formatted"] == "<s>[INST] q [/INST]"


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "q")], TURNS)
    plan = c.read_chats(c.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_has_the_probe(spark):
    import __spark_entry__ as se
    from tests_paths import SF001

    row = se.queries()["op10_chat_format"](spark, SF001).where("conv_id = -7").first()
    probe = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["valid"] and row["loss_chars"] == len(probe)
    assert row["loss_sha256"] == hashlib.sha256(probe.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{probe}\nassistant\n{probe}\n".encode()).hexdigest()
