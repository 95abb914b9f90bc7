from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from opine.llm import chat_format
from opine.llm.queries import REGISTRY, op12_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ODD = ["", "<", "|", "<|", r"<\|", r"<\\|", r"<\\\|x<|y<", "<|im_end|>\n", "<|nl|>", "a\nb\r\n", "é😀<|im_start|>user\n", "\\", "<" * 50 + "|" * 3, "x" * 300_000]

RECORDS = [
    {"id": 1, "messages": [{"role": "human", "content": "hi"}, {"role": "assistant", "content": "yo"}, {"role": "tool", "content": None}]},
    {"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    {"id": 3, "instruction": "add", "input": "1 2", "output": "3"},
    {"id": 4, "instruction": "say", "system": "be kind"},
    {"id": 5, "prompt": "p", "completion": "c", "unknown": {"deep": 1}},
    {"id": 6, "prompt": "p", "response": "r", "system": "s"},
    {"id": 7, "question": "q?", "answer": "a!"},
    {"id": 8, "messages": []},
    {"id": 9, "prompt": "p", "answer": "no such layout"},
    {"id": 10, "role": "user", "text": "row"},
    {"id": 11},
    {"id": 7, "question": "q?", "answer": "a!"},
    {"id": 12, "messages": [{"role": "user"}, {"content": "x"}]},
]


def expected(record: dict) -> tuple[str | None, list[tuple[str, str]]]:
    """The turns of a record by plain Python, by looking at its keys."""
    names = {"human": "user", "gpt": "assistant"}
    keys = frozenset(record) - {"id", "unknown"}
    if keys == {"messages"}:
        return "messages", [(names.get(m.get("role"), m.get("role") or ""), m.get("content") or "") for m in record["messages"]]
    if keys == {"conversations"}:
        return "from and value", [(names.get(m["from"], m["from"]), m["value"]) for m in record["conversations"]]
    if keys == {"role", "text"}:
        return "turn row", [(record["role"], record["text"])]
    if "instruction" in keys:
        user = "\n".join(record[k] for k in ("instruction", "input") if k in record)
        found = [("system", record.get("system")), ("user", user), ("assistant", record.get("output"))]
        return "instruction", [(r, t) for r, t in found if t is not None]
    pairs = {
        frozenset({"prompt", "completion"}): "prompt and completion",
        frozenset({"prompt", "response"}): "prompt and response",
        frozenset({"question", "answer"}): "question and answer",
    }
    name = pairs.get(keys - {"system"})
    if name is None:
        return None, []
    first, second = (k for k in ("prompt", "question", "completion", "response", "answer") if k in keys)
    turns = [("user", record[first]), ("assistant", record[second])]
    return name, ([("system", record["system"])] if "system" in keys else []) + turns


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("records") / "records.json"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    return spark.read.json(str(path))


def test_each_layout_is_found_by_its_fingerprint(records):
    rows = chat_format.canonical(records, ["id"]).collect()
    found = sorted((r.id, r.layout or "", -1 if r.place is None else r.place, r.role or "", r.text or "") for r in rows)
    wanted = []
    for record in RECORDS:
        layout, turns = expected(record)
        wanted += [(record["id"], layout or "", n, *turn) for n, turn in enumerate(turns)] or [(record["id"], layout or "", -1, "", "")]
    assert found == sorted(wanted)


def test_parts_of_messages_are_joined(spark, tmp_path):
    path = tmp_path / "parts.json"
    path.write_text(json.dumps({"id": 1, "messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}))
    (row,) = chat_format.canonical(spark.read.json(str(path)), ["id"]).collect()
    assert (row.layout, row.role, row.text) == ("messages of parts", "user", "a\nb")


def test_layouts_found_names_what_is_not_declared(records):
    found = {tuple(r.paths): (r.layout, r.n) for r in chat_format.layouts_found(records).collect()}
    assert found[("answer", "prompt")] == (None, 1)
    assert found[("answer", "question")] == ("question and answer", 2)
    assert found[("completion", "prompt")][0] == "prompt and completion"
    assert sum(n for _, n in found.values()) == len(RECORDS)


def test_layouts_that_cannot_be_told_apart_are_refused():
    first = chat_format.Layout("one", (), ("a",), ("b",))
    with pytest.raises(ValueError, match="share the fields"):
        chat_format.registry([first, chat_format.Layout("two", (), ("a", "b"))])


def digest_rows(rows: list[tuple]) -> dict:
    """The contract, by plain Python."""
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c == conv)
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def digested(rows) -> dict:
    found = chat_format.conversations(chat_format.formatted(op12_turns(rows)), "conv_id", ["turn"]).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}


def test_texts_roles_and_masks_are_read_back(spark):
    rows = [(n, t, role, text) for n, text in enumerate(ODD) for t, role in enumerate(["user", "assistant", "assistant", text[:40]])]
    rows += [(50, None, None, None), (50, None, "assistant", None), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (None, 3, "user", "null key")]
    assert digested(spark.createDataFrame(rows, SCHEMA).repartition(5)) == digest_rows(rows)


def test_no_text_can_close_its_turn(spark):
    rows = spark.createDataFrame([(n, 0, "assistant", text) for n, text in enumerate(ODD)], SCHEMA)
    pieces = chat_format.formatted(op12_turns(rows)).select("piece", "loss_start", "loss_end").collect()
    for row in pieces:
        assert row.piece.count("<|") == 2 and row.piece.endswith("<|im_end|>\n")
    whole = "".join(r.piece for r in pieces)
    assert len(whole.split("<|im_end|>\n")) == len(ODD) + 1


def test_clashing_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "x")], SCHEMA)
    extra = rows.withColumns({c: F.lit(7) for c in ("piece", "loss_start", "prompt", "layout", "place", "messages")})
    assert digested(extra) == digest_rows([(1, 0, "assistant", "x")])
    assert digested(rows.limit(0)) == {}


def test_query_holds_the_hostile_conversation(spark, tiny):
    rows = {r.conv_id: r for r in REGISTRY["op12_chat_format"](spark, tiny).collect()}
    table = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    table += [(-1, 0, "user", chat_format.HOSTILE), (-1, 1, "assistant", chat_format.HOSTILE)]
    wanted = digest_rows(table)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in rows.items()} == wanted
    assert rows[-1].loss_chars == len(chat_format.HOSTILE)


def test_native_plan(spark, tiny):
    plan = REGISTRY["op12_chat_format"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
