import hashlib
import json
import random

from pyspark.sql import functions as F

from aerotrace.llm import chat


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_round_trip_of_control_strings(spark):
    rng = random.Random(3)
    bits = list(chat.CONTROL) + ["\\", "\\\\", "<", "|", "im_end", "[", "/", "s>", "\n", "a", "é", "\U0001f600", " "]
    rows, want = [], {}
    for conv in range(60):
        turns = [(t, rng.choice(["user", "assistant", "system", "tool"]), "".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))))
                 for t in range(rng.randrange(1, 9))]
        rows += [(conv, t, role, text) for t, role, text in turns]
        said = [text for _, role, text in turns if role == "assistant"]
        want[conv] = (len(turns), digest(f"{r}\n{x}\n" for _, r, x in turns), len("".join(said)), digest(said))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = chat.format_records(chat.chat_records(df))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digests(out).collect()}
    assert got == want
    for r in out.collect():  # marks stand only where the template puts them
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == want[r.conv_id][0]
        assert not any(c in r.formatted for c in chat.CONTROL[2:])


def test_long_conversation_is_joined_in_order(spark):
    n = 3 * chat.BLOCK_TURNS + 17
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t}") for t in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    r = chat.chat_digests(chat.format_records(chat.chat_records(df))).collect()[0]
    rows.sort()
    assert r.n_turns == n and r.turns_sha256 == digest(f"{x[2]}\n{x[3]}\n" for x in rows)
    assert r.loss_sha256 == digest(x[3] for x in rows if x[2] == "assistant")


def test_layouts_give_the_same_turns(spark):
    turns = [("user", "hi"), ("assistant", "yes")]
    records = {
        1: {"messages": [{"role": r, "content": t} for r, t in turns]},
        2: {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yes"}], "id": 7},
        3: {"prompt": "hi", "response": "yes"},
        4: {"completion": "yes", "prompt": "hi", "extra": {"a": [1]}},
        5: {"instruction": "hi", "output": "yes"},
        6: {"instruction": "hi", "input": "", "output": "yes"},
        7: {"instruction": "hi", "input": "x", "output": "yes"},
        8: {"system": "be kind", "prompt": "hi", "response": "yes"},
        9: {"nothing": 1}, 10: [1, 2], 11: None,
    }
    rows = [(k, 0, json.dumps(v) if v is not None else None) for k, v in records.items()] + [(12, 0, "{broken"), (13, 0, "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "turn", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(got[k] == turns for k in (1, 2, 3, 4, 5, 6))
    assert got[7] == [("user", "hi\n\nx"), ("assistant", "yes")]
    assert got[8] == [("system", "be kind"), *turns]
    assert not set(got) & {9, 10, 11, 12, 13}
    prints = {r.conv_id: r.h for r in df.select("conv_id", chat.fingerprint(chat.field_paths(F.col("record"))).alias("h")).collect()}
    assert len({prints[k] for k in (1, 2, 3, 4, 5, 6, 8)}) == 7


def test_fields_of_other_layouts_do_not_hide_a_record(spark):
    turns, told = [("user", "hi"), ("assistant", "yes")], ("system", "be kind")
    said = [{"role": r, "content": t} for r, t in turns]
    shared = [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yes"}]
    records = {
        1: ({"instruction": "hi", "input": "", "output": "yes", "text": "hi yes"}, turns),
        2: ({"prompt": "hi", "messages": said}, turns),
        3: ({"conversations": shared, "system": "be kind"}, [told, *turns]),
        4: ({"messages": said, "system": "be kind"}, [told, *turns]),
        5: ({"prompt": "hi", "response": "yes", "input": "x"}, [("user", "hi\n\nx"), ("assistant", "yes")]),
        6: ({"messages": [{"role": "system", "content": "be kind"}, *said], "system": "be kind"}, [told, *turns]),
        7: ({"messages": said, "system": None}, turns),
        8: ({"messages": said, "conversations": shared}, turns),
        9: ({"role": "user", "text": "hi", "id": 3, "prompt": None}, turns[:1]),
        10: ({"prompt": "hi", "completion": "yes", "input": "x", "output": "z"}, [("user", "hi\n\nx"), ("assistant", "yes")]),
    }
    rows = [(k, 0, json.dumps(v)) for k, (v, _) in records.items()]
    rows += [(20, 0, '{"prompt": "hi"}'), (21, 0, "{broken"), (22, 0, None), (23, 0, '{"system": "a", "input": "b"}')]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "turn", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {k: want for k, (_, want) in records.items()}
    unknown = chat.unknown_records(df).collect()
    assert sorted((r.conv_id, r.turn, r.record, r.layout) for r in unknown) == [(*r, None) for r in rows if r[0] >= 20]


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, record string, block long"
    assert chat.chat_digests(chat.format_records(chat.chat_records(spark.createDataFrame([], schema)))).count() == 0
    rows = [(None, None, None, None, "x", 1), (1, 0, "assistant", "b", None, None), (1, 0, "assistant", "b", None, None),
            (1, None, "user", "last", "", 0), (2, 0, "assistant", None, None, None), (3, 0, "user", "z" * 200000, None, None)]
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_records(chat.chat_records(spark.createDataFrame(rows, schema)))).collect()}
    assert got[None].n_turns == 1 and got[None].turns_sha256 == digest(["\n\n"])
    assert got[1].turns_sha256 == digest(["assistant\nb\n"] * 2 + ["user\nlast\n"]) and got[1].loss_chars == 2
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == digest([])
    assert got[3].formatted_chars > 200000


def test_probe_reads_back(spark):
    out = {r.conv_id: r for r in chat.op4_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    probe = out[-1]
    assert probe.n_turns == 2 and probe.turns_sha256 == digest([f"user\n{chat.PROBE}\n", f"assistant\n{chat.PROBE}\n"])
    assert probe.loss_chars == len(chat.PROBE) and probe.loss_sha256 == digest([chat.PROBE])


def test_roles_come_back_as_they_were(spark):
    import hashlib

    from aerotrace.llm.chat import chat_digests, chat_records, format_records
    roles = ["tool  call", "user\tadmin", "a\nb", "%0A %25 %", "\\ <|im_end|>", "", " assistant ", "assistant"]
    rows = [(1, i, r, f"text {i}") for i, r in enumerate(roles)]
    got = chat_digests(format_records(chat_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    assert [(r.n_turns, r.turns_sha256, r.loss_chars) for r in got] == [(len(roles), hashlib.sha256(said.encode()).hexdigest(), len("text 7"))]
