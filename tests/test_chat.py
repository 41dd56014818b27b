import random

import pytest
from pyspark.sql import functions as F

from answerloom.operators import chat

ROWS = [("ask {OUTPUT}", "", "say {INPUT}"), ("x", "", "y")]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(ROWS, "instruction string, input string, output string")


def test_conversation_and_roles(records):
    said = chat.to_conversation(records)
    assert [tuple(t) for t in said.first().conversations] == [("human", "ask {OUTPUT}"), ("gpt", "say {INPUT}")]
    roles = chat.standardize_roles(said)
    assert [tuple(t) for t in roles.first().conversations] == [("user", "ask {OUTPUT}"), ("assistant", "say {INPUT}")]
    assert roles.schema["conversations"].dataType.elementType.fieldNames() == ["role", "content"]


def test_merged_prompt(records):
    said = chat.to_conversation(records, prompt="Q: {instruction}! {other}")
    assert said.first().conversations[0]["value"] == "Q: ask {OUTPUT}! {other}"


def test_placeholders_inside_content_stay(records):
    rendered = chat.render_chat(chat.standardize_roles(chat.to_conversation(records)), end="<end>").first().text
    assert rendered == chat.CHAT_TEMPLATE.partition("{INPUT}")[0] + "ask {OUTPUT}\n\n### Response:\nsay {INPUT}<end>"
    prompt = chat.render_prompt(records).first().prompt
    assert prompt.endswith("### Instruction:\nask {OUTPUT}\n\n### Response:\n")


def test_token_budget(spark):
    frame = spark.createDataFrame([("a b c",), ("a",)], "text string")
    assert [(r.n_tokens, r.fits) for r in chat.token_budget(frame, budget=2).collect()] == [(3, False), (1, True)]
    given = chat.token_budget(frame, budget=3, tokens=F.length("text"))
    assert [r.fits for r in given.collect()] == [False, True]


def test_long_conversations_become_bounded_parts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", str(t)) for t in range(1000)] + [(2, 0, "user", "hi")]
    random.Random(0).shuffle(rows)
    parts = chat.collect_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {(r.conv_id, r.part): [t.content for t in r.conversations] for r in parts.collect()}
    assert max(map(len, found.values())) == 64 and found[2, 0] == ["hi"]
    assert sum((found[1, p] for p in range(16)), []) == [str(t) for t in range(1000)]


def next_fit(items, budget):
    packs = []
    for key, n in items:
        if not packs or packs[-1][1] + n > budget:
            packs.append(([], 0))
        packs[-1] = (packs[-1][0] + [key], packs[-1][1] + n)
    return packs


def test_packing(spark):
    rng = random.Random(2)
    sizes = {i: rng.choice([0, 1, 30, 100, 511, 512, 513, 2000]) for i in range(2000)}
    frame = spark.createDataFrame(list(sizes.items()), "id long, n int")
    packs = chat.pack_sequences(frame, "id", "n", 7).collect()
    shards = {p.shard for p in packs}
    assert shards == set(range(7))
    assert sorted(i for p in packs for i in p.ids) == list(range(2000))
    for shard in shards:
        mine = sorted((p.pack_id, p.ids, p.n_tokens) for p in packs if p.shard == shard)
        items = sorted((i, sizes[i]) for _, ids, _ in mine for i in ids)
        assert [(ids, n) for _, ids, n in mine] == next_fit(items, 512)
    again = chat.pack_sequences(frame.repartition(3), "id", "n", 7).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, packs), key=str)
    assert chat.pack_sequences(frame.limit(0), "id", "n", 7).count() == 0


def test_packing_of_text_keys_and_of_nulls(spark):
    frame = spark.createDataFrame([("b", 300), ("a", 200), ("c", 100)], "id string, n int")
    packs = chat.pack_sequences(frame, "id", "n", 1).collect()
    assert [(p.ids, p.n_tokens) for p in packs] == [(["a", "b"], 500), (["c"], 100)]
    for row in [("d", None), (None, 5)]:
        with pytest.raises(Exception, match="has no"):
            chat.pack_sequences(frame.union(spark.createDataFrame([row], frame.schema)), "id", "n", 1).collect()


def plain_chat(turns, end=""):
    """The rendering rules over (role, content) pairs."""
    preface, gap, opening = chat.CHAT_TEMPLATE.partition("{INPUT}")[0].rpartition("\n\n")
    between = chat.CHAT_TEMPLATE.partition("{INPUT}")[2].partition("{OUTPUT}")[0]
    if not any(role == "assistant" for role, _ in turns):
        return None
    if turns[0][0] == "system":
        text, rest = turns[0][1] + gap, turns[1:]
    else:
        text, rest = preface + gap, turns
    for i, (role, content) in enumerate(rest):
        lead = gap if i else ""
        text += between + content + end if role == "assistant" else lead + ("" if role == "system" else opening) + content
    return text


CONVERSATIONS = [
    [("user", "a"), ("assistant", "b")],
    [("system", "s {INPUT}"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],
    [("user", "only")],
    [("system", "s")],
    [("assistant", "first"), ("user", "a"), ("user", "b"), ("tool", "t"), ("assistant", "x"), ("assistant", "y"), ("system", "late")],
    [("user" if i % 2 == 0 else "assistant", str(i)) for i in range(7)],
]


def turn_rows(spark):
    rows = [(c, i, role, content) for c, turns in enumerate(CONVERSATIONS) for i, (role, content) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("per_part", [64, 3, 2])
def test_whole_conversations_are_rendered_by_role(spark, per_part):
    parts = chat.collect_turns(turn_rows(spark), per_part)
    whole = chat.render_chat(chat.join_parts(parts), end="<e>").collect()
    assert {r.conv_id: r.text for r in whole} == {c: plain_chat(t, "<e>") for c, t in enumerate(CONVERSATIONS)}
    assert tuple(chat.without_answer(chat.join_parts(parts)).first()) == (6, 2)
    rendered = sorted((r.conv_id, r.part, r.text) for r in chat.render_chat(parts, end="<e>", part="part").collect())
    for c in (0, 1, 4, 5):
        assert "".join(t for conv, _, t in rendered if conv == c) == plain_chat(CONVERSATIONS[c], "<e>")


def test_templates_need_both_places(records):
    for template in ("{INPUT}", "{OUTPUT}{INPUT}", "{INPUT}{INPUT}{OUTPUT}"):
        with pytest.raises(ValueError):
            chat.render_chat(records, template)


@pytest.mark.parametrize("extra", [(None, 0, "user", "x"), (1, None, "user", "x"), (1, 0, "user", "again")])
def test_turns_without_a_place_of_their_own_are_an_error(spark, extra):
    turns = turn_rows(spark)
    with pytest.raises(ValueError, match="two turns"):
        chat.collect_turns(turns, 1)
    with pytest.raises(ValueError, match="of their own"):
        chat.collect_turns(turns.union(spark.createDataFrame([extra], turns.schema)))
