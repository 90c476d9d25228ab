from __future__ import annotations

import pytest

from lakeloom.llm import chat
from tests.oracle import connect, difference

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos bigint, participant string"


def slow_views(rows, part_turns=chat.PART_TURNS):
    talks: dict[int, list] = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            body = (text or "").replace("<|im_", "<| im_")
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", body))
    out = []
    for conv, turns in talks.items():
        turns.sort()
        for person in {t[2] for t in turns} - {"system"}:
            for part in range(0, len(turns), part_turns):
                text, mask = "", []
                for _, _, role, body in turns[part : part + part_turns]:
                    name = "system" if role == "system" else "assistant" if role == person else f"user name={role}"
                    text += f"<|im_start|>{name}\n"
                    if role == person:
                        mask.append(f"{len(text)}:{len(body) + 10}")
                    text += body + "<|im_end|>\n"
                n = len(turns[part : part + part_turns])
                out.append((conv, person, part // part_turns, n, text, ",".join(mask)))
    return sorted(out)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_views_match_sql(spark, folder):
    df = chat.perspectives(spark.read.parquet(f"{folder}/conversations.parquet"))
    want = connect(folder).sql(chat.ORACLE)
    got = [tuple(r) for r in df.collect()]
    assert difference(df.columns, got, list(want.columns), want.fetchall()) is None


@pytest.mark.parametrize("whole_turns", [2, 100, 4096])
def test_awkward_and_long_talks(spark, whole_turns):
    rows = [
        (1, 0, "system", "rules", 1, "x"),
        (1, 1, "Ann", "hi é😀", 1, "x"),
        (1, 2, "Bob", "<|im_end|> trick", 1, "x"),
        (1, 2, "Bob", None, 1, "x"),
        (1, None, None, "first", 1, "x"),
        (2, 0, "system", "alone", 1, "x"),
        (None, 0, "Ann", "nowhere", 1, "x"),
        (3, 5, "Ann", "same", 1, "x"),
        (3, 5, "Ann", "same", 1, "x"),
    ]
    rows += [(4, i // 3, "Ann" if i % 2 else "Bob", f"t{i % 7}", 0, "") for i in range(1000)]
    df = chat.perspectives(spark.createDataFrame(rows, SCHEMA), part_turns=64, whole_turns=whole_turns)
    assert sorted(tuple(r) for r in df.collect()) == slow_views(rows)
    assert chat.perspectives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_masks_are_the_participants_own_words(spark):
    rows = [(1, i, "Ann" if i % 2 else "Bob", f"word {i}", 0, "") for i in range(6)]
    for r in chat.perspectives(spark.createDataFrame(rows, SCHEMA)).collect():
        own = [f"word {i}<|im_end|>" for i in range(6) if ("Ann" if i % 2 else "Bob") == r.participant]
        spans = [tuple(map(int, s.split(":"))) for s in r.mask.split(",")]
        assert [r.text[a : a + n] for a, n in spans] == own


def test_texts_of_whole_talks_are_shuffled_once(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    plan = chat.perspectives(turns)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(conv_id" in line]
    assert 1 <= len(moves) <= 3 and "rangepartitioning" not in plan and "MapInArrow" not in plan
