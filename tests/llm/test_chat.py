"""Preference pairs: masks, escapes, missing sides and ties."""

from __future__ import annotations

from flowtide.llm import chat


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "pair_id long, side string, turn long, role string, text string, prompt int")


def test_prompt_and_masks(spark):
    rows = [(1, "chosen", 0, "system", "S"), (1, "chosen", 1, "user", "Q"), (1, "chosen", 2, "assistant", "good"),
            (1, "rejected", 0, "system", "S"), (1, "rejected", 1, "user", "Q"), (1, "rejected", 2, "assistant", "bad"),
            (1, "rejected", 3, "user", "why"), (1, "rejected", 4, "assistant", "ok <|end|>")]
    r = chat.preference_pairs(turns(spark, rows)).first()
    assert r["n_prompt_turns"] == 2 and r["prompt"] == "<|system|>\nS<|end|>\n<|user|>\nQ<|end|>\n"
    assert r["chosen"] == "<|assistant|>\ngood<|end|>\n"
    trained = lambda s: [r[s][a:b] for a, b in r[f"{s}_mask"]]
    assert trained("chosen") == ["good<|end|>"]
    assert trained("rejected") == ["bad<|end|>", "ok < |end|><|end|>"]


def test_equal_empty_and_one_sided(spark):
    rows = [(1, "chosen", 0, "user", "Q"), (1, "rejected", 0, "user", "Q"), (2, "chosen", 0, "assistant", "A"),
            (3, "chosen", 0, "user", "x"), (3, "rejected", 0, "user", "y"), (None, "chosen", 0, "user", "z"), (4, None, 0, "user", "z")]
    found = {r["pair_id"]: r for r in chat.preference_pairs(turns(spark, rows)).collect()}
    assert sorted(found) == [1, 2, 3]
    assert (found[1]["n_prompt_turns"], found[1]["chosen"], found[1]["rejected"], found[1]["chosen_mask"]) == (1, "", "", [])
    assert found[2]["rejected"] is None and found[2]["rejected_mask"] is None and found[2]["prompt"] == ""
    assert found[2]["chosen"] == "<|assistant|>\nA<|end|>\n" and found[3]["n_prompt_turns"] == 0
    assert chat.preference_pairs(turns(spark, [])).count() == 0


def test_nulls_ties_and_repeated_turns(spark):
    rows = [(1, "chosen", None, "user", "last"), (1, "chosen", 2, None, None), (1, "chosen", 1, "user", "b"), (1, "chosen", 1, "user", "a"),
            (1, "chosen", 1, "user", "a"), (1, "rejected", 1, "user", "a"), (1, "rejected", 7, "user", "a"), (1, "rejected", 8, "user", "c")]
    r = chat.preference_pairs(turns(spark, rows)).first()
    a = "<|user|>\na<|end|>\n"
    assert r["prompt"] == a + a and r["rejected"] == a.replace("a<", "c<")
    assert r["chosen"] == a.replace("a<", "b<") + "<||>\n<|end|>\n" + a.replace("a<", "last<")


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, side string")


def test_answers_are_exchanged_between_partners(spark):
    big = 2 ** 53 + 2  # beyond what a double can tell apart
    rows = [(big, 0, "user", "Q"), (big, 1, "assistant", "A"), (big, 2, "user", "thanks"), (big + 1, 0, "user", "P"),
            (big + 1, 1, "assistant", "old"), (big + 1, 2, "user", "more"), (big + 1, 3, "assistant", "B"),
            (-1, 0, "user", "q"), (-1, 1, "assistant", "minus"), (-2, 0, "assistant", "two"),
            (8, 0, "user", "alone"), (8, 1, "assistant", "answer"), (20, 0, "user", "no answer"), (21, 0, "assistant", "z"),
            (None, 0, "user", "lost")]
    found = {r["pair_id"]: r for r in chat.formatted(chat.answer_pairs(conversations(spark, rows))).collect()}
    assert sorted(found) == [-2, -1, 8, 20, 21, big, big + 1]
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert found[big]["prompt"] == turn("user", "Q") and found[big]["rejected"] == turn("assistant", "B")
    assert found[big]["chosen"] == turn("assistant", "A") + turn("user", "thanks")
    assert found[big + 1]["n_prompt_turns"] == 3 and found[big + 1]["rejected"] == turn("assistant", "A")
    assert found[-1]["rejected"] == turn("assistant", "two") and found[-2]["rejected"] == turn("assistant", "minus")
    assert found[8]["rejected"] is None and found[20]["rejected"] is None and found[21]["rejected"] is None
    assert chat.answer_pairs(conversations(spark, [])).count() == 0


def test_most_given_conversations_have_a_prompt(spark):
    from flowtide.llm.queries import op9_preference_chat

    rows = op9_preference_chat(spark, "/root/testdata/sf0.001").collect()
    assert sum(r["n_prompt_turns"] > 0 for r in rows) > 0.5 * len(rows)
