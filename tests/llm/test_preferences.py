from __future__ import annotations

from gradewell.llm import preferences as p

TURNS = "conv_id bigint, turn bigint, role string, text string, row int, key int"


def test_common_prefix_is_rendered_once():
    shared = [("system", "S"), ("user", "U")]
    found = p.format_pair([*shared, ("assistant", "good")], [*shared, ("assistant", "bad"), ("user", "?"), ("assistant", "")])
    assert found["prompt_turns"] == 2
    assert found["prompt"] == "<|system|>\nS<|end|>\n<|user|>\nU<|end|>\n"
    assert found["chosen"] == "<|assistant|>\ngood<|end|>\n"
    spans = [found["chosen"][a:b] for a, b in found["chosen_mask"]]
    assert spans == ["good<|end|>"]
    assert [found["rejected"][a:b] for a, b in found["rejected_mask"]] == ["bad<|end|>", "<|end|>"]


def test_prefix_of_one_another_and_empty():
    one = [("user", "a"), ("assistant", "b")]
    assert p.format_pair(one, one)["chosen"] == p.format_pair(one, one)["rejected"] == ""
    assert p.format_pair(one, one[:1])["rejected"] == "" and p.format_pair(one, one[:1])["prompt_turns"] == 1
    assert p.format_pair([], one)["prompt"] == "" and p.format_pair([], [])["chosen_mask"] == []
    assert p.common_turns([("user", None)], [("user", "")]) == 0


def test_odd_turns(spark):
    rows = [
        (0, 1, "user", "q"), (0, 1, "user", "q"), (0, 2, "assistant", "x"), (0, 2, "assistant", "y"), (0, None, None, None),
        (1, 5, "assistant", None), (2, 1, "assistant", "alone"), (4, 1, "user", "no answer"), (5, 1, "assistant", "z"),
        (None, 1, "user", "nobody's"),
    ]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS)
    found = {r.pair: r for r in p.format_pairs(p.mismatched_pairs(turns)).collect()}
    assert set(found) == {0, 1, 2, 4, 5}  # every conversation
    assert found[0].prompt == "<|" + "|>\n<|end|>\n<|user|>\nq<|end|>\n<|assistant|>\nx<|end|>\n"
    assert (found[0].chosen, found[0].rejected) == ("<|assistant|>\ny<|end|>\n", "<|assistant|>\n<|end|>\n")
    assert (found[1].chosen, found[1].rejected) == ("<|assistant|>\n<|end|>\n", "<|assistant|>\ny<|end|>\n")
    assert (found[2].prompt, found[2].chosen, found[2].rejected) == ("", "<|assistant|>\nalone<|end|>\n", "")  # no neighbour
    assert (found[4].prompt_turns, found[4].chosen, found[4].rejected) == (1, "", "")  # no answer
    assert (found[5].chosen, found[5].rejected, found[5].rejected_mask) == ("<|assistant|>\nz<|end|>\n", "", [])  # neighbour without answer
    assert p.format_pairs(p.mismatched_pairs(turns.limit(0))).count() == 0


def test_turns_after_an_answer_without_another(spark):
    rows = [(8, 1, "user", "q"), (8, 2, "assistant", "a"), (8, 3, "user", "thanks")]
    (row,) = p.format_pairs(p.mismatched_pairs(spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS))).collect()
    assert row.prompt == "<|user|>\nq<|end|>\n" and row.rejected == ""
    assert row.chosen == "<|assistant|>\na<|end|>\n<|user|>\nthanks<|end|>\n" and len(row.chosen_mask) == 1


def test_ids_that_are_no_numbers_and_long_turns(spark):
    long = "many words " * 100_000
    rows = [("x", 1, "user", long), ("x", 2, "assistant", long), ("y", 1, "assistant", "b"), ("10", 1, "assistant", "c"), ("11", 1, "assistant", "d")]
    turns = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    found = {r.pair: r for r in p.format_pairs(p.mismatched_pairs(turns)).collect()}
    assert set(found) == {"x", "y", "10", "11"}
    assert found["x"].rejected == "" and long in found["x"].chosen and long in found["x"].prompt
    assert "d" in found["10"].rejected and "c" in found["11"].rejected


def test_every_conversation_of_the_small_table(spark, small_folder):
    from gradewell.llm.queries import QUERIES

    ids = {r.conv_id for r in spark.read.parquet(f"{small_folder}/conversations.parquet").collect()}
    assert sorted(r.conv_id for r in QUERIES["op4_preference_format"](spark, small_folder).collect()) == sorted(i for i in ids if i is not None)
