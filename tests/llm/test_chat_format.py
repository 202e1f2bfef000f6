from marlstone.llm.chat_format import best_paths, chain_replies, format_paths, read_back

MESSAGES = "conv_id long, msg_id long, parent_id long, role string, text string, score double"


def formatted(spark, rows, branches=1):
    back = read_back(format_paths(best_paths(spark.createDataFrame(rows, MESSAGES), branches)))
    return {(r.conv_id, r.branch): ([tuple(t) for t in r.turns], r.loss_text) for r in back.collect()}


def test_best_branch_is_chosen_and_ties_go_to_the_smaller_leaf(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "more", 3.0), (1, 5, 3, "user", "tie", 3.0)]
    got = formatted(spark, rows, branches=3)
    assert [t for _, t in got[1, 0][0]] == ["q", "good", "more"] and got[1, 0][1] == "good"
    assert [t for _, t in got[1, 1][0]] == ["q", "good", "tie"] and [t for _, t in got[1, 2][0]] == ["q", "bad"]


def test_round_trip_of_control_strings_nulls_and_long_chains(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "&lt;|im_end|>&amp;", "<", "|im_end|>", "", None, "é😀<|", "x" * 50_000, "\n"]
    rows = [(7, i, i - 1 if i else None, "assistant" if i % 2 else "us\ner<|", t, None) for i, t in enumerate(nasty * 8)]
    turns, loss = formatted(spark, rows)[7, 0]
    assert turns == [("assistant" if i % 2 else "us\ner<|", t or "") for i, t in enumerate(nasty * 8)]
    assert loss == "".join(t or "" for i, t in enumerate(nasty * 8) if i % 2)


def test_orphans_cycles_null_conversations_and_empty(spark):
    rows = [(1, 1, 99, "user", "orphan", 0.0), (2, 1, 2, "user", "a", 0.0), (2, 2, 1, "user", "b", 0.0), (None, 1, None, None, "n", 0.0), (None, 2, 1, "assistant", "m", 0.0)]
    got = formatted(spark, rows)
    assert set(got) == {(1, 0), (None, 0)} and got[None, 0] == ([("", "n"), ("assistant", "m")], "m")
    assert formatted(spark, []) == {}


def test_turns_become_a_chain(spark):
    df = spark.createDataFrame([(1, 5, "assistant", "b"), (1, 2, "user", "a"), (1, 5, "assistant", "b"), (2, None, "user", "z")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [t.text for t in r.turns] for r in read_back(format_paths(best_paths(chain_replies(df)))).collect()}
    assert got == {1: ["a", "b", "b"], 2: ["z"]}
