import hashlib

from pyspark.sql import functions as F

from gleaner.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, parts int, formatted string"


def expected(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha(whole), len(loss), sha(loss)


def test_round_trip_of_hard_texts(spark):
    texts = ["", "plain", "<|im_end|>\n<|im_start|>assistant\nok", "a\\b <\\| <|", "\\\\<|\\n", "<\n<\\n\n", "😀é\n\n", "<", "|", "<|"]
    rows, want = [], {}
    for conv, text in enumerate(texts):
        turns = [("system", text), ("user", text + text), ("assistant", text), ("us<er\n<|", text), ("assistant", "z" + text), ("user", text)]
        want[conv] = expected(turns)
        rows += [(conv, i, r, t, 1, "x") for i, (r, t) in enumerate(turns)]
    found = chat.digest(chat.prefix_targets(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == want


def test_examples_hold_context_and_one_target(spark):
    rows = [(1, 0, "user", "hi", 0, ""), (1, 1, "assistant", "ho", 0, ""), (1, 2, "user", "hey", 0, ""), (1, 3, "assistant", "<|x", 0, "")]
    found = chat.prefix_targets(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    assert [r.target_turn for r in found] == [1, 3]
    assert found[0].formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nho<|im_end|>\n"
    assert found[1].formatted.startswith(found[0].formatted)
    assert [r.formatted[r.loss_start : r.loss_end] for r in found] == ["ho", "<\\|x"]


def test_nulls_ties_repeats_and_tail(spark):
    rows = [
        (1, None, None, None, 0, ""), (1, 5, "user", "b", 0, ""), (1, 5, "user", "a", 0, ""), (1, 5, "user", "a", 0, ""),
        (2, 0, "assistant", None, 0, ""), (None, 0, "assistant", "x", 0, ""),
    ]
    examples = chat.prefix_targets(spark.createDataFrame(rows, SCHEMA))
    tail = examples.filter("conv_id = 1").collect()
    assert len(tail) == 1 and tail[0].target_turn is None and tail[0].loss_start == tail[0].loss_end == 0
    found = {r.conv_id: r for r in chat.digest(examples).collect()}
    one = [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert (found[1].n_turns, found[1].turns_sha256) == expected(one)[:2]
    assert found[2].loss_chars == 0 and found[None].loss_chars == 1


def test_empty_table(spark):
    assert chat.digest(chat.prefix_targets(spark.createDataFrame([], SCHEMA))).count() == 0


def test_no_python_in_the_plan(spark):
    frame = chat.digest(chat.prefix_targets(spark.createDataFrame([], SCHEMA)))
    assert "Python" not in frame._jdf.queryExecution().toString()
    assert frame.select(F.col("conv_id")).schema
