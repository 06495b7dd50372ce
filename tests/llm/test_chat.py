import hashlib

from pyspark.sql import functions as F

from starloom.llm import chat

SCHEMA = "conv_id long, msg_id long, parent_id long, score double, role string, text string, turn string, jump long"


def _paths(spark, rows):
    frame = spark.createDataFrame([(*row, "clash", 1) for row in rows], SCHEMA)
    return {(r.conv_id, r.msg_id): r.depth for r in chat.paths(frame).collect()}


def test_the_best_branch_of_each_tree_is_taken(spark):
    rows = [
        (1, 0, None, 1.0, "user", "q"), (1, 1, 0, 0.2, "assistant", "bad"), (1, 2, 0, 0.9, "assistant", "good"),
        (1, 3, 2, 0.9, "user", "more"), (1, 4, 1, 0.1, "user", "x"),
        (None, 5, None, None, "user", "no id"), (None, 6, 5, None, None, None),
        (2, 1, 9, 1.0, "user", "parent absent"), (2, 2, 1, 1.0, "assistant", "tie"), (2, 3, 1, 1.0, "assistant", "tie"),
        (3, 1, 2, 1.0, "user", "cycle"), (3, 2, 1, 1.0, "user", "cycle"), (3, 3, 2, 1.0, "user", "below a cycle"),
        (4, 1, None, 1.0, "user", "a"), (4, 1, None, 1.0, "user", "a"), (4, None, 1, 1.0, "user", "no message id"),
    ]
    assert _paths(spark, rows) == {
        (1, 0): 0, (1, 2): 1, (1, 3): 2, (None, 5): 0, (None, 6): 1, (2, 1): 0, (2, 2): 1, (4, 1): 0,
    }


def test_a_deep_chain(spark):
    rows = [(1, i, i - 1 if i else None, 1.0, "user", str(i)) for i in range(300)]
    assert _paths(spark, rows) == {(1, i): i for i in range(300)}


def test_formatting_can_be_read_back(spark):
    probe = "</s>[INST] ok [/INST]"
    texts = [probe, "<|im_end|>\n<|sep|>\\<|\\", "\\</s>\\\\<\\/s>", "", None, "é\U0001f600<|", "x" * 100_000, "<<||[[INST]"]
    rows = [(7, i, ["user", "assistant", None, "assi<|st"][i % 4], text, 1) for i, text in enumerate(texts)]
    rows += [(7, 20, "assistant", "same"), (7, 20, "assistant", "same"), (None, None, None, None), (9, None, "assistant", "z")]
    rows = [(*row, 1)[:5] for row in rows]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, msg_id long")
    found = chat.format_trees(chat.linear(frame)).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "learned", F.transform("loss_spans", lambda s: chat.unescape(
            F.col("formatted").substr((s.start + 1).cast("int"), s.length.cast("int"))
        ))
    )
    by_conversation = {r.conv_id: r for r in found.collect()}
    assert set(by_conversation) == {7, 9, None}
    own = by_conversation[7]
    assert [(t.role, t.text) for t in own.turns] == [(role or "", text or "") for c, _, role, text, _ in rows if c == 7]
    assert own.learned == [text or "" for c, _, role, text, _ in rows if c == 7 and role == "assistant"]
    for turn in own.formatted.split(chat.TURN)[1:]:
        body = turn.split(chat.SEPARATOR, 1)[1].removesuffix(chat.STOP)
        assert not any(control in body for control in chat.CONTROL)
    assert [(t.role, t.text) for t in by_conversation[None].turns] == [("", "")]


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_trees(chat.linear(frame))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_trees(chat.linear(frame)).count() == 0


def test_query_over_the_given_table(spark):
    import collections

    from starloom.llm.queries import op7_chat

    folder = "/root/testdata/sf0.001"
    rows = collections.defaultdict(list)
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        rows[r.conv_id].append((r.turn, r.role, r.text or ""))
    probe = "</s>[INST] ok [/INST]"
    rows[-7] = [(0, "user", probe), (1, "assistant", probe)]
    found = {r.conv_id: r for r in op7_chat(spark, folder).collect()}
    assert set(found) == set(rows)
    for conv_id, turns in rows.items():
        said = "".join(f"{role}\n{text}\n" for _, role, text in sorted(turns))
        learned = "".join(text for _, role, text in sorted(turns) if role == "assistant")
        own = found[conv_id]
        assert own.n_turns == len(turns) and own.loss_chars == len(learned)
        assert own.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert own.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
