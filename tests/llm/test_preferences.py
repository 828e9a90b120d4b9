from pyspark.sql import functions as F

from tierload.llm import preferences as P

SCHEMA = "conv_id long, turn long, role string, text string"


def test_prefix_once_and_masks(spark):
    rows = [("p", "chosen", 0, "user", "hi"), ("p", "chosen", 1, "assistant", "a é"), ("p", "chosen", 2, "user", "more"), ("p", "chosen", 3, "assistant", "good"),
            ("p", "rejected", 0, "user", "hi"), ("p", "rejected", 1, "assistant", "a é"), ("p", "rejected", 2, "user", "else <|end|>"),
            ("p", "rejected", 3, "assistant", "bad"), ("p", "rejected", 4, None, None),
            ("q", "chosen", 0, "user", None), ("q", "rejected", 0, "user", None),
            ("r", "chosen", 0, "user", "only chosen")]
    df = spark.createDataFrame(rows, "pair string, side string, turn long, role string, text string").withColumn("prompt", F.lit(1))
    got = {r.pair: r for r in P.format_pairs(df, ["pair"]).collect()}
    p = got["p"]
    assert p.n_common == 2 and p.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\na é<|end|>\n"
    assert p.chosen == "<|user|>\nmore<|end|>\n<|assistant|>\ngood<|end|>\n"
    assert [p.chosen[s[0]:s[1]] for s in p.chosen_spans] == ["good<|end|>\n"]
    assert [p.rejected[s[0]:s[1]] for s in p.rejected_spans] == ["bad<|end|>\n"]
    assert "else < |end|>" in p.rejected and p.rejected.endswith("<|unknown|>\n<|end|>\n") and p.usable
    assert got["q"].n_common == 1 and got["q"].chosen == "" and not got["q"].usable
    assert got["r"].n_common == 0 and got["r"].rejected == "" and not got["r"].usable


def test_opening_groups_pair_the_best_with_each_other(spark):
    rows = []
    for c in range(40):
        rows += [(c, 0, "user", "same" if c < 30 else f"own {c}"), (c, 1, "assistant", "x" * (c % 7))]
    rows += [(None, 0, "user", "same")]
    got = P.opening_pairs(spark.createDataFrame(rows, SCHEMA))
    pairs = {(r.chosen_id, r.rejected_id) for r in got.collect()}
    assert pairs == {(6, c) for c in range(30) if c != 6}
    assert got.count() == 29 * 4


def test_truncated_pairs_and_edges(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one two three"), (2, 0, "user", None), (2, 0, "user", None), (3, 0, None, "x"), (None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("side", F.lit("clash")).withColumn("last", F.lit("clash"))
    out = {r.chosen_id: r for r in P.format_pairs(P.truncated_pairs(df.select("conv_id", "turn", "role", "text")), ["chosen_id", "rejected_id"]).collect()}
    assert out[1].rejected == "<|assistant|>\none two<|end|>\n" and out[1].usable
    assert out[2].n_common == 2 and not out[2].usable and not out[3].usable and set(out) == {1, 2, 3}
    empty = spark.createDataFrame([], SCHEMA)
    assert P.format_pairs(P.truncated_pairs(empty).unionAll(P.opening_pairs(empty)), ["chosen_id", "rejected_id"]).count() == 0


def test_no_python_in_the_plan(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = P.format_pairs(P.truncated_pairs(turns), ["chosen_id", "rejected_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
