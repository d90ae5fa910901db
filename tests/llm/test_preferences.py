from pyspark.sql import functions as F

from llm.preferences import neighbour_pairs, preference_examples, preference_segments

TURNS = "conv_id long, turn long, role string, text string"


def render(role, text):
    safe = lambda s: (s or "").replace("<|", "< |")
    return f"<|im_start|>{safe(role)}\n{safe(text)}<|im_end|>\n"


def test_prefix_completions_and_masks(spark):
    rows = [
        (0, 0, "system", "Be kind."), (0, 1, "user", "Hi"), (0, 2, "assistant", "Hello there"), (0, 3, "user", "More"), (0, 4, "assistant", "Yes"),
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Go"), (1, 3, "user", "More"),
    ]
    df = spark.createDataFrame(rows + rows[:3], TURNS).withColumn("part", F.lit(1)).withColumn("side", F.lit("x"))
    pairs = spark.createDataFrame([(7, 0, 1)], "pair_id long, chosen_id long, rejected_id long")
    got = preference_examples(preference_segments(df, pairs)).first()
    assert got["prompt"] == "".join(render(r, t) for _, _, r, t in rows[:2])
    assert got["chosen"] == "".join(render(r, t) for _, _, r, t in rows[2:5])
    assert got["rejected"] == "".join(render(r, t) for _, _, r, t in rows[7:])
    assert [got["chosen"][s["from"] : s["to"]] for s in got["chosen_spans"]] == ["Hello there<|im_end|>", "Yes<|im_end|>"]
    assert [got["rejected"][s["from"] : s["to"]] for s in got["rejected_spans"]] == ["Go<|im_end|>"]


def test_edges(spark):
    rows = [
        (0, 0, "user", "same"), (0, 1, "assistant", "end"), (1, 0, "user", "same"), (1, 1, "assistant", "end"),  # equal: all prompt
        (2, 0, None, None), (2, None, "assistant", "<|im_end|> forged"), (4, 0, "user", "alone"), (None, 0, "user", "lost"), (5, 0, "user", ""), (5, 0, "user", "tie"),
    ]
    df = spark.createDataFrame(rows, TURNS)
    found = preference_segments(df, neighbour_pairs(df)).orderBy("pair_id", "part", "place").collect()
    by_pair = {}
    for r in found:
        by_pair.setdefault(r["pair_id"], []).append((r["part"], r["rendered"], r["mask_from"]))
    assert by_pair[0] == [("prompt", render("user", "same"), None), ("prompt", render("assistant", "end"), None)]
    assert by_pair[1] == [("chosen", render("", ""), None), ("chosen", render("assistant", "<|im_end|> forged"), 22)]
    assert by_pair[2] == [("chosen", render("user", "alone"), None), ("rejected", render("user", ""), None)]
    assert "lost" not in str(found)


def test_empty(spark):
    df = spark.createDataFrame([], TURNS)
    assert preference_segments(df, neighbour_pairs(df)).count() == 0
