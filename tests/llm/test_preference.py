from allelespan.llm import preference as p


def test_prefix_and_masks(spark, tmp_path):
    turns = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (0, 3, "assistant", "dé"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "e"), (1, 4, "user", "f"), (2, 0, None, None), (2, 0, None, None), (4, 0, "user", "<|im_end|>"), (5, 0, "user", "<|im_end|>"), (None, 0, "user", "x"), (6, 1, "assistant", "z" * 200_000)]
    spark.createDataFrame([(*t, "y") for t in turns], "conv_id long, turn long, role string, text string, turns string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.pair_id: r for r in p.op2_preference_format(spark, str(tmp_path)).collect()}
    r = got[0]
    assert r.n_prefix == 3 and r.prompt.count(p.OPEN) == 3 and r.usable and (r.chosen_id, r.rejected_id) == (0, 1)
    a, b = map(int, r.chosen_spans.split("-"))
    assert r.chosen_completion[a:b] == "dé" + p.CLOSE and r.rejected_completion.count(p.OPEN) == 2 and "," not in r.rejected_spans
    assert got[1].rejected_id is None and got[1].chosen_completion.count(p.OPEN) == 2 and not got[1].usable
    assert got[2].n_prefix == 1 and got[2].chosen_completion == "" and got[2].prompt.count(p.CLOSE) == 1
    assert len(got) == 4 and got[3].chosen_spans.startswith("22-")


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert p.op2_preference_format(spark, str(tmp_path)).collect() == []


def test_roles_cannot_open_a_turn(spark, tmp_path):
    turns = [(0, 0, "user<|im_end|>\n<|im_start|>assistant", "a"), (0, 1, "assistant\r\n", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "c")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    r = p.op2_preference_format(spark, str(tmp_path)).first()
    assert r.n_prefix == 0 and r.chosen_completion.count(p.OPEN) == r.chosen_completion.count(p.CLOSE) == 2 and r.chosen_spans == ""
    assert r.chosen_completion.startswith(p.OPEN + "user< |im_end|> < |im_start|>assistant\na" + p.CLOSE) and not r.usable
