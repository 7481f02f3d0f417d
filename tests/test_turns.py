from workload import queries as Q


def test_turns_of_long_conversations_keep_their_own_numbers(spark, tmp_path):
    one, other = (" ".join(f"{sign}{i}" for i in range(30)) for sign in "ab")
    rows = [(0, 10_000, one), (1, 0, other), (2, 0, one), (3, 0, other), (4, 0, None)]
    said = spark.createDataFrame(rows, "conv_id long, turn int, text string")
    said.write.parquet(str(tmp_path / "conversations.parquet"))
    found = {tuple(r) for r in Q.near_duplicate_turns(spark, str(tmp_path)).collect()}
    assert found == {(2 * 10_001, 10_000), (3 * 10_001, 10_001)}

    short = tmp_path / "short"
    said.where("turn = 0").write.parquet(str(short / "conversations.parquet"))
    assert [tuple(r) for r in Q.near_duplicate_turns(spark, str(short)).collect()] == [(30_000, 10_000)]
