from churnloom.llm import chat


def test_equal_messages_without_turn_or_conversation_all_stay(spark):
    rows = [(1, None, "user", "yes")] * 3 + [(None, 0, "user", "hello")] * 2 + [(2, 0, "user", "once")] * 2
    rows.append((1, 5, "user", "> yes\nwhy?"))
    got = chat.formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    found = {r.conv_id: r for r in got.collect()}
    assert {k: r.n_messages for k, r in found.items()} == {1: 4, None: 2, 2: 1}
    assert found[1].chat.count("yes") == 3 and found[1].n_quotes == found[1].n_linked == 1
