"""op9 reads the loss columns through the operator's loss mask."""

from touchline.llm import chat, queries


def test_a_wrong_mask_shows_in_the_result(spark, monkeypatch):
    data = "/root/testdata/sf0.001"
    read = lambda: {r["conv_id"]: r for r in queries.op9_chat_format(spark, data).collect()}
    right, made = read(), chat.format_conversations
    assert right[-7]["loss_chars"] == len(queries.HARD_TURN)
    monkeypatch.setattr(chat, "format_conversations", lambda turns: made(turns, learn_role="user"))
    wrong = read()
    assert all(wrong[i]["turns_sha256"] == r["turns_sha256"] for i, r in right.items())
    assert any(wrong[i]["loss_sha256"] != r["loss_sha256"] for i, r in right.items())
