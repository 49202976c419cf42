from tapeline.llm import chats

SCHEMA = "conv_id long, turn long, role string, text string, key string"


def conversations(spark, logs):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", x, "k") for c, turns in logs for t, x in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def kept(rows):
    found = {}
    for row in chats.rendered(chats.maximal_conversations(rows)).collect():
        found.setdefault((row.conv_id, row.n_logged), []).append((row.position, row.text, row.n_turns))
    return {k: [t for _, t, _ in sorted(v)] for k, v in found.items()}


def test_prefixes_and_copies_collapse(spark):
    logs = [(1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"]), (5, ["a", "b", "c"]), (4, ["a", "x"]), (6, ["b"])]
    assert kept(conversations(spark, logs)) == {(3, 2): ["a", "b", "c"], (4, 1): ["a", "x"], (6, 1): ["b"]}


def test_long_conversations_span_chunks(spark, monkeypatch):
    monkeypatch.setattr(chats, "CHUNK_TURNS", 3)
    long = [f"t{i}" for i in range(20)]
    logs = [(1, long), (2, long[:13]), (3, long[:12] + ["other"]), (4, long)]
    assert kept(conversations(spark, logs)) == {(1, 2): long, (3, 1): long[:12] + ["other"]}


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a", ""), (1, 0, "user", "a", ""), (1, None, "user", "z", ""), (None, 0, "user", "z", "")]
    rows += [(2, 7, None, None, ""), (3, 7, "", "", ""), (4, 3, "user", "a", ""), (4, 3, "user", "b", "")]
    table = spark.createDataFrame(rows, SCHEMA)
    assert kept(table) == {(2, 2): [""], (4, 1): ["a", "b"]}  # gaps don't matter: 1 begins 4
    assert kept(table.limit(0)) == {}


def test_rendering(spark):
    row = chats.rendered(chats.maximal_conversations(conversations(spark, [(1, ["hi"])]))).first()
    assert row.rendered == "<|user|>\nhi\n<|end|>\n" and row.position == row.n_turns == 1
