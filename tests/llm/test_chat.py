"""Chat windows: round trips of awkward conversations, budgets, masks, SQL for long ones."""

import hashlib
import random

import compare
import pytest
from pyspark.sql import functions as F

from tunelab.llm import catalog, chat

TEXTS = ["</turn> a", "<turn>", r"<\turn> \\ <\\/turn>", "<says>x", "<<turn>>", "plain é😀 text", "", None, "</tu", "word " * 30, chat.CLOSE + "\n", "$1 \\1"]
COLUMNS = "conv_id long, turn long, role string, text string"


def conversations(seed=2):
    rng, rows = random.Random(seed), []
    for conv in [*range(30), None]:
        start = rng.choice([0, 0, 0, 250, -3])
        for t in range(1 if conv == 5 else rng.choice([1, 2, 8, 30, 300, 700])):
            role = "system" if t == 0 and conv and conv % 2 else rng.choice(["user", "assistant", "assistant", "tool</turn>", None, "system" if rng.random() < 0.1 else "user"])
            rows.append((conv, start + t if rng.random() > 0.02 else None, role, rng.choice(TEXTS)))
            if rng.random() < 0.03:
                rows.append(rows[-1])
    return rows


def in_order(rows):
    """{conv_id: (role, text) in the order of the windows} of (conv_id, turn, role, text) rows."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((-(1 << 63) if turn is None else turn, role != "system", role or "", text or ""))
    return {c: [x[2:] for x in sorted(v, key=lambda x: (*x[:2], x[2].encode(), x[3].encode()))] for c, v in found.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def table(spark, rows):
    extra = ("part", "kind", "t", "tokens", "number", "windows", "long_id")
    return spark.createDataFrame([(*r, *extra) for r in rows], COLUMNS + "".join(f", `{c}` string" for c in extra)).repartition(5)


@pytest.mark.parametrize("budget, history", [(2048, 256), (60, 20), (10, 5), (100, 0)])
def test_round_trip(table, rows, budget, history):
    got = {r["conv_id"]: r for r in chat.digest(chat.windows(table, budget, history)).collect()}
    want = in_order(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        learned = "".join(x for role, x in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == sha("".join(f"{role}\n{x}\n" for role, x in turns))
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(learned), sha(learned))


@pytest.mark.parametrize("budget, history", [(2048, 256), (120, 40)])
def test_windows(table, rows, budget, history):
    found = chat.windows(table, budget, history).withColumn("turns", chat.turns_of(F.col("text"))).orderBy("conv_id", "part", "number").collect()
    want, at = in_order(rows), {}
    size = lambda x: 4 + -(-len(x.encode()) // 4)
    for r in found:
        turns, conv = [(t["role"], t["text"]) for t in r["turns"]], r["conv_id"]
        begin = at.get(conv, 0)
        at[conv] = begin + r["n_turns"]
        assert turns[r["n_repeated"] :] == want[conv][begin : at[conv]]
        repeated = turns[: r["n_repeated"]]
        first = want[conv][0]
        if begin and first[0] == "system":
            assert repeated.pop(0) == first
        assert repeated == want[conv][begin - len(repeated) : begin]
        assert sum(size(x) for _, x in repeated) <= history
        assert r["n_tokens"] == sum(size(x) for _, x in turns)
        assert r["n_tokens"] <= budget or (r["n_turns"] == 1 and not repeated) or (first[0] == "system" and not repeated and len(turns) == 2)
        learned = [r["text"][s["start"] : s["start"] + s["length"]] for s in r["loss"]]
        assert len(learned) == sum(role == "assistant" for role, _ in turns[r["n_repeated"] :])
        assert not any(mark in x for x in learned for mark in (chat.OPEN, chat.SAYS, chat.CLOSE))
    assert at == {c: len(v) for c, v in want.items()}


def test_windows_are_full(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", "x" * 40) for i in range(256)]
    found = chat.windows(spark.createDataFrame(rows, COLUMNS), 140, 28).orderBy("number").collect()
    assert [r["n_turns"] for r in found[:2]] == [10, 8] and {r["n_repeated"] for r in found[1:]} == {2}
    assert {r["n_tokens"] for r in found[:-1]} == {140}


def test_a_long_turn_is_not_cut(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 2, "assistant", "long " * 500), (1, 3, "user", "b")]
    found = chat.windows(spark.createDataFrame(rows, COLUMNS), 100, 20).orderBy("number").collect()
    assert [(r["n_turns"], r["n_repeated"]) for r in found] == [(2, 0), (1, 1), (1, 1)]
    assert found[1]["loss"][0]["length"] == 2500


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    pieces = ["<", "\\", "turn>", "says>", "/turn>", "/", " ", "<turn>", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("safe", chat.escaped(F.col("text")))
    for r in df.withColumn("back", chat.unescaped(F.col("safe"))).collect():
        assert r["back"] == r["text"] and not any(m in r["safe"] for m in (chat.OPEN, chat.SAYS, chat.CLOSE))


def test_sql_on_long_conversations(spark, table, tmp_path):
    """The registered query against its SQL where conversations have many parts and windows."""
    path = str(tmp_path)
    table.select("conv_id", "turn", "role", F.when(F.col("turn") % 3 == 0, F.repeat("text", 20)).otherwise(F.col("text")).alias("text")).coalesce(1).write.parquet(f"{path}/conversations.parquet")
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet/*.parquet'")
    assert compare.differences(catalog.QUERIES["op13_chat"](spark, path), con.sql(catalog.ORACLE["op13_chat"])) is None


def test_empty_table(table):
    assert chat.windows(table.limit(0)).count() == 0 and chat.digest(chat.windows(table.limit(0))).count() == 0
