"""Column functions against hand-worked values and plain Python."""

import ast
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tunelab import schemas
from tunelab.functions import names, prompts
from tunelab.operators import prep, scoring


def one(spark, values, dtype, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text,label",
    [
        ("dismissal", 0),
        ("The appeal was DISMISSED.", 0),
        ("Approved, not a dismissal", 0),
        ("Approved", 1),
        ("approval", 1),
        ("unclear", -1),
        ("", -1),
        (None, -1),
    ],
)
def test_answer_label(spark, text, label):
    assert one(spark, [text], "string", prompts.answer_label) == [label]


def test_answer_label_of_missing_or_numeric_column(spark):
    df = spark.createDataFrame([(5,)], "n int")
    assert df.select(prompts.answer_label_of(df, "n").alias("x"), prompts.answer_label_of(df, "no").alias("y")).first() \
        == Row(x=-1, y=-1)


def test_label_word(spark):
    def words(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return [r[0] for r in df.select(prompts.label_word(df)).collect()]

    assert words([(0,), (1,), (7,), (None,)], "label int") == ["dismissal", "approval", "7", "None"]
    assert words([(True,), (False,)], "label boolean") == ["approval", "dismissal"]
    # A text is no class number.
    assert words([("0",), ("approval",), (None,)], "label string") == ["0", "approval", "None"]
    assert words([(1,)], "other int") == [""]


def python_label(i):
    """Bijective base 26, worked out digit by digit."""
    out, n = "", i + 1
    while n:
        n, digit = divmod(n - 1, 26)
        out = chr(65 + digit) + out
    return out


def test_choice_label(spark):
    indexes = [*range(0, 2000), 18277, 18278, 475253, 475254, 2**31 - 1]
    assert one(spark, indexes, "int", prompts.choice_label) == [python_label(i) for i in indexes]
    assert one(spark, [-1, None], "int", prompts.choice_label) == [None, None]


def test_gold_label(spark):
    df = spark.createDataFrame([(0, 4), (3, 4), (4, 4), (-1, 4), (-5, 4), (27, 32), (0, None)], "g int, n int")
    got = [r[0] for r in df.select(prompts.gold_label(F.col("g"), F.col("n"))).collect()]
    assert got == ["A", "D", None, "D", None, "AB", None]


@pytest.mark.parametrize(
    "text,choice",
    [
        ("###A###", "A"),
        ("###A### then ###B###", "B"),
        ("###A###B###", "A"),
        ("######A######", "A"),
        ("###AB###", "AB"),
        ("###a###", "None"),
        ("### A ###", "None"),
        ("", "None"),
        (None, "None"),
    ],
)
def test_parse_choice(spark, text, choice):
    assert one(spark, [text], "string", prompts.parse_choice) == [choice]


def test_parse_choice_as_findall_on_random_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("##AB a") for _ in range(rng.randrange(40))) for _ in range(500)]
    want = [(re.findall(prompts.CHOICE_PATTERN, t) or ["None"])[-1] for t in texts]
    assert one(spark, texts, "string", prompts.parse_choice) == want
    whole = [(re.findall("#[AB]", t) or ["None"])[-1] for t in texts]
    assert one(spark, texts, "string", lambda c: prompts.parse_choice(c, "#[AB]")) == whole


def test_pattern_with_two_groups_is_refused():
    with pytest.raises(ValueError):
        prompts.check_choice_pattern("(A)(B)")


LITERALS = [
    "['a', 'b']",
    '["it\'s", \'b\']',
    "('a','b')",
    "['a', None]",
    "not a list",
    "[]",
    "['a' 'b']",
    "[1, 2.50, True]",
    "['a\\n', '\\x41', 'it\\'s']",
    '["x, y", "[z]", "{u}"]',
    "['a',]",
    "['a', ['b']]",
    "[null]",
    "{'a': 1}",
    "  [ 'a' ,\n 'b' ]",
    "['raw\nbreak']",
    "[u'a']",
    "['ünï', '漢']",
    "__import__('os')",
    "",
]


def test_parsed_choices_as_python_literals(spark):
    def read(text):
        try:
            value = ast.literal_eval(text)
        except Exception:
            return None
        return [str(v) for v in value] if isinstance(value, list) else None

    df = spark.createDataFrame([(i, t) for i, t in enumerate([*LITERALS, None])], "i int, choices string")
    rows = prep.read_literals(df.withColumn("text", F.col("choices"))).orderBy("i").collect()
    want = [read(t) for t in LITERALS] + [None]
    for text, row, expected in zip([*LITERALS, None], rows, want):
        assert row["choices"] == expected, text
    # without Python: the same, or null and flagged
    native = df.select("choices", prep.parsed_choices(df).alias("c"), prep.unread_choices(df).alias("left"), "i")
    for row, expected in zip(native.orderBy("i").collect(), want):
        assert row["c"] == expected or (row["c"] is None and row["left"]), row["choices"]


@pytest.mark.parametrize(
    "text", ["['a', 1, None, 2.5, True]", "['it\\'s', \"a \\\"b\\\"\"]", "['a', 'b',]", "[-3, 0, 0.25]", "['back\\\\slash']", "[ 'a' ,'1, 2' ]"]
)
def test_choices_read_without_python(spark, text, capsys):
    df = spark.createDataFrame([(text,)], "choices string")
    found = df.select(prep.parsed_choices(df).alias("c"))
    assert found.first()["c"] == [str(x) for x in ast.literal_eval(text)]
    prep.mcq_prompts(df.withColumns({"question": F.lit("q"), "course": F.lit("c")})).explain()
    assert "Python" not in capsys.readouterr().out


@pytest.mark.parametrize("text", ["[1e3]", "[01]", "[1_0]", "[[1], 2]", "['a' 'b']", "[1.50]", "[0x1F]", "['a\\n']", "[x]", "[1 2]", "['a',,]", "[,]", "[-0]"])
def test_choices_left_to_python_are_flagged(spark, text):
    df = spark.createDataFrame([(text,)], "choices string")
    assert df.select(prep.parsed_choices(df), prep.unread_choices(df)).first()[0:2] == (None, True)


def test_long_choice_list(spark):
    """No recursion in the pattern that tells plain lists from others."""
    big = [f"choice {i}" for i in range(30000)]
    df = spark.createDataFrame([(repr(big),)], "choices string")
    assert df.select(F.size(prep.parsed_choices(df))).first()[0] == 30000


def test_mcq_prompt(spark):
    df = spark.createDataFrame(
        [("Q {x}?", ["one", None], "Contract {law}"), ("Q", None, None)],
        "question string, choices array<string>, course string",
    )
    first, second = [r["prompt"] for r in prep.mcq_prompts(df).select("prompt").collect()]
    assert first.startswith("You are an expert in Contract {law} and address")
    assert "\nQuestion:\n Q {x}?\nA. one\nB. None\n\nAnswer:" in first
    assert " Correct Answer: ###C### \n" in first
    assert second.endswith("Question:\n Q\n\nAnswer:") and "expert in None and" in second
    bare = df.drop("course")
    assert "expert in Law and" in prep.mcq_prompts(bare).select("prompt").first()[0]


def test_judgment_prompt_fields(spark):
    df = spark.createDataFrame([(2001, None, "the {year} text")], "year int, region string, text string")
    row = prep.judgment_messages(df.withColumn("label", F.lit(1))).first()
    user, assistant = row["messages"]
    assert user["role"] == "user" and assistant == Row(role="assistant", content="approval")
    lines = user["content"].split("\n")
    assert "Year: 2001" in lines and "Region: None" in lines and "Canton: N/A" in lines
    assert user["content"].endswith("<BEGIN CASE TEXT>\nthe {year} text\n<END CASE TEXT>")
    assert prep.judgment_messages(df).columns == ["messages"]


def test_training_and_inference_prompts_are_equal(spark):
    df = spark.createDataFrame([(1, "t")], "label int, text string")
    user = prep.judgment_messages(df).first()["messages"][0]["content"]
    fmt = prompts.ChatFormat("<", ">", "|")
    chat = prep.judgment_chat_prompt(df, fmt=fmt).first()["prompt"]
    assert chat == f"<user>{user}|<assistant>"


def test_token_count(spark):
    texts = ["", "  ", "a", " a  b\n\tc ", None]
    assert one(spark, texts, "string", prompts.token_count) == [0, 0, 1, 3, None]


RUN_NAMES = {
    "lr1e-4_r64_lora_8B": (True, 1e-4, 64, "lora", "8B"),
    "lr0.0002_r8_lora_8B": (True, 0.0002, 8, "lora", "8B"),
    "lr1e-5_r1_full_70B_retry": (True, 1e-5, None, "full", "70B"),
    "lr1..2_r1_lora_8B": (True, None, 1, "lora", "8B"),
    "x_lr1e-4_r64_lora_8B": (False, None, None, None, None),
    "lr1e-4_r64_dora_8B": (False, None, None, None, None),
    "baseline": (False, None, None, None, None),
    None: (False, None, None, None, None),
}


def test_run_names(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(RUN_NAMES)], "i int, name string")
    rows = df.select("i", *[c.alias(k) for k, c in names.run_name_fields(F.col("name")).items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == list(RUN_NAMES.values())


def test_name_texts(spark):
    assert one(spark, [1e-4, 2e-4, 1e-10, 0.5], "double", names.rate_text) == ["1e-4", "2e-4", "1e-10", "5e-1"]
    assert one(spark, ["final_loss", "min_loss"], "string", names.metric_title) == ["Final Loss", "Min Loss"]
    paths = ["/g/lr1_r1/checkpoint-100", "/g/model", "checkpoint-5", "org/checkpoints/model"]
    assert one(spark, paths, "string", names.checkpoint_id) == [
        "lr1_r1/checkpoint-100", "model", "/checkpoint-5", "model",
    ]
    assert one(spark, ["/lr1e-4/checkpoint-1000", "/m/x"], "string", names.checkpoint_step) == [1000, None]
    files = ["/o/a.json", "/o/b.safetensors", "/o/c.json.tmp", "/o/log"]
    assert one(spark, files, "string", names.is_model_file) == [True, True, False, False]
    stamp = one(spark, ["2024-03-05 06:07:08"], "string", lambda c: names.timestamped(F.lit("b"), c.cast("timestamp")))
    assert stamp == ["b_2024-03-05_06-07-08"]
    metrics = ["lr1e-4_r64_lora_8B/mcq_4_choices/accuracy", "base/mcq/accuracy"]
    assert one(spark, metrics, "string", names.metric_rate) == [1e-4, None]
    assert one(spark, metrics, "string", names.metric_rank) == [64, None]


def test_public_config(spark):
    out = one(spark, [{"a": "1", "_b": "2"}], "map<string,string>", names.public_config)
    assert out == [{"a": "1"}]


def test_defaults_and_missing_values(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (None, "y"), (1.0, None)], "`train/loss` double, s string")
    clean = schemas.nan_to_null(df)
    assert [r[0] for r in clean.collect()] == [None, None, 1.0]
    full = schemas.with_defaults(df, {"s": "N/A", "t": "N/A"})
    assert [(r["s"], r["t"]) for r in full.collect()] == [("x", "N/A"), ("y", "N/A"), (None, "N/A")]


def test_strategies(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert prep.default_text(df).first()["text"] == '{"a":1,"b":null}'
    with_text = df.withColumn("text", F.lit("t"))
    assert prep.default_text(with_text) is with_text
    with pytest.raises(ValueError, match="known"):
        prep.pick_strategy(prep.TRAINING_STRATEGIES, "nope")
    for spelling in ("swiss_judgment_prediction", "swiss_judgement_prediction"):
        assert prep.pick_strategy(prep.TRAINING_STRATEGIES, spelling) is prep.judgment_messages
    registry = {}
    prep.register_strategy(registry, "mine", prep.default_text)
    assert prep.pick_strategy(registry, "mine") is prep.default_text
    with pytest.raises(ValueError, match="missing"):
        prep.only_split(spark.createDataFrame([("test",)], "split string"), "train")


def test_conversations_are_one_row_each(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}:{t}") for c in (1, 2) for t in range(5)]
    random.Random(1).shuffle(turns)
    df = spark.createDataFrame([*turns, (3, 0, "user", None)], "conv_id long, turn long, role string, text string")
    whole = {r["conv_id"]: r for r in prep.conversation_messages(df).collect()}
    assert [m["content"] for m in whole[1]["messages"]] == [f"1:{t}" for t in range(5)]
    assert whole[3]["messages"] == [Row(role="user", content="")]
    long = spark.range(1500).selectExpr("7 AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    sparse = spark.createDataFrame([(8, t, "user", str(t)) for t in (15000, 0, 5000, 10000)], long.schema)
    rows = {r["conv_id"]: [m["content"] for m in r["messages"]] for r in prep.conversation_messages(long.union(sparse)).collect()}
    assert rows == {7: [str(t) for t in range(1500)], 8: ["0", "5000", "10000", "15000"]}


def test_accuracy_counts_null_as_wrong(spark):
    df = spark.createDataFrame([(0, 0), (1, -1), (None, 0), (1, None)], "label int, pred int")
    assert scoring.accuracy(df).first()[0] == 0.25
    empty = scoring.parse_errors(df.limit(0)).first()
    assert empty["total_rows"] == 0 and empty["parse_error_percent"] is None
