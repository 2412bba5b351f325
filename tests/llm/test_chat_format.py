import hashlib
import re

import pytest
from pyspark.sql import functions as F

from predia.llm import chat_format as X

TURNS = "conv_id long, turn long, role string, text string"
CASES = ["plain", None, "", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\s>", "[\\INST]",
         "<<s>", "[[/INST]", "a\\", "<", "tail <", "é漢字🎉\n\n", "<|im_start|", "%0A %25", "w" * 100_000, "[/s>", "<INST]"]


def read(df):
    return X.digests(X.segments(df))


def test_every_text_comes_back(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(CASES)] + [(i, 1, "assistant", t) for i, t in enumerate(CASES)]
    got = {r["conv_id"]: r for r in read(spark.createDataFrame(rows, TURNS)).collect()}
    for i, text in enumerate(CASES):
        text = text or ""
        said = f"user\n{text}\nassistant\n{text}\n"
        assert got[i]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest(), text[:50]
        assert got[i]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got[i]["n_turns"], got[i]["loss_chars"], got[i]["valid"]) == (2, len(text), True)


def test_no_control_string_comes_from_a_text(spark):
    rows = [(1, i, "user", t) for i, t in enumerate(CASES)]
    template = X.Template()
    out = X.segments(spark.createDataFrame(rows, TURNS)).select(X.formatted("segments").alias("f")).first()["f"]
    assert out.count("<|im_start|>") == out.count("<|im_end|>") == len(CASES)
    assert not re.search(r"</?s>|\[/?INST\]", out) and template.opening in out


@pytest.mark.parametrize("roles,valid,bad", [
    (["user", "assistant"], True, None), (["system", "user", "assistant"], True, None),
    (["user", "assistant", "user"], False, None), (["assistant"], False, 0), (["user", "user"], False, 1),
    (["user", "system"], False, 1), (["user", "assistant", "assistant", "user"], False, 2), ([None], False, 0),
    (["user", "assistant"] * 40, True, None), (["tool\nx%0A"], False, 0)])
def test_machine(spark, roles, valid, bad):
    df = spark.createDataFrame([(3, i, r, "t") for i, r in enumerate(roles)], TURNS).orderBy(F.desc("turn"))
    row = X.segments(df).first()
    assert (row["valid"], row["first_bad_turn"]) == (valid, bad)
    said = "".join(f"{r or ''}\nt\n" for r in roles)
    assert read(df).first()["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_ties_nulls_repeated_rows_and_other_columns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, "user", "x"), (None, 1, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumn("segments", F.lit("own")).withColumn("valid", F.lit(1))
    got = {r["conv_id"]: r for r in read(df).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    assert got[None]["turns_sha256"] == hashlib.sha256(b"user\nx\n\n\n").hexdigest()
    assert read(df.where("false")).count() == 0


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "b")], TURNS)
    plan = read(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_loss_follows_the_template(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], TURNS)
    both = X.Template(loss_roles=("user", "assistant"))
    assert X.digests(X.segments(df, both), both).first()["loss_chars"] == 2
