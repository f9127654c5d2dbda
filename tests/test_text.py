import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions import chat, completions, jsontext, prompts, text
from ledgerweave.plans import adhoc
from ledgerweave.streaming import tokens

SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", "　"]
NOT_SPACES = ["​", "\x00", "﻿"]


def test_strip_is_python_strip(column):
    values = [f"{s}a{s}b{s}{s}" for s in SPACES + NOT_SPACES] + ["", " ", "".join(SPACES), "x"]
    assert column(values, text.strip) == [v.strip() for v in values]


def test_strip_long_inner_space(column):
    value = "a" + " " * 200_000 + "b "
    assert column([value], text.strip) == [value.strip()]


def expected_sql(raw):
    raw = re.sub(r"<think>.*?</think>", "", raw, flags=re.DOTALL).strip()
    raw = re.sub(r"```(?:sql)?\s*", "", raw).strip()
    return raw.rstrip("`").strip()


@pytest.mark.parametrize("raw", [
    "SELECT 1", "<think>a\nb</think>\nSELECT 1", "<think>never closed SELECT 1",
    "```sql\nSELECT 1\n```", "```\nSELECT 1```", "so: ```sql SELECT 1``` done",
    "SELECT `a` ``", "\xa0SELECT 1\xa0", "", "<think>x</think>", "<think>a</think>1<think>b</think>"])
def test_clean_sql_text(column, raw):
    assert column([raw], text.clean_sql_text) == [expected_sql(raw)]


def test_template_inserts_once(column):
    template = "{a}|{b}|{{c}}|{a}"
    got = column(["{b}"], lambda x: text.fill_template(template, a=x, b=F.lit(None)))
    assert got == ["{b}||{c}|{b}"]


def test_whole_dollars_ties_to_even(column):
    values = [0.5, 1.5, 2.5, 299.5, 300.5, 600.0]
    assert column(values, text.whole_dollars, "double") == ["0", "2", "2", "300", "300", "600"]


def test_json_strings(column):
    values = ["plain", "é \U0001F600", 'q"b\\/\b\f\n\r\t\x00\x0b\x1f\x7f', "\\u001F", "", "[x]", "é]["]
    assert column(values, lambda x: jsontext.json_string("x")) == [json.dumps(v) for v in values]


def test_json_floats(column):
    rng = random.Random(1)
    values = [0.0, -0.0, 1e7, 12345678.9, 9.99e15, 1e16, 1.5e17, 1e-4, 1.25e-4, 1e-5, -1.5e-7,
              1e100, 300.5] + [round(rng.uniform(-1e9, 1e9), 2) for _ in range(500)]
    got = column(values, lambda x: jsontext.json_value("x", T.DoubleType()), "double")
    assert got == [repr(v) for v in values]


def test_json_nested_value(spark):
    rows = [{"a": [1, None], "b": {"k": "é"}, "c": None, "d": True}]
    schema = "a array<int>, b map<string,string>, c string, d boolean"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    assert df.select(jsontext.json_object(df.schema)).first()[0] == json.dumps(rows[0])


def test_indented_rows(spark):
    rows = [{"a": 1, "b": 'x, "y": {é', "c": None, "d": 12345678.9}, {}, {"k": True}]
    encoded = [json.dumps(r) for r in rows]
    foreign = [json.dumps(r, ensure_ascii=False).replace("12345678.9", "1.23456789E7")
               for r in rows]
    df = spark.createDataFrame([(encoded, foreign, [])],
                               "a array<string>, f array<string>, e array<string>")
    got = df.select(jsontext.indented_rows("a"), jsontext.indented_rows("f"),
                    jsontext.indented_rows("e"), jsontext.indented_rows("a", 2)).first()
    assert got[0] == got[1] == json.dumps(rows, indent=2)
    assert got[2] == "[]"
    assert got[3] == json.dumps(rows[:2], indent=2)


def test_indented_nested_rows(spark):
    rows = [{"a": {"b": [1, 2.5, {"c": None, "d": []}], "e": {}}, "f": "{[:,]}"}, {"g": [[], [["x"]], {}]}, {}]
    df = spark.createDataFrame([([json.dumps(r) for r in rows],
                                 [json.dumps(r, separators=(",", ":")) for r in rows])],
                               "a array<string>, b array<string>")
    got = df.select(jsontext.indented_rows("a"), jsontext.indented_rows("b")).first()
    assert got[0] == got[1] == json.dumps(rows, indent=2)


@pytest.mark.parametrize("style,body,answer", [
    ("choices", '{"choices": [{"message": {"content": " hi\\n"}}]}', "hi"),
    ("choices", '{"choices": []}', None), ("choices", "broken", None),
    ("message", '{"message": {"content": " m "}}', "m"), ("message", '{"message": {}}', ""),
    ("message", "{}", ""), ("message", '{"message": null}', None),
    ("response", '{"response": "r "}', "r"), ("response", "{}", ""), ("response", "[", None),
    ("blocks", '{"content": [{"text": " t"}]}', "t"), ("blocks", "{}", None)])
def test_completion_text(column, style, body, answer):
    assert column([body], lambda x: completions.completion_text(x, style)) == [answer]


def test_system_message_only_if_given(spark):
    df = spark.createDataFrame([("s", [("user", "u")]), ("", [("user", "u")])],
                               "system string, messages array<struct<role:string,content:string>>")
    got = [r[0] for r in df.select(chat.chat_text(
        chat.prepend_system(F.col("messages"), F.col("system")), "<", ">", ";")).collect()]
    assert got == ["<system>s;<user>u;", "<user>u;"]


def test_key_strip_and_length(spark):
    messages = [{"role": "system", "content": "s", "_question": "q", "name": "n"},
                {"role": "user", "content": "u"}]
    df = spark.createDataFrame([(messages,), (messages[:1],), ([],)],
                               "messages array<map<string,string>>")
    got = [r.messages for r in chat.training_rows(df).collect()]
    assert got == [[{"role": "system", "content": "s", "name": "n"},
                    {"role": "user", "content": "u"}]]


def test_spark_prompt_asks_for_sql_that_runs(spark):
    """Column names and date rules of the prompt hold for the tables that texts may read."""
    text = spark.range(1).select(prompts.spark_sql_prompt(
        F.lit("How {much}?"), "2024-03-31").alias("p")).first().p
    assert 'Question: "How {much}?"' in text and "{as_of}" not in text
    t = spark.createDataFrame([(1, dt.date(2024, 2, 29), "x", 5, "Rent", "Checking")],
                              "id long, tx_date date, description string, amount int, category string, "
                              "account string")
    for column in t.columns:
        assert f"\n  {column} " in text
    rule = re.search(r'"last month"  -> (WHERE .*\n.*)', text)[1]
    got = adhoc.run_query(spark, f"SELECT id FROM transactions {rule}", {"transactions": t})
    assert got.error == "" and [r.id for r in got.rows.collect()] == [1]
    for name in ("this month", "this year", "last N days"):
        rule = re.search(rf'"{name}"\s*-> (WHERE .*)', text)[1].replace("N)", "90)")
        got = adhoc.run_query(spark, f"SELECT id FROM transactions {rule}", {"transactions": t})
        assert [r.id for r in got.rows.collect()] == ([] if name == "this month" else [1])


def test_tokens_are_parsed_where_the_key_may_be(spark):
    lines = ['data: {"choices": [{"delta": {"content": "a"}}]}', 'data: {"choices": []}',
             'data: {"choices": [{"delta": {"\\u0063ontent": "b"}}]}', "data: [DONE]"]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)],
                               "request_id int, seq long, raw_line string")
    assert tokens.reassemble_events(df).first().text == "ab"
