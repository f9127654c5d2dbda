import json

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import chat
from ledgerweave.sources import jsonl, sinks

LINES = ['{"question": "good", "sql": "s", "rows": [{"a": 1}]}', "bad json", "", "  ", "[1,2]",
         '{"x":1}', '"str"', '{"question": "cut', '{"question": 3}', '{"question": "t"} tail',
         '{"question": "g"}{"question": "h"}', '{"question": "c"},{"question": "d"}',
         "{'question': 'q'}", '{"question": null}', '{"question": "good"}', '  {"question": "sp"}  ']


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_ledger_ignores_unusable_lines(spark):
    got = {r[0] for r in jsonl.done_questions(lines(spark, LINES)).collect()}
    assert got == {"good", "3", "sp"}


def test_records_and_rejects(spark):
    good, rejects = jsonl.read_records(lines(spark, LINES))
    assert sorted(r.question for r in good.collect()) == ["3", "good", "good", "sp"]
    assert good.where("sql = 's'").first().rows == ['{"a":1}']
    reasons = {r.value: r.reason for r in rejects.collect()}
    assert reasons['{"x":1}'] == reasons['{"question": null}'] == "no question"
    assert reasons["bad json"] == reasons["[1,2]"] == "malformed"
    assert good.count() + rejects.count() == len(LINES)


def test_strict_read(spark):
    ok = ['{"messages": [{"role": "user", "content": "u", "k": "v"}]}', " ", '{"x": 1}']
    got = [[{k: v.toPython() for k, v in m.items()} for m in r.messages]
           for r in jsonl.read_strict(lines(spark, ok)).collect()]
    assert got == [[{"role": "user", "content": "u", "k": "v"}], []]
    with pytest.raises(Exception, match="malformed line: oops"):
        jsonl.read_strict(lines(spark, [*ok, "oops"])).count()


def test_message_values_keep_their_types(spark):
    message = {"role": "user", "content": "é \"x\"", "_question": "q", "n": 3, "f": 1.5, "ok": True, "no": None,
               "s": "3", "list": [1, "two", [], {"a": {"b": [False, None]}, "c": "é"}], "none": {}}
    record = {"messages": [message, {"role": "assistant", "content": "a"}], "metadata": 1}
    rows = chat.training_rows(jsonl.read_strict(lines(spark, [json.dumps(record)])))
    line = rows.select(chat.messages_line(rows.schema["messages"].dataType)).first()[0]
    del message["_question"]
    assert line == json.dumps({"messages": record["messages"]})
    assert rows.select(chat.chat_text(F.col("messages"), "<", ":", ">")).first()[0] == (
        '<user:é "x"><assistant:a>')


def test_annotated_questions(spark):
    values = ['{"messages": [{"role": "system", "content": "s", "_question": "q1"}]}',
              '{"messages": []}', '{"messages": [{"role": "system", "_question": ""}]}', "x"]
    got = [r[0] for r in jsonl.annotated_questions(lines(spark, values)).collect()]
    assert got == ["q1"]


def test_raw_examples_round_trip(spark, tmp_path):
    row = ("é?", "s", ['{"a": 1.5, "b": null}'], "", "p", "l", "")
    df = spark.createDataFrame([row], "question string, sql string, rows array<string>, "
                               "context_section string, full_prompt string, llama_answer string, "
                               "gold_answer string")
    path = str(tmp_path / "raw")
    sinks.append_raw_examples(df, path)
    sinks.append_raw_examples(df.withColumn("question", F.lit("second")), path)
    good, rejects = jsonl.read_records(spark.read.text(path))
    assert {r.question for r in good.collect()} == {"é?", "second"}
    assert good.first().rows == ['{"a":1.5,"b":null}'] and rejects.count() == 0


def test_record_line_keeps_question_on_system_message_only(spark):
    messages = chat.training_messages(F.lit("s"), F.lit("q"), F.lit("u"), F.lit("a"))
    df = spark.range(1).select(messages.alias("messages"), F.struct(
        F.lit("q").alias("question"), F.lit("x").alias("sql")).alias("metadata"))
    assert df.select(chat.record_line()).first()[0] == (
        '{"messages": [{"role": "system", "content": "s", "_question": "q"}, '
        '{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}], '
        '"metadata": {"question": "q", "sql": "x"}}')
