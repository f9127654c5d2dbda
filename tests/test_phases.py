import datetime as dt
import json
import shutil
import threading
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerweave import schemas
from ledgerweave.plans import adhoc, annotate, answering, collect, completion, resume, runs
from ledgerweave.sources import jsonl, sinks, tables
from ledgerweave.sources.questions import QUESTIONS, Domain, Question, call, rename
from ledgerweave.streaming import tokens
from ledgerweave.streaming.increments import annotate_increments, rejected_lines

NO_WAIT = {"backoff": 0, "pause": 0}


def test_question_bank():
    assert len(QUESTIONS) == 88 and len({q.text for q in QUESTIONS}) == 88
    assert {c.operator for q in QUESTIONS for c in q.calls} <= {
        *collect.OPERATORS, *collect.TALLIES, "merchant_total", "top_categories", "top_transactions",
        "account_activity", "budget_status"}


def test_rename():
    got = rename([Question("q", (call("spend_total", category="A", period="p"),))], {"A": "B"})
    assert got[0].binding == "spend_total(category='B', period='p')"


@pytest.mark.parametrize("broken", [{"questions": ()}, {"system_prompt": ""},
                                    {"annotation_template": "{question}"},
                                    {"questions": (Question("q", ()),)}])
def test_domain_contract(broken):
    with pytest.raises(ValueError):
        Domain(**broken)


def test_resume_keeps_duplicates_and_ignores_nulls(spark):
    work = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "question string")
    done = spark.createDataFrame([("a",), (None,), ("a",)], "question string")
    got = sorted(r[0] for r in resume.pending(work, done).collect())
    assert got == ["b", "b", "c"]


def test_outcomes(spark):
    rows = [("boom", ["r"], "error"), ("", [], "no_data"), (None, None, "no_data"),
            ("", ['{"x": null}'], "ok")]
    df = spark.createDataFrame(rows, "error string, rows array<string>, want string")
    assert df.where(resume.outcome(F.col("error"), F.col("rows")) == F.col("want")).count() == 4
    outcomes = spark.createDataFrame([("ok",), ("error",), ("no_data",), ("already_done",)],
                                     "outcome string")
    got = {r.result: r.n for r in resume.collect_summary(outcomes).collect()}
    assert got == {"new": 1, "errors": 1, "skipped": 2}


@pytest.mark.parametrize("failures,answered", [(0, True), (1, True), (2, True), (3, False)])
def test_completion_retries(spark, failures, answered):
    def flaky(prompts, seen={}):
        seen[prompts[0]] = seen.get(prompts[0], 0) + 1
        if seen[prompts[0]] <= failures:
            raise RuntimeError("busy")
        return [p.upper() for p in prompts]
    df = spark.createDataFrame([("a",), ("b",)], "p string").coalesce(1)
    got = completion.complete(df, "p", flaky, **NO_WAIT).collect()
    assert [r.answer for r in got] == (["A", "B"] if answered else [None, None])
    assert [r.error for r in got] == ([None] * 2 if answered else ["RuntimeError: busy"] * 2)


def test_completion_counts_answers(spark):
    df = spark.createDataFrame([("a",)], "p string")
    got = completion.complete(df, "p", lambda ps: [], **NO_WAIT).first()
    assert got.answer is None and "0 answers to 1" in got.error


def test_one_failure_does_not_touch_the_others(spark):
    def picky(prompts):
        if prompts[0] == "bad":
            raise ValueError("no")
        return prompts
    df = spark.createDataFrame([("x",), ("bad",), ("y",)], "p string").coalesce(1)
    got = completion.complete(df, "p", picky, concurrency=2, **NO_WAIT).collect()
    assert {r.p: r.answer for r in got} == {"x": "x", "bad": None, "y": "y"}


def test_completion_holds_few_python_strings(spark):
    """A worker does not turn whole batches into Python strings, however wide the rows are."""
    tracing = {}

    def fn(prompts):
        import tracemalloc
        if not tracing:
            tracemalloc.start()
            tracing["on"] = True
        peak = tracemalloc.get_traced_memory()[1]
        if prompts[0].startswith("2999 "):
            tracemalloc.stop()
        return [str(peak)]
    text = F.concat("id", F.lit(" "), F.repeat(F.lit("x"), 5000), F.lit("\U0001f600"))  # 4 bytes a letter
    df = spark.range(0, 3000, 1, 1).select("id", text.alias("p"), text.alias("q"),
                                           F.array(text).alias("r"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = completion.complete(df, "p", fn, **NO_WAIT).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.id for r in got] == list(range(3000)) and all(r.error is None for r in got)
    assert all(r.p == r.q == r.r[0] == f"{r.id} " + "x" * 5000 + "\U0001f600" for r in got)
    assert max(int(r.answer) for r in got) < 80_000_000


QUERY_ERRORS = ["DROP TABLE t", "SELECT 1; SELECT 2", "SELECT nope FROM t", "INSERT INTO t VALUES (1)",
                "SELECT reflect('java.lang.System', 'nanoTime')", "SHOW TABLES",
                "SELECT IDENTIFIER('java_' || 'method')('java.lang.System', 'nanoTime')",
                "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
                "SELECT * FROM other_view", "SELECT * FROM t WHERE a IN (SELECT id FROM other_view)",
                "SELECT (SELECT max(id) FROM other_view) FROM t", "SELECT * FROM default.t",
                "WITH x AS (SELECT * FROM other_view) SELECT * FROM x", "SELECT input_file_name() FROM t",
                "SELECT * FROM (WITH other_view AS (SELECT 1) SELECT * FROM other_view) a, other_view",
                "SELECT * FROM IDENTIFIER('t')", "SELECT default.abs(a) FROM t", "SELECT secret() FROM t"]


@pytest.mark.parametrize("sql", QUERY_ERRORS)
def test_queries_refused(spark, sql):
    t = spark.range(3).toDF("a")
    spark.range(9).createOrReplaceTempView("other_view")
    spark.udf.register("secret", lambda: "s")
    got = adhoc.run_query(spark, sql, {"t": t})
    assert got.rows is None and got.error.startswith("SQL error: ")


def test_queries_leave_the_session_alone(spark):
    spark.range(9).createOrReplaceTempView("t")
    before = sorted(x.name for x in spark.catalog.listTables())
    files = spark.conf.get("spark.sql.runSQLOnFiles")
    t = spark.createDataFrame([("reflect on identifier",), ("x",)], "a string")
    for text in ("SELECT a FROM t WHERE a ILIKE '%reflect%'", "SELECT a FROM T WHERE a LIKE '%identifier%'",
                 "WITH b AS (SELECT a FROM t) SELECT b.a FROM b JOIN t ON b.a = t.a WHERE length(b.a) > 1",
                 "SELECT a FROM t WHERE length(a) = (SELECT max(length(a)) FROM t)"):
        got = adhoc.run_query(spark, text, {"t": t})
        assert got.error == "" and [r.a for r in got.rows.collect()] == ["reflect on identifier"]
    assert spark.table("t").count() == 9 and spark.conf.get("spark.sql.runSQLOnFiles") == files
    assert sorted(x.name for x in spark.catalog.listTables()) == before
    assert adhoc.run_query(spark, "SELECT 1 AS a", {}).rows.first().a == 1


def test_query_cap_and_late_failure(spark):
    t = spark.range(500).toDF("a")
    got = adhoc.run_query(spark, "SELECT a FROM t ORDER BY a DESC -- newest;", {"t": t})
    rows, error = adhoc.fetch_rows(got)
    assert error == "" and len(rows) == 200 and json.loads(rows[0]) == {"a": 499}
    escape = adhoc.run_query(spark, "SELECT a FROM t) UNION ALL (SELECT a FROM t", {"t": t})
    assert len(adhoc.fetch_rows(escape)[0]) <= 200
    late = adhoc.run_query(spark, "SELECT 1 / (a - a) AS x FROM t", {"t": t})
    rows, error = adhoc.fetch_rows(late)
    assert rows == [] and error.startswith("SQL error: ")


def test_answers_from_query_texts(spark):
    t = spark.createDataFrame([("A", 1.5), ("B", 2.0)], "category string, amount double")
    limits = spark.createDataFrame([("A", 2.5), ("C", 1.0)], "category string, monthly_limit double")
    got = answering.answer_questions(
        spark, [("all?", "```sql\nSELECT category, amount FROM t ORDER BY amount\n```"), ("none?", "")],
        {"t": t}, limits, Domain()).orderBy("q_no").collect()
    assert got[0].rows == ['{"category": "A", "amount": 1.5}', '{"category": "B", "amount": 2.0}']
    assert got[0].context_section == "Budget limits:\n  A: $2/month\n\n"
    want = json.dumps([json.loads(r) for r in got[0].rows], indent=2)
    assert f"Data returned:\n{want}\nBudget limits:" in got[0].full_prompt
    assert (got[1].outcome, got[1].error) == ("error", answering.NO_SQL)


def test_answers_of_one_tenant(spark):
    t = spark.createDataFrame([(1, "A", 1.5), (2, "B", 2.0)], "user_id long, category string, amount double")
    limits = spark.createDataFrame([(1, "A", 9.0), (2, "A", 1.0)], "user_id long, category string, monthly_limit double")
    texts = [("all?", "SELECT * FROM t"), ("none?", "SELECT * FROM t WHERE amount > 5"), ("bad?", "SELECT user_id FROM t")]
    got = answering.answer_questions(spark, texts, {"t": t}, limits, Domain(), tenant={"user_id": 1},
                                     fn=lambda ps: [p[:9] for p in ps], **NO_WAIT).orderBy("q_no").collect()
    assert got[0].rows == ['{"category": "A", "amount": 1.5}'] and "A: $9/month" in got[0].context_section
    assert [r.outcome for r in got] == ["ok", "no_data", "error"]
    assert len(got[0].answer) == 9 and got[1].answer == got[2].answer == ""


def test_calls_overlap_and_leave_in_order(spark):
    """Eight slow calls at once, none of which waits for the one that backs off."""
    def slow(prompts, state, lock):
        with lock:
            state["open"] += 1
            state["most"] = max(state["most"], state["open"])
        time.sleep(0.05)
        with lock:
            state["open"] -= 1
            if prompts[0] == "p3" and not state["failed"]:
                state["failed"] = True
                raise RuntimeError("busy")
        return [f"{p} {state['most']}" for p in prompts]
    frames = [f"p{i}" for i in range(64)]
    df = spark.createDataFrame([(p,) for p in frames], "p string").coalesce(1)

    def most(in_flight):
        # the lock cannot be pickled, so each task makes its own
        def fn(prompts, own={}):
            if not own:
                own["state"], own["lock"] = {"open": 0, "most": 0, "failed": False}, threading.Lock()
            return slow(prompts, own["state"], own["lock"])
        got = completion.complete(df, "p", fn, backoff=1.5, pause=0, in_flight=in_flight).collect()
        assert [r.p for r in got] == frames and all(r.error is None for r in got)
        return max(int(r.answer.split()[1]) for r in got)
    assert most(1) == 1 and most(8) > 3


def raw(spark, questions):
    rows = [(q, "s", ['{"a": 1}'], "", "prompt " + q, "base", "") for q in questions]
    return spark.createDataFrame(rows, "question string, sql string, rows array<string>, "
                                 "context_section string, full_prompt string, "
                                 "llama_answer string, gold_answer string")


def test_annotation_resumes(spark, tmp_path):
    domain, out = Domain(), str(tmp_path / "out")
    first = annotate.annotate(raw(spark, ["a", "b"]), domain, lambda ps: ["gold"], **NO_WAIT)
    sinks.append_training_records(annotate.training_records(first, domain), out)
    done = jsonl.annotated_questions(spark.read.text(out))
    again = annotate.annotate(raw(spark, ["a", "b", "c"]), domain, lambda ps: ["gold"], done, **NO_WAIT)
    assert [r.question for r in again.collect()] == ["c"]
    strict = jsonl.read_strict(spark.read.text(out))
    assert strict.count() == 2


def test_chunks_keep_what_is_finished(spark, tmp_path):
    """A run that dies in a later chunk loses that chunk only; the next run adds the rest once."""
    paths = [str(tmp_path / p) for p in ("raw", "out")]
    sinks.append_raw_examples(raw(spark, [f"q{i}" for i in range(40)]), paths[0])
    calls = []

    def stops(annotated, *rest, real=runs.append_training_records):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        real(annotated, *rest)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(runs, "append_training_records", stops)
        with pytest.raises(KeyboardInterrupt):
            runs.run_annotate(spark, *paths, Domain(), lambda ps: ["gold"] * len(ps), chunks=4, **NO_WAIT)
    kept = spark.read.text(paths[1]).count()
    assert 0 < kept < 40
    got = runs.run_annotate(spark, *paths, Domain(), lambda ps: ["gold"] * len(ps), chunks=4, **NO_WAIT)
    assert {r["result"]: r["n"] for r in got.collect()} == {"skipped": kept, "annotated": 40 - kept}
    lines = [json.loads(r[0])["metadata"]["question"] for r in spark.read.text(paths[1]).collect()]
    assert sorted(lines) == sorted(f"q{i}" for i in range(40))


def test_stream_adds_only_new_questions(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("raw", "out", "state")]
    for questions in (["a", "b"], ["b", "c"]):
        sinks.append_raw_examples(raw(spark, questions), paths[0])
        annotate_increments(spark, *paths, Domain(), lambda ps: ["gold"] * len(ps),
                            **NO_WAIT).awaitTermination()
    lines = [json.loads(r[0]) for r in spark.read.text(paths[1]).collect()]
    assert sorted(x["metadata"]["question"] for x in lines) == ["a", "b", "c"]


def test_stream_state_holds_each_key_once(spark, tmp_path):
    """Repeats within a batch and from earlier runs are found in the state; no key is listed."""
    paths = [str(tmp_path / p) for p in ("raw", "out", "state")]
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    for questions, held in ((["a", "b", "b"], 2), (["b", "c"], 3), (["a", "c"], 3)):
        sinks.append_raw_examples(raw(spark, questions), paths[0])
        query = annotate_increments(spark, *paths, Domain(), lambda ps: ["gold"] * len(ps),
                                    **NO_WAIT)
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == held and "rocksdbGetCount" in state["customMetrics"]
    lines = spark.read.option("recursiveFileLookup", True).text(paths[1]).collect()
    assert sorted(json.loads(r[0])["metadata"]["question"] for r in lines) == ["a", "b", "c"]
    assert not (tmp_path / "state" / "work" / "keys").exists()
    assert spark.conf.get(setting) == before


def _down(prompts):
    raise OSError("no model")


def test_stream_retries_failures_and_keeps_rejects(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("raw", "out", "state")]
    sinks.append_raw_examples(raw(spark, ["a", "b"]), paths[0])
    spark.createDataFrame([("broken",)], "value string").write.mode("append").text(paths[0])
    earlier = raw(spark, ["b"]).withColumn("status", F.lit("ok"))
    sinks.append_training_records(annotate.training_records(earlier, Domain()), paths[1])
    for fn, expected in ((_down, ["b"]), (_down, ["b"]), (lambda ps: ["gold"] * len(ps), ["a", "b"]),
                         (_down, ["a", "b"])):
        annotate_increments(spark, *paths, Domain(), fn, max_files=1,
                            **NO_WAIT).awaitTermination()
        lines = spark.read.option("recursiveFileLookup", True).text(paths[1]).collect()
        assert sorted(json.loads(r[0])["metadata"]["question"] for r in lines) == expected
    assert [tuple(r) for r in rejected_lines(spark, paths[2]).collect()] == [("broken", "malformed")]


EVENTS = [": comment", 'data: {"choices": [{"delta": {"role": "assistant"}}]}', "data: {broken",
          'data: {"choices": [{"delta": {"content": "Hel"}}]}', 'data: {"choices": []}',
          ' data: {"choices": [{"delta": {"content": "lo"}}]} \r', "data:",
          "data: [DONE]", 'data: {"choices": [{"delta": {"content": " late"}}]}']
OBJECTS = ['{"message": {"content": "one "}, "done": false}', "broken", '{"message": {}}',
           '{"message": {"content": "two"}, "done": true}', '{"message": {"content": "late"}}']


def chunks(spark, *logs):
    rows = [(r, i * step, line) for r, step, lines in logs for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "request_id long, seq long, raw_line string").repartition(5)


@pytest.mark.parametrize("step", [1, 700])
def test_token_logs(spark, step):
    """With a step of 700 each request spreads over many runs of sequence numbers."""
    events = tokens.reassemble_events(chunks(spark, (1, step, EVENTS), (2, step, [": none"])))
    objects = tokens.reassemble_objects(chunks(spark, (2, step, OBJECTS), (3, step, OBJECTS)))
    assert {r.request_id: r.text for r in events.collect()} == {1: "Hello", 2: ""}
    both = tokens.first_with_tokens(events, objects)
    assert {r.request_id: r.text for r in both.collect()} == {
        1: "Hello", 2: "one two", 3: "one two"}


def test_upsert_last_wins(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, balance double")
    new = spark.createDataFrame([("a", 5.0, 1), ("a", 3.0, 2), ("c", 9.0, 1), ("c", None, 2)],
                                "name string, balance double, seq int")
    got = {r.name: r.balance for r in tables.upsert(base, new, ["name"], "seq").collect()}
    assert got == {"a": 3.0, "b": 2.0, "c": None}


def test_upsert_orders_null_seq(spark):
    """An update without a seq beats the base row and yields to one with a seq; ties are total."""
    base = spark.createDataFrame([("a", 9.0), ("b", 9.0), ("c", 9.0)], "name string, balance double")
    new = spark.createDataFrame([("a", 1.0, None), ("b", 8.0, None), ("b", 1.0, 0), ("c", 2.0, 1),
                                 ("c", 3.0, 1), (None, 4.0, 1)],
                                "name string, balance double, seq int")
    for parts in (1, 7):
        got = {r.name: r.balance for r in tables.upsert(base, new.repartition(parts), ["name"], "seq")
               .collect()}
        assert got == {"a": 1.0, "b": 1.0, "c": 3.0, None: 4.0}


def test_merge_rewrites_changed_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(500).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    tables.write_keyed(base, path, ["k"], parts=16)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    new = spark.createDataFrame([(3, 1, 1), (3, 2, 2), (900, 5, 1), (None, 7, None)],
                                "k long, v int, s int")
    for _ in range(2):                  # merged again, nothing changes
        tables.merge_keyed(new, path, base.schema, ["k"], "s", parts=16)
        got = {r.k: r.v for r in tables.read_keyed(spark, path, base.schema).collect()}
        assert got == {**dict.fromkeys(range(500), 0), 3: 2, 900: 5, None: 7}
    kept = [f for f, t in files().items() if before.get(f) == t]
    assert len(kept) >= 13
    tables.merge_keyed(new.limit(0), path, base.schema, ["k"], "s", parts=16)
    assert tables.read_keyed(spark, path, base.schema).count() == 502


def test_check_table(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "z")], "id int, c string")
    got = {r.rule: r.violations
           for r in tables.check_table(df, "t", ["id", "c"], ["id"], {"c": ["x"]}).collect()}
    assert got == {"id not null": 0, "c not null": 1, "c in domain": 1, "id unique": 1}


def _small_tables(spark, path, register=None):
    """Two tenants with transactions, one of them without an account, and one without any."""
    rows = [(1, 1, dt.date(2024, 3, 5), "Starbucks", Decimal("5.00"), "Restaurants", "Checking"),
            (1, 1, dt.date(2024, 3, 5), "Starbucks", Decimal("5.00"), "Restaurants", "Checking"),
            (1, 2, dt.date(2024, 2, 5), "Employer", Decimal("-100.00"), "Income", "Checking"),
            (2, 3, dt.date(2024, 2, 9), "Market", Decimal("9.50"), "Groceries", "Credit Card")]
    spark.createDataFrame(rows, schemas.TRANSACTIONS).write.mode("overwrite").parquet(path)
    accounts = spark.createDataFrame([(1, "Checking", "c", Decimal("7.00")), (3, "Checking", "c", None)],
                                     schemas.ACCOUNTS)
    budgets = spark.createDataFrame([(1, "Groceries", Decimal("600"))], schemas.BUDGETS)
    return collect.Tables(spark.read.schema(schemas.TRANSACTIONS).parquet(path), accounts, budgets,
                          "2024-03-31", register=register)


def test_bank_reads_transactions_once(spark, tmp_path):
    path = str(tmp_path / "tx")
    calls = collect.distinct_calls(QUESTIONS)
    tables = _small_tables(spark, path).covering(calls)
    plan = collect.working_set(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert tables.working_set.count() > 0
    shutil.rmtree(path)                    # nothing else may read them
    got = collect.collect_answers(tables, Domain()).collect()
    assert len(got) == 3 * len(QUESTIONS)
    rows = {(r["user_id"], r["sql"]): list(r["rows"]) for r in got}
    merchant = [c for c in calls if c.operator == "merchant_total"]
    coffee = next(c.text for c in merchant if "starbucks" in c.text)
    assert rows[1, coffee] == ['{"n": 2, "spent": 10.0}']
    for tenant in (2, 3):                  # zero rows are an answer, not missing data
        assert rows[tenant, coffee] == ['{"n": 0, "spent": null}']
    for c in calls:
        if c.operator in collect.TALLIES:
            assert all(rows.get((t, c.text), ["x"]) for t in (1, 2, 3))
    top = next(c.text for c in calls if c.operator == "top_transactions")
    assert '"description": "Market"' in rows[2, top][0] and rows[3, top] == []


def test_nothing_left_reads_no_transactions(spark, tmp_path):
    path = str(tmp_path / "tx")
    register = spark.createDataFrame([(1,), (2,)], "user_id long")
    tables = _small_tables(spark, path, register)
    every = collect.tenant_questions(register, QUESTIONS).select("user_id", "question")
    one_left = every.where(f"NOT (user_id = 2 AND question = '{QUESTIONS[1].text}')")
    got = collect.collect_answers(tables, Domain(), one_left).collect()
    assert [(r["user_id"], r["question"]) for r in got] == [(2, QUESTIONS[1].text)]
    assert "Market" not in got[0]["rows"][0] and "Groceries" in got[0]["rows"][0]
    shutil.rmtree(path)
    assert collect.collect_answers(tables, Domain(), every).collect() == []
