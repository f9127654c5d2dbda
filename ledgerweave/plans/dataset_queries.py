"""Data-set queries over the given tables, each with its SQL statement.

JSON lines, chunk logs and ledgers are derived from whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import chat, completions, dates, jsontext, prompts, text
from ledgerweave.operators import spending
from ledgerweave.operators.measures import narrow
from ledgerweave.operators.ranking import top_k
from ledgerweave.plans import annotate as annotating
from ledgerweave.plans import collect, oracle_dataset as sql, runs, splitting
from ledgerweave.plans.adhoc import run_query
from ledgerweave.plans.answering import answer_questions
from ledgerweave.plans.completion import complete
from ledgerweave.plans.resume import (
    ANSWER_CAPS, annotate_summary, collect_summary, outcome, pending,
)
from ledgerweave.sources import jsonl, sinks, star, tables
from ledgerweave.sources.questions import QUESTIONS, Domain, question_frame, rename
from ledgerweave.sources.shared import shared_dir, write_through
from ledgerweave.sources.star import AS_OF
from ledgerweave.streaming import tokens
from ledgerweave.streaming.increments import annotate_increments

DOMAIN = Domain(questions=rename(QUESTIONS, sql.STAR_NAMES))


def turns(spark, d):
    return star.read(spark, d, "conversations")


def documents(spark, d):
    return star.read(spark, d, "documents")


def records(spark, d):
    return chat.chat_records(turns(spark, d))


# Lines in every state a ledger can be in, one per conversation turn.

def ledger_lines(spark, d) -> DataFrame:
    t = turns(spark, d)
    good = F.concat(F.lit('{"question": '), jsontext.json_string("text"),
                    F.lit(', "sql": "s"}'))
    kind = (F.col("conv_id") + F.col("turn")) % 7
    line = (F.when(kind == 0, good)
            .when(kind == 1, F.substring(good, F.lit(1), F.length(good) - 1))
            .when(kind == 2, F.col("text")).when(kind == 3, F.lit("[1, 2]"))
            .when(kind == 4, F.lit('{"x": 1}')).when(kind == 5, F.concat(good, F.lit(" tail")))
            .otherwise('{"question": 3}'))
    return t.select(line.alias("value"))


def ledger_questions(spark, d):
    return jsonl.done_questions(ledger_lines(spark, d))


def read_records(spark, d):
    good, _ = jsonl.read_records(ledger_lines(spark, d))
    return good.select("question", "sql")


def record_rejects(spark, d):
    _, rejects = jsonl.read_records(ledger_lines(spark, d))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def _training_lines(spark, d) -> DataFrame:
    """Conversations as training-record lines, with blank lines between them."""
    noted = F.transform("messages", lambda m, i: F.struct(
        m["role"].alias("role"), m["content"].alias("content"),
        F.when(i == 0, F.col("conv_id").cast("string")).alias("_question")))
    rows = records(spark, d).select(noted.alias("messages"), F.struct(
        F.col("conv_id").cast("string").alias("question"), F.lit("s").alias("sql"))
        .alias("metadata"))
    return rows.select(F.explode(F.array(chat.record_line(), F.lit("  "))).alias("value"))


def training_rows(spark, d):
    rows = chat.training_rows(jsonl.read_strict(_training_lines(spark, d)))
    keys = F.array_distinct(F.flatten(F.transform("messages", F.map_keys)))
    return rows.select(F.size("messages").cast("long").alias("n_messages"),
                       F.array_join(F.array_sort(keys), ",").alias("keys"),
                       chat.chat_text(F.col("messages")).alias("text"))


def chat_records(spark, d):
    return records(spark, d).select(
        "conv_id", F.size("messages").cast("long").alias("n_messages"),
        chat.chat_text(F.col("messages")).alias("text"))


def system_prepended(spark, d):
    system = F.when(F.col("conv_id") % 2 == 1, prompts.SYSTEM_PROMPT).otherwise("")
    return records(spark, d).select(
        "conv_id", chat.chat_text(chat.prepend_system(F.col("messages"), system)).alias("text"))


def train_split(spark, d):
    return splitting.split_records(records(spark, d), ["conv_id"]).select("conv_id", "split")


def split_counts(spark, d):
    return splitting.split_counts(splitting.split_records(records(spark, d), ["conv_id"]))


def split_copies(spark, d):
    """Documents, many of them copies, split by their text."""
    docs = documents(spark, d).select("text")
    return (splitting.split_records(docs, ["text"])
            .select(F.md5("text").alias("text_md5"), "split"))


def shuffled_positions(spark, d):
    return splitting.shuffled_positions(records(spark, d), ["conv_id"])


def shuffled_copies(spark, d):
    docs = documents(spark, d).select("text")
    return (splitting.shuffled_positions(docs, ["text"])
            .select(F.md5("text").alias("text_md5"), "position"))


def split_files(spark, d):
    """Splits written as JSON lines and read again."""
    path = shared_dir(spark)
    split = splitting.split_records(records(spark, d), ["conv_id"])
    sinks.write_splits(split, path, [splitting.shuffle_hash(["conv_id"]), "conv_id"])
    lines = spark.read.text(path)
    parsed = lines.select("split", jsontext.strict_record(
        F.col("value"), "struct<messages:array<struct<role:string,content:string>>>").alias("r"))
    return parsed.select("split", chat.chat_text(F.col("r.messages")).alias("text"))


def outcome_counts(spark, d):
    return (_outcomes(spark, d).groupBy("outcome").agg(F.count("*").alias("n")))


def _outcomes(spark, d):
    docs = documents(spark, d)
    error = F.when(F.col("doc_id") % 5 == 0, F.col("lang")).otherwise("")
    rows = F.filter(F.split("text", "\n"), lambda x: x.contains("the"))
    return docs.select("doc_id", outcome(error, rows).alias("outcome"))


def run_summary(spark, d):
    done = documents(spark, d).where(F.col("doc_id") % 3 == 0)
    new = pending(_outcomes(spark, d), done, ["doc_id"])
    old = done.select("doc_id", F.lit("already_done").alias("outcome"))
    return collect_summary(new.unionByName(old))


def clean_sql(spark, d):
    wrapped = F.concat(F.lit(" <think>"), F.col("text"), F.lit("</think>\n```sql\nSELECT '"),
                       F.col("text"), F.lit("'\n``` `` "))
    return documents(spark, d).select("doc_id", text.clean_sql_text(wrapped).alias("cleaned"),
                                      text.strip(F.col("text")).alias("stripped"))


def sql_prompts(spark, d):
    asked = turns(spark, d).where(F.col("role") == "user")
    return asked.select("conv_id", "turn", prompts.sql_prompt(F.col("text")).alias("prompt"))


def whole_dollars(spark, d):
    half = F.col("l_quantity") * 0.5
    return (star.read(spark, d, "lineitem").groupBy(text.whole_dollars(half).alias("dollars"))
            .agg(F.count("*").alias("n")))


def json_lines(spark, d):
    docs = documents(spark, d).select("doc_id", "text", "lang",
                                      F.when(F.col("doc_id") % 2 == 0, F.col("source"))
                                      .alias("source"))
    return docs.select("doc_id", jsontext.json_object(docs.schema).alias("line"))


def indented_rows(spark, d):
    """The largest movements of each tenant as indented JSON."""
    top = spending.top_transactions(star.transactions(spark, d), AS_OF, "last_month", 3)
    kept = top.select("user_id", "rank", "description", "amount", "tx_date",
                      F.lit(None).cast("string").alias("note"))
    row = jsontext.json_object(kept.schema, ["description", "amount", "tx_date", "note"])
    lists = (kept.groupBy("user_id")
             .agg(F.array_sort(F.collect_list(F.struct("rank", row.alias("row"))))["row"]
                  .alias("rows")))
    return lists.select("user_id", jsontext.indented_rows("rows").alias("results"))


def nested_rows(spark, d):
    """Conversations as indented JSON with lists, objects and typed values inside."""
    rows = records(spark, d).select("conv_id", F.transform("messages", lambda m, i: F.struct(
        m["role"].alias("role"), F.struct(i.alias("turn"), (i == 0).alias("first")).alias("at"),
        F.when(i > 0, F.array(F.length(m["content"]).cast("int"))).otherwise(
            F.array().cast("array<int>")).alias("sizes"))).alias("turns"))
    row = jsontext.json_object(rows.schema)
    return (rows.select("conv_id", F.array(row, F.lit('{"end":[{}, [null,1.5]]}')).alias("rows"))
            .select("conv_id", jsontext.indented_rows("rows").alias("results")))


def typed_messages(spark, d):
    """Training lines whose messages hold typed extra keys, read, stripped and written again."""
    extra = F.expr("concat('\"turn\": ', turn, ', \"user\": ', role = 'user', "
                   "', \"tags\": [', turn, ', \"x\", {\"a\": [null, 0.5]}], \"_question\": \"q\"')")
    quoted = jsontext.json_string("text")
    one = F.concat(F.lit('{"role": "'), F.col("role"), F.lit('", "content": '), quoted, F.lit(", "),
                   extra, F.lit("}"))
    lines = turns(spark, d).select("conv_id", "turn", F.concat(
        F.lit('{"messages": ['), one, F.lit(", "), one, F.lit('], "metadata": {}}')).alias("value"))
    rows = chat.training_rows(jsonl.read_strict(lines))
    return rows.select(chat.messages_line(rows.schema["messages"].dataType).alias("line"))


def extract_completion(spark, d):
    t = turns(spark, d)
    quoted = jsontext.json_string(r"concat('  ', text, ' \n')")
    bodies = {
        "choices": F.concat(F.lit('{"choices": [{"message": {"content": '), quoted, F.lit("}}]}")),
        "message": F.concat(F.lit('{"message": {"content": '), quoted, F.lit("}}")),
        "response": F.when(F.col("turn") == 0, F.lit("{}")).otherwise(
            F.concat(F.lit('{"response": '), quoted, F.lit("}"))),
        "blocks": F.when(F.col("turn") == 0, F.col("text")).otherwise(
            F.concat(F.lit('{"content": [{"text": '), quoted, F.lit("}]}"))),
    }
    return t.select("conv_id", "turn", *[
        completions.completion_text(body, style).alias(style) for style, body in bodies.items()])


def date_keys(spark, d):
    day = F.col("o_orderdate").cast("date")
    return (star.read(spark, d, "orders")
            .groupBy(dates.month_key(day).alias("month"), dates.year_key(day).alias("year"),
                     dates.start_of_month(day, -1).alias("previous_month"),
                     dates.start_of_week(dates.days_before(day, 30)).alias("week"))
            .agg(F.count("*").alias("n")))


# Chunk logs: one token per word, noise between them, a stop in the middle.

def _words(spark, d) -> DataFrame:
    t = turns(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
                               F.split("text", " ").alias("words"))
    t = t.withColumn("stop", F.floor((F.size("words") + 1) / 2).cast("long"))
    return t.select("request_id", "stop", F.posexplode("words").alias("i", "word"))


def event_chunks(spark, d) -> DataFrame:
    quoted = jsontext.json_string("concat(word, ' ')")
    lines = F.array(
        F.when(F.col("i") == F.col("stop"), "data: [DONE]").otherwise(": keep-alive"),
        F.concat(F.lit('data: {"choices": [{"delta": {"content": '), quoted, F.lit("}}]}\n")),
        F.when(F.col("i") % 5 == 0, 'data: {"choices": ').otherwise(
            'data: {"choices": [{"delta": {"role": "assistant"}}]}'))
    w = _words(spark, d).where(F.col("request_id") % 3 > 0)
    return (w.select("request_id", "i", F.posexplode(lines).alias("j", "raw_line"))
            .select("request_id", (F.col("i") * 3 + F.col("j")).cast("long").alias("seq"),
                    "raw_line"))


def object_chunks(spark, d) -> DataFrame:
    quoted = jsontext.json_string("concat(word, ' ')")
    done = F.when(F.col("i") == F.col("stop"), "true").otherwise("false")
    lines = F.array(F.lit("not json"), F.concat(
        F.lit('{"message": {"content": '), quoted, F.lit('}, "done": '), done, F.lit("}")))
    w = _words(spark, d).where(F.col("request_id") % 3 < 2)
    return (w.select("request_id", "i", F.posexplode(lines).alias("j", "raw_line"))
            .select("request_id", (F.col("i") * 2 + F.col("j")).cast("long").alias("seq"),
                    "raw_line"))


def reassemble_events(spark, d):
    return tokens.reassemble_events(event_chunks(spark, d))


def reassemble_objects(spark, d):
    return tokens.reassemble_objects(object_chunks(spark, d))


def source_fallback(spark, d):
    return tokens.first_with_tokens(reassemble_events(spark, d), reassemble_objects(spark, d))


def _stub(prompts_: list[str]) -> list[str]:
    """Stands in for a model: fails on some prompts, else tells their length."""
    for p in prompts_:
        if len(p) % 5 == 0:
            raise RuntimeError("refused")
    return [f"{len(p)} characters" for p in prompts_]


def _echo(prompts_: list[str]) -> list[str]:
    return [f"{len(p)} characters" for p in prompts_]


NO_WAIT = {"attempts": 2, "backoff": 0, "pause": 0}


def complete_prompts(spark, d):
    return complete(turns(spark, d), "text", _stub, **NO_WAIT).select(
        "conv_id", "turn", "answer", "error")


# Collecting and annotating.

def _bank(spark, d):
    tenants = star.accounts(spark, d).select("user_id").distinct()
    return collect.tenant_questions(tenants, DOMAIN.questions).drop("binding")


def collect_resume(spark, d):
    done = _bank(spark, d).where((F.col("user_id") + F.col("q_no")) % 3 == 0)
    return pending(_bank(spark, d), done, ["user_id", "question"])


def _star_tables(spark, d) -> collect.Tables:
    return collect.Tables(star.transactions(spark, d), star.accounts(spark, d),
                          write_through(star.budgets(spark, d)), AS_OF)


def collect_answers(spark, d):
    answers = collect.collect_answers(_star_tables(spark, d), DOMAIN)
    return answers.select("user_id", "q_no", "question", "sql",
                          F.array_join("rows", "\n").alias("row_lines"),
                          F.size("rows").cast("long").alias("n_rows"), "context_section",
                          "outcome")


def _small_answers(spark, d) -> DataFrame:
    """Every tenant's top categories of last month as answers with context."""
    question = DOMAIN.questions[1]
    return collect.collect_answers(_star_tables(spark, d), Domain(questions=(question,)))


def baseline_answers(spark, d):
    answers = collect.baseline_answers(_small_answers(spark, d), DOMAIN, _stub, **NO_WAIT)
    return answers.select("user_id", "full_prompt", "answer", "error", "outcome")


def raw_examples(spark, d):
    raw = collect.raw_examples(_small_answers(spark, d))
    return raw.select("user_id", "question", F.array_join("rows", "\n").alias("row_lines"),
                      "context_section", "full_prompt", "llama_answer", "gold_answer")


def phase_counts(spark, d):
    """Collect, annotate and prepare over folders, the first two run twice each."""
    base = shared_dir(spark)
    raw, records_, data = f"{base}/raw", f"{base}/records", f"{base}/data"
    domain = Domain(questions=DOMAIN.questions[1:2])
    fields = runs.tenant_fields(["user_id"])
    counts = []
    for n in (1, 2):
        got = runs.run_collect(_star_tables(spark, d), domain, raw)
        counts.append(got.select(F.lit(f"collect {n}").alias("phase"), "result", "n"))
    for n in (1, 2):
        got = runs.run_annotate(spark, raw, records_, domain, _echo, fields, **NO_WAIT)
        counts.append(got.select(F.lit(f"annotate {n}").alias("phase"), "result", "n"))
    got = runs.run_prepare(spark, records_, data)
    counts.append(got.select(F.lit("prepare").alias("phase"), F.col("split").alias("result"), "n"))
    return reduce(DataFrame.unionByName, counts)


def answer_sizes(spark, d):
    raw = collect.raw_examples(_small_answers(spark, d))
    return sinks.answer_sizes(raw.withColumn("gold_answer", F.col("full_prompt")))


def budget_context(spark, d):
    tx = star.transactions(spark, d)
    cats = (spending.top_categories(tx, AS_OF, "this_month", 3).groupBy("user_id")
            .agg(F.collect_list("category").alias("categories")))
    return collect.budget_context(cats, star.budgets(spark, d), ["user_id"]).select(
        "user_id", "context_section")


def _turn_examples(spark, d) -> DataFrame:
    """Assistant turns as raw examples; their text is the baseline answer."""
    return (turns(spark, d).where(F.col("role") == "assistant").select(
        F.concat_ws("/", "conv_id", "turn").alias("question"),
        F.lit("SELECT 1").alias("sql"),
        F.array(F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit("}")))
        .alias("rows"),
        F.lit("").alias("context_section"), F.col("text").alias("full_prompt"),
        F.col("text").alias("llama_answer"), F.lit("").alias("gold_answer")))


def _annotated_before(spark, d) -> DataFrame:
    old = _turn_examples(spark, d).where(F.length("full_prompt") % 3 == 0)
    noted = old.withColumn("status", F.lit("ok")).withColumn("gold_answer", F.lit("old"))
    return annotating.training_records(noted, DOMAIN).select(chat.record_line().alias("value"))


def annotate_resume(spark, d):
    done = jsonl.annotated_questions(_annotated_before(spark, d))
    return pending(_turn_examples(spark, d), done).select("question")


def annotation_prompts(spark, d):
    return annotating.with_prompts(_turn_examples(spark, d), DOMAIN).select(
        "question", "annotation_prompt")


def _annotated(spark, d):
    done = jsonl.annotated_questions(_annotated_before(spark, d))
    return annotating.annotate(_turn_examples(spark, d), DOMAIN, _stub, done, **NO_WAIT)


def annotate_records(spark, d):
    rec = annotating.training_records(_annotated(spark, d), DOMAIN)
    return rec.select(F.col("metadata.question").alias("question"),
                      chat.chat_text(F.col("messages")).alias("text"))


def annotate_run_summary(spark, d):
    raw = _turn_examples(spark, d)
    done = jsonl.annotated_questions(_annotated_before(spark, d))
    skipped = raw.join(done, "question", "left_semi").select(F.lit("already_done").alias("status"))
    return annotate_summary(_annotated(spark, d).select("status").unionByName(skipped))


def annotate_stream(spark, d):
    """Annotation as a file stream; what failed in the first run is done in the second."""
    base = shared_dir(spark)
    raw, out, state = f"{base}/raw", f"{base}/out", f"{base}/state"
    sinks.append_raw_examples(_turn_examples(spark, d), raw)
    for fn in (_stub, _echo, _echo):
        annotate_increments(spark, raw, out, state, DOMAIN, fn, **NO_WAIT).awaitTermination()
    return jsonl.annotated_questions(spark.read.text(out))


# Query texts.

def _views(spark, d):
    return {"transactions": star.transactions(spark, d), "accounts": star.accounts(spark, d),
            "budgets": star.budgets(spark, d)}


def adhoc_query(spark, d):
    return run_query(spark, sql.ADHOC, _views(spark, d)).rows


def answer_texts(spark, d):
    tx = _views(spark, d)
    limits = (star.budgets(spark, d).groupBy("category")
              .agg(F.sum("monthly_limit").alias("monthly_limit")))
    answers = answer_questions(spark, sql.QUERY_TEXTS, tx, limits, DOMAIN)
    shown = F.when(F.col("error").startswith("SQL error: "), "SQL error").otherwise(F.col("error"))
    return answers.select("q_no", "question", F.array_join("rows", "\n").alias("row_lines"),
                          "context_section", shown.alias("error"), "outcome")


# Tables.

def schema_check(spark, d):
    return tables.check_tables(star.transactions(spark, d), star.accounts(spark, d),
                               star.budgets(spark, d))


def domain_check(spark, d):
    tx = star.transactions(spark, d)
    return tables.check_table(tx, "transactions", ["id"], ["user_id", "id"],
                              {"category": ("Income", "STANDARD", "SMALL"),
                               "account": ("BUILDING", "MACHINERY")})


def _balances(spark, d):
    orders = star.read(spark, d, "orders")
    base = star.read(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("value"))
    return base, orders.select(F.col("o_custkey").alias("c_custkey"),
                               F.col("o_totalprice").alias("value"),
                               F.col("o_orderkey").alias("seq"),
                               F.col("o_orderdate").cast("date").alias("day"))


def upsert_latest(spark, d):
    base, updates = _balances(spark, d)
    return tables.upsert(base, updates.drop("day"), ["c_custkey"], "seq")


def merge_latest(spark, d):
    """Updates merged in place twice: the orders before 1997, then those after."""
    base, updates = _balances(spark, d)
    path = shared_dir(spark)
    tables.write_keyed(base, path, ["c_custkey"])
    early = F.col("day") < F.lit("1997-01-01").cast("date")
    for some in (updates.where(early), updates.where(~early)):
        tables.merge_keyed(some.drop("day"), path, base.schema, ["c_custkey"], "seq")
    return tables.read_keyed(spark, path, base.schema)


def period_reloaded(spark, d):
    """Last month's sums from month folders, of which the others are not read."""
    path = shared_dir(spark)
    tables.write_transactions(star.transactions(spark, d), path)
    tx = tables.load_transactions(spark, path, "last_month", AS_OF)
    return tx.groupBy("user_id").agg(F.count("*").alias("n"),
                                     F.sum("amount").cast("double").alias("amount"))


def tables_reloaded(spark, d):
    """Finance tables written by month, loaded again and summed."""
    path = shared_dir(spark)
    tables.write_tables(star.transactions(spark, d), star.accounts(spark, d),
                        star.budgets(spark, d), path)
    tx, accounts, budgets = tables.load_tables(spark, path)
    sums = tx.groupBy("user_id").agg(F.count("*").alias("n"),
                                     F.sum("amount").cast("double").alias("amount"))
    held = accounts.groupBy("user_id").agg(F.sum("balance").cast("double").alias("balance"))
    limits = budgets.groupBy("user_id").agg(F.sum("monthly_limit").cast("double").alias("limits"))
    return reduce(lambda a, b: a.join(b, "user_id"), [sums, held, limits])


def result_caps(spark, d):
    """How many of a tenant's rows of this month each reader gets to see."""
    tx = narrow(star.transactions(spark, d), AS_OF, "this_month")
    order = [F.desc("tx_date"), F.desc("amount"), F.asc("id")]
    ranked = top_k(tx.select("user_id", "tx_date", "amount", "id"), ["user_id"], order,
                   ANSWER_CAPS[0])
    return ranked.groupBy("user_id").agg(*[
        F.sum(F.when(F.col("rank") <= cap, F.col("amount"))).cast("double").alias(f"sum_{cap}")
        for cap in ANSWER_CAPS])


def bank_bindings(spark, d):
    """How many tenants ask each question."""
    bank = question_frame(spark, DOMAIN.questions)
    return (_bank(spark, d).join(F.broadcast(bank), ["q_no", "question"])
            .groupBy("q_no", "question", "binding").agg(F.count("*").alias("tenants")))


QUERIES = {
    "ledger_questions": (ledger_questions, sql.LEDGER_QUESTIONS),
    "read_records": (read_records, sql.READ_RECORDS),
    "record_rejects": (record_rejects, sql.RECORD_REJECTS),
    "training_rows": (training_rows, sql.TRAINING_ROWS),
    "chat_records": (chat_records, sql.CHAT_RECORDS),
    "system_prepended": (system_prepended, sql.SYSTEM_PREPENDED),
    "train_split": (train_split, sql.TRAIN_SPLIT),
    "split_counts": (split_counts, sql.SPLIT_COUNTS),
    "split_copies": (split_copies, sql.SPLIT_COPIES),
    "shuffled_positions": (shuffled_positions, sql.SHUFFLED_POSITIONS),
    "shuffled_copies": (shuffled_copies, sql.SHUFFLED_COPIES),
    "split_files": (split_files, sql.SPLIT_FILES),
    "outcome_counts": (outcome_counts, sql.OUTCOME_COUNTS),
    "run_summary": (run_summary, sql.RUN_SUMMARY),
    "clean_sql_text": (clean_sql, sql.CLEAN_SQL),
    "sql_prompts": (sql_prompts, sql.SQL_PROMPTS),
    "whole_dollars": (whole_dollars, sql.WHOLE_DOLLARS),
    "json_lines": (json_lines, sql.JSON_LINES),
    "indented_rows": (indented_rows, sql.INDENTED_ROWS),
    "nested_rows": (nested_rows, sql.NESTED_ROWS),
    "typed_messages": (typed_messages, sql.TYPED_MESSAGES),
    "extract_completion": (extract_completion, sql.EXTRACT_COMPLETION),
    "date_keys": (date_keys, sql.DATE_KEYS),
    "reassemble_events": (reassemble_events, sql.REASSEMBLE_EVENTS),
    "reassemble_objects": (reassemble_objects, sql.REASSEMBLE_OBJECTS),
    "source_fallback": (source_fallback, sql.SOURCE_FALLBACK),
    "complete_prompts": (complete_prompts, sql.COMPLETE_PROMPTS),
    "bank_bindings": (bank_bindings, sql.BANK_BINDINGS),
    "collect_resume": (collect_resume, sql.COLLECT_RESUME),
    "collect_answers": (collect_answers, sql.COLLECT_ANSWERS),
    "baseline_answers": (baseline_answers, sql.BASELINE_ANSWERS),
    "raw_examples": (raw_examples, sql.RAW_EXAMPLES),
    "phase_counts": (phase_counts, sql.PHASE_COUNTS),
    "answer_sizes": (answer_sizes, sql.ANSWER_SIZES),
    "budget_context": (budget_context, sql.BUDGET_CONTEXT),
    "annotate_resume": (annotate_resume, sql.ANNOTATE_RESUME),
    "annotation_prompts": (annotation_prompts, sql.ANNOTATION_PROMPTS),
    "annotate_records": (annotate_records, sql.ANNOTATE_RECORDS),
    "annotate_summary": (annotate_run_summary, sql.ANNOTATE_SUMMARY),
    "annotate_stream": (annotate_stream, sql.ANNOTATE_STREAM),
    "adhoc_query": (adhoc_query, sql.ADHOC_CHECK),
    "answer_questions": (answer_texts, sql.ANSWER_TEXTS),
    "schema_check": (schema_check, sql.SCHEMA_CHECK),
    "domain_check": (domain_check, sql.DOMAIN_CHECK),
    "upsert_latest": (upsert_latest, sql.UPSERT_LATEST),
    "merge_latest": (merge_latest, sql.MERGE_LATEST),
    "period_reloaded": (period_reloaded, sql.PERIOD_RELOADED),
    "tables_reloaded": (tables_reloaded, sql.TABLES_RELOADED),
    "result_caps": (result_caps, sql.RESULT_CAPS),
}
