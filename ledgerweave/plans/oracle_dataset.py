"""SQL statements of the data-set queries, for a check in another engine."""

from __future__ import annotations

from ledgerweave.functions import prompts
from ledgerweave.plans import oracle_finance as fin
from ledgerweave.sources.questions import QUESTIONS, Call, rename

# Stand-ins of the star schema for names in the question bank.
STAR_NAMES = {
    "Groceries": "STANDARD", "Restaurants": "LARGE", "Entertainment": "SMALL",
    "Subscriptions": "ECONOMY", "Transport": "MEDIUM", "Shopping": "PROMO",
    "Credit Card": "BUILDING", "Checking": "MACHINERY", "Savings": "HOUSEHOLD",
    "%starbucks%": "%ring%", "%doordash%": "%BOLT%", "%amazon%": "%widget%",
}
BANK = rename(QUESTIONS, STAR_NAMES)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fill(template: str, **values: str) -> str:
    """The template as a concatenation of literals and SQL expressions."""
    from string import Formatter
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(lit(literal))
        if name is not None:
            parts.append(f"({values[name]})")
    return " || ".join(parts)


_WS = r"[\t-\r \x1c-\x1f\x{85}\x{a0}\p{Z}]"


def strip(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, '^(?-m){_WS}+', ''), "
            f"'{_WS}+(?-m)$', '')").replace("(?-m)", "")


def ascii_json(x: str) -> str:
    """JSON text with everything beyond printable ASCII escaped."""
    return f"""array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c:
      CASE WHEN unicode(c) < 127 THEN c
           WHEN unicode(c) < 65536 THEN format('\\u{{:04x}}', unicode(c))
           ELSE format('\\u{{:04x}}\\u{{:04x}}', 55296 + ((unicode(c) - 65536) >> 10),
                       56320 + ((unicode(c) - 65536) & 1023)) END), '')"""


def quoted(x: str) -> str:
    return ascii_json(f"CAST(to_json({x}) AS VARCHAR)")


_TURN = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
_CONV = f"""SELECT conv_id, COUNT(*) AS n_messages, string_agg({_TURN}, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id"""

_KIND = "(conv_id + turn) % 7"
LEDGER_QUESTIONS = f"""SELECT DISTINCT CASE WHEN {_KIND} = 0 THEN text ELSE '3' END AS question
  FROM conversations WHERE {_KIND} IN (0, 6)"""
READ_RECORDS = f"""SELECT CASE WHEN {_KIND} = 0 THEN text ELSE '3' END AS question,
  CASE WHEN {_KIND} = 0 THEN 's' END AS sql FROM conversations WHERE {_KIND} IN (0, 6)"""
RECORD_REJECTS = f"""SELECT CASE WHEN {_KIND} = 4 THEN 'no question' ELSE 'malformed' END AS reason,
  COUNT(*) AS n FROM conversations WHERE {_KIND} NOT IN (0, 6) GROUP BY 1"""
TRAINING_ROWS = f"""SELECT n_messages, 'content,role' AS keys, text FROM ({_CONV})
  WHERE n_messages >= 2"""
CHAT_RECORDS = _CONV
SYSTEM_PREPENDED = f"""SELECT conv_id, CASE WHEN conv_id % 2 = 1 THEN '<|im_start|>system' || chr(10)
  || {lit(prompts.SYSTEM_PROMPT)} || '<|im_end|>' || chr(10) ELSE '' END || text AS text
  FROM ({_CONV})"""

_LABEL = """CASE WHEN r <= nv THEN 'valid' WHEN r <= nv + GREATEST(1, LEAST(5, nv)) THEN 'test'
  ELSE 'train' END"""
_RANKED = """SELECT *, GREATEST(1, CAST(floor(n * 0.15::DOUBLE) AS BIGINT)) AS nv FROM (
  SELECT conv_id, COUNT(*) OVER () AS n,
    row_number() OVER (ORDER BY md5('42:' || conv_id), conv_id) AS r
  FROM (SELECT DISTINCT conv_id FROM conversations))"""
_RANKED_DOCS = """SELECT *, GREATEST(1, CAST(floor(n * 0.15::DOUBLE) AS BIGINT)) AS nv FROM (
  SELECT md5(text) AS text_md5, COUNT(*) OVER () AS n,
    row_number() OVER (ORDER BY md5('42:' || text), text) AS r FROM documents)"""
TRAIN_SPLIT = f"SELECT conv_id, {_LABEL} AS split FROM ({_RANKED})"
SPLIT_COUNTS = f"SELECT split, COUNT(*) AS n FROM ({TRAIN_SPLIT}) GROUP BY split"
SPLIT_COPIES = f"SELECT text_md5, {_LABEL} AS split FROM ({_RANKED_DOCS})"
SHUFFLED_POSITIONS = f"SELECT conv_id, r AS position FROM ({_RANKED})"
SHUFFLED_COPIES = f"SELECT text_md5, r AS position FROM ({_RANKED_DOCS})"
SPLIT_FILES = f"""SELECT s.split, c.text FROM ({TRAIN_SPLIT}) s JOIN ({_CONV}) c
  ON s.conv_id = c.conv_id"""

_OUTCOME = """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'error'
  WHEN contains(text, 'the') THEN 'ok' ELSE 'no_data' END AS outcome FROM documents"""
OUTCOME_COUNTS = f"SELECT outcome, COUNT(*) AS n FROM ({_OUTCOME}) GROUP BY outcome"
RUN_SUMMARY = f"""SELECT CASE WHEN doc_id % 3 = 0 THEN 'skipped' WHEN outcome = 'ok' THEN 'new'
  WHEN outcome = 'error' THEN 'errors' ELSE 'skipped' END AS result, COUNT(*) AS n
  FROM ({_OUTCOME}) GROUP BY 1"""

_WRAPPED = """' <think>' || text || '</think>' || chr(10) || '```sql' || chr(10) || 'SELECT '''
  || text || '''' || chr(10) || '``` `` '"""
_THOUGHT = strip(f"regexp_replace({_WRAPPED}, '(?s)<think>.*?</think>', '', 'g')")
_FENCED = strip(f"regexp_replace({_THOUGHT}, '```(?:sql)?{_WS}*', '', 'g')")
CLEAN_SQL = f"""SELECT doc_id, {strip(f"regexp_replace({_FENCED}, '`+$', '')")} AS cleaned,
  {strip('text')} AS stripped FROM documents"""

SQL_PROMPTS = f"""SELECT conv_id, turn, {fill(prompts.SQL_TEMPLATE, question='text',
                                              schema=lit(prompts.TABLE_TEXT))} AS prompt
  FROM conversations WHERE role = 'user'"""
WHOLE_DOLLARS = """SELECT CAST(CAST(round_even(l_quantity * 0.5::DOUBLE, 0) AS BIGINT) AS VARCHAR)
  AS dollars, COUNT(*) AS n FROM lineitem GROUP BY 1"""
JSON_LINES = f"""SELECT doc_id, '{{"doc_id": ' || doc_id || ', "text": ' || {quoted('text')}
  || ', "lang": ' || {quoted('lang')} || ', "source": ' ||
  CASE WHEN doc_id % 2 = 0 THEN {quoted('source')} ELSE 'null' END || '}}' AS line
  FROM documents"""
_TURN_LINES = """'        {' || chr(10) || '          "role": "' || role || '",' || chr(10) ||
  '          "at": {' || chr(10) || '            "turn": ' || i || ',' || chr(10) ||
  '            "first": ' || (i = 0) || chr(10) || '          },' || chr(10) || '          "sizes": ' ||
  CASE WHEN i = 0 THEN '[]' ELSE '[' || chr(10) || '            ' || length(text) || chr(10) ||
    '          ]' END || chr(10) || '        }'"""
NESTED_ROWS = f"""SELECT conv_id, '[' || chr(10) || '  {{' || chr(10) || '    "conv_id": ' || conv_id
  || ',' || chr(10) || '    "turns": [' || replace(chr(10) || string_agg({_TURN_LINES},
    ',' || chr(10) ORDER BY turn), chr(10) || '  ', chr(10)) || chr(10) || '    ]' || chr(10)
  || '  }},' || chr(10) || '  {{' || chr(10) || '    "end": [' || chr(10) || '      {{}},' || chr(10)
  || '      [' || chr(10) || '        null,' || chr(10) || '        1.5' || chr(10) || '      ]'
  || chr(10) || '    ]' || chr(10) || '  }}' || chr(10) || ']' AS results
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
  GROUP BY conv_id"""
_TYPED = f"""'{{"role": "' || role || '", "content": ' || {quoted('text')} || ', "turn": ' || turn
  || ', "user": ' || (role = 'user') || ', "tags": [' || turn || ', "x", {{"a": [null, 0.5]}}]}}'"""
TYPED_MESSAGES = f"""SELECT '{{"messages": [' || {_TYPED} || ', ' || {_TYPED} || ']}}' AS line
  FROM conversations"""
EXTRACT_COMPLETION = f"""SELECT conv_id, turn, {strip('text')} AS choices,
  {strip('text')} AS message, CASE WHEN turn = 0 THEN '' ELSE {strip('text')} END AS response,
  CASE WHEN turn > 0 THEN {strip('text')} END AS blocks FROM conversations"""
DATE_KEYS = """SELECT strftime(d, '%Y-%m') AS month, strftime(d, '%Y') AS year,
  CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS previous_month,
  CAST(date_trunc('week', d - 30) AS DATE) AS week, COUNT(*) AS n
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY 1, 2, 3, 4"""

_WORDS = """SELECT conv_id * 1000 + turn AS request_id, w, (len(w) + 1) // 2 AS stop
  FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)"""
_EVENTS = f"""SELECT request_id, array_to_string(w[1:stop], ' ') || ' ' AS text
  FROM ({_WORDS}) WHERE request_id % 3 > 0"""
_OBJECTS = f"""SELECT request_id, array_to_string(w[1:stop + 1], ' ') || ' ' AS text
  FROM ({_WORDS}) WHERE request_id % 3 < 2"""
REASSEMBLE_EVENTS, REASSEMBLE_OBJECTS = _EVENTS, _OBJECTS
SOURCE_FALLBACK = f"""SELECT * FROM ({_EVENTS}) UNION ALL
  SELECT * FROM ({_OBJECTS}) WHERE request_id % 3 = 0"""

COMPLETE_PROMPTS = """SELECT conv_id, turn,
  CASE WHEN length(text) % 5 <> 0 THEN length(text) || ' characters' END AS answer,
  CASE WHEN length(text) % 5 = 0 THEN 'RuntimeError: refused' END AS error FROM conversations"""

# Answers to the question bank.

_BANK_ROWS = ", ".join(f"({i}, {lit(q.text)}, {lit(q.binding)})" for i, q in enumerate(BANK, 1))
_BANK = f"""SELECT u.user_id, q.q_no, q.question, q.binding
  FROM (SELECT user_id FROM accounts UNION SELECT user_id FROM transactions) u
  CROSS JOIN (SELECT * FROM (VALUES {_BANK_ROWS}) AS v(q_no, question, binding)) q"""
_CTES = fin.BASE.replace(" AS (\n", " AS MATERIALIZED (\n")
BANK_BINDINGS = f"""{_CTES} SELECT q_no, question, binding, COUNT(*) AS tenants FROM ({_BANK})
  GROUP BY q_no, question, binding"""
COLLECT_RESUME = f"""{_CTES} SELECT user_id, q_no, question FROM ({_BANK})
  WHERE (user_id + q_no) % 3 <> 0"""

# Columns per operator with their kind (s string, n number, t date), and row order.
_SHAPES = {
    "spend_total": ("spent n", None),
    "top_categories": ("category s, total n", "rank"),
    "compare_periods": ("a n, b n, delta n, pct n", None),
    "top_transactions": ("id n, tx_date t, description s, amount n, category s, account s",
                         "rank"),
    "avg_monthly": ("avg_amount n", None),
    "daily_average": ("spent n, days n, per_day n", None),
    "transaction_count": ("n n", None),
    "half_split": ("first_half n, second_half n", None),
    "budget_status": ("category s, spent n, limit n, left n, pct_used n", None),
    "budget_ranking": ("category s, spent n, limit n, over_by n", "over_by DESC, category"),
    "budget_pace": ("spent n, limit n, expected_to_date n, pace n", None),
    "finance_summary": ("category s, spent n, limit n, share n", "category NULLS FIRST"),
    "savings_headroom": ("category s, monthly_avg n, limit n, excess n", "excess DESC, category"),
    "income_total": ("income n", None),
    "cash_flow": ("income n, spent n, net n, savings_rate n", None),
    "extreme_month": ("month s, amount n", None),
    "monthly_trend": ("month s, amount n, delta n", "month"),
    "category_growth": ("category s, first n, last n, growth n", "rank"),
    "spend_vs_baseline": ("category s, current n, baseline n, ratio n",
                          '"current" DESC, category'),
    "merchant_total": ("n n, spent n", None),
    "recurring_charges": ("description s, months n, avg_amount n",
                          "avg_amount DESC, description"),
    "account_balance": ("name s, balance n", None),
    "account_transfers": ("transferred n", None),
    "account_activity": ("id n, tx_date t, description s, amount n, category s, account s",
                         "tx_date DESC, amount DESC, description, category, id"),
}


# What a tenant without matching rows gets, by operator.
_OVER_NOTHING = {
    "spend_total": {"spent": None}, "income_total": {"income": None},
    "avg_monthly": {"avg_amount": None}, "account_transfers": {"transferred": None},
    "compare_periods": {"a": 0, "b": 0, "delta": 0, "pct": None},
    "daily_average": {"spent": None, "days": 15, "per_day": None}, "transaction_count": {"n": 0},
    "half_split": {"first_half": 0, "second_half": 0},
    "cash_flow": {"income": 0, "spent": 0, "net": 0, "savings_rate": None},
    "merchant_total": {"n": 0, "spent": None},
}
_TENANTS = "SELECT user_id FROM accounts UNION SELECT user_id FROM transactions"


def _call_sql(call: Call) -> str:
    statement = _found_sql(call)
    if call.operator in _OVER_NOTHING:
        return fin.every_tenant(statement, **_OVER_NOTHING[call.operator])
    return statement


def _found_sql(call: Call) -> str:
    p = dict(call.params)
    cases = {
        "spend_total": lambda: fin.spend_total(p["period"], p.get("category"), p.get("account")),
        "income_total": lambda: fin.income_total(p["period"]),
        "daily_average": lambda: fin.DAILY_AVERAGE,
        "half_split": lambda: fin.HALF_SPLIT,
        "budget_pace": lambda: fin.BUDGET_PACE,
        "budget_ranking": lambda: fin.budget_ranking(p["side"], p.get("k")),
        "spend_vs_baseline": lambda: fin.SPEND_VS_BASELINE,
        "savings_headroom": lambda: fin.savings_headroom(),
        "category_growth": lambda: fin.category_growth(p["k"]),
        "avg_monthly": lambda: fin.avg_monthly(p["n"], p["measure"]),
        "compare_periods": lambda: fin.compare_periods(
            p["a"], p["b"], p.get("measure", "spend"), p.get("account")),
        "monthly_trend": lambda: fin.monthly_trend_over(
            ["2001-02", "2001-03", "2001-04", "2001-05"][-p["n"]:], fin.METRICS[p["measure"]],
            {"spend": "amount > 0", "net": "TRUE"}[p["measure"]]
            + (f" AND category = '{p['category']}'" if p["category"] else ""), _TENANTS),
        "top_transactions": lambda: fin.top_transactions(p["period"], p["k"], p.get("by_abs")),
        "recurring_charges": lambda: fin.recurring_charges(p["min_months"], p["always"]),
        "extreme_month": lambda: fin.extreme_month(p["measure"], p["which"]),
    }
    if call.operator in cases:
        return cases[call.operator]()
    order = {"top_categories": ("period", "k"), "transaction_count": ("period",),
             "budget_status": ("category",), "cash_flow": ("period",),
             "finance_summary": ("period",), "merchant_total": ("period", "patterns"),
             "account_balance": ("account",), "account_transfers": ("account", "period"),
             "account_activity": ("account", "period")}[call.operator]
    return getattr(fin, call.operator)(*[p[k] for k in order])


def _row_json(shape: str) -> str:
    parts = []
    for item in shape.split(", "):
        name, kind = item.split()
        column = f'"{name}"'
        value = {"s": quoted(column), "n": f"CAST({column} AS VARCHAR)",
                 "t": f"'\"' || CAST({column} AS VARCHAR) || '\"'"}[kind]
        parts.append(f"'\"{name}\": ' || COALESCE({value}, 'null')")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


def _answers(bank) -> str:
    branches = []
    for binding, calls in {q.binding: q.calls for q in bank}.items():
        for part, call in enumerate(calls):
            shape, order = _SHAPES[call.operator]
            category = "category" if "category s" in shape else "CAST(NULL AS VARCHAR)"
            rank = (f"row_number() OVER (PARTITION BY user_id ORDER BY {order})" if order
                    else "1")
            branches.append(
                f"SELECT * FROM (SELECT user_id, {lit(binding)} AS binding, {part} AS part, "
                f"{rank} AS rk, "
                f"{_row_json(shape)} AS row_json, {category} AS category "
                f"FROM ({_call_sql(call)})) WHERE rk <= 200")
    return f"""answer_rows AS MATERIALIZED ({' UNION ALL '.join(branches)}),
    answers AS (SELECT user_id, binding, string_agg(row_json, chr(10) ORDER BY part, rk) AS row_lines,
        COUNT(*) AS n_rows FROM answer_rows GROUP BY user_id, binding),
    contexts AS (SELECT c.user_id, c.binding, 'Budget limits:' || chr(10) || string_agg('  ' ||
          c.category || ': $' || CAST(round_even(CAST(b.monthly_limit AS DOUBLE), 0) AS BIGINT)
          || '/month', chr(10) ORDER BY c.category) || chr(10) || chr(10) AS context
        FROM (SELECT DISTINCT user_id, binding, category FROM answer_rows
              WHERE category <> '') c
        JOIN budgets b ON b.user_id = c.user_id AND b.category = c.category
        GROUP BY c.user_id, c.binding)"""


COLLECT_ANSWERS = f"""{_CTES}, {_answers(BANK)}
  SELECT q.user_id, q.q_no, q.question, q.binding AS sql, COALESCE(row_lines, '') AS row_lines,
    COALESCE(n_rows, 0) AS n_rows, COALESCE(context, '') AS context_section,
    CASE WHEN n_rows IS NULL THEN 'no_data' ELSE 'ok' END AS outcome
  FROM ({_BANK}) q LEFT JOIN answers a ON a.user_id = q.user_id AND a.binding = q.binding
  LEFT JOIN contexts c ON c.user_id = q.user_id AND c.binding = q.binding"""

_TOP = BANK[1]
_INDENTED = """'[' || chr(10) || string_agg('  {' || chr(10) || '    "category": "' || category
  || '",' || chr(10) || '    "total": ' || CAST(total AS VARCHAR) || chr(10) || '  }',
  ',' || chr(10) ORDER BY rank) || chr(10) || ']'"""
_SMALL = f"""{_CTES}, {_answers([_TOP])},
  small AS (SELECT t.user_id, t.results, a.row_lines, a.n_rows,
      COALESCE(c.context, '') AS context_section FROM (
      SELECT user_id, {_INDENTED} AS results FROM ({fin.top_categories('last_month', 5)})
      GROUP BY user_id) t
    JOIN answers a USING (user_id) LEFT JOIN contexts c USING (user_id)),
  prompts AS (SELECT *, {fill(prompts.ANSWER_TEMPLATE, question=lit(_TOP.text),
                              sql=lit(_TOP.binding), results='results',
                              budget_section='context_section')} AS full_prompt FROM small),
  chats AS (SELECT *, length('[{{"role": "system", "content": ' || {quoted(lit(prompts.SYSTEM_PROMPT))}
    || '}}, {{"role": "user", "content": ' || {quoted('full_prompt')} || '}}]') AS size FROM prompts)
"""
BASELINE_ANSWERS = f"""{_SMALL} SELECT user_id, full_prompt,
  CASE WHEN size % 5 <> 0 THEN size || ' characters' ELSE '' END AS answer,
  CASE WHEN size % 5 = 0 THEN 'RuntimeError: refused' ELSE '' END AS error,
  CASE WHEN size % 5 = 0 THEN 'error' ELSE 'ok' END AS outcome FROM chats
  UNION ALL SELECT DISTINCT user_id, '', '', '', 'no_data' FROM accounts
  WHERE user_id NOT IN (SELECT user_id FROM chats)"""
RAW_EXAMPLES = f"""{_SMALL} SELECT user_id, {lit(_TOP.text)} AS question, row_lines,
  context_section, full_prompt, '' AS llama_answer, '' AS gold_answer FROM prompts"""
ANSWER_SIZES = f"""{_SMALL} SELECT user_id, {lit(_TOP.text)} AS question,
  CAST(n_rows AS INTEGER) AS n_rows, CAST(length(full_prompt) AS INTEGER) AS answer_chars
  FROM prompts"""

# Tenants with spending last month are collected; the others are skipped each time.
PHASE_COUNTS = f"""{_CTES}, t AS (SELECT COUNT(DISTINCT user_id) AS all_tenants,
    COUNT(DISTINCT user_id) FILTER (user_id IN (SELECT user_id FROM transactions
      WHERE amount > 0 AND {fin.PERIODS['last_month']})) AS n FROM accounts),
  s AS (SELECT *, GREATEST(1, CAST(floor(n * 0.15::DOUBLE) AS BIGINT)) AS nv FROM t)
  SELECT * FROM (
    SELECT 'collect 1' AS phase, 'new' AS result, n FROM t
    UNION ALL SELECT 'collect 1', 'skipped', all_tenants - n FROM t
    UNION ALL SELECT 'collect 2', 'skipped', all_tenants FROM t
    UNION ALL SELECT 'annotate 1', 'annotated', n FROM t
    UNION ALL SELECT 'annotate 2', 'skipped', n FROM t
    UNION ALL SELECT 'prepare', 'valid', nv FROM s
    UNION ALL SELECT 'prepare', 'test', GREATEST(1, LEAST(5, nv)) FROM s
    UNION ALL SELECT 'prepare', 'train', n - nv - GREATEST(1, LEAST(5, nv)) FROM s)
  WHERE n > 0"""

INDENTED_ROWS = f"""{_CTES} SELECT user_id, '[' || chr(10) || string_agg('  {{' || chr(10)
  || '    "description": "' || description || '",' || chr(10)
  || '    "amount": ' || CAST(amount AS VARCHAR) || ',' || chr(10)
  || '    "tx_date": "' || tx_date || '",' || chr(10) || '    "note": null' || chr(10)
  || '  }}', ',' || chr(10) ORDER BY rank) || chr(10) || ']' AS results
  FROM ({fin.top_transactions('last_month', 3)}) GROUP BY user_id"""

BUDGET_CONTEXT = f"""{_CTES} SELECT t.user_id, COALESCE('Budget limits:' || chr(10) || string_agg(
    CASE WHEN b.category IS NOT NULL THEN '  ' || b.category || ': $' ||
      CAST(round_even(CAST(b.monthly_limit AS DOUBLE), 0) AS BIGINT) || '/month' END,
    chr(10) ORDER BY b.category) || chr(10) || chr(10), '') AS context_section
  FROM ({fin.top_categories('this_month', 3)}) t
  LEFT JOIN budgets b ON b.user_id = t.user_id AND b.category = t.category
  GROUP BY t.user_id"""

_EXAMPLES = f"""SELECT *, {fill(prompts.ANNOTATION_TEMPLATE, question='question',
    sql="'SELECT 1'", context_section="''", llama_answer='text',
    results="'[' || chr(10) || '  {' || chr(10) || '    \"turn\": ' || turn || chr(10) "
            "|| '  }' || chr(10) || ']'")} AS annotation_prompt
  FROM (SELECT conv_id || '/' || turn AS question, turn, text FROM conversations
        WHERE role = 'assistant')"""
_DONE = "length(text) % 3 = 0"
ANNOTATE_RESUME = f"SELECT question FROM ({_EXAMPLES}) WHERE NOT ({_DONE})"
ANNOTATION_PROMPTS = f"SELECT question, annotation_prompt FROM ({_EXAMPLES})"
ANNOTATE_RECORDS = f"""SELECT question, '<|im_start|>system' || chr(10) ||
  {lit(prompts.SYSTEM_PROMPT)} || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || text
  || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) ||
  length(annotation_prompt) || ' characters<|im_end|>' || chr(10) AS text
  FROM ({_EXAMPLES}) WHERE NOT ({_DONE}) AND length(annotation_prompt) % 5 <> 0"""
ANNOTATE_SUMMARY = f"""SELECT CASE WHEN {_DONE} THEN 'skipped'
  WHEN length(annotation_prompt) % 5 = 0 THEN 'errors' ELSE 'annotated' END AS result,
  COUNT(*) AS n FROM ({_EXAMPLES}) GROUP BY 1"""
ANNOTATE_STREAM = f"SELECT question FROM ({_EXAMPLES})"

ADHOC = """SELECT account, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS total
  FROM transactions WHERE amount > 0 GROUP BY account ORDER BY total DESC;"""
ADHOC_CHECK = fin.BASE + ADHOC.rstrip(";")

_BY_CATEGORY = """SELECT category, CAST(SUM(amount) AS DOUBLE) AS total
  FROM transactions WHERE amount > 0 GROUP BY category ORDER BY category"""
QUERY_TEXTS = [
    ("By category?", f"<think>sums</think>```sql\n{_BY_CATEGORY}\n```"),
    ("Unknown column?", "SELECT nope FROM transactions"),
    ("Nothing?", "<think>no idea</think>  "),
    ("No rows?", "SELECT * FROM transactions WHERE amount = 0"),
    ("Changes?", "DROP TABLE transactions"),
    ("Other code?", "SELECT java_method('java.lang.System', 'nanoTime')"),
    ("Fails late?", "SELECT CAST(description AS INT) AS x FROM transactions"),
    ("A file?", "SELECT * FROM parquet.`/tmp/x`"),
    ("Sum of nothing?", "SELECT SUM(amount) AS total FROM transactions WHERE amount = 0"),
]
_TEXT_OUTCOMES = [("SQL error", "error"), ("LLM returned no SQL", "error"), ("", "no_data"),
                  *[("SQL error", "error")] * 4]
ANSWER_TEXTS = f"""{fin.BASE} SELECT 1 AS q_no, 'By category?' AS question,
    string_agg('{{"category": "' || category || '", "total": ' || CAST(total AS VARCHAR) || '}}',
      chr(10) ORDER BY category) AS row_lines,
    'Budget limits:' || chr(10) || (SELECT string_agg('  ' || category || ': $' ||
        CAST(round_even(CAST(l AS DOUBLE), 0) AS BIGINT) || '/month', chr(10) ORDER BY category)
      FROM (SELECT category, SUM(monthly_limit) AS l FROM budgets GROUP BY category))
      || chr(10) || chr(10) AS context_section, '' AS error, 'ok' AS outcome
  FROM ({_BY_CATEGORY})
  UNION ALL SELECT 9, 'Sum of nothing?', '{{"total": null}}', '', '', 'ok'
  """ + "".join(f" UNION ALL SELECT {i}, {lit(QUERY_TEXTS[i - 1][0])}, '', '', {lit(e)}, {lit(o)}"
                for i, (e, o) in enumerate(_TEXT_OUTCOMES, 2))


def _nulls(table, columns):
    return [f"SELECT '{table}' AS \"table\", '{c} not null' AS rule, "
            f"COUNT(*) FILTER ({c} IS NULL) AS violations FROM {table}" for c in columns]


def _surplus(table, key):
    return [f"""SELECT '{table}', '{key} unique', CAST((SELECT COUNT(*) FROM {table}) -
      (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {table})) AS BIGINT)"""]


SCHEMA_CHECK = _CTES + " UNION ALL ".join([
    *_nulls("transactions", ["id", "tx_date", "description", "amount", "category", "account"]),
    *_surplus("transactions", "id"),
    *_nulls("accounts", ["name", "type", "balance"]), *_surplus("accounts", "user_id, name"),
    *_nulls("budgets", ["category", "monthly_limit"]), *_surplus("budgets", "user_id, category")])
DOMAIN_CHECK = _CTES + " UNION ALL ".join([
    *_nulls("transactions", ["id"]),
    "SELECT 'transactions', 'category in domain', COUNT(*) FROM transactions "
    "WHERE category NOT IN ('Income', 'STANDARD', 'SMALL')",
    "SELECT 'transactions', 'account in domain', COUNT(*) FROM transactions "
    "WHERE account NOT IN ('BUILDING', 'MACHINERY')",
    *_surplus("transactions", "user_id, id")])
UPSERT_LATEST = """SELECT COALESCE(c.c_custkey, o.k) AS c_custkey, COALESCE(o.v, c_acctbal) AS value
  FROM customer c FULL JOIN (SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v
    FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.k"""
_LAST_PRICE = """SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v FROM orders
    WHERE CAST(o_orderdate AS DATE) {} DATE '1997-01-01' GROUP BY o_custkey"""
MERGE_LATEST = f"""SELECT COALESCE(c.c_custkey, a.k, b.k) AS c_custkey,
  COALESCE(b.v, a.v, c_acctbal) AS value FROM customer c
  FULL JOIN ({_LAST_PRICE.format('<')}) a ON c.c_custkey = a.k
  FULL JOIN ({_LAST_PRICE.format('>=')}) b ON COALESCE(c.c_custkey, a.k) = b.k"""
PERIOD_RELOADED = f"""{_CTES} SELECT user_id, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount
  FROM transactions WHERE {fin.PERIODS['last_month']} GROUP BY user_id"""
TABLES_RELOADED = f"""{_CTES} SELECT t.user_id, n, amount, balance, limits
  FROM (SELECT user_id, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM transactions
        GROUP BY user_id) t
  JOIN (SELECT user_id, CAST(SUM(balance) AS DOUBLE) AS balance FROM accounts
        GROUP BY user_id) a USING (user_id)
  JOIN (SELECT user_id, CAST(SUM(monthly_limit) AS DOUBLE) AS limits FROM budgets
        GROUP BY user_id) b USING (user_id)"""
RESULT_CAPS = f"""{_CTES} SELECT user_id,
  CAST(SUM(amount) FILTER (rk <= 200) AS DOUBLE) AS sum_200,
  CAST(SUM(amount) FILTER (rk <= 15) AS DOUBLE) AS sum_15,
  CAST(SUM(amount) FILTER (rk <= 10) AS DOUBLE) AS sum_10
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY tx_date DESC, amount DESC, id) AS rk
        FROM transactions WHERE {fin.PERIODS['this_month']})
  WHERE rk <= 200 GROUP BY user_id"""
