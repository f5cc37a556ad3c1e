"""The queries again, as SQL that another engine can run on the same tables.

The SQL states each result directly (for instance it renders every request
and measures it) rather than the way the Spark side gets there.
"""

from __future__ import annotations

from ..fixed_values import (
    INSTRUCTION_TEMPLATE, MODEL_PRICES, MSG_EMPTY_CONTENT, MSG_FEW_EXAMPLES, MSG_LEVELS,
    MSG_NO_EXAMPLES, MSG_SHORT, MSG_VALID, REQUEST_MAX_TOKENS, TOKEN_PATTERN,
)
from . import derived as d
from .queries import COST_MODELS, MAX_BYTES, MAX_LINES, PREFIXES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    def cell(value):
        return _text(value) if isinstance(value, str) else repr(value)

    return ", ".join("(" + ", ".join(cell(value) for value in row) + ")" for row in rows)


_RUBRICS = (
    "rubrics(acronym, ord, full_name, content) AS (VALUES "
    + _values([(a, n, name, d.rubric_text(name)) for a, n, name in d.DEMANDS]) + ")"
)

_PRICES = (
    "prices(ord, model_key, input, output) AS (SELECT col0, col1, CAST(col2 AS DOUBLE), CAST(col3 AS DOUBLE) "
    "FROM (VALUES " + _values([(i, *price) for i, price in enumerate(MODEL_PRICES)]) + ") AS p(col0, col1, col2, col3))"
)

_OUTPUTS = """outputs AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS custom_id, d.doc_id, r.acronym AS demand,
    r.acronym || CASE WHEN d.doc_id % 2 = 0 THEN '_part1' ELSE '_part2' END AS part,
    CASE WHEN d.doc_id % 2 = 0 THEN 'gpt-4o-mini-2024-07-18' ELSE 'o4-mini-2025-04-16' END AS model,
    CASE (d.doc_id + r.ord) % 10 WHEN 8 THEN 'length' WHEN 9 THEN 'content_filter' ELSE 'stop' END AS finish_reason,
    d.text || chr(10) || chr(10) || 'Thus, the level of *' || r.full_name
      || '* demanded by the given TASK INSTANCE is: '
      || CASE WHEN (d.doc_id * 7 + r.ord * 3) % 9 = 8 THEN 'Not Applicable'
              ELSE CAST((d.doc_id * 7 + r.ord * 3) % 9 AS VARCHAR) END AS content,
    CAST(floor(d.n_chars / 4) AS BIGINT) AS prompt_tokens,
    CAST(20 + (d.doc_id * 13 + r.ord * 5) % 200 AS BIGINT) AS completion_tokens
  FROM documents d CROSS JOIN rubrics r)"""

_LEVELS = """levels AS (
  SELECT *, CASE WHEN number BETWEEN 0 AND 5 THEN number END AS extracted,
    CASE WHEN finish_reason = 'stop' AND number BETWEEN 0 AND 5 THEN number END AS level
  FROM (SELECT *, TRY_CAST(list_extract(regexp_extract_all(
      list_extract(string_split(content, chr(10) || chr(10)), -1), '[0-9]+'), -1) AS DOUBLE) AS number
    FROM outputs))"""

_RENDERED = """rendered AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS custom_id, d.doc_id, r.acronym AS demand,
    replace(replace(replace(""" + _text(INSTRUCTION_TEMPLATE) + """,
      '{name}', r.full_name), '{rubric}', r.content), '{prompt}', d.text) AS instruction
  FROM documents d CROSS JOIN rubrics r)"""

_LINES = f"""lines AS (
  SELECT *, strlen(CAST(to_json({{custom_id: custom_id, method: 'POST', url: '/chat/completions',
    body: {{model: 'gpt-4o', messages: [{{role: 'system', content: ''}}, {{role: 'user', content: instruction}}],
      max_tokens: {REQUEST_MAX_TOKENS}, temperature: 0}}}}) AS VARCHAR)) + 1 AS line_bytes
  FROM rendered)"""

_SIZES = """sizes AS (
  SELECT demand, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(line_bytes) AS BIGINT) AS n_bytes
  FROM lines GROUP BY demand)"""

_PLAN = f"""plan AS (
  SELECT *, CASE WHEN n_lines // by_bytes >= {MAX_LINES} THEN by_lines ELSE by_bytes END AS num_parts
  FROM (SELECT *, n_lines > {MAX_LINES} OR n_bytes > {MAX_BYTES} AS need_split,
      (n_bytes + {MAX_BYTES} - 1) // {MAX_BYTES} AS by_bytes, (n_lines + {MAX_LINES} - 1) // {MAX_LINES} AS by_lines
    FROM sizes))"""

# Parts start at the rows that dealing in order reaches first.
_DEALT = """starts AS (
  SELECT p.demand, p.need_split, CAST(s.k AS BIGINT) AS part_no,
    s.k * (p.n_lines // parts) + least(s.k, p.n_lines % parts) - (p.n_lines // parts)
      - CASE WHEN s.k <= p.n_lines % parts THEN 1 ELSE 0 END AS first_row,
    (p.n_lines // parts) + CASE WHEN s.k <= p.n_lines % parts THEN 1 ELSE 0 END AS part_rows
  FROM (SELECT *, CASE WHEN need_split THEN num_parts ELSE 1 END AS parts FROM plan) p,
    LATERAL (SELECT unnest(generate_series(1, p.parts)) AS k) s),
indexed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
dealt AS (
  SELECT i.doc_id, s.demand,
    CASE WHEN s.need_split THEN s.demand || '_part' || CAST(s.part_no AS VARCHAR) ELSE s.demand END AS part,
    s.part_no, CAST(i.i - s.first_row AS BIGINT) AS part_row, CAST(s.part_rows AS BIGINT) AS part_rows
  FROM starts s JOIN indexed i ON i.i >= s.first_row AND i.i < s.first_row + s.part_rows)"""

_USAGE = """usage AS (
  SELECT part, arg_max(model, doc_id) AS model, CAST(count(*) AS BIGINT) AS n,
    CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
    CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
    avg(completion_tokens) AS avg_completion,
    sqrt(CAST(count(*) * sum(completion_tokens * completion_tokens) - sum(completion_tokens) * sum(completion_tokens) AS DOUBLE)
      / CAST(count(*) * (count(*) - 1) AS DOUBLE)) AS std_completion,
    max(completion_tokens) AS max_completion, min(completion_tokens) AS min_completion,
    CAST(count(*) FILTER (finish_reason = 'stop') AS BIGINT) AS stop,
    CAST(count(*) FILTER (finish_reason = 'length') AS BIGINT) AS length,
    CAST(count(*) FILTER (finish_reason NOT IN ('stop', 'length')) AS BIGINT) AS other
  FROM outputs GROUP BY part)"""

_COST = """cost AS (
  SELECT u.*, u.prompt_tokens / CAST(1000000 AS DOUBLE) * p.input AS cost_prompt,
    u.completion_tokens / CAST(1000000 AS DOUBLE) * p.output AS cost_completion
  FROM usage u, LATERAL (
    SELECT coalesce(arg_min(input, ord), 0) AS input, coalesce(arg_min(output, ord), 0) AS output
    FROM prices WHERE contains(u.model, model_key)) p)"""

_METADATA = """metadata AS (
  SELECT demand, part, 'batch_' || part AS id,
    CASE demand WHEN 'CD' THEN 'failed' WHEN 'CE' THEN 'in_progress' ELSE 'completed' END AS status,
    1700000000 + min(doc_id) AS created_at,
    CASE WHEN demand <> 'CE'
      THEN CAST(1700000000 + min(doc_id) + sum(completion_tokens) % 9973 AS BIGINT) END AS completed_at,
    'out_' || part AS output_file_id,
    CASE WHEN demand = 'CD' THEN 'err_' || part END AS error_file_id,
    CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (finish_reason <> 'content_filter') AS BIGINT) AS completed,
    CAST(count(*) FILTER (finish_reason = 'content_filter') AS BIGINT) AS failed,
    CASE WHEN demand = 'CD' THEN 'refused requests' END AS errors
  FROM outputs GROUP BY demand, part)"""

_ISO = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%dT%H:%M:%S')"

_SUMMARIES = f"""summaries AS (
  SELECT m.id AS batch_id, c.model, m.status,
    {_ISO.format('m.created_at')} AS created_at, {_ISO.format('m.completed_at')} AS completed_at,
    m.completed_at - m.created_at AS duration, m.part AS subdomain,
    m.total AS requests_total, m.completed AS requests_completed, m.failed AS requests_failed,
    coalesce(c.stop, 0) AS finish_stop, coalesce(c.length, 0) AS finish_length,
    coalesce(c.other, 0) AS finish_other, coalesce(c.n, 0) AS finish_total,
    coalesce(c.prompt_tokens, 0) AS tokens_prompt, coalesce(c.completion_tokens, 0) AS tokens_completion,
    c.avg_completion AS tokens_avg_completion, c.std_completion AS tokens_std_completion,
    coalesce(c.max_completion, 0) AS tokens_max_completion, coalesce(c.min_completion, 0) AS tokens_min_completion,
    coalesce(c.prompt_tokens, 0) + coalesce(c.completion_tokens, 0) AS tokens_total,
    coalesce(c.cost_prompt, 0) AS cost_prompt, coalesce(c.cost_completion, 0) AS cost_completion,
    coalesce(c.cost_prompt + c.cost_completion, 0) AS cost_total,
    CASE WHEN m.errors IS NOT NULL THEN m.error_file_id END AS error_file_id, m.errors
  FROM metadata m LEFT JOIN cost c ON c.part = m.part)"""

_POOLED = """pooled AS (
  SELECT CAST(sum(tokens_completion) AS BIGINT) AS tokens_completion,
    CASE WHEN sum(tokens_completion) > 0 THEN any_value(mean) ELSE 0 END AS tokens_avg_completion,
    CASE WHEN sum(tokens_completion) > 0 THEN sqrt(
      (sum((requests_total - 1) * tokens_std_completion ** 2)
        + sum(requests_total * (tokens_avg_completion - mean) ** 2)) / (sum(requests_total) - 1))
      ELSE 0 END AS tokens_std_completion,
    max(tokens_max_completion) AS tokens_max_completion, min(tokens_min_completion) AS tokens_min_completion
  FROM summaries, (SELECT sum(requests_total * tokens_avg_completion) / sum(requests_total) AS mean FROM summaries))"""

_STATUS = "CASE event_type " + " ".join(
    f"WHEN '{kind}' THEN '{status}'" for kind, status in d.STATUS_OF_EVENT
) + " END"

_JOBS = f"""jobs AS (
  SELECT 'batch_' || CAST(user_id AS VARCHAR) AS id, arg_max({_STATUS}, (ts, event_id)) AS status,
    CAST(floor(epoch(min(ts))) AS BIGINT) AS created_at,
    CASE WHEN arg_max(event_type, (ts, event_id)) IN ('purchase', 'error')
      THEN CAST(floor(epoch(max(ts))) AS BIGINT) END AS completed_at,
    CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (event_type IN ('purchase', 'view')) AS BIGINT) AS completed
  FROM events GROUP BY user_id)"""

_NAMES = "[" + ", ".join(f"'{a}'" for a in d.ACRONYMS) + "]"

_LEDGER = f"""ledger AS (
  SELECT {_NAMES}[user_id % {len(d.ACRONYMS)} + 1] AS demand,
    {_NAMES}[user_id % {len(d.ACRONYMS)} + 1] || '_part' || CAST(user_id AS VARCHAR) AS part,
    'batch_' || CAST(user_id AS VARCHAR) AS batch_id
  FROM events GROUP BY user_id HAVING arg_min(event_type, (ts, event_id)) <> 'error')"""


def _with(*tables: str, select: str) -> str:
    return f"WITH {', '.join(tables)} {select}"


def _over_outputs(select: str, *more: str) -> str:
    return _with(_RUBRICS, _OUTPUTS, *more, select=select)


def _digest(text: str, name: str) -> str:
    return f"md5({text}) AS {name}_md5, CAST(strlen({text}) AS INTEGER) AS {name}_bytes"


def _tokens(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '{TOKEN_PATTERN}')) AS BIGINT)"


_PROMPTS = "SELECT CAST(doc_id AS VARCHAR) AS custom_id, text AS prompt FROM documents"
_LONG = f"SELECT custom_id, demand, level, finish_reason, {_digest('content', 'response')} FROM levels"
_FROM_LONG = _over_outputs(_LONG, _LEVELS)
_FROM_SIZES = (_RUBRICS, _RENDERED, _LINES, _SIZES)
_FROM_DEALT = (*_FROM_SIZES, _PLAN, _DEALT)
_FROM_SUMMARIES = (_PRICES, _USAGE, _COST, _METADATA, _SUMMARIES)


def _summary(group: str) -> str:
    column = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    percent = "CAST(100 AS DOUBLE) * {0} / count(*)"
    return _over_outputs(
        f"SELECT {column}CAST(count(*) AS BIGINT) AS total, CAST(count(level) AS BIGINT) AS successful, "
        f"{percent.format('count(level)')} AS successful_percent, "
        f"CAST(count(*) - count(level) AS BIGINT) AS failed, "
        f"{percent.format('(count(*) - count(level))')} AS failed_percent FROM levels{tail}",
        _LEVELS,
    )


_GENERAL_SELECT = """SELECT CAST(count(*) AS BIGINT) AS batches, CAST(count(DISTINCT subdomain) AS BIGINT) AS n_subdomains,
      string_agg(DISTINCT split_part(subdomain, '_', 1), ',' ORDER BY split_part(subdomain, '_', 1)) AS demands,
      string_agg(DISTINCT model, ',' ORDER BY model) AS models,
      avg(duration) AS duration_mean, round(coalesce(stddev_samp(duration), 0), 6) AS duration_std,
      CAST(count(*) FILTER (status = 'completed') AS BIGINT) AS status_completed,
      CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS status_failed,
      CAST(count(*) FILTER (status NOT IN ('completed', 'failed')) AS BIGINT) AS status_others,
      CAST(sum(requests_total) AS BIGINT) AS requests_total,
      CAST(sum(requests_completed) AS BIGINT) AS requests_completed,
      CAST(sum(requests_failed) AS BIGINT) AS requests_failed,
      CAST(sum(finish_stop) AS BIGINT) AS finish_stop, CAST(sum(finish_length) AS BIGINT) AS finish_length,
      CAST(sum(finish_other) AS BIGINT) AS finish_other,
      CAST(sum(finish_stop + finish_length + finish_other) AS BIGINT) AS finish_total,
      CAST(sum(tokens_prompt) AS BIGINT) AS tokens_prompt, CAST(sum(tokens_total) AS BIGINT) AS tokens_total,
      round(sum(cost_prompt), 6) AS cost_prompt, round(sum(cost_completion), 6) AS cost_completion,
      round(sum(cost_total), 6) AS cost_total,
      (SELECT tokens_completion FROM pooled) AS tokens_completion,
      (SELECT round(tokens_avg_completion, 6) FROM pooled) AS tokens_avg_completion,
      (SELECT round(tokens_std_completion, 6) FROM pooled) AS tokens_std_completion,
      (SELECT tokens_max_completion FROM pooled) AS tokens_max_completion,
      (SELECT tokens_min_completion FROM pooled) AS tokens_min_completion
    FROM summaries"""
_GENERAL = _over_outputs(_GENERAL_SELECT, *_FROM_SUMMARIES, _POOLED)


def _over_runs(select: str, *more: str) -> str:
    """As ``_over_outputs`` for answers in two runs whose parts have the same names."""
    run = "CASE WHEN d.doc_id % 3 = 0 THEN 'run2' ELSE 'run1' END AS run"
    return _with(
        _RUBRICS, _OUTPUTS.replace("d.doc_id, r.acronym", f"d.doc_id, {run}, r.acronym"), _PRICES,
        _USAGE.replace("SELECT part,", "SELECT run, part,").replace("GROUP BY part", "GROUP BY run, part"), _COST,
        _METADATA.replace("SELECT demand, part, 'batch_' || part", "SELECT run, demand, part, 'batch_' || run || part")
        .replace("GROUP BY demand", "GROUP BY run, demand"),
        _SUMMARIES.replace("SELECT m.id", "SELECT m.run, m.id").replace("c.part = m.part", "c.part = m.part AND c.run = m.run"),
        *more, select=select)


_GENERAL_RUNS = _over_runs(_GENERAL_SELECT.replace("DISTINCT subdomain", "DISTINCT (run, subdomain)"), _POOLED)



def _prefix_test(name: str) -> str:
    return f"starts_with(part, '{name}')"


def _price(match: str, order: str) -> str:
    return f"""SELECT doc_id, model, (SELECT arg_min(model_key, {order}) FROM prices WHERE contains(model, model_key)) AS model_key,
      coalesce((SELECT arg_min(input, {order}) FROM prices WHERE contains(model, model_key)), 0) AS input,
      coalesce((SELECT arg_min(output, {order}) FROM prices WHERE contains(model, model_key)), 0) AS output,
      EXISTS (SELECT 1 FROM prices WHERE contains(model, model_key)) AS found, '{match}' AS match
    FROM named"""


def _estimate(tokens_of_pair: str, *more: str) -> str:
    models = ", ".join(f"('{model}')" for model in COST_MODELS)
    return _with(
        _RUBRICS, _PRICES, *more, f"models(model) AS (VALUES {models})",
        f"""totals AS (SELECT CAST(sum({tokens_of_pair}) AS BIGINT) AS input_tokens,
            CAST(count(*) * {REQUEST_MAX_TOKENS} AS BIGINT) AS output_tokens FROM pairs)""",
        """rates AS (SELECT m.model, arg_min(input, ord) AS input, arg_min(output, ord) AS output
            FROM models m JOIN prices ON contains(m.model, model_key) GROUP BY m.model)""",
        select="""SELECT model, input_tokens, output_tokens,
            input_tokens / CAST(1000000 AS DOUBLE) * input AS input_cost,
            output_tokens / CAST(1000000 AS DOUBLE) * output AS output_cost,
            input_tokens / CAST(1000000 AS DOUBLE) * input + output_tokens / CAST(1000000 AS DOUBLE) * output AS cost
          FROM totals CROSS JOIN rates""",
    )


_EMPTY_TEXT = INSTRUCTION_TEMPLATE.format(name="", rubric=" ", prompt="")
_PIECE_PAIRS = (
    f"doc_tokens AS (SELECT doc_id, {_tokens('text')} AS t FROM documents)",
    f"""rubric_tokens AS (SELECT acronym AS demand, 4 * {_tokens('full_name')} + {_tokens('content')}
        + {_tokens(_text(_EMPTY_TEXT))} AS t FROM rubrics)""",
    "pairs AS (SELECT r.demand, d.t + r.t AS tokens FROM doc_tokens d CROSS JOIN rubric_tokens r)",
)
_RENDERED_PAIRS = (
    _RENDERED, f"pairs AS (SELECT demand, {_tokens('instruction')} AS tokens FROM rendered)",
)
_PER_DEMAND = """SELECT demand, CAST(count(*) AS BIGINT) AS n_prompts, CAST(sum(tokens) AS BIGINT) AS input_tokens
    FROM pairs GROUP BY demand"""

_LATEST_TURN = """SELECT CAST(conv_id AS VARCHAR) AS custom_id, arg_max(text, turn) AS prompt
    FROM conversations GROUP BY conv_id"""

_RUBRIC_LEVELS = "'Level 0: ' || text || chr(10) || 'Examples: none'" + "".join(
    f" || chr(10) || 'Level {k}: more' || chr(10) || 'Examples: none'" for k in range(1, 6)
)

_CHECK = """CASE
    WHEN trim(content, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN {empty}
    WHEN len(regexp_extract_all(content, '[Ll]evel\\s*[0-5]')) < 6 THEN {levels}
    WHEN length(trim(content, ' ' || chr(9) || chr(10) || chr(13))) < 100 THEN {short}
    WHEN len(regexp_extract_all(content, '(?i)examples?')) = 0 THEN {none}
    WHEN len(regexp_extract_all(content, '(?i)examples?')) < 6 THEN {few}
    ELSE {valid} END""".format(
    empty=_text(MSG_EMPTY_CONTENT), levels=_text(MSG_LEVELS), short=_text(MSG_SHORT),
    none=_text(MSG_NO_EXAMPLES), few=_text(MSG_FEW_EXAMPLES), valid=_text(MSG_VALID),
)

_WIDE = ", ".join(
    f"max(level) FILTER (demand = '{a}') AS \"{a}\"" for a in d.ACRONYMS
)
_NESTED = ", ".join(
    f"max(level) FILTER (demand = '{a}') AS \"{a}_level\", "
    f"max(finish_reason) FILTER (demand = '{a}') AS \"{a}_reason\", "
    f"max(md5(content)) FILTER (demand = '{a}') AS \"{a}_md5\""
    for a in d.ACRONYMS
)

_LAST = """last AS (
  SELECT source AS custom_id, demand, level, finish_reason, content
  FROM (SELECT l.*, t.source, row_number() OVER (PARTITION BY t.source, l.demand ORDER BY l.doc_id DESC) AS age
    FROM levels l JOIN documents t ON t.doc_id = l.doc_id) WHERE age = 1)"""

_PROMPTED = _over_outputs(
    f"""SELECT l.custom_id, l.demand, l.level, l.finish_reason, {_digest('t.text', 'prompt')}
      FROM levels l JOIN documents t ON t.doc_id = l.doc_id""", _LEVELS)


def _pivoted(keys: str) -> str:
    cells = ", ".join(f"max(level) FILTER (demand = '{name}') AS \"{name}\"" for name in d.ACRONYMS)
    return f"SELECT {keys}, {cells} FROM levels GROUP BY {keys}"


ORACLES = {
    "read_prompts_jsonl": _PROMPTS,
    "read_prompts_csv": _PROMPTS,
    "read_prompts_csv_parallel": _PROMPTS,
    "read_prompts_parquet": _PROMPTS,
    "prompts_only": "SELECT text AS prompt FROM documents",
    "load_rubrics": _with(
        f"files AS (SELECT CAST(doc_id AS VARCHAR) AS doc, {_RUBRIC_LEVELS} AS content FROM documents)",
        select=f"""SELECT 'D' || doc AS acronym, 'Document ' || doc AS full_name, {_digest('content', 'content')}
            FROM files WHERE NOT ends_with(doc, '7') AND {_CHECK} = {_text(MSG_VALID)}""",
    ),
    "read_outputs": _over_outputs(
        f"""SELECT custom_id, demand, part, model, finish_reason, prompt_tokens, completion_tokens,
            {_digest('content', 'content')} FROM outputs"""),
    "part_inventory": _over_outputs(
        """SELECT demand, part, 'outputs' AS kind, CAST(count(*) AS BIGINT) AS rows,
            CAST(sum(strlen(CAST(to_json({custom_id: custom_id, response: {body: {model: model,
              choices: [{finish_reason: finish_reason, message: {content: content}}],
              usage: {prompt_tokens: prompt_tokens, completion_tokens: completion_tokens}}}}) AS VARCHAR)) + 1) AS BIGINT) AS bytes
          FROM outputs GROUP BY demand, part"""),
    "read_errors": _over_outputs(
        """SELECT demand, part, custom_id, '{"code":"content_filter","model":"' || model || '"}' AS error
          FROM outputs WHERE finish_reason = 'content_filter'"""),
    "read_errors_whole": _over_outputs(
        """SELECT demand, part, CASE WHEN doc_id % 4 <> 0 THEN custom_id END AS custom_id, CAST(NULL AS VARCHAR) AS error,
            CASE WHEN doc_id % 4 <> 0 THEN '{"status_code":400}' END AS response,
            CASE WHEN doc_id % 4 = 0 THEN '{"custom_id":"' || custom_id || '","response":{"status_code":400' END AS corrupt_record
          FROM outputs WHERE finish_reason = 'content_filter'"""),
    "read_error_details": _over_outputs(
        f"""SELECT demand, part, CASE WHEN k < 4 THEN custom_id END AS custom_id,
            CAST(CASE k WHEN 1 THEN 400 WHEN 3 THEN 429 END AS INTEGER) AS status_code,
            CASE k WHEN 0 THEN 'content_filter' WHEN 1 THEN 'policy' WHEN 3 THEN CAST(completion_tokens AS VARCHAR) END AS code,
            {_digest('message', 'message')}, CASE WHEN k = 4 THEN '{{"custom_id":"' || custom_id || '",' END AS corrupt_record
          FROM (SELECT *, doc_id % 5 AS k, CASE WHEN doc_id % 5 < 3 THEN content END AS message FROM outputs
            WHERE finish_reason = 'content_filter')"""),
    "shape_of_errors": _over_outputs(
        """SELECT part, CASE WHEN bool_and(k = 4) THEN 'VOID' ELSE 'OBJECT<' || array_to_string(list_filter(['custom_id: STRING',
              CASE WHEN bool_or(k IN (0, 3)) AND bool_or(k = 2) THEN 'error: VARIANT'
                WHEN bool_or(k = 2) THEN 'error: STRING'
                WHEN bool_or(k IN (0, 3)) THEN 'error: OBJECT<code: ' || CASE WHEN bool_and(k <> 3) THEN 'STRING' WHEN bool_and(k <> 0)
                  THEN 'BIGINT' ELSE 'VARIANT' END || CASE WHEN bool_or(k = 0) THEN ', message: STRING' ELSE '' END || '>' END,
              CASE WHEN bool_or(k = 1) THEN
                'response: OBJECT<body: OBJECT<error: OBJECT<message: STRING, type: STRING>>, status_code: BIGINT>' END,
              CASE WHEN bool_or(k = 3) THEN 'status_code: BIGINT' END], lambda x: x IS NOT NULL), ', ') || '>' END AS shape
          FROM (SELECT part, doc_id % 5 AS k FROM outputs WHERE finish_reason = 'content_filter') GROUP BY part"""),
    "read_batch_metadata": _over_outputs("SELECT * FROM metadata", _METADATA),
    "job_ledger": _with(_LEDGER, select="SELECT * FROM ledger"),
    "write_requests": _with(
        _RUBRICS, _RENDERED,
        f"""indexed AS (SELECT CAST(doc_id AS VARCHAR) AS custom_id,
            ntile(CAST((SELECT (count(*) + {MAX_LINES} - 1) // {MAX_LINES} FROM documents) AS INTEGER))
              OVER (ORDER BY CAST(doc_id AS VARCHAR)) AS k, count(*) OVER () AS n FROM documents)""",
        select=f"""SELECT demand, CASE WHEN n > {MAX_LINES} THEN demand || '_part' || CAST(k AS VARCHAR) ELSE demand END AS part,
            custom_id, {_digest('instruction', 'content')} FROM rendered JOIN indexed USING (custom_id)""",
    ),
    "write_requests_bytes": _with(
        _RUBRICS, _RENDERED, _LINES, _SIZES,
        f"""plan AS (SELECT *, n_bytes > {MAX_BYTES} AS need_split, (n_bytes + {MAX_BYTES} - 1) // {MAX_BYTES} AS num_parts
            FROM sizes)""", _DEALT,
        select=f"""SELECT demand, part, custom_id, {_digest('instruction', 'content')}
            FROM dealt JOIN rendered USING (doc_id, demand)"""),
    "write_requests_exact": _with(
        _RUBRICS, _RENDERED, _LINES,
        "longest AS (SELECT demand FROM lines GROUP BY demand ORDER BY sum(line_bytes) DESC LIMIT 1)",
        f"""begins AS (SELECT custom_id, row_number() OVER w - 1 AS i, sum(line_bytes) OVER w - line_bytes AS b,
              {MAX_BYTES} - max(line_bytes) OVER () + 1 AS width
            FROM lines JOIN longest USING (demand) WINDOW w AS (ORDER BY custom_id))""",
        "stretches AS (SELECT *, b // width AS stretch FROM begins)",
        f"""cuts AS (SELECT *, dense_rank() OVER (ORDER BY stretch, (i - least) // {MAX_LINES}) AS k
            FROM (SELECT *, min(i) OVER (PARTITION BY stretch) AS least FROM stretches))""",
        select="""SELECT demand, CASE WHEN (SELECT max(k) FROM cuts) > 1 THEN demand || '_part' || CAST(k AS VARCHAR) ELSE demand END AS part,
            CAST(count(*) AS BIGINT) AS lines, CAST(sum(line_bytes) AS BIGINT) AS bytes, min(custom_id) AS first_id,
            max(custom_id) AS last_id FROM lines JOIN cuts USING (custom_id) GROUP BY demand, k"""),
    "write_annotations_jsonl": _FROM_LONG,
    "write_annotations_csv": _FROM_LONG,
    "write_annotations_parquet": _FROM_LONG,
    "split_by_demand": _FROM_LONG,
    "write_annotations_kept": _FROM_LONG,
    "render_instruction": _with(
        _RUBRICS, _RENDERED,
        select=f"SELECT custom_id, demand, {_digest('instruction', 'instruction')} FROM rendered"),
    "build_request": _with(
        _RUBRICS, _RENDERED, _LINES,
        select=f"""SELECT custom_id, demand, 'POST' AS method, '/chat/completions' AS url, 'gpt-4o' AS model,
            'system' AS system_role, '' AS system_content, 'user' AS user_role, md5(instruction) AS user_md5,
            {REQUEST_MAX_TOKENS} AS max_tokens, 0 AS temperature, CAST(line_bytes AS INTEGER) AS line_bytes FROM lines"""),
    "demand_of_path": _over_outputs(
        "SELECT demand, part, CAST(count(*) AS BIGINT) AS rows FROM outputs GROUP BY demand, part"),
    "extract_level": _over_outputs("SELECT custom_id, demand, extracted AS level FROM levels", _LEVELS),
    "extract_level_guarded": """SELECT doc_id, CASE
            WHEN len(numbers) = 1 THEN NULL
            WHEN TRY_CAST(list_extract(numbers, -1) AS DOUBLE) BETWEEN 0 AND 5
              THEN TRY_CAST(list_extract(numbers, -1) AS DOUBLE) END AS level
          FROM (SELECT doc_id, regexp_extract_all(CAST(doc_id % 8 AS VARCHAR) || '. ' || text, '[0-9]+') AS numbers
            FROM documents)""",
    "annotate_long": _FROM_LONG,
    "bad_rows": _over_outputs(
        """SELECT demand, part, CASE WHEN finish_reason = 'length' THEN custom_id END AS custom_id,
            CASE WHEN finish_reason = 'length' THEN 'stop' END AS finish_reason,
            CASE WHEN finish_reason <> 'length' THEN CAST(strlen(string_split(CAST(to_json({custom_id: custom_id,
              response: {body: {model: model, choices: [{finish_reason: finish_reason, message: {content: content}}],
              usage: 0}}}) AS VARCHAR), '"usage"')[1]) AS INTEGER) END AS corrupt_bytes
          FROM outputs WHERE demand = 'AB' AND finish_reason <> 'stop'"""),
    "annotate_long_broken": _over_outputs(
        "SELECT custom_id, demand, level FROM levels WHERE demand <> 'AB' OR finish_reason = 'stop'", _LEVELS),
    "annotate_long_drop_file": _over_outputs(
        """SELECT custom_id, demand, level FROM levels WHERE part NOT IN
            (SELECT part FROM outputs WHERE demand = 'AB' AND finish_reason <> 'stop')""", _LEVELS),
    "finish_bucket": _over_outputs(
        """SELECT custom_id, demand, finish_reason,
            CASE WHEN finish_reason IN ('stop', 'length') THEN finish_reason ELSE 'other' END AS finish_bucket
          FROM outputs"""),
    "filter_finish_reason": _over_outputs(
        """SELECT custom_id, demand, level, CASE finish_reason WHEN 'length' THEN 'length' ELSE 'other' END AS bucket
          FROM levels WHERE finish_reason <> 'stop'""", _LEVELS),
    "filter_outcome": _over_outputs(
        "SELECT custom_id, demand, level FROM levels WHERE finish_reason = 'stop' AND level IS NULL", _LEVELS),
    "filter_outcome_succeed": _over_outputs(
        "SELECT custom_id, demand, level FROM levels WHERE level IS NOT NULL", _LEVELS),
    "only_levels": _over_outputs("SELECT custom_id, demand, level FROM levels", _LEVELS),
    "filter_demands": _with(
        _RUBRICS, select="""SELECT CAST(doc_id AS VARCHAR) AS custom_id, acronym AS demand
          FROM documents CROSS JOIN rubrics WHERE acronym IN ('AA', 'CE')"""),
    "filter_demands_prefix": _over_outputs(
        "SELECT custom_id, part FROM outputs WHERE " + " OR ".join(map(_prefix_test, PREFIXES))),
    "filter_demands_substring": _over_outputs(
        "SELECT custom_id, part FROM outputs WHERE contains(part, 'B_part1') OR contains(part, 'CE')"),
    "unmatched_prefixes": _over_outputs(
        f"""SELECT name FROM (VALUES {_values([(name,) for name in PREFIXES])}) AS names(name)
          WHERE NOT EXISTS (SELECT 1 FROM outputs WHERE starts_with(part, name))"""),
    "expand_requests": _with(
        _RUBRICS, select="""SELECT CAST(doc_id AS VARCHAR) AS custom_id, acronym AS demand, full_name,
          CAST(strlen(text) AS INTEGER) AS prompt_bytes FROM documents CROSS JOIN rubrics"""),
    "attach_prompts": _over_outputs(
        """SELECT l.custom_id, l.demand, l.level, coalesce(p.prompt, '') AS prompt
          FROM levels l LEFT JOIN latest p ON p.custom_id = l.custom_id""",
        _LEVELS, f"latest AS ({_LATEST_TURN})"),
    "attach_prompts_hot": f"""SELECT d.doc_id, d.lang AS custom_id, {_digest('p.text', 'prompt')}
        FROM documents d JOIN (SELECT lang, arg_max(text, doc_id) AS text FROM documents GROUP BY lang) p ON p.lang = d.lang""",
    "prompt_map": _LATEST_TURN,
    "price_lookup": _with(
        _PRICES,
        f"""named AS (SELECT doc_id, [{', '.join(map(_text, d.MODEL_NAMES))}][doc_id % {len(d.MODEL_NAMES)} + 1] AS model
          FROM documents)""",
        select=_price("first", "ord") + " UNION ALL " + _price("longest", "-length(model_key)")),
    "jobs_in_ledger": _with(
        _JOBS, _LEDGER, select="""SELECT j.id, j.status, l.demand, l.part, j.created_at, j.completed_at
          FROM jobs j JOIN ledger l ON l.batch_id = j.id WHERE j.status = 'completed'"""),
    "completed_jobs": _with(
        _JOBS, _LEDGER,
        select="SELECT * FROM ledger WHERE batch_id IN (SELECT id FROM jobs WHERE status = 'completed')"),
    "completed_jobs_by_output": _over_outputs(
        "SELECT DISTINCT demand, part, 'batch_' || part AS batch_id FROM outputs WHERE demand <> 'CE'"),
    "unknown_demands": """SELECT name FROM (VALUES ('src1'), ('src99'), ('AA')) AS names(name)
        WHERE name NOT IN (SELECT source FROM documents)""",
    "missing_outputs": _over_outputs(
        "SELECT custom_id, demand FROM outputs WHERE finish_reason = 'content_filter'"),
    "missing_output_parts": _with(
        _JOBS, _LEDGER,
        select="SELECT demand, part FROM ledger WHERE batch_id NOT IN (SELECT id FROM jobs WHERE status = 'completed')"),
    "annotation_summary": _summary("demand"),
    "annotation_summary_broken": _over_outputs(
        """SELECT demand, CAST(count(*) FILTER (NOT bad) AS BIGINT) AS total,
            CAST(count(level) FILTER (NOT bad) AS BIGINT) AS successful,
            CAST(100 AS DOUBLE) * count(level) FILTER (NOT bad) / count(*) FILTER (NOT bad) AS successful_percent,
            CAST(count(*) FILTER (NOT bad AND level IS NULL) AS BIGINT) AS failed,
            CAST(100 AS DOUBLE) * count(*) FILTER (NOT bad AND level IS NULL) / count(*) FILTER (NOT bad) AS failed_percent,
            CAST(count(*) FILTER (bad) AS BIGINT) AS bad
          FROM (SELECT *, demand = 'AB' AND finish_reason <> 'stop' AS bad FROM levels) GROUP BY demand""", _LEVELS),
    "annotation_summary_total": _summary(""),
    "failed_breakdown": _over_outputs(
        """SELECT finish_reason, CAST(count(*) AS BIGINT) AS count,
            CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM levels WHERE level IS NULL) AS percent
          FROM levels WHERE level IS NULL GROUP BY finish_reason""", _LEVELS),
    "batch_usage": _over_outputs(
        """SELECT part, model, n, prompt_tokens, completion_tokens, avg_completion, std_completion,
            max_completion, min_completion FROM usage""", _USAGE),
    "batch_usage_files": _over_outputs(
        """SELECT part, model, n, prompt_tokens, completion_tokens, avg_completion, std_completion,
            max_completion, min_completion FROM usage""", _USAGE),
    "finish_reason_counts": _over_outputs(
        "SELECT part, stop, length, other, n AS total FROM usage", _USAGE),
    "batch_cost": _over_outputs(
        """SELECT part, model, cost_prompt, cost_completion, cost_prompt + cost_completion AS cost_total
          FROM cost""", _PRICES, _USAGE, _COST),
    "batch_summary": _over_outputs(
        "SELECT * FROM summaries", *_FROM_SUMMARIES),
    "batch_summary_runs": _over_runs("SELECT * FROM summaries"),
    "general_summary_runs": _GENERAL_RUNS,
    "stream_summary_runs": _GENERAL_RUNS,
    "general_summary": _GENERAL,
    "general_summary_members": _over_outputs(
        """SELECT 'subdomain' AS kind, subdomain AS name, CAST(count(*) AS BIGINT) AS batches
            FROM summaries GROUP BY subdomain
          UNION ALL SELECT 'model', model, CAST(count(*) AS BIGINT) FROM summaries GROUP BY model""",
        *_FROM_SUMMARIES),
    "pooled_token_stats": _over_outputs(
        """SELECT * REPLACE (round(tokens_avg_completion, 6) AS tokens_avg_completion,
            round(tokens_std_completion, 6) AS tokens_std_completion) FROM pooled""",
        *_FROM_SUMMARIES, _POOLED),
    "status_histogram": _with(
        _JOBS, select="""SELECT status, CAST(count(*) AS BIGINT) AS count,
          CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM jobs) * 100 AS percentage FROM jobs GROUP BY status"""),
    "batch_progress": _with(
        _JOBS, select="""SELECT id, completed, total, CAST(completed AS DOUBLE) / total * 100 AS percentage
          FROM jobs WHERE status = 'in_progress'"""),
    "token_count": f"SELECT CAST(doc_id AS VARCHAR) AS custom_id, {_tokens('text')} AS tokens FROM documents",
    "input_tokens_exact": _with(_RUBRICS, *_RENDERED_PAIRS, select=_PER_DEMAND),
    "input_tokens_rendered": _with(
        _RUBRICS, _RENDERED, "pairs AS (SELECT demand, CAST(ceil(length(instruction) / 4) AS BIGINT) AS tokens FROM rendered)",
        select=_PER_DEMAND),
    "input_tokens_approx": _with(_RUBRICS, *_PIECE_PAIRS, select=_PER_DEMAND),
    "estimate_cost": _estimate("tokens", *_PIECE_PAIRS),
    "estimate_cost_exact": _estimate("tokens", *_RENDERED_PAIRS),
    "validate_prompts": """SELECT doc_id // 500 AS file, i AS line_index,
          CASE doc_id % 10 WHEN 3 THEN 'custom_id' ELSE 'idx,prompt' END AS keys
        FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id) - 1 AS i FROM documents)
        WHERE doc_id % 10 IN (3, 7)""",
    "validate_rubrics": f"""SELECT doc_id, message = {_text(MSG_VALID)} AS is_valid, message
        FROM (SELECT doc_id, {_CHECK} AS message FROM (
          SELECT doc_id, text || repeat(' Level 3', doc_id % 8) || repeat(' example', doc_id % 9) AS content
          FROM documents))""",
    "need_split": _with(
        *_FROM_SIZES, select=f"""SELECT demand, n_lines, n_bytes,
          n_lines > {MAX_LINES} OR n_bytes > {MAX_BYTES} AS need_split FROM sizes"""),
    "split_plan": _with(
        *_FROM_DEALT, select="SELECT doc_id, demand, part, part_no, part_row, part_rows FROM dealt"),
    "halve_part": _with(
        *_FROM_DEALT, select="""SELECT part, half, CAST(count(*) AS BIGINT) AS rows,
            min(doc_id) AS first_doc, max(doc_id) AS last_doc
          FROM (SELECT *, CASE WHEN part_row < part_rows // 2 THEN 1 ELSE 2 END AS half FROM dealt)
          GROUP BY part, half"""),
    "union_outputs": _over_outputs("SELECT custom_id, demand, part, finish_reason FROM outputs"),
    "pivot_wide": _over_outputs(f"SELECT custom_id, {_WIDE} FROM levels GROUP BY custom_id", _LEVELS),
    "nest_wide": _over_outputs(
        f"SELECT custom_id, CAST(count(*) AS INTEGER) AS demands, {_NESTED} FROM levels GROUP BY custom_id", _LEVELS),
    "pivot_wide_last": _over_outputs(f"SELECT custom_id, {_WIDE} FROM last GROUP BY custom_id", _LEVELS, _LAST),
    "nest_wide_last": _over_outputs(
        f"SELECT custom_id, demand, level, finish_reason, {_digest('content', 'response')} FROM last", _LEVELS, _LAST),
    "stream_status": f"""SELECT 'batch_' || CAST(user_id AS VARCHAR) AS batch_id,
          arg_max({_STATUS}, (ts, event_id)) AS status, arg_max(event_id, (ts, event_id)) AS event_id
        FROM events GROUP BY user_id""",
    "stream_pending": f"""SELECT * FROM (SELECT 'batch_' || CAST(user_id AS VARCHAR) AS batch_id,
            arg_max({_STATUS}, (ts, event_id)) AS status, arg_max(event_id, (ts, event_id)) AS event_id
          FROM events GROUP BY user_id) WHERE status NOT IN ('completed', 'failed')""",
    "stream_status_tracked": f"""SELECT * FROM (SELECT 'batch_' || CAST(user_id AS VARCHAR) AS batch_id,
            arg_max({_STATUS}, (ts, event_id)) AS status, arg_max(event_id, (ts, event_id)) AS event_id
          FROM events GROUP BY user_id) WHERE status IN ('completed', 'failed')""",
    "stream_outputs": _FROM_LONG,
    "stream_outputs_broken": _over_outputs(
        """SELECT custom_id, demand, level, false AS quarantined FROM levels WHERE demand <> 'AB' OR finish_reason = 'stop'
          UNION ALL SELECT CASE WHEN finish_reason = 'length' THEN custom_id END, demand, NULL, true
          FROM levels WHERE demand = 'AB' AND finish_reason <> 'stop'""", _LEVELS),
    "stream_summary": _GENERAL,
    "stream_outputs_prompts": _PROMPTED,
    "stream_wide": _over_runs(_pivoted("run, custom_id"), _LEVELS),
    "stream_nested": _over_runs(
        f"SELECT run, custom_id, demand, level, finish_reason, {_digest('content', 'response')} FROM levels", _LEVELS),
    "stream_outputs_runs": _over_runs("SELECT run, custom_id, demand, level FROM levels", _LEVELS),
    "annotate_long_runs": _over_runs("SELECT run, custom_id, demand, level, finish_reason FROM levels", _LEVELS),
    "pivot_wide_runs": _over_runs(_pivoted("run, custom_id"), _LEVELS),
    "kept_run_long": _PROMPTED,
    "kept_run_wide": _over_outputs(_pivoted("custom_id"), _LEVELS),
    "kept_run_nested": _PROMPTED,
    "annotation_run": _over_outputs(
        f"""SELECT l.custom_id, l.demand, l.level, l.finish_reason, {_digest('t.text', 'prompt')}
          FROM levels l JOIN documents t ON t.doc_id = l.doc_id WHERE l.level IS NOT NULL""", _LEVELS),
}
