"""DuckDB SQL for every query in the catalogue (the correctness oracle).

The SQL is written independently of the Spark code: relational counting
(unnest + GROUP BY + join) for the n-gram overlaps, list lambdas for the
line filters. Fixture parameters come from the same constants.
"""

from __future__ import annotations

from ..constants import (BLEU_DIGITS, IM_END, IM_START, PY_WHITESPACE_CODEPOINTS, REPORT_HEADER,
                         REPORT_METRICS, REPORT_RULE, ROWS_PER_STEP, SEQ_BUDGET_TOKENS, SHORT_REPORT, SYSTEM_PROMPT, TOKEN_PATTERN,
                         TRAIN_MAX_STEPS, TRAIN_SEED, LOG_TAIL_LINES)
from ..sources import fixtures as fx

WS = "(" + "||".join(f"chr({c})" for c in PY_WHITESPACE_CODEPOINTS) + ")"
BLANK = "(' '||chr(9)||chr(11)||chr(12))"
NL = "chr(10)"
TOK = TOKEN_PATTERN
D = "::DOUBLE"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scaled(expr: str, digits: int) -> str:
    """Half-even rounding of the scaled double."""
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {scale}{D}, 0) / {scale}{D})"


def rnd(expr: str, digits: int) -> str:
    """The decimal that printing the exact value of the double gives."""
    return f"CAST(printf('%.{digits}f', CAST({expr} AS DOUBLE)) AS DOUBLE)"


def fixed_sum(expr: str, bits: int) -> str:
    """Sum in whole multiples of a power of two."""
    return f"(CAST(sum(CAST(round_even(({expr}) * {float(1 << bits)}{D}, 0) AS HUGEINT)) AS DOUBLE) / {float(1 << bits)}{D})"


def block(role: str, content: str) -> str:
    return f"({q(IM_START)} || {role} || {NL} || {content} || {q(IM_END)} || {NL})"


MODELS = "models AS (SELECT unnest([" + ", ".join(q(m) for m in fx.SIM_MODELS) + "]) AS model)"

SUITE = f"""suite AS (
  SELECT CASE WHEN doc_id % 2 = 0 THEN 'suite_a' ELSE 'suite_b' END AS suite,
         doc_id AS id, text AS nl, trim(replace(text, {NL}, ' '), {WS}) AS gold
  FROM documents)"""

SUITE_BY_PLACE = SUITE.replace("SELECT CASE", "SELECT * REPLACE (row_number() OVER (PARTITION BY suite ORDER BY id) AS id) FROM (\n  SELECT CASE"
                               ).replace("FROM documents)", "FROM documents))")

SIM = f"""sim0 AS (
  SELECT m.model, s.suite, s.id, s.gold,
         CASE WHEN m.model = 'base' THEN s.id % {fx.SIM_FLAVOURS}
              WHEN s.id % {fx.SIM_TUNED_KEEP_MOD} = 0 THEN s.id % {fx.SIM_FLAVOURS}
              ELSE 0 END AS f
  FROM suite s CROSS JOIN models m),
answers AS (
  SELECT model, suite, id,
         CASE f WHEN 0 THEN gold
                WHEN 1 THEN '```bash' || {NL} || gold || {NL} || '```'
                WHEN 2 THEN gold || {NL} || {q(fx.CHATTER)}
                WHEN 3 THEN {q(fx.COMMENT_LINE)} || {NL} || replace(gold, 'e', 'E')
                ELSE left(gold, CAST(floor(length(gold) / 2) AS INTEGER)) END AS raw_prediction,
         {fx.SIM_LATENCY_STEP}{D} * (id % {fx.SIM_LATENCY_MOD})
           + CASE WHEN model = 'base' THEN {fx.SIM_LATENCY_BASE['base']}{D}
                  ELSE {fx.SIM_LATENCY_BASE['tuned']}{D} END AS latency
  FROM sim0),
sim AS (
  SELECT model, suite, id, raw_prediction, latency, FALSE AS is_error FROM answers
  WHERE id % {fx.SIM_MISSING_MOD} <> 0 AND id % {fx.SIM_FAILED_MOD} <> 0)"""

PAIRED = f"""paired AS (
  SELECT m.model, s.suite, s.id, s.nl, s.gold,
         coalesce(trim(r.raw_prediction, {WS}), '') AS raw_prediction,
         coalesce(r.latency, 0.0{D}) AS latency,
         r.model IS NULL AS is_error
  FROM suite s CROSS JOIN models m
  LEFT JOIN sim r ON r.model = m.model AND r.suite = s.suite AND r.id = s.id)"""


# The dump of the calls: answers that were cut off count as failed.
DUMPED = f"dump AS (SELECT * FROM sim WHERE id % {fx.SIM_CUT_MOD} <> {fx.SIM_CUT_REST})"
PAIRED_DUMP = PAIRED.replace("LEFT JOIN sim r", "LEFT JOIN dump r")


def clean_sql(col: str) -> str:
    kept = (f"list_filter(list_transform(string_split(trim({col}, {WS}), {NL}), lambda l: trim(l, {WS})), "
            f"lambda l: l <> '' AND NOT starts_with(l, '```') AND NOT starts_with(l, '#'))")
    return (f"coalesce(({kept})[-1], trim(replace(trim({col}, {WS}), '`', ''), {WS}))")


def tokens_sql(col: str) -> str:
    return f"regexp_extract_all(lower({col}), {q(TOK)}, 1)"


def scoring(src: str) -> str:
    """CTEs cleaned/tok/grams/cnt/ov/scored over a CTE with (model, suite, id, gold, raw_prediction, ...)."""
    grams_side = []
    for side, col in (("pred", "pt"), ("gold", "gt")):
        for n in range(1, 5):
            # Shifted slices side by side: linear in the tokens. Short bags give null grams.
            slices = ", ".join(f"{col}[{k}:len({col}) - {n - k}]" for k in range(1, n + 1))
            joined = " || ' ' || ".join(f"x[{k}]" for k in range(1, n + 1))
            gram = col if n == 1 else f"list_transform(list_zip({slices}), lambda x: {joined})"
            grams_side.append(f"SELECT model, suite, id, {n} AS n, '{side}' AS side, unnest({gram}) AS gram FROM tok")
    grams_sql = "\n  UNION ALL ".join(grams_side)
    ov_joins = "\n".join(
        f"  LEFT JOIN ov o{n} ON o{n}.model = c.model AND o{n}.suite = c.suite AND o{n}.id = c.id AND o{n}.n = {n}"
        for n in range(1, 5))
    terms = " + ".join(
        f"CASE WHEN np >= {n} AND ng >= {n} THEN 0.25{D} * ln((m{n} + 0.1{D}) / (greatest(np - {n - 1}, 1) + 0.1{D})) "
        f"ELSE 0.0{D} END" for n in range(1, 5))
    return f"""cleaned AS (SELECT *, {clean_sql('raw_prediction')} AS clean_prediction FROM {src}),
tok AS (SELECT model, suite, id, {tokens_sql('clean_prediction')} AS pt, {tokens_sql('gold')} AS gt FROM cleaned),
grams AS (SELECT * FROM ({grams_sql}) WHERE gram IS NOT NULL),
cnt AS (SELECT model, suite, id, n, side, gram, count(*) AS c FROM grams GROUP BY ALL),
ov AS (
  SELECT p.model, p.suite, p.id, p.n, sum(least(p.c, g.c)) AS m
  FROM cnt p JOIN cnt g ON p.model = g.model AND p.suite = g.suite AND p.id = g.id
       AND p.n = g.n AND p.gram = g.gram AND p.side = 'pred' AND g.side = 'gold'
  GROUP BY ALL),
counted AS (
  SELECT c.*, len(t.pt) AS np, len(t.gt) AS ng,
         coalesce(o1.m, 0) AS m1, coalesce(o2.m, 0) AS m2, coalesce(o3.m, 0) AS m3, coalesce(o4.m, 0) AS m4
  FROM cleaned c JOIN tok t ON t.model = c.model AND t.suite = c.suite AND t.id = c.id
{ov_joins}),
scored AS (
  SELECT *,
    CASE WHEN lower(trim(clean_prediction, {WS})) = lower(trim(gold, {WS})) THEN 1.0{D} ELSE 0.0{D} END AS em,
    CASE WHEN np = 0 OR ng = 0 OR m1 = 0 THEN 0.0{D}
         ELSE (2.0{D} * (1.0{D} * m1 / np) * (1.0{D} * m1 / ng)) / ((1.0{D} * m1 / np) + (1.0{D} * m1 / ng)) END AS f1,
    CASE WHEN np = 0 THEN 0.0{D}
         ELSE {scaled(f"(CASE WHEN np < ng THEN exp(1.0{D} - ng / greatest(np, 1)) ELSE 1.0{D} END) * exp(0.0{D} + {terms})", BLEU_DIGITS)} END AS bleu4,
    CASE WHEN len(string_split(raw_prediction, {NL})) <= 2 THEN 1 ELSE 0 END AS single_line,
    CAST(length(raw_prediction) AS BIGINT) AS output_chars
  FROM counted)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


EVAL = with_(MODELS, SUITE, SIM, PAIRED, scoring("paired"))

SUMMARY_COLS = f"""model, suite, count(*) AS num_samples,
  {rnd('sum(em) / count(*) * 100.0::DOUBLE', 2)} AS exact_match_pct,
  {rnd(fixed_sum('f1', 53) + ' / count(*) * 100.0::DOUBLE', 2)} AS mean_token_f1,
  {rnd(fixed_sum('bleu4', 53) + ' / count(*) * 100.0::DOUBLE', 2)} AS mean_bleu4,
  {rnd('sum(single_line)::DOUBLE / count(*) * 100.0::DOUBLE', 2)} AS single_line_clean_pct,
  {rnd('sum(latency) / count(*)', 2)} AS avg_latency_sec,
  {rnd('sum(output_chars)::DOUBLE / count(*)', 1)} AS avg_output_chars"""

SUMMARY_SELECT = f"""SELECT {SUMMARY_COLS},
  CAST(sum(CAST(is_error AS BIGINT)) AS BIGINT) AS n_errors,
  {rnd('avg(CASE WHEN NOT is_error THEN latency END)', 2)} AS avg_latency_ok
FROM scored GROUP BY model, suite"""

SHORT = ", ".join(f"'{m}'" for m in SHORT_REPORT)

_present = [(i, m) for i, m in enumerate(REPORT_METRICS, 1) if m[0] != "syntax_validity_pct"]
LONG = "long AS (" + "\n  UNION ALL ".join(
    f"SELECT model, suite, '{m[0]}' AS metric, {i} AS metric_ord, '{m[3]}' AS kind, {m[0]}{D} AS value FROM summary"
    for i, m in _present) + ")"

COMPARE = f"""summary AS ({SUMMARY_SELECT}),
{LONG},
wide AS (
  SELECT suite, metric, CAST(metric_ord AS BIGINT) AS metric_ord, kind,
         max(CASE WHEN model = 'base' THEN value END) AS base,
         max(CASE WHEN model = 'tuned' THEN value END) AS tuned
  FROM long GROUP BY suite, metric, metric_ord, kind),
cmp AS (
  SELECT suite, metric, metric_ord, base, tuned,
         CASE WHEN kind = 'faster' THEN
                CASE WHEN base = 0 THEN NULL ELSE {rnd('(1.0::DOUBLE - tuned / base) * 100.0::DOUBLE', 1)} END
              ELSE tuned - base END AS delta,
         kind
  FROM wide)"""


def _case(field: int) -> str:
    return "CASE metric " + " ".join(f"WHEN '{m[0]}' THEN {q(m[field])}" for m in REPORT_METRICS) + " END"


def _num(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'n/a')"


MARKDOWN = f"""{EVAL}, {COMPARE},
shown AS (SELECT * FROM cmp WHERE suite <> 'suite_b' OR metric IN ({SHORT})),
heads AS (SELECT DISTINCT suite FROM cmp)
SELECT suite, CAST(0 AS BIGINT) AS line_no, '### ' || suite AS line FROM heads
UNION ALL SELECT suite, CAST(1 AS BIGINT), {q(REPORT_HEADER.format(base='simulated base', tuned='simulated tuned'))} FROM heads
UNION ALL SELECT suite, CAST(2 AS BIGINT), {q(REPORT_RULE)} FROM heads
UNION ALL SELECT suite, metric_ord + 2,
  '| ' || {_case(1)} || ' | ' || {_num('base')} || {_case(2)} || ' | **' || {_num('tuned')} || {_case(2)} || '** | '
  || CASE WHEN kind = 'faster' THEN '⚡ ' || {_num('delta')} || '% faster'
          ELSE '+' || {_num(rnd('delta', 1))} || {_case(2)} END || ' |'
FROM shown"""

PAIRS = f"""pairs AS (
  SELECT CAST('0x' || left(md5(CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR)), 15) AS BIGINT) AS pair_id,
         trim(u.text, {WS}) AS instruction, trim(a.text, {WS}) AS command
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
resolved AS (SELECT * FROM pairs WHERE instruction IS NOT NULL AND command IS NOT NULL)"""

TRAIN_TEXT = (f"{block(q('system'), q(SYSTEM_PROMPT))} || {block(q('user'), 'instruction')} || "
              f"{block(q('assistant'), 'command')}")

PROMPT_TEXT = (f"{block(q('system'), q(SYSTEM_PROMPT))} || "
               f"CASE WHEN coalesce(text, '') <> '' THEN {block(q('user'), 'text')} ELSE '' END || "
               f"{q(IM_START + 'assistant')} || {NL}")

RUN_LOG = "SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step, ts, value AS loss FROM events"
RESERVED = "CAST(round(value * 1073741824.0::DOUBLE) AS BIGINT)"

ORACLE_SQL: dict[str, str] = {
    "chatml_train": f"{with_(PAIRS)}SELECT pair_id, {TRAIN_TEXT} AS text FROM resolved",
    "chatml_prompt": f"SELECT conv_id, turn, {PROMPT_TEXT} AS prompt FROM conversations WHERE role = 'user'",
    "chatml_multiturn": f"""SELECT conv_id, count(*) AS n_turns,
  string_agg({block('role', f'trim(text, {WS})')}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
    "alias_resolve": f"{with_(PAIRS)}SELECT pair_id, instruction, command FROM resolved",
    "pairs_from_json": f"{with_(PAIRS)}SELECT pair_id, instruction, command FROM resolved",
    "stop_truncate": with_(MODELS, SUITE, SIM) + f"""SELECT model, suite, id,
  split_part(split_part(
    raw_prediction || CASE id % 3 WHEN 1 THEN {q(IM_END)} || {NL} || {q(fx.CHATTER)}
                               WHEN 2 THEN {q(IM_START + 'assistant')} || {NL} || raw_prediction
                               ELSE '' END,
    {q(IM_END)}, 1), {q(IM_START)}, 1) AS cut
FROM answers""",
    "ask_last_line": with_(MODELS, SUITE, SIM) + f"""SELECT model, suite, id,
  list_filter(string_split(replace(raw_prediction, chr(13), ''), {NL}), lambda l: trim(l, {BLANK}) <> '')[-1] AS last_line
FROM answers""",
    "clean_command": with_(MODELS, SUITE, SIM) + f"SELECT model, suite, id, {clean_sql('raw_prediction')} AS clean_prediction FROM answers",
    "seq_budget": f"""WITH t AS (SELECT doc_id, {tokens_sql('text')} AS tok FROM documents)
SELECT doc_id, CAST(len(tok) AS BIGINT) AS n_tokens, len(tok) > {SEQ_BUDGET_TOKENS} AS over_budget,
  CAST(len(list_slice(tok, 1, {SEQ_BUDGET_TOKENS})) AS BIGINT) AS kept_n,
  md5(array_to_string(list_slice(tok, 1, {SEQ_BUDGET_TOKENS}), ' ')) AS kept_md5
FROM t""",
    "token_counts": EVAL + "SELECT model, suite, id, side, CAST(n AS BIGINT) AS n, gram, count(*) AS cnt FROM grams GROUP BY ALL",
    "ngram_overlap": EVAL + """SELECT c.model, c.suite, c.id, CAST(o.n AS BIGINT) AS n,
  CAST(greatest(len(t.pt) - o.n + 1, 0) AS BIGINT) AS pred_ngrams,
  CAST(greatest(len(t.gt) - o.n + 1, 0) AS BIGINT) AS gold_ngrams,
  CAST(coalesce(v.m, 0) AS BIGINT) AS matched
FROM cleaned c JOIN tok t ON t.model = c.model AND t.suite = c.suite AND t.id = c.id
CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n) o
LEFT JOIN ov v ON v.model = c.model AND v.suite = c.suite AND v.id = c.id AND v.n = o.n""",
    "exact_match": EVAL + "SELECT model, suite, id, em FROM scored",
    "token_f1": EVAL + "SELECT model, suite, id, f1 FROM scored",
    "bleu4": EVAL + "SELECT model, suite, id, bleu4 FROM scored",
    "single_line": EVAL + "SELECT model, suite, id, CAST(single_line AS BIGINT) AS single_line FROM scored",
    "output_chars": EVAL + "SELECT model, suite, id, output_chars FROM scored",
    "eval_grid": with_(MODELS, SUITE) + "SELECT m.model, s.suite, s.id FROM suite s CROSS JOIN models m",
    "missing_default": with_(MODELS, SUITE, SIM, PAIRED) + "SELECT model, suite, id, raw_prediction, latency, is_error FROM paired",
    "response_dump": with_(MODELS, SUITE, SIM, DUMPED, PAIRED_DUMP) + """SELECT model, suite, id, raw_prediction, latency, is_error
FROM paired""",
    "failed_calls": with_(MODELS, SUITE) + f"""SELECT model, suite, reason, count(*) AS n_calls FROM (
  SELECT m.model, s.suite, CASE WHEN id % 2 = 0 THEN 'timeout' ELSE 'flagged' END AS reason
  FROM suite s CROSS JOIN models m
  WHERE id % {fx.SIM_MISSING_MOD} <> 0 AND (id % {fx.SIM_FAILED_MOD} = 0 OR id % {fx.SIM_RETRY_MOD} = 0)
  UNION ALL
  SELECT m.model, s.suite, 'malformed' FROM suite s CROSS JOIN models m
  WHERE id % {fx.SIM_MISSING_MOD} <> 0 AND id % {fx.SIM_FAILED_MOD} <> 0 AND id % {fx.SIM_CUT_MOD} = {fx.SIM_CUT_REST})
GROUP BY ALL""",
    "suite_union": f"""SELECT 'documents' AS suite, doc_id AS id, trim(replace(text, {NL}, ' '), {WS}) AS gold FROM documents
UNION ALL SELECT 'benchmark', item_id, trim(replace(text, {NL}, ' '), {WS}) FROM benchmark""",
    "sample_results": EVAL + """SELECT model, suite, id, nl, gold, raw_prediction, clean_prediction,
  em, f1, bleu4, latency, is_error FROM scored""",
    "positional_results": with_(MODELS, SUITE_BY_PLACE, SIM, PAIRED, scoring("paired")) + """SELECT model, suite, id, nl, gold,
  raw_prediction, clean_prediction, em, f1, bleu4, latency, is_error FROM scored""",
    "json_report": EVAL + """SELECT model, suite, id, nl, gold, raw_prediction, clean_prediction,
  em, f1, bleu4, latency, is_error FROM scored""",
    "json_summary": EVAL + SUMMARY_SELECT,
    "json_models": with_(MODELS) + """SELECT model, CASE model WHEN 'base' THEN 'simulated base' ELSE 'simulated tuned' END AS label,
  CAST((SELECT count(*) FROM documents) AS BIGINT) AS num_samples FROM models""",
    "suite_summary": EVAL + SUMMARY_SELECT,
    "model_compare": EVAL + ", " + COMPARE + "\nSELECT suite, metric, metric_ord, base, tuned, delta FROM cmp",
    "markdown_report": MARKDOWN,
    "train_plan": f"""{with_(PAIRS)}, k AS (
  SELECT pair_id, md5('{TRAIN_SEED}:' || CAST(pair_id AS VARCHAR)) AS order_key FROM resolved),
r AS (SELECT *, row_number() OVER (ORDER BY order_key, pair_id) AS rank FROM k)
SELECT pair_id, order_key, CAST(rank AS BIGINT) AS rank,
  CAST(floor((rank - 1) / {ROWS_PER_STEP}) + 1 AS BIGINT) AS step
FROM r WHERE rank <= {TRAIN_MAX_STEPS * ROWS_PER_STEP}""",
    "train_order": f"""{with_(PAIRS)}, k AS (
  SELECT pair_id, md5('{TRAIN_SEED}:' || CAST(pair_id AS VARCHAR)) AS order_key FROM resolved),
r AS (SELECT *, row_number() OVER (ORDER BY order_key, pair_id) AS rank FROM k)
SELECT pair_id, order_key, CAST(rank AS BIGINT) AS rank, CAST(floor((rank - 1) / {ROWS_PER_STEP}) + 1 AS BIGINT) AS step FROM r""",
    "corpus_size": f"""{with_(PAIRS)}SELECT count(*) AS n_rows, CAST(sum(length({TRAIN_TEXT})) AS BIGINT) AS n_chars
FROM resolved""",
    "loss_convergence": f"""SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS n_logged,
  min(event_id) AS first_step, max(event_id) AS last_step,
  arg_min(value, event_id) AS first_loss, arg_max(value, event_id) AS final_loss,
  min(value) AS min_loss, {rnd('avg(value)', 6)} AS mean_loss,
  (max(epoch_us(ts)) - min(epoch_us(ts))) / 1000000.0{D} AS runtime_sec,
  arg_min(value, event_id) - arg_max(value, event_id) AS loss_drop
FROM events GROUP BY user_id""",
    "peak_memory": f"""WITH g AS (
  SELECT user_id, count(*) AS n_samples, max({RESERVED}) AS peak_reserved_bytes,
         CAST({fx.GPU_TOTAL_GIB * (1 << 30)} AS BIGINT) AS total_bytes
  FROM events GROUP BY user_id),
u AS (SELECT *, {rnd('peak_reserved_bytes / 1073741824.0::DOUBLE', 3)} AS used_gib,
             {rnd('total_bytes / 1073741824.0::DOUBLE', 3)} AS total_gib FROM g)
SELECT CAST(user_id AS VARCHAR) AS run_id, n_samples, peak_reserved_bytes, total_bytes, used_gib, total_gib,
  CASE WHEN total_gib = 0 THEN NULL ELSE {rnd('used_gib / total_gib * 100.0::DOUBLE', 2)} END AS used_pct
FROM u""",
    "peak_memory_by_label": f"""WITH g AS (
  SELECT user_id, event_type AS label, count(*) AS n_samples, max({RESERVED}) AS peak_reserved_bytes,
         CAST({fx.GPU_TOTAL_GIB * (1 << 30)} AS BIGINT) AS total_bytes
  FROM events GROUP BY user_id, event_type),
u AS (SELECT *, {rnd('peak_reserved_bytes / 1073741824.0::DOUBLE', 3)} AS used_gib,
             {rnd('total_bytes / 1073741824.0::DOUBLE', 3)} AS total_gib FROM g)
SELECT CAST(user_id AS VARCHAR) AS run_id, label, n_samples, peak_reserved_bytes, total_bytes, used_gib, total_gib,
  CASE WHEN total_gib = 0 THEN NULL ELSE {rnd('used_gib / total_gib * 100.0::DOUBLE', 2)} END AS used_pct
FROM u""",
    "log_tail": f"""SELECT run_id, step, ts, loss, CAST(rn AS BIGINT) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS rn FROM ({RUN_LOG}))
WHERE rn <= {LOG_TAIL_LINES}""",
    "stream_log_tail": RUN_LOG,
    "stream_growing_log": RUN_LOG,
    "train_log_records": f"""SELECT 'step' AS kind, step, loss, 0.5{D} AS grad_norm, 0.00002{D} AS learning_rate FROM ({RUN_LOG})""",
    "stream_eval": with_(MODELS, SUITE, SIM, f"""present AS (
  SELECT r.model, r.suite, r.id, s.gold, coalesce(trim(r.raw_prediction, {WS}), '') AS raw_prediction, r.latency
  FROM sim r JOIN suite s ON s.suite = r.suite AND s.id = r.id)""",
                         scoring("present")) + f"SELECT {SUMMARY_COLS} FROM scored GROUP BY model, suite",
    "stream_telemetry": f"""WITH w AS (
  SELECT date_trunc('day', ts) AS window_start, event_type AS label, count(*) AS n_samples,
         max({RESERVED}) AS peak_reserved_bytes
  FROM events GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, label, n_samples, peak_reserved_bytes
FROM w""",
    "stream_late_rows": "SELECT event_type AS label, CAST(count(*) AS BIGINT) AS n_events FROM events GROUP BY event_type",
    "stream_loss_windows": f"""WITH w AS (
  SELECT date_trunc('day', ts) AS window_start, CAST(user_id AS VARCHAR) AS run_id, count(*) AS n_logged,
         {rnd('avg(value)', 6)} AS mean_loss, arg_max(value, event_id) AS last_loss
  FROM events GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, run_id, n_logged, mean_loss, last_loss
FROM w""",
}
