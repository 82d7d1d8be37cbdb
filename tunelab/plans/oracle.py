"""The registered queries in plain SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from tunelab.functions.prompts import JUDGMENT_PROMPT, MCQ_PROMPT
from tunelab.plans.derived import duckdb_with

RUN = "'^lr([0-9.e-]+)_r([0-9]+)_(lora|full)_([0-9]+)B'"

PARSED = f"""parsed AS (
  SELECT *, regexp_matches(name, {RUN}) AS is_grid_run,
         TRY_CAST(nullif(regexp_extract(name, {RUN}, 1), '') AS DOUBLE) AS learning_rate,
         CASE WHEN regexp_extract(name, {RUN}, 3) = 'lora'
              THEN CAST(regexp_extract(name, {RUN}, 2) AS INT) END AS lora_rank,
         nullif(regexp_extract(name, {RUN}, 3), '') AS method,
         CASE WHEN regexp_matches(name, {RUN}) THEN regexp_extract(name, {RUN}, 4) || 'B' END AS model_size
  FROM runs)"""

LOSSES = """loss_points AS (
  SELECT name, step, loss_1 AS loss, 1 AS choice FROM history WHERE loss_1 IS NOT NULL
  UNION ALL SELECT name, step, loss_2, 2 FROM history WHERE loss_2 IS NOT NULL),
losses AS (
  SELECT h.name, l.loss AS final_loss FROM (SELECT DISTINCT name FROM history) h LEFT JOIN (
    SELECT * FROM loss_points
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY choice, step DESC NULLS LAST, loss DESC) = 1) l
  ON h.name = l.name),
lossy AS (SELECT p.*, l.final_loss FROM parsed p LEFT JOIN losses l ON p.name = l.name)"""

DIVERGED = "(model_size = '70B' AND lora_rank = 1 AND learning_rate = 1e-3)"
GOOD = f"""good AS (SELECT * FROM lossy WHERE state = 'finished' AND final_loss < 2.0)"""
RATE = "replace(format('{:.0e}', %s), 'e-0', 'e-')"

PRED = """CASE WHEN lower(generated_answer) LIKE '%dismissal%' OR lower(generated_answer) LIKE '%dismissed%' THEN 0
            WHEN lower(generated_answer) LIKE '%approval%' OR lower(generated_answer) LIKE '%approved%' THEN 1
            ELSE -1 END"""
JUDGED = f"judged AS (SELECT *, {PRED} AS pred FROM judgment)"

LETTER = """CASE WHEN {i} < 26 THEN chr(CAST(65 + {i} AS INT))
               ELSE chr(CAST(64 + floor({i} / 26.0) AS INT)) || chr(CAST(65 + {i} % 26 AS INT)) END"""
CHOSEN = r"""coalesce(list_last(regexp_extract_all(generated_text, '###([A-Z]+)###', 1)), 'None')"""
ANSWERS = f"""answers AS (
  SELECT *, {LETTER.format(i="gold")} AS gold_letter, {CHOSEN} AS pred FROM mcq)"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _template(template: str, **fields: str) -> str:
    """A template as an SQL expression that joins its texts and fields."""
    sql = _text(template)
    for name, expr in fields.items():
        sql = sql.replace("{" + name + "}", f"' || {expr} || '")
    return f"({sql})"


def _or_none(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), 'None')"


CASE_PROMPT = _template(
    JUDGMENT_PROMPT,
    **{f: _or_none(f) for f in ("year", "language", "source_language", "region", "canton", "legal_area", "text")},
)
CHAT_PROMPT = f"('<|im_start|>user' || chr(10) || {CASE_PROMPT} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10))"
CHOICE_LINES = "array_to_string(list_transform(range(n_choices), lambda i: chr(10) || {letter} || '. option ' || i), '')"
ITEM_PROMPT = _template(
    MCQ_PROMPT,
    course_name=_or_none("course"),
    question="question || " + CHOICE_LINES.format(letter=LETTER.format(i="i")),
)
LENGTHS = f"""lens AS (
  SELECT subset, len(regexp_extract_all({ITEM_PROMPT}, '[^ \\t\\n\\r\\f]+')) AS x FROM mcq)"""

REPORT = """
cells AS (SELECT {keys} gold, pred, count(*) AS n FROM {source} GROUP BY ALL),
labels AS ({labels}),
classes AS (
  SELECT {lkeys} l.label,
         coalesce(sum(n) FILTER (c.gold = l.label AND c.pred = l.label), 0) AS hits,
         coalesce(sum(n) FILTER (c.gold = l.label), 0) AS support,
         coalesce(sum(n) FILTER (c.pred = l.label), 0) AS predicted
  FROM labels l LEFT JOIN cells c ON {on} GROUP BY ALL),
rated AS (
  SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS p,
         CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS r,
         CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted)::DOUBLE ELSE 0 END AS f
  FROM classes)"""

GRID_REPORT = REPORT.format(
    keys="model_folder, subset,",
    source="(SELECT model_folder, subset, gold_letter AS gold, pred FROM answers)",
    labels="SELECT model_folder, subset, gold AS label FROM cells UNION SELECT model_folder, subset, pred FROM cells",
    lkeys="l.model_folder, l.subset,",
    on="c.model_folder = l.model_folder AND c.subset = l.subset",
)
CASE_REPORT = REPORT.format(
    keys="",
    source="(SELECT label AS gold, pred FROM judged)",
    labels="SELECT unnest([0, 1]) AS label",
    lkeys="",
    on="TRUE",
)

GRID_POINTS = """points AS (
  SELECT m.model_size, x.method, x.learning_rate, x.lora_rank, m.i AS i, x.j AS j, x.k AS k, x.l AS l
  FROM (SELECT * FROM (VALUES ('8B', 0), ('70B', 1)) t(model_size, i)) m, (
    SELECT 'lora' AS method, 0 AS j, r.learning_rate, r.k, q.lora_rank, q.l
    FROM (VALUES (1e-6::DOUBLE, 0), (1e-5, 1), (1e-4, 2), (1e-3, 3)) r(learning_rate, k),
         (SELECT CAST(power(2, l) AS INT) AS lora_rank, l FROM range(10) g(l)) q
    UNION ALL
    SELECT 'full', 1, r.learning_rate, r.k, 1, 0 FROM (VALUES (1e-6::DOUBLE, 0), (1e-5, 1), (1e-4, 2)) r(learning_rate, k)) x),
gaps AS (
  SELECT p.* FROM points p WHERE NOT EXISTS (
    SELECT 1 FROM parsed r WHERE r.state = 'finished' AND r.model_size = p.model_size AND r.method = p.method
      AND r.learning_rate = p.learning_rate AND (p.method = 'full' OR r.lora_rank = p.lora_rank)))"""

STATUS = """fin AS (
  SELECT *, CASE WHEN is_grid_run THEN 'grid' ELSE 'other' END AS kind FROM parsed WHERE state = 'finished'),
stored AS (SELECT DISTINCT name FROM fin WHERE created_at < TIMESTAMP '2024-01-01 02:00:00'),
ranked AS (
  SELECT f.*, s.name IS NOT NULL AS is_stored,
         coalesce(bool_or(has_history) OVER (PARTITION BY f.name ORDER BY created_at, run_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS had_one
  FROM fin f LEFT JOIN stored s ON f.name = s.name),
status AS (
  SELECT *, CASE WHEN is_stored OR had_one THEN 'skipped' WHEN has_history THEN 'downloaded' ELSE 'failed' END AS status
  FROM ranked)"""

BENCH_LONG = """long AS (
  SELECT CASE WHEN model_folder LIKE '%70B%' THEN '70B' ELSE '8B' END AS model_size,
         CAST(substr(split_part(model_folder, '_', 1), 3) AS DOUBLE) AS learning_rate,
         CAST(substr(split_part(model_folder, '_', 2), 2) AS INT) AS lora_rank, name, metric, value AS accuracy
  FROM bench WHERE value IS NOT NULL AND name <> 'other-evaluation')"""
MEAN_LOSS = """mean_loss AS (
  SELECT model_size, learning_rate, lora_rank, round(avg(final_loss), 8) AS final_loss
  FROM lossy WHERE method = 'lora' GROUP BY ALL)"""
MERGED = f"""merged AS (
  SELECT l.*, m.final_loss FROM long l LEFT JOIN mean_loss m USING (model_size, learning_rate, lora_rank)
  WHERE NOT (l.model_size = '70B' AND l.lora_rank = 1 AND l.learning_rate = 1e-3))"""

FIRST_RUN = """(SELECT * FROM parsed WHERE state = 'finished' AND method = 'lora'
   QUALIFY row_number() OVER (PARTITION BY model_size, learning_rate, lora_rank ORDER BY created_at, run_id) = 1)"""


CURVES = f"""shown AS (
  SELECT model_size, learning_rate AS panel, method, lora_rank, learning_rate, name FROM {FIRST_RUN}
  WHERE (model_size = '8B' AND lora_rank <= 256) OR (model_size = '70B' AND lora_rank IN (16, 64, 512))),
pairs AS (SELECT * FROM (VALUES (1e-3::DOUBLE, 1e-4::DOUBLE), (1e-4, 1e-5), (1e-5, 1e-6)) t(panel, full_rate)),
first_full AS (
  SELECT * FROM parsed WHERE state = 'finished' AND method = 'full'
  QUALIFY row_number() OVER (PARTITION BY model_size, learning_rate ORDER BY created_at, run_id) = 1),
chosen AS (
  SELECT * FROM shown
  UNION ALL
  SELECT f.model_size, p.panel, f.method, f.lora_rank, f.learning_rate, f.name FROM first_full f
  JOIN pairs p ON p.full_rate = f.learning_rate
  WHERE EXISTS (SELECT 1 FROM shown s WHERE s.model_size = f.model_size AND s.panel = p.panel)),
curves AS (
  SELECT c.model_size, {RATE % 'c.panel'} AS lr, CASE c.panel WHEN 1e-3 THEN 1 WHEN 1e-4 THEN 2 WHEN 1e-5 THEN 3 WHEN 1e-6 THEN 4 END AS panel_place, c.method, c.lora_rank, {RATE % 'c.learning_rate'} AS run_lr, c.name,
         h.step, h.loss_1 AS loss
  FROM chosen c JOIN history h ON h.name = c.name AND h.loss_1 IS NOT NULL)"""


def _sql(views: tuple[str, ...], *parts: str) -> str:
    """``WITH`` the views and further steps; the last part is the query."""
    steps = [duckdb_with(*views)] if views else []
    steps += parts[:-1]
    return (f"WITH {', '.join(steps)}\n" if steps else "") + parts[-1]


R, RH = ("runs",), ("runs", "history")
LOSSY = (PARSED, LOSSES)

ORACLE: dict[str, str] = {
    "src_dataset": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "src_multi_folder_union": _sql(
        ("cases",), "SELECT row_id, source AS folder, label, generated_answer FROM cases"
    ),
    "src_run_results": _sql(
        ("judgment",),
        JUDGED,
        """SELECT run_group, run_name,
                  sum(CASE WHEN run_name <> 'unknown-run-17' AND label = pred THEN 1 ELSE 0 END)::DOUBLE / count(*) AS accuracy
           FROM judged WHERE run_name <> 'unknown-run-18' GROUP BY ALL""",
    ),
    "src_checkpoint_tree": _sql(
        ("checkpoints",),
        """SELECT model_folder, path AS checkpoint_path, 'checkpoint-467' AS checkpoint_name FROM checkpoints
           WHERE path LIKE '%/checkpoint-467'""",
    ),
    "metric_history": _sql(
        ("judgment",),
        JUDGED,
        """SELECT run_name AS name, 'eval_accuracy' AS metric, 'evaluation-1' AS batch,
                  sum((label = pred)::INT)::DOUBLE / count(*) AS value FROM judged GROUP BY run_name""",
    ),
    "ingest_quarantine": _sql(
        RH,
        f"""files AS (SELECT DISTINCT name, regexp_matches(name, {RUN}) AS is_grid, name LIKE '%70B%' AS bad FROM history)""",
        """SELECT CASE WHEN is_grid THEN 'grid' ELSE 'other' END AS kind, count(*) AS total,
                  count(*) FILTER (NOT bad) AS downloaded, count(*) FILTER (false) AS skipped, count(*) FILTER (bad) AS failed
           FROM files GROUP BY ALL""",
    ),
    "eval_accuracy": _sql(
        ("judgment",), JUDGED, "SELECT sum((label = pred)::INT)::DOUBLE / count(*) AS accuracy FROM judged"
    ),
    "eval_accuracy_by_run": _sql(
        ("judgment",),
        JUDGED,
        """SELECT run_group, run_name, sum((label = pred)::INT)::DOUBLE / count(*) AS accuracy
           FROM judged GROUP BY ALL""",
    ),
    "eval_parse_errors": _sql(
        ("judgment",),
        JUDGED,
        """SELECT count(*) AS total_rows, count(*) FILTER (pred = -1) AS parse_errors,
                  round(count(*) FILTER (pred = -1) * 100.0::DOUBLE / count(*), 2) AS parse_error_percent FROM judged""",
    ),
    "eval_class_report": _sql(
        ("judgment",),
        JUDGED,
        CASE_REPORT.lstrip(),
        """SELECT CASE label WHEN 0 THEN 'Dismissal (0)' ELSE 'Approval (1)' END AS class, round(p, 10) AS precision,
                  round(r, 10) AS recall, round(f, 10) AS f1, support::BIGINT AS support FROM rated
           UNION ALL
           SELECT 'micro avg', round(sum(hits) / sum(predicted)::DOUBLE, 10), round(sum(hits) / sum(support)::DOUBLE, 10),
                  round(2 * sum(hits) / sum(support + predicted)::DOUBLE, 10), sum(support)::BIGINT FROM rated
           WHERE EXISTS (SELECT 1 FROM judged WHERE pred NOT IN (0, 1))
           UNION ALL
           SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support)::DOUBLE, 10), sum(support)::BIGINT FROM rated
           HAVING NOT EXISTS (SELECT 1 FROM judged WHERE pred NOT IN (0, 1))
           UNION ALL
           SELECT 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10), sum(support)::BIGINT FROM rated
           UNION ALL
           SELECT 'weighted avg', round(sum(p * support) / sum(support), 10), round(sum(r * support) / sum(support), 10),
                  round(sum(f * support) / sum(support), 10), sum(support)::BIGINT FROM rated""",
    ),
    "mcq_gold_label": _sql(
        ("mcq",),
        """asked AS (SELECT row_id, gold * 2 - 3 AS gold_index, n_choices,
                     CASE WHEN gold * 2 - 3 < 0 THEN gold * 2 - 3 + n_choices ELSE gold * 2 - 3 END AS i FROM mcq)""",
        f"""SELECT row_id, gold_index, n_choices, CASE WHEN i < n_choices THEN {LETTER.format(i="i")} END AS gold_label,
                   i >= n_choices AS out_of_range FROM asked""",
    ),
    "mcq_predictions": _sql(
        ("mcq",),
        ANSWERS,
        f"""SELECT row_id, model_folder, subset, {ITEM_PROMPT} AS prompt, gold_letter AS gold, pred AS prediction,
                   generated_text, gold_letter = pred AS correct FROM answers""",
    ),
    "mcq_other_pattern": _sql(
        ("mcq",),
        r"""SELECT row_id, coalesce(list_last(regexp_extract_all(generated_text, '(?:thought|Answer:) ###([A-Z])', 1)), 'None')
                   AS prediction FROM mcq""",
    ),
    "mcq_literal_choices": """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 3 THEN 0 END::INT AS n,
        CASE doc_id % 5 WHEN 0 THEN 'it''s ' || w || '|a "b" c|None' WHEN 1 THEN '1|2.5|True|' || w WHEN 3 THEN '' END AS choices
        FROM (SELECT doc_id, regexp_extract(text, '[a-zA-Z]+') AS w FROM documents)""",
    "mcq_class_report": _sql(
        ("mcq",),
        ANSWERS,
        GRID_REPORT.lstrip(),
        """SELECT model_folder, subset, label AS class, round(p, 10) AS precision, round(r, 10) AS recall,
                  round(f, 10) AS f1, support::BIGINT AS support FROM rated
           UNION ALL
           SELECT model_folder, subset, 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10),
                  sum(support)::BIGINT FROM rated GROUP BY model_folder, subset
           UNION ALL
           SELECT model_folder, subset, 'weighted avg', round(sum(p * support) / sum(support), 10),
                  round(sum(r * support) / sum(support), 10), round(sum(f * support) / sum(support), 10),
                  sum(support)::BIGINT FROM rated GROUP BY model_folder, subset""",
    ),
    "mcq_confusion": _sql(
        ("mcq",),
        ANSWERS,
        "SELECT model_folder, subset, gold_letter AS gold, pred, count(*) AS n FROM answers GROUP BY ALL",
    ),
    "mcq_pred_distribution": _sql(
        ("mcq",), ANSWERS, "SELECT model_folder, subset, pred, count(*) AS n FROM answers GROUP BY ALL"
    ),
    "mcq_label_union": _sql(
        ("mcq",),
        ANSWERS,
        """labels AS (SELECT model_folder, subset, gold_letter AS label FROM answers
                      UNION SELECT model_folder, subset, pred FROM answers)""",
        """SELECT *, CAST(row_number() OVER (PARTITION BY model_folder, subset ORDER BY label) AS INT) AS place
           FROM labels""",
    ),
    "eval_grid_results": _sql(
        ("mcq",),
        ANSWERS,
        """SELECT model_folder, 'checkpoint-467' AS checkpoint, subset,
                  sum((gold_letter = pred)::INT)::DOUBLE / count(*) AS accuracy,
                  count(*) FILTER (gold_letter = pred) AS correct, count(*) AS total,
                  round(sum(length(generated_text)) / 100.0, 6)::DOUBLE AS generation_time
           FROM answers GROUP BY model_folder, subset""",
    ),
    "eval_leaderboard": _sql(
        ("mcq",),
        ANSWERS,
        """scored AS (SELECT subset, model_folder, avg((gold_letter = pred)::INT) AS accuracy
                      FROM answers GROUP BY ALL)""",
        """SELECT subset, CAST(row_number() OVER (PARTITION BY subset ORDER BY accuracy DESC, model_folder) AS INT) AS place,
                  model_folder, accuracy FROM scored""",
    ),
    "grid_answers": _sql(
        ("mcq",),
        """SELECT row_id, m.model_folder,
                  '###' || substr('ABCD', CAST((length(question) + length(m.model_folder)) % 4 + 1 AS INT), 1) || '###' AS generated_text
           FROM mcq, (SELECT unnest(['lora_8B', 'lora_70B']) AS model_folder) m""",
    ),
    "prompt_length_tokens": _sql(
        ("mcq",),
        "lens AS (SELECT subset, len(string_split(coalesce(question, ''), ' ')) AS x FROM mcq)",
        """SELECT subset, min(x)::INT AS min, max(x)::INT AS max, round(avg(x), 6) AS mean,
                  round(quantile_cont(x, 0.5), 6)::DOUBLE AS median, round(stddev_pop(x), 6) AS std,
                  round(quantile_cont(x, 0.95), 6)::DOUBLE AS p95, round(quantile_cont(x, 0.99), 6)::DOUBLE AS p99,
                  count(*) AS count FROM lens GROUP BY subset""",
    ),
    "prompt_length_stats": _sql(
        ("mcq",),
        LENGTHS,
        """SELECT subset, min(x)::INT AS min, max(x)::INT AS max, round(avg(x), 6) AS mean,
                  round(quantile_cont(x, 0.5), 6)::DOUBLE AS median, round(stddev_pop(x), 6) AS std,
                  round(quantile_cont(x, 0.95), 6)::DOUBLE AS p95, round(quantile_cont(x, 0.99), 6)::DOUBLE AS p99,
                  count(*) AS count FROM lens GROUP BY subset""",
    ),
    "prompt_length_hist": _sql(
        ("mcq",),
        LENGTHS,
        """lim AS (SELECT subset, CASE WHEN min(x) = max(x) THEN min(x) - 0.5::DOUBLE ELSE min(x)::DOUBLE END AS lo,
                          CASE WHEN min(x) = max(x) THEN max(x) + 0.5::DOUBLE ELSE max(x)::DOUBLE END AS hi
                   FROM lens GROUP BY subset)""",
        """edges AS (SELECT subset, CAST(b AS INT) AS bin, lo + b * ((hi - lo) / 50) AS a,
                            lo + (b + 1) * ((hi - lo) / 50) AS z FROM lim, range(50) g(b))""",
        """SELECT e.subset, e.bin, round(e.a, 6) AS bin_start, count(l.x) AS n
           FROM edges e LEFT JOIN lens l ON l.subset = e.subset AND l.x >= e.a AND (l.x < e.z OR e.bin = 49)
           GROUP BY e.subset, e.bin, e.a""",
    ),
    "prep_judgment_messages": _sql(
        ("judgment",),
        f"""SELECT 2::INT AS n_messages, 'user' AS first_role, {CASE_PROMPT} AS first_content,
                   'assistant' AS second_role,
                   CASE label WHEN 0 THEN 'dismissal' WHEN 1 THEN 'approval' END AS second_content
            FROM judgment WHERE toxic = 0""",
    ),
    "prep_default_text": """SELECT doc_id, lang, source, n_chars,
        to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'n_chars': n_chars})::VARCHAR AS text FROM documents""",
    "prompt_judgment": _sql(("cases",), f"SELECT row_id, {CHAT_PROMPT} AS prompt FROM cases"),
    "prompt_default": _sql(("cases",), "SELECT row_id, text AS prompt, '' AS absent_prompt FROM cases"),
    "mcq_prompt": _sql(("mcq",), f"SELECT row_id, subset, n_choices, {ITEM_PROMPT} AS prompt FROM mcq"),
    "conversations_to_messages": """SELECT conv_id, count(*)::INT AS n_messages,
        string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS messages FROM conversations GROUP BY conv_id""",
    "render_chat": """SELECT conv_id,
        string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
          || '<|im_start|>assistant' || chr(10) AS chat FROM conversations GROUP BY conv_id""",
    "batch_generate": _sql(
        ("cases",),
        f"""SELECT row_id, label, CASE WHEN length({CHAT_PROMPT}) % 2 = 0 THEN 'dismissal' ELSE 'approval' END
                   AS generated_answer FROM cases""",
    ),
    "generate_resumed": _sql(
        ("cases",),
        f"""SELECT row_id, label, CASE WHEN length({CHAT_PROMPT}) % 2 = 0 THEN 'dismissal' ELSE 'approval' END
                   AS generated_answer FROM cases""",
    ),
    "slice_rows": """SELECT event_id, user_id, event_type, value, props FROM events
        ORDER BY event_id LIMIT 800 OFFSET 100""",
    "shard_contiguous": """SELECT event_id, user_id, CAST(ntile(7) OVER (ORDER BY event_id) - 1 AS INT) AS shard
        FROM events""",
    "debug_head": "SELECT doc_id, text, source FROM documents ORDER BY doc_id LIMIT 100",
    "runs_parse_names": _sql(
        R,
        PARSED,
        """SELECT run_id, name, state, is_grid_run, model_size, method, learning_rate, lora_rank FROM parsed""",
    ),
    "runs_overview": _sql(
        R,
        """SELECT name, run_id::VARCHAR AS id, state, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
                  '{"run_name":"' || name || '","host":"node"}' AS config, '{"events":"' || n_events || '"}' AS summary
           FROM runs""",
    ),
    "runs_filter": _sql(
        R,
        PARSED,
        """SELECT run_id, name, learning_rate, lora_rank FROM parsed
           WHERE state = 'finished' AND model_size = '8B' AND method = 'lora' AND learning_rate = 1e-4""",
    ),
    "runs_summary": _sql(
        R,
        PARSED,
        f"""SELECT count(*) AS total_runs, count(*) FILTER (is_grid_run) AS grid_runs,
                   count(*) FILTER (method = 'lora') AS lora_runs, count(*) FILTER (method = 'full') AS full_ft_runs,
                   count(*) FILTER (NOT is_grid_run) AS other_runs,
                   (SELECT string_agg({RATE % 'v'}, ',' ORDER BY v)
                    FROM (SELECT DISTINCT learning_rate AS v FROM parsed WHERE learning_rate IS NOT NULL)) AS learning_rates,
                   (SELECT string_agg(v::VARCHAR, ',' ORDER BY v)
                    FROM (SELECT DISTINCT lora_rank AS v FROM parsed WHERE lora_rank IS NOT NULL)) AS lora_ranks,
                   (SELECT string_agg(v, ',' ORDER BY v)
                    FROM (SELECT DISTINCT model_size AS v FROM parsed WHERE model_size IS NOT NULL)) AS model_sizes
            FROM parsed""",
    ),
    "runs_state_counts": _sql(R, "SELECT state, count(*) AS n FROM runs GROUP BY state"),
    "runs_size_counts": _sql(
        R, PARSED, "SELECT model_size, count(*) AS n FROM parsed WHERE is_grid_run GROUP BY model_size"
    ),
    "runs_first_per_config": _sql(
        R,
        PARSED,
        """SELECT model_size, method, learning_rate, lora_rank, run_id, name FROM parsed
           WHERE state = 'finished' AND is_grid_run
           QUALIFY row_number() OVER (PARTITION BY model_size, method, learning_rate, lora_rank
                                      ORDER BY created_at, run_id) = 1""",
    ),
    "runs_grid_semi": _sql(
        R,
        PARSED,
        """SELECT run_id, name, CASE WHEN name IN (SELECT name FROM parsed WHERE state = 'finished' AND is_grid_run)
                                     THEN 'grid' ELSE 'other' END AS kind FROM parsed""",
    ),
    "runs_update_final_loss": _sql(RH, *LOSSY, "SELECT run_id, name, final_loss FROM lossy"),
    "runs_with_final_loss": _sql(
        RH,
        *LOSSY,
        """SELECT run_id, name || '_' || strftime(created_at, '%Y-%m-%d_%H-%M-%S') AS stamped, final_loss,
                  'Final Loss' AS title FROM lossy WHERE is_grid_run""",
    ),
    "runs_attach_accuracy": _sql(
        ("judgment", "runs"),
        JUDGED,
        "acc AS (SELECT run_name, avg((label = pred)::INT) AS a FROM judged GROUP BY run_name)",
        """SELECT r.run_id, r.name, coalesce(a.a, CASE WHEN r.state = 'failed' THEN 0.5::DOUBLE END) AS eval_accuracy
           FROM runs r LEFT JOIN acc a ON a.run_name = r.name""",
    ),
    "runs_matched_accuracy": _sql(
        ("judgment", "runs"),
        JUDGED,
        "acc AS (SELECT run_name, avg((label = pred)::INT) AS a FROM judged GROUP BY run_name)",
        "SELECT r.run_id, r.name, a.a AS eval_accuracy FROM runs r JOIN acc a ON a.run_name = r.name",
    ),
    "runs_unmatched": _sql(
        ("judgment", "runs"),
        JUDGED,
        """SELECT run_name AS name, avg((label = pred)::INT) AS eval_accuracy FROM judged
           WHERE run_name NOT IN (SELECT name FROM runs) GROUP BY run_name""",
    ),
    "ingest_new_runs": _sql(
        R, PARSED, STATUS, "SELECT run_id, name, kind FROM fin WHERE name NOT IN (SELECT name FROM stored)"
    ),
    "ingest_status": _sql(R, PARSED, STATUS, "SELECT run_id, name, kind, status FROM status"),
    "ingest_stats": _sql(
        R,
        PARSED,
        STATUS,
        """SELECT kind, count(*) AS total, count(*) FILTER (status = 'downloaded') AS downloaded,
                  count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed
           FROM status GROUP BY kind""",
    ),
    "hist_final_loss": _sql(("history",), LOSSES.rsplit(",\nlossy", 1)[0], "SELECT name, final_loss FROM losses"),
    "hist_curve_stats": _sql(
        ("history",),
        """SELECT name, arg_max(loss_1, step) AS final_loss, min(loss_1) AS min_loss, round(avg(loss_1), 8) AS mean_loss,
                  count(*) AS num_steps FROM history WHERE loss_1 IS NOT NULL GROUP BY name""",
    ),
    "hist_custom_metric": _sql(
        ("history",),
        """SELECT name, count(loss_1) AS num_steps, round(max(loss_1) - min(loss_1), 8) AS spread
           FROM history WHERE loss_1 IS NOT NULL GROUP BY name""",
    ),
    "hist_last_100": _sql(
        ("history",),
        """SELECT name, step AS _step, loss_1 AS loss FROM history
           QUALIFY row_number() OVER (PARTITION BY name ORDER BY step DESC) <= 100""",
    ),
    "grid_run_ids": _sql(
        R,
        PARSED,
        f"""names AS (
          SELECT m.model_size, 'lora' AS method, r.lora_rank,
                 'lr' || {RATE % 'l.learning_rate'} || '_r' || r.lora_rank || '_lora_' || m.model_size AS run_id
          FROM (SELECT DISTINCT model_size FROM parsed WHERE is_grid_run) m,
               (SELECT DISTINCT learning_rate FROM parsed WHERE method = 'lora') l,
               (SELECT DISTINCT lora_rank FROM parsed WHERE method = 'lora') r)""",
        """SELECT model_size, method, lora_rank, run_id, 'sft-' || run_id AS job_name, '/out/' || run_id AS output_dir
           FROM names""",
    ),
    "grid_missing": _sql(
        R, PARSED, GRID_POINTS, f"SELECT model_size, method, {RATE % 'learning_rate'} AS lr, lora_rank FROM gaps"
    ),
    "grid_missing_top10": _sql(
        R,
        PARSED,
        GRID_POINTS,
        f"""SELECT model_size, method, {RATE % 'learning_rate'} AS lr, lora_rank,
                   greatest(0, (SELECT count(*) FROM gaps) - 10) AS and_more
            FROM gaps ORDER BY i, j, k, l LIMIT 10""",
    ),
    "grid_coverage": _sql(
        R,
        PARSED,
        GRID_POINTS,
        """marked AS (SELECT p.model_size, CASE WHEN g.i IS NULL THEN 1 ELSE 0 END AS found FROM points p
                      LEFT JOIN gaps g ON p.i = g.i AND p.j = g.j AND p.k = g.k AND p.l = g.l)""",
        """SELECT coalesce(model_size, 'all') AS model_size, count(*) AS total_expected, sum(found)::BIGINT AS total_found,
                  round(100.0::DOUBLE * sum(found) / count(*), 6) AS coverage_percent
           FROM marked GROUP BY ROLLUP (model_size)""",
    ),
    "grid_pending": _sql(
        R,
        PARSED,
        GRID_POINTS,
        f"""plan AS (SELECT 'lr' || {RATE % 'learning_rate'} || '_r' || lora_rank || '_' || method || '_' || model_size
                            AS run_id FROM points)""",
        """SELECT run_id, 'sft-' || run_id AS job_name, '/out/' || run_id AS output_dir FROM plan
           WHERE run_id NOT IN (SELECT name FROM runs WHERE state IN ('running', 'finished'))""",
    ),
    "grid_pending_listed": _sql(
        R,
        PARSED,
        GRID_POINTS,
        f"""plan AS (SELECT 'lr' || {RATE % 'learning_rate'} || '_r' || lora_rank || '_' || method || '_' || model_size
                            AS run_id FROM points)""",
        """SELECT run_id, 'sft-' || run_id AS job_name, '/out/' || run_id AS output_dir FROM plan
           WHERE run_id NOT IN (SELECT name FROM runs WHERE state IN ('running', 'finished'))""",
    ),
    "ranks_available": _sql(
        R,
        PARSED,
        """SELECT DISTINCT model_size, lora_rank FROM parsed WHERE state = 'finished' AND method = 'lora'
           AND ((model_size = '8B' AND lora_rank <= 256) OR (model_size = '70B' AND lora_rank IN (16, 64, 512)))""",
    ),
    "ckpt_discover": _sql(
        ("checkpoints",),
        """SELECT model_folder, path AS checkpoint_path, 'checkpoint-467' AS checkpoint_name FROM checkpoints
           WHERE path LIKE '%/checkpoint-467'""",
    ),
    "ckpt_single_model": _sql(
        ("checkpoints",),
        """SELECT model_folder, path AS checkpoint_path, 'checkpoint-467' AS checkpoint_name FROM checkpoints
           WHERE path LIKE '%/checkpoint-467' AND model_folder = 'lr1e-4_r2_lora_70B'""",
    ),
    "ckpt_missing": _sql(
        ("checkpoints",),
        """SELECT DISTINCT model_folder FROM checkpoints WHERE model_folder NOT IN
           (SELECT model_folder FROM checkpoints WHERE path LIKE '%/checkpoint-467')""",
    ),
    "ckpt_adapter_info": _sql(
        ("checkpoints",),
        """SELECT path, model_folder, config IS NOT NULL AS is_lora,
                  CASE WHEN config IS NOT NULL THEN coalesce(json_extract_string(config, '$.base_model_name_or_path'), '')
                  END AS base_model,
                  CASE WHEN config IS NOT NULL THEN coalesce(CAST(json_extract_string(config, '$.r') AS INT), 64) END
                  AS lora_rank
           FROM checkpoints""",
    ),
    "ckpt_latest": _sql(
        ("checkpoints",),
        "steps AS (SELECT *, CAST(split_part(path, 'checkpoint-', 2) AS BIGINT) AS step FROM checkpoints)",
        "SELECT model_folder, arg_max(path, step) AS path, max(step) AS step FROM steps GROUP BY model_folder",
    ),
    "ckpt_run_info": _sql(("checkpoints",), "SELECT path, replace(path, '/grid/', '') AS run_info FROM checkpoints"),
    "sweep_lr_loss": _sql(
        RH,
        *LOSSY,
        GOOD,
        f"""SELECT model_size, method, lora_rank, learning_rate,
                   CAST(dense_rank() OVER (PARTITION BY model_size, method, lora_rank ORDER BY learning_rate) AS INT) AS place,
                   final_loss FROM good WHERE method IS NOT NULL AND coalesce(NOT {DIVERGED}, TRUE)
            QUALIFY count(*) OVER (PARTITION BY model_size, method, lora_rank) >= CASE method WHEN 'lora' THEN 2 ELSE 1 END""",
    ),
    "loss_by_lr_rank": _sql(
        RH,
        *LOSSY,
        """SELECT model_size, learning_rate, lora_rank, round(avg(final_loss), 8) AS final_loss FROM lossy
           WHERE method = 'lora' GROUP BY ALL""",
    ),
    "heatmap_pivot": _sql(
        RH,
        *LOSSY,
        f"""SELECT model_size, lora_rank, {RATE % 'learning_rate'} AS lr, round(avg(final_loss), 8) AS final_loss
            FROM lossy WHERE state = 'finished' AND method = 'lora' GROUP BY model_size, lora_rank, learning_rate""",
    ),
    "best_lr": _sql(
        RH,
        *LOSSY,
        GOOD,
        """SELECT model_size, method, learning_rate, final_loss FROM good WHERE is_grid_run
           QUALIFY row_number() OVER (PARTITION BY model_size, method ORDER BY final_loss, learning_rate) = 1""",
    ),
    "best_lr_per_rank": _sql(
        RH,
        *LOSSY,
        GOOD,
        """SELECT model_size, lora_rank, learning_rate, final_loss FROM good WHERE method = 'lora'
           QUALIFY row_number() OVER (PARTITION BY model_size, lora_rank ORDER BY final_loss, learning_rate) = 1""",
    ),
    "full_vs_lora_gap": _sql(
        RH,
        *LOSSY,
        GOOD,
        """least AS (SELECT model_size, min(final_loss) FILTER (method = 'lora') AS lora_loss,
                            min(final_loss) FILTER (method = 'full') AS full_loss FROM good WHERE is_grid_run GROUP BY 1)""",
        "SELECT *, round((lora_loss - full_loss) / lora_loss * 100, 6) AS gap_percent FROM least",
    ),
    "pair_lora_full": _sql(
        RH,
        *LOSSY,
        """fin AS (SELECT * FROM lossy WHERE state = 'finished' AND is_grid_run),
           pairs AS (SELECT * FROM (VALUES (1e-3::DOUBLE, 1e-4::DOUBLE), (1e-4, 1e-5), (1e-5, 1e-6)) t(lora_rate, full_rate)),
           firsts AS (SELECT * FROM fin WHERE method = 'full'
                      QUALIFY row_number() OVER (PARTITION BY model_size, learning_rate ORDER BY created_at, run_id) = 1)""",
        """SELECT l.model_size, p.lora_rate, p.full_rate, min(l.final_loss) AS lora_loss, f.name AS full_run,
                  f.final_loss AS full_loss
           FROM fin l JOIN pairs p ON l.learning_rate = p.lora_rate AND l.method = 'lora'
           LEFT JOIN firsts f ON f.model_size = l.model_size AND f.learning_rate = p.full_rate
           GROUP BY l.model_size, p.lora_rate, p.full_rate, f.name, f.final_loss""",
    ),
    "chart_learning_curves": _sql(RH, PARSED, CURVES, "SELECT * FROM curves"),
    "chart_curve_tail": _sql(
        RH,
        PARSED,
        CURVES,
        "SELECT * FROM curves QUALIFY row_number() OVER (PARTITION BY name ORDER BY step DESC) <= 100",
    ),
    "chart_model_comparison": _sql(
        RH,
        PARSED,
        f"""SELECT {RATE % 'r.learning_rate'} AS lr, r.lora_rank, h.step,
                   max(h.loss_1) FILTER (r.model_size = '8B') AS loss_8b,
                   max(h.loss_1) FILTER (r.model_size = '70B') AS loss_70b
            FROM {FIRST_RUN} r JOIN history h ON h.name = r.name AND h.loss_1 IS NOT NULL
            WHERE r.learning_rate IN (1e-3, 1e-4) AND r.lora_rank IN (64, 256) GROUP BY 1, 2, 3""",
    ),
    "chart_axis_limits": _sql(
        RH,
        *LOSSY,
        GOOD,
        """pooled AS (SELECT model_size, final_loss FROM good WHERE method = 'lora'
                      UNION ALL SELECT model_size, final_loss FROM good WHERE method = 'full')""",
        """SELECT model_size, round(min(final_loss) - (max(final_loss) - min(final_loss)) * 0.05::DOUBLE, 8) AS y_min,
                  round(max(final_loss) + (max(final_loss) - min(final_loss)) * 0.05::DOUBLE, 8) AS y_max
           FROM pooled GROUP BY model_size""",
    ),
    "chart_task_accuracy": _sql(
        ("task",),
        """SELECT model_size, lr, rank, round(log2(rank), 10) AS log2_rank, round(eval_accuracy * 100, 8) AS accuracy_percent
           FROM task WHERE NOT (model_size = '70B' AND rank = 1 AND lr = 1e-3)""",
    ),
    "chart_rank_series": _sql(
        ("task",),
        """SELECT model_size, lr, rank, eval_accuracy,
                  CAST(row_number() OVER (PARTITION BY model_size, lr ORDER BY rank) - 1 AS INT) AS position
           FROM task WHERE NOT (model_size = '70B' AND rank = 1 AND lr = 1e-3)""",
    ),
    "rank_plateau_gap": _sql(
        ("task",),
        "kept AS (SELECT * FROM task WHERE NOT (model_size = '70B' AND rank = 1 AND lr = 1e-3))",
        """SELECT k.model_size, k.lr, k.rank, round(b.best - k.eval_accuracy, 8) AS gap FROM kept k
           JOIN (SELECT model_size, lr, max(eval_accuracy) AS best FROM kept GROUP BY ALL) b USING (model_size, lr)""",
    ),
    "bench_unpivot": _sql(
        ("bench",), BENCH_LONG, "SELECT model_size, learning_rate, lora_rank, name, metric, accuracy FROM long"
    ),
    "bench_vs_loss": _sql(
        ("runs", "history", "bench"),
        *LOSSY,
        BENCH_LONG,
        MEAN_LOSS,
        MERGED,
        "SELECT model_size, learning_rate, lora_rank, name, accuracy, final_loss FROM merged",
    ),
    "chart_bench_series": _sql(
        ("runs", "history", "bench"),
        *LOSSY,
        BENCH_LONG,
        MEAN_LOSS,
        MERGED,
        """points AS (SELECT model_size, learning_rate, lora_rank, round(avg(accuracy), 8) AS accuracy,
                             max(final_loss) AS final_loss FROM merged GROUP BY ALL)""",
        """SELECT *, CAST(row_number() OVER (PARTITION BY model_size, learning_rate ORDER BY lora_rank) AS INT) AS place
           FROM points""",
    ),
    "bench_baseline_delta": _sql(
        ("runs", "history", "bench"),
        *LOSSY,
        BENCH_LONG,
        MEAN_LOSS,
        MERGED,
        """SELECT model_size, learning_rate, round(avg(final_loss), 8) AS mean_loss, round(avg(accuracy), 8) AS mean_accuracy,
                  round(avg(accuracy) - CASE model_size WHEN '8B' THEN 0.271::DOUBLE ELSE 0.331::DOUBLE END, 8) AS delta
           FROM merged GROUP BY model_size, learning_rate""",
    ),
}
