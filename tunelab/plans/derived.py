"""Tables derived from the test data, written once for Spark and DuckDB.

The test data has no run names, answers or losses, so they are computed from
its keys.  Each view is plain SQL over ``{table}`` placeholders; Spark binds
them to DataFrames, the SQL side to its registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Run name of a user: rate 1e-3..1e-5, ranks 1..512 or full, 8B or 70B.
_NAME = """concat('lr1e-', CAST(3 + {u} % 3 AS STRING), '_r',
       CAST(CASE WHEN {u} % 11 = 10 THEN 1 ELSE CAST(power(2, {u} % 11) AS INT) END AS STRING), '_',
       CASE WHEN {u} % 11 = 10 THEN 'full' ELSE 'lora' END, '_', CASE WHEN {u} % 2 = 0 THEN '8B' ELSE '70B' END)"""

# All documents; those without a label have none to be scored by.
_CASES = f"""
SELECT d.doc_id AS row_id, d.lang AS run_group, d.source AS source, l.toxic AS toxic,
       CASE WHEN d.n >= 17 THEN concat('unknown-run-', CAST(d.n AS STRING)) ELSE {_NAME.format(u="d.n")} END AS run_name,
       CAST(2000 + d.doc_id % 21 AS INT) AS year, d.lang AS language,
       CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE d.lang END AS source_language,
       CASE WHEN d.doc_id % 3 = 0 THEN 'Zuerich' ELSE 'Vaud' END AS region,
       CASE WHEN d.doc_id % 3 = 0 THEN 'ZH' ELSE 'VD' END AS canton,
       CASE WHEN d.doc_id % 2 = 0 THEN 'civil law' ELSE 'penal law' END AS legal_area,
       d.text AS text, l.quality AS label,
       CASE WHEN d.doc_id % 8 = 0 THEN 'dismissal' WHEN d.doc_id % 8 = 1 THEN 'approval'
            WHEN d.doc_id % 8 = 2 THEN 'The appeal was DISMISSED.' WHEN d.doc_id % 8 = 3 THEN 'Approved, not a dismissal'
            WHEN d.doc_id % 8 = 4 THEN 'unclear' WHEN d.doc_id % 8 = 5 THEN NULL
            WHEN d.doc_id % 8 = 6 THEN CASE WHEN l.quality = 1 THEN 'approval' ELSE 'dismissal' END
            ELSE '' END AS generated_answer
FROM (SELECT *, CAST(substr(source, 4) AS INT) AS n FROM {{documents}}) d LEFT JOIN {{labels}} l ON d.doc_id = l.doc_id
"""

_JUDGMENT = "SELECT * FROM cases WHERE label IS NOT NULL"

_MCQ = """
SELECT row_id, subset, model_folder, question, course, n_choices, gold,
       CASE WHEN row_id % 7 = 5 THEN 'no final answer given'
            WHEN row_id % 7 = 3 THEN 'I first thought ###A### but Correct Answer: ###B###'
            ELSE concat('reasoning ... Correct Answer: ###',
                 CASE WHEN gold < 26 THEN substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', gold + 1, 1)
                      ELSE concat('A', substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', gold - 25, 1)) END, '###') END AS generated_text
FROM (SELECT *, concat('mcq_', CAST(n_choices AS STRING), '_choices') AS subset, CAST(row_id % n_choices AS INT) AS gold
      FROM (SELECT doc_id AS row_id, source AS model_folder, text AS question, lang AS course,
                   CAST(CASE n_chars % 4 WHEN 0 THEN 4 WHEN 1 THEN 8 WHEN 2 THEN 16 ELSE 32 END AS INT) AS n_choices
            FROM {documents}) a) b
"""

_NAMED = f"""
SELECT *, concat({_NAME.format(u="user_id")}, CASE WHEN user_id % 19 = 0 THEN '_retry' ELSE '' END) AS name
FROM {{events}}
"""

# No window over a user's events: the step of a point is its event number.
# The name is made from an aggregate (u equals user_id), so conditions on names
# are tested once per run and not pushed down to every event.
_RUNS = f"""
SELECT run_id, concat({_NAME.format(u="u")}, CASE WHEN u % 19 = 0 THEN '_retry' ELSE '' END) AS name,
       CASE WHEN u % 13 = 0 THEN 'failed' WHEN u % 17 = 0 THEN 'running' ELSE 'finished' END AS state,
       created_at, n_events, top_value > 150 AS has_history
FROM (SELECT user_id AS run_id, min(user_id) AS u, min(ts) AS created_at, count(*) AS n_events, max(value) AS top_value
      FROM {{events}} GROUP BY user_id) g
UNION ALL
SELECT CAST(-1 AS BIGINT), 'baseline-debug', 'finished', CAST('2024-01-01 00:00:00' AS TIMESTAMP),
       count(*), CAST(0 AS BOOLEAN)
FROM {{events}}
"""

# Rank 8 logs only the second loss column; 70B at rank 1 and 1e-3 diverges.
_HISTORY = """
SELECT name, event_id AS step,
       CASE WHEN user_id % 11 = 3 OR event_id % 17 = 0 THEN NULL
            WHEN user_id % 66 = 33 THEN CAST(9.99 AS DOUBLE) ELSE 0.5 + value / 100.0 END AS loss_1,
       CASE WHEN user_id % 11 = 3 AND event_id % 5 <> 0 THEN 0.6 + value / 100.0 ELSE NULL END AS loss_2
FROM named
"""

_CHECKPOINTS = """
SELECT r.name AS model_folder, concat('/grid/', r.name, '/checkpoint-', CAST(s.step AS STRING)) AS path,
       r.run_id AS run_id,
       CASE WHEN r.name NOT LIKE '%lora%' THEN NULL
            WHEN r.run_id % 4 = 0 THEN '{{"base_model_name_or_path": "base"}}'
            ELSE '{{"base_model_name_or_path": "base", "r": 16}}' END AS config
FROM (SELECT name, min(run_id) AS run_id FROM runs GROUP BY name) r, {steps}
WHERE NOT (s.step = 467 AND r.name LIKE '%r256%') AND NOT (s.step = 1000 AND r.name LIKE 'lr1e-3%')
"""

_TASK = """
SELECT model_size, lr, rank, CAST(sum(hit) AS DOUBLE) / count(*) AS eval_accuracy
FROM (SELECT CASE WHEN user_id % 2 = 0 THEN '8B' ELSE '70B' END AS model_size,
             CAST(concat('1e-', CAST(3 + user_id % 3 AS STRING)) AS DOUBLE) AS lr,
             CAST(power(2, user_id % 11) AS INT) AS rank,
             CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS hit
      FROM named WHERE name LIKE '%lora%') e
GROUP BY model_size, lr, rank
"""

_BENCH = """
SELECT name AS model_folder, concat(name, '/mcq_4_choices/accuracy') AS metric,
       CASE WHEN count(*) % 9 = 0 THEN NULL
            ELSE CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) END AS value,
       CASE count(*) % 3 WHEN 0 THEN 'other-evaluation' WHEN 1 THEN name
            ELSE concat('grid_', CASE WHEN name LIKE '%70B%' THEN '70B' ELSE '8B' END, '_lora_checkpoint-467') END AS name
FROM named WHERE name LIKE '%lora%' GROUP BY name
"""

# name -> (views it needs, SQL)
VIEWS = {
    "cases": ((), _CASES),
    "judgment": (("cases",), _JUDGMENT),
    "mcq": ((), _MCQ),
    "named": ((), _NAMED),
    "runs": ((), _RUNS),
    "history": (("named",), _HISTORY),
    "checkpoints": (("runs",), _CHECKPOINTS),
    "task": (("named",), _TASK),
    "bench": (("named",), _BENCH),
}
TABLES = ("documents", "labels", "events", "conversations")
SPARK_STEPS = "LATERAL explode(array(100, 467, 1000)) AS s(step)"
DUCKDB_STEPS = "(SELECT unnest([100, 467, 1000]) AS step) s"


def needed_views(*names: str) -> list[str]:
    """The views and what they build on, in order of definition."""
    wanted = {need for name in names for need in (*VIEWS[name][0], name)}
    return [name for name in VIEWS if name in wanted]


def with_clause(names: list[str]) -> str:
    return ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in names)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data.  The tables never change, so a schema is read from its footer once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = f"WITH {with_clause(needed_views(name))} SELECT * FROM {name}"
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql.replace("{steps}", SPARK_STEPS), **used)


def duckdb_with(*names: str) -> str:
    """The same views as a ``WITH`` clause for DuckDB."""
    sql = with_clause(needed_views(*names)).replace("{steps}", DUCKDB_STEPS)
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("{{", "{").replace("}}", "}")
