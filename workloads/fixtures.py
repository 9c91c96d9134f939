"""Hospital inputs derived from the driver tables by SQL that Spark and DuckDB share.

The texts name their tables as ``{orders}``; Spark gets DataFrames for these names and
DuckDB its views. The column ``group`` is a reserved word, so the SQL says ``grp``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Codes of the derived theatre times and specialties: the first part keys stand for real
# codes the baseline uses, the others for codes it does not.
SQL: dict[str, str] = {
    "ip_baseline": """
SELECT o_orderkey AS rn, 0 AS model_run,
  coalesce(CASE WHEN c_nationkey % 5 = 4 THEN NULL ELSE concat('S', cast(c_nationkey % 5 AS string)) END, 'unknown') AS sitetret,
  cast(o_custkey % 60 AS int) AS age,
  CASE o_orderkey % 9 WHEN 0 THEN '11' WHEN 1 THEN '12' WHEN 2 THEN '13' WHEN 3 THEN '11' WHEN 4 THEN '21'
    WHEN 5 THEN '22' WHEN 6 THEN '2A' WHEN 7 THEN '31' ELSE '82' END AS admimeth,
  cast(1 + o_orderkey % 4 AS string) AS classpat,
  cast((o_orderkey % 17) % 3 AS int) AS speldur,
  CASE o_orderkey % 11 WHEN 0 THEN '361' WHEN 1 THEN '303' WHEN 2 THEN '320' WHEN 3 THEN '811' WHEN 4 THEN '100'
    WHEN 5 THEN '110' WHEN 6 THEN '300' WHEN 7 THEN '420' WHEN 8 THEN '120' WHEN 9 THEN '&' ELSE NULL END AS tretspef,
  CASE WHEN o_orderkey % 7 = 0 THEN 'maternity' WHEN o_orderkey % 7 < 4 THEN 'elective' ELSE 'non-elective' END AS grp,
  CASE o_orderkey % 13 WHEN 0 THEN 'R241' WHEN 1 THEN 'R182' WHEN 2 THEN 'R171' WHEN 3 THEN 'R211' WHEN 4 THEN 'G451'
    WHEN 5 THEN 'H221' WHEN 6 THEN 'K631' WHEN 7 THEN 'W371' WHEN 8 THEN 'X998' WHEN 9 THEN 'E491' WHEN 10 THEN 'R251'
    WHEN 11 THEN 'J381' ELSE NULL END AS primary_procedure,
  o_orderkey % 13 <> 12 AS has_procedure,
  o_orderkey % 5 <> 0 AS maternity_delivery_in_spell
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "ip_raw": """
SELECT o_orderkey AS record_index,
  CASE WHEN c_nationkey % 5 = 4 THEN NULL ELSE concat('S', cast(c_nationkey % 5 AS string)) END AS sitetret,
  cast(o_custkey % 60 AS int) AS age
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "ip_results": """
SELECT l_orderkey AS rn, l_linenumber AS model_run, cast(l_quantity AS int) % 4 AS speldur,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '2' ELSE cast(1 + l_suppkey % 4 AS string) END AS classpat
FROM {lineitem}""",
    "scenario_results": """
SELECT cast(l_suppkey % 3 AS int) AS scenario, l_orderkey AS rn, l_linenumber AS model_run, cast(l_quantity AS int) % 4 AS speldur,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '2' ELSE cast(1 + l_suppkey % 4 AS string) END AS classpat
FROM {lineitem}""",
    "tretspef_lookup_raw": """
SELECT CASE p_partkey WHEN 1 THEN 100 WHEN 2 THEN 110 WHEN 3 THEN 120 WHEN 4 THEN 811 WHEN 5 THEN 300 WHEN 6 THEN 303
    WHEN 7 THEN 320 WHEN 8 THEN 361 WHEN 9 THEN 420 ELSE 1000 + p_partkey END AS tretspef,
  CASE WHEN p_partkey BETWEEN 1 AND 4 OR p_partkey > 9 AND p_size % 2 = 0 THEN 'Surgical' ELSE 'Medical/Other' END AS categorisation,
  p_name AS description
FROM {part}""",
    "theatre_times_raw": """
SELECT CASE p_partkey WHEN 1 THEN 'G451' WHEN 2 THEN 'W371' WHEN 3 THEN 'H221' WHEN 4 THEN 'R171' WHEN 5 THEN 'K631'
    WHEN 6 THEN 'X998' WHEN 7 THEN 'J381' ELSE concat('Z', cast(p_partkey AS string)) END AS opcs_code,
  CASE WHEN p_partkey = 7 OR p_partkey % 17 = 9 THEN NULL ELSE p_name END AS opcs_description,
  CASE WHEN p_partkey = 5 THEN '*' WHEN p_partkey = 6 THEN 'NaN' WHEN p_partkey < 8 THEN concat(cast(p_size AS string), '.25')
    WHEN p_partkey % 5 = 0 THEN '*' WHEN p_partkey % 5 = 1 THEN 'NaN' WHEN p_partkey % 5 = 2 THEN ' 12.5 '
    WHEN p_partkey % 5 = 3 THEN concat(cast(p_size AS string), 'd') ELSE cast(p_size AS string) END AS theatre_time
FROM {part}""",
    "aae_baseline": """
SELECT event_id AS rn, 0 AS model_run, concat('S', cast(user_id % 4 AS string)) AS sitetret, cast(user_id % 60 AS int) AS age,
  CASE WHEN event_id % 6 < 3 THEN '01' WHEN event_id % 6 = 3 THEN '05' WHEN event_id % 6 = 4 THEN '02' ELSE '03' END AS aedepttype,
  CASE event_type WHEN 'view' THEN 'standard' WHEN 'click' THEN 'urgent' WHEN 'purchase' THEN 'very-urgent'
    WHEN 'error' THEN 'immediate-resuscitation' ELSE NULL END AS acuity,
  cast(1 + event_id % 2 AS int) AS arrivals
FROM {events}""",
    "aae_results": """
SELECT event_id AS rn, run AS model_run, cast((event_id + run) % 3 AS int) AS arrivals
FROM {events} CROSS JOIN (VALUES (1),(2),(3)) AS r(run)
WHERE (event_id + run) % 10 <> 0 AND event_id % 50 <> 0""",
    "sdec_conversion": """
SELECT cast(1 + event_id % 3 AS int) AS model_run,
  CASE WHEN user_id % 5 = 4 THEN NULL ELSE concat('S', cast(user_id % 5 AS string)) END AS sitetret, 1 AS arrivals
FROM {events}""",
    "op_baseline": """
SELECT o_orderkey AS rn, 0 AS model_run, concat('S', cast(o_custkey % 5 AS string)) AS sitetret,
  o_orderkey % 3 = 0 AS has_procedures, o_orderkey % 2 = 0 AS is_first,
  cast(o_orderkey % 4 AS int) AS attendances, cast(o_custkey % 3 AS int) AS tele_attendances
FROM {orders}""",
    "op_results": """
SELECT l_orderkey AS rn, l_linenumber AS model_run, cast(l_quantity AS int) % 3 AS attendances,
  cast(l_quantity AS int) % 2 AS tele_attendances
FROM {lineitem}""",
    "op_conversion": """
SELECT l_linenumber AS model_run, concat('S', cast(l_suppkey % 6 AS string)) AS sitetret, 1 AS attendances
FROM {lineitem}""",
    "version_catalogue": """
SELECT DISTINCT CASE p_partkey % 9 WHEN 0 THEN 'dev' WHEN 1 THEN concat('v', cast(p_size AS string), '.1')
  ELSE concat('v', cast(2 + 2 * (p_size % 3) AS string), '.', cast(2 * (p_partkey % 5) AS string), '.',
    cast(p_partkey % 13 AS string)) END AS name
FROM {part}""",
    "version_prereleases": """
SELECT DISTINCT concat('v', cast(2 + 2 * (p_size % 3) AS string), '.', cast(2 * (p_partkey % 5) AS string), '.', cast(p_partkey % 7 AS string),
    CASE p_partkey % 6 WHEN 0 THEN concat('rc', cast(p_size % 4 AS string)) WHEN 1 THEN concat('a', cast(p_size % 3 AS string))
      WHEN 2 THEN concat('-beta', cast(p_size % 5 AS string)) WHEN 3 THEN concat('dev', cast(p_size % 2 AS string))
      WHEN 4 THEN concat('-', cast(1 + p_size % 2 AS string)) ELSE '' END) AS name
FROM {part} WHERE p_partkey % 41 < 9""",
    "version_requests": """
SELECT o_orderkey AS request_id, concat('v', cast(o_custkey % 8 AS string), '.', cast(o_orderkey % 11 AS string)) AS model_version
FROM {orders}""",
    "default_results": """
SELECT 'aae_type-01' AS pod, run AS model_run, cast(sum((event_id + run) % 3) AS bigint) AS value
FROM {events} CROSS JOIN (VALUES (1),(2),(3)) AS r(run)
WHERE (event_id + run) % 10 <> 0 AND event_id % 50 <> 0 GROUP BY run
UNION ALL SELECT 'aae_type-01', 0, cast(sum(1 + event_id % 2) AS bigint) FROM {events}
UNION ALL SELECT 'ip_elective_admission', l_linenumber, count(*) FROM {lineitem} GROUP BY l_linenumber""",
    "default_visits": """
SELECT concat('S', cast(o_custkey % 5 AS string)) AS sitetret, l_linenumber AS model_run,
  CASE WHEN o_orderkey % 3 = 0 THEN 'procedure' ELSE 'other' END AS kind,
  sum(cast(l_quantity AS int) % 3) AS value
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "default_spells": """
SELECT CASE WHEN c_nationkey % 5 = 4 THEN 'unknown' ELSE concat('S', cast(c_nationkey % 5 AS string)) END AS sitetret,
  l_linenumber AS model_run, count(*) AS value
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2""",
    "scenario_paths": """
SELECT concat('full-model-results/v', cast(3 + o_custkey % 3 AS string), '.', cast(o_orderkey % 5 AS string), '/R',
    cast(o_custkey % 50 AS string), '/', CASE WHEN o_orderkey % 2 = 0 THEN 'full-plan-' ELSE 'plan-' END,
    cast(o_orderkey AS string), '/20250101-', cast(100000 + o_orderkey % 100000 AS string), '/') AS path,
  concat('{{"start_year": ', CASE WHEN o_orderkey % 3 = 0 THEN '"' ELSE '' END, cast(2019 + o_orderkey % 6 AS string),
    CASE WHEN o_orderkey % 3 = 0 THEN '"' ELSE '' END, '}}') AS params
FROM {orders}""",
    "scenario_params": """
SELECT concat('full-model-results/v', cast(3 + o_custkey % 3 AS string), '.', cast(o_orderkey % 5 AS string), '/R',
    cast(o_custkey % 50 AS string), '/plan-', cast(o_orderkey AS string), '/20250101-120000/') AS path,
  CASE o_orderkey % 8 WHEN 0 THEN concat('{{"start_year": ', cast(2019 + o_custkey % 6 AS string))
    WHEN 1 THEN NULL WHEN 2 THEN '{{"end_year": 2041}}' WHEN 3 THEN concat('{{"start_year": "Y', cast(o_custkey % 9 AS string), '"}}')
    WHEN 4 THEN concat('{{"id": "', cast(o_orderkey AS string), '", "start_year": "', cast(2019 + o_custkey % 6 AS string), '"}}')
    WHEN 5 THEN concat('[', cast(o_custkey AS string), ']')
    ELSE concat('{{"start_year": ', cast(2019 + o_custkey % 6 AS string), ', "seed": ', cast(o_orderkey AS string), '}}') END AS params
FROM {orders}""",
    "manifest": """
SELECT concat('dev', cast(o_custkey % 3 AS string)) AS capacity_version,
  concat(CASE WHEN o_orderkey % 3 = 0 THEN 'old-' ELSE '' END, cast(o_orderkey AS string)) AS run_id,
  concat('R', cast(o_custkey % 50 AS string)) AS dataset
FROM {orders}""",
    "manifest_entries": """
SELECT concat('dev', cast(o_custkey % 3 AS string)) AS capacity_version,
  concat(CASE WHEN o_orderkey % 2 = 1 THEN 'new-' ELSE '' END, cast(o_orderkey AS string)) AS run_id,
  concat('R', cast(o_custkey % 50 AS string)) AS dataset
FROM {orders}""",
}


# Columns the derived inputs use; declared, so that no job has to read a file for them.
TABLES: dict[str, str] = {
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING",
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
}


def tables_of(name: str) -> list[str]:
    """Driver tables a derived input reads."""
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", SQL[name])))


def duckdb_sql(name: str) -> str:
    """The input's SQL with plain table names."""
    return SQL[name].format(**{table: table for table in tables_of(name)})


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input as a DataFrame over the parquet tables of ``sf_dir``."""
    tables = {
        table: spark.read.schema(TABLES[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
        for table in tables_of(name)
    }
    df = spark.sql(SQL[name], **tables)
    return df.withColumnRenamed("grp", "group") if "grp" in df.columns else df
