"""DuckDB SQL for every registered query.

The rules are written out in SQL on their own, not generated from the library's
predicates, and the areas follow the plain form: left join to the baseline, aggregate,
join to a key skeleton.
"""

from __future__ import annotations

from workloads.fixtures import duckdb_sql

PREFIX = "substr(primary_procedure, 1, 3)"
ENDOSCOPY = (
    "'G14','G15','G16','G17','G18','G19','G20','G42','G43','G44','G45','G46','G54','G55','G64','G65','G79','G80',"
    "'H23','H24','H25','H26','H27','H28','H37','H69','H70','H71','J38','J39','J40','J41','J42','J43','J44','J45',"
    "'H20','H21','H22','H68','E48','E49','E50','E51'"
)

ELECTIVE = "(admimeth LIKE '1%' AND classpat = '1')"
NON_ELECTIVE = "(admimeth LIKE '2%' AND classpat = '1' AND grp <> 'maternity')"
DAYCASE = "(admimeth IN ('11','12','13') AND classpat = '2')"
RENAL_ELECTIVE = f"(tretspef = '361' AND {ELECTIVE} AND speldur = 0)"
RENAL_REGULAR = "(tretspef = '361' AND classpat IN ('3','4'))"
HAEM_ONC = f"({DAYCASE} AND tretspef IN ('253','303','260','370','800') AND has_procedure)"
ENDOSCOPIC = f"({DAYCASE} AND {PREFIX} IN ({ENDOSCOPY}))"
SPECIALTY = f"({RENAL_ELECTIVE} OR {RENAL_REGULAR} OR {HAEM_ONC} OR {ENDOSCOPIC})"
NOT_SPECIALTY = f"(NOT coalesce({SPECIALTY}, false))"
BIRTH = "(grp = 'maternity' AND maternity_delivery_in_spell)"
ASSISTED = f"{PREFIX} IN ('R19','R20','R21','R22','R23')"
MINOR = "(acuity IN ('standard','non-urgent','urgent') OR acuity IS NULL)"
CATHETER = (
    "((tretspef IN ('320','321') AND has_procedure) OR (has_procedure AND "
    f"{PREFIX} IN ('K63','K75','K60','K62','K59','K57','K73','K49')))"
)
RADIOLOGY = "(tretspef IN ('811','280') AND has_procedure)"

AAE_LABEL = f"""CASE WHEN aedepttype = '05' THEN 'sdec_attendances'
  WHEN acuity = 'immediate-resuscitation' THEN 'resus_attendances'
  WHEN aedepttype = '01' AND age >= 18 AND {MINOR} THEN 'adult_minor_attendances'
  WHEN aedepttype = '01' AND age >= 18 AND acuity = 'very-urgent' THEN 'adult_major_attendances'
  WHEN aedepttype = '01' AND age < 18 AND {MINOR} THEN 'child_minor_attendances'
  WHEN aedepttype = '01' AND age < 18 AND acuity = 'very-urgent' THEN 'child_major_attendances' END"""
DAYCASE_LABEL = f"""CASE WHEN {RENAL_ELECTIVE} OR {RENAL_REGULAR} THEN 'daycase_renal_spells'
  WHEN {HAEM_ONC} THEN 'daycase_haem_onc_spells' WHEN {ENDOSCOPIC} THEN 'daycase_endoscopy_spells'
  WHEN {DAYCASE} AND age >= 18 AND tretspef_type = 'Medical/Other' AND {NOT_SPECIALTY} THEN 'daycase_adult_medical_spells'
  WHEN {DAYCASE} AND age >= 18 AND tretspef_type = 'Surgical' AND {NOT_SPECIALTY} THEN 'daycase_adult_surgical_spells'
  WHEN {DAYCASE} AND age < 18 AND tretspef_type = 'Medical/Other' AND {NOT_SPECIALTY} THEN 'daycase_child_medical_spells'
  WHEN {DAYCASE} AND age < 18 AND tretspef_type = 'Surgical' AND {NOT_SPECIALTY} THEN 'daycase_child_surgical_spells' END"""
MATERNITY_LABEL = f"""CASE WHEN {BIRTH} AND {PREFIX} = 'R24' AND speldur = 0 THEN 'maternity_normal_delivery_zerolos'
  WHEN {BIRTH} AND {PREFIX} = 'R24' AND speldur > 0 THEN 'maternity_normal_delivery_nonzerolos'
  WHEN {BIRTH} AND {ASSISTED} AND speldur = 0 THEN 'maternity_assisted_delivery_zerolos'
  WHEN {BIRTH} AND {ASSISTED} AND speldur > 0 THEN 'maternity_assisted_delivery_nonzerolos'
  WHEN grp = 'maternity' AND speldur = 0 AND NOT maternity_delivery_in_spell THEN 'maternity_assessment'
  WHEN {BIRTH} AND {PREFIX} = 'R18' AND speldur = 0 THEN 'maternity_nonelective_csection_zerolos'
  WHEN {BIRTH} AND {PREFIX} = 'R18' AND speldur > 0 THEN 'maternity_nonelective_csection_nonzerolos'
  WHEN {BIRTH} AND {PREFIX} = 'R17' AND speldur = 0 THEN 'maternity_elective_csection_zerolos'
  WHEN {BIRTH} AND {PREFIX} = 'R17' AND speldur > 0 THEN 'maternity_elective_csection_nonzerolos'
  WHEN grp = 'maternity' AND speldur > 0 AND NOT maternity_delivery_in_spell THEN 'maternity_overnight_no_birth' END"""
WARD_LABEL = f"""(CASE WHEN age >= 18 THEN 'adult' WHEN age < 18 THEN 'paediatric' END)
  || '_' || (CASE WHEN {ELECTIVE} THEN 'elective' WHEN {NON_ELECTIVE} THEN 'nonelective' END)
  || '_' || (CASE tretspef_type WHEN 'Medical/Other' THEN 'medical' WHEN 'Surgical' THEN 'surgical' END)
  || '_' || (CASE WHEN speldur > 0 THEN 'nonzerolos' WHEN speldur = 0 THEN 'zerolos' END)"""

THEATRE = (
    ("adult_elective_surgical_procedures", f"age >= 18 AND {ELECTIVE} AND has_procedure AND tretspef_type = 'Surgical'"),
    ("adult_nonelective_surgical_procedures", f"age >= 18 AND {NON_ELECTIVE} AND has_procedure AND tretspef_type = 'Surgical'"),
    ("adult_surgical_daycase_procedures", f"age >= 18 AND {DAYCASE} AND has_procedure AND tretspef_type = 'Surgical'"),
    ("paediatric_elective_procedures", f"age < 18 AND {ELECTIVE} AND has_procedure"),
    ("paediatric_nonelective_procedures", f"age < 18 AND {NON_ELECTIVE} AND has_procedure"),
    ("paediatric_daycase_procedures", f"age < 18 AND {DAYCASE} AND has_procedure"),
)
PROCEDURE_LABEL = (
    f"CASE WHEN {RADIOLOGY} THEN 'interventional_radiology_procedure' WHEN {CATHETER} THEN 'cardiac_catheter_procedure'"
    + "".join(
        f" WHEN {rule} AND theatre_time IS NULL THEN '{name}_unknown_time' WHEN {rule} THEN '{name}'"
        for name, rule in THEATRE
    )
    + " ELSE 'unknown_procedure' END"
)

AAE_REQUIRED = (
    "adult_minor_attendances", "adult_major_attendances", "child_minor_attendances",
    "child_major_attendances", "resus_attendances", "sdec_attendances",
)
OP_REQUIRED = (
    "op_procedures", "op_first_attendances", "op_follow_up_attendances", "op_virtual_attendances",
)
DAYCASE_REQUIRED = tuple(
    f"daycase_{name}_spells"
    for name in ("renal", "haem_onc", "endoscopy", "adult_medical", "adult_surgical", "child_medical", "child_surgical")
)
MATERNITY_REQUIRED = (
    *(f"maternity_{birth}_{los}"
      for birth in ("normal_delivery", "assisted_delivery", "nonelective_csection", "elective_csection")
      for los in ("zerolos", "nonzerolos")),
    "maternity_assessment", "maternity_overnight_no_birth",
)
WARD_REQUIRED = tuple(
    f"{age}_{route}_{kind}_{los}"
    for age in ("adult", "paediatric")
    for route in ("elective", "nonelective")
    for kind in ("medical", "surgical")
    for los in ("zerolos", "nonzerolos")
)
PROCEDURE_REQUIRED = (
    *(f"{name}_unknown_time" for name, _ in THEATRE),
    "interventional_radiology_procedure", "cardiac_catheter_procedure",
)
PROCEDURE_ALL = (*PROCEDURE_REQUIRED, *(name for name, _ in THEATRE), "unknown_procedure")

COUNT = "count(rn)"
BEDDAYS = "cast(sum(speldur) AS bigint)"
THEATRE_TIME = "coalesce(sum(theatre_time), 0)"

# (label, required, measures, source of spells, label column)
INPATIENT = {
    "ip_daycase": (DAYCASE_LABEL, DAYCASE_REQUIRED, {"total": COUNT}, "spells", "grouping"),
    "ip_maternity": (MATERNITY_LABEL, MATERNITY_REQUIRED, {"spells": COUNT, "beddays": BEDDAYS}, "spells", "grouping"),
    "ip_wards": (WARD_LABEL, WARD_REQUIRED, {"spells": COUNT, "beddays": BEDDAYS}, "spells", "grouping"),
    "ip_procedures_and_theatres": (
        PROCEDURE_LABEL, PROCEDURE_REQUIRED, {"spells": COUNT, "total_theatre_time": THEATRE_TIME},
        "theatre_spells", "procedure_grouping",
    ),
}

# Named steps; each may use the ones before it.
STEPS = {
    "specialties": """SELECT cast(tretspef AS bigint) AS code, categorisation AS tretspef_type FROM tretspef_lookup_raw""",
    "theatre_times": """SELECT * FROM (SELECT opcs_code, opcs_description, try_cast(theatre_time AS double) AS theatre_time
      FROM theatre_times_raw) WHERE opcs_code IS NOT NULL AND opcs_description IS NOT NULL AND NOT isnan(theatre_time)""",
    "spells": """SELECT b.*, s.tretspef_type FROM ip_baseline b LEFT JOIN specialties s ON try_cast(b.tretspef AS bigint) = s.code""",
    "theatre_spells": """SELECT s.*, t.opcs_description, t.theatre_time FROM spells s LEFT JOIN theatre_times t
      ON s.primary_procedure = t.opcs_code WHERE s.has_procedure AND NOT s.grp = 'maternity'""",
}
STEP_INPUTS = {
    "specialties": ("tretspef_lookup_raw",),
    "theatre_times": ("theatre_times_raw",),
    "spells": ("ip_baseline", "specialties"),
    "theatre_spells": ("spells", "theatre_times"),
}


def _ctes(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name in STEPS:
            _ctes(STEP_INPUTS[name], seen)
            seen.setdefault(name, STEPS[name])
        else:
            seen.setdefault(name, duckdb_sql(name))
    return seen


def over(*names: str, **steps: str) -> str:
    """WITH clause for the named inputs and steps, then further ``steps`` in order."""
    ctes = _ctes(names, {}) | steps
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n"


def dense(required: tuple[str, ...], measures: tuple[str, ...], label: str = "grouping") -> str:
    """Complete ``agg(model_run, sitetret, g, measures...)``."""
    wanted = ", ".join(f"('{name}')" for name in required)
    filled = ", ".join(f"coalesce(a.{m}, 0) AS {m}" for m in measures)
    return f"""SELECT k.model_run, k.sitetret, q.g AS "{label}", {filled}
FROM (SELECT DISTINCT model_run, sitetret FROM agg) k CROSS JOIN (VALUES {wanted}) AS q(g)
LEFT JOIN agg a ON a.model_run = k.model_run AND a.sitetret = k.sitetret AND a.g = q.g
UNION ALL SELECT model_run, sitetret, g, {", ".join(measures)} FROM agg
WHERE g NOT IN (SELECT g FROM (VALUES {wanted}) AS q(g))"""


def inpatient_steps(area: str, keep: str = "LEFT") -> dict[str, str]:
    label, _, measures, source, _ = INPATIENT[area]
    sums = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    return {
        "records": f"""SELECT b.* EXCLUDE (model_run, speldur, classpat), r.model_run, r.speldur, r.classpat
      FROM {source} b {keep} JOIN ip_results r ON b.rn = r.rn
      UNION ALL SELECT b.* EXCLUDE (model_run, speldur, classpat), model_run, speldur, classpat FROM {source} b""",
        "agg": f"SELECT model_run, sitetret, {label} AS g, {sums} FROM records GROUP BY ALL",
    }


def inpatient(
    area: str,
    required: tuple[str, ...] | None = None,
    keep: str = "LEFT",
    scenario: int | None = None,
) -> str:
    _, usual, measures, source, column = INPATIENT[area]
    completed = dense(required or usual, tuple(measures), column)
    if scenario is None:
        return over(source, "ip_results", **inpatient_steps(area, keep)) + completed
    results = f"SELECT * FROM scenario_results WHERE scenario = {scenario}"
    steps = over(source, "scenario_results", ip_results=results, **inpatient_steps(area, keep))
    return f"SELECT {scenario} AS scenario, * FROM ({steps}{completed})"


def inpatient_totals(area: str) -> str:
    _, _, measures, source, column = INPATIENT[area]
    return (
        over(source, "ip_results", **inpatient_steps(area))
        + f'SELECT model_run, sitetret, g AS "{column}", {", ".join(measures)} FROM agg'
    )


def all_inpatient() -> str:
    parts = []
    for area, (_, _, measures, _, column) in INPATIENT.items():
        spells = "spells" if "spells" in measures else "total AS spells"
        days = "beddays" if "beddays" in measures else "cast(NULL AS bigint) AS beddays"
        time = (
            "total_theatre_time"
            if "total_theatre_time" in measures
            else "cast(NULL AS double) AS total_theatre_time"
        )
        parts.append(
            f"SELECT '{area}' AS area, model_run, sitetret, \"{column}\" AS \"grouping\", {spells}, {days}, {time}"
            f" FROM ({inpatient(area)})"
        )
    return "\nUNION ALL ".join(parts)


SUM_TOTAL = "cast(sum(total) AS bigint) AS total"
AAE_LABELLED = f"SELECT *, {AAE_LABEL} AS g FROM aae_baseline"
AAE_RUNS = """SELECT r.model_run, b.sitetret, b.g, cast(sum(r.arrivals) AS bigint) AS total
  FROM labelled b LEFT JOIN aae_results r ON b.rn = r.rn GROUP BY ALL"""
AAE_BASE = "SELECT model_run, sitetret, g, cast(sum(arrivals) AS bigint) AS total FROM labelled GROUP BY ALL"


def emergency_steps(site: str = "sitetret") -> dict[str, str]:
    return {
        "labelled": AAE_LABELLED,
        "runs": AAE_RUNS,
        "sdec": f"""SELECT model_run, {site} AS sitetret, 'sdec_attendances' AS g, cast(sum(arrivals) AS bigint) AS total
      FROM sdec_conversion GROUP BY ALL""",
        "merged": f"""SELECT model_run, sitetret, g, {SUM_TOTAL}
      FROM (SELECT * FROM runs UNION ALL SELECT * FROM sdec) GROUP BY ALL""",
        "agg": f"SELECT * FROM merged UNION ALL {AAE_BASE}",
    }


def emergency(site: str = "sitetret") -> str:
    return over(
        "aae_baseline", "aae_results", "sdec_conversion", **emergency_steps(site)
    ) + dense(AAE_REQUIRED, ("total",))


OP_SUMS = """cast(sum(CASE WHEN has_procedures THEN attendances END) AS bigint) AS op_procedures,
  cast(sum(CASE WHEN NOT has_procedures AND is_first THEN attendances END) AS bigint) AS op_first_attendances,
  cast(sum(CASE WHEN NOT has_procedures AND NOT is_first THEN attendances END) AS bigint) AS op_follow_up_attendances,
  cast(sum(tele_attendances) AS bigint) AS op_virtual_attendances"""
OP_LONG = "\nUNION ALL ".join(
    f"SELECT model_run, sitetret, '{name}' AS g, {name} AS total FROM {{wide}}" for name in OP_REQUIRED
)


def outpatients() -> str:
    return over(
        "op_baseline",
        "op_results",
        "op_conversion",
        records="""SELECT r.model_run, b.sitetret, b.has_procedures, b.is_first, r.attendances, r.tele_attendances
      FROM op_baseline b LEFT JOIN op_results r ON b.rn = r.rn""",
        run_sums=f"SELECT model_run, sitetret, {OP_SUMS} FROM records GROUP BY ALL",
        base_sums=f"SELECT model_run, sitetret, {OP_SUMS} FROM op_baseline GROUP BY ALL",
        merged=f"""SELECT model_run, sitetret, g, {SUM_TOTAL} FROM ({OP_LONG.format(wide="run_sums")}
      UNION ALL SELECT model_run, sitetret, 'op_procedures', sum(attendances) FROM op_conversion GROUP BY ALL) GROUP BY ALL""",
        agg=f"SELECT * FROM merged UNION ALL {OP_LONG.format(wide='base_sums')}",
    ) + dense(OP_REQUIRED, ("total",))


def truth(source: str, conditions: dict[str, str]) -> str:
    return "SELECT rn, " + ", ".join(f"({sql}) AS {name}" for name, sql in conditions.items()) + f" FROM {source}"


EMERGENCY_TRUTH = {
    "adult": "age >= 18",
    "child": "age < 18",
    "emergency_department": "aedepttype = '01'",
    "resus": "acuity = 'immediate-resuscitation'",
    "major": "acuity = 'very-urgent'",
    "minor": MINOR,
    "sdec": "aedepttype = '05'",
    "adult_minor": f"aedepttype = '01' AND age >= 18 AND {MINOR}",
    "adult_major": "aedepttype = '01' AND age >= 18 AND acuity = 'very-urgent'",
    "child_minor": f"aedepttype = '01' AND age < 18 AND {MINOR}",
    "child_major": "aedepttype = '01' AND age < 18 AND acuity = 'very-urgent'",
}
OUTPATIENT_TRUTH = {
    "op_procedure": "has_procedures",
    "op_first": "NOT has_procedures AND is_first",
    "op_follow_up": "NOT has_procedures AND NOT is_first",
}
INPATIENT_TRUTH = {
    "adult": "age >= 18",
    "child": "age < 18",
    "elective_route": "admimeth LIKE '1%'",
    "planned_route": "admimeth IN ('11','12','13')",
    "emergency_route": "admimeth LIKE '2%' AND grp <> 'maternity'",
    "ordinary": "classpat = '1'",
    "day_patient": "classpat = '2'",
    "not_maternity": "grp <> 'maternity'",
    "non_elective": NON_ELECTIVE,
    "elective": ELECTIVE,
    "daycase": DAYCASE,
    "regular_day_night": "classpat IN ('3','4')",
    "zero_los": "speldur = 0",
    "non_zero_los": "speldur > 0",
    "medical": "tretspef_type = 'Medical/Other'",
    "surgical": "tretspef_type = 'Surgical'",
    "renal": "tretspef = '361'",
    "haem_onc": "tretspef IN ('253','303','260','370','800')",
    "cardiology": "tretspef IN ('320','321')",
    "interventional_radiology": "tretspef IN ('811','280')",
    "has_procedure": "has_procedure",
    "endoscopy": f"{PREFIX} IN ({ENDOSCOPY})",
    "cardiac_catheter": f"{PREFIX} IN ('K63','K75','K60','K62','K59','K57','K73','K49')",
    "unknown_time": "theatre_time IS NULL",
    "maternity": "grp = 'maternity'",
    "birth_event": "maternity_delivery_in_spell",
    "no_birth_event": "NOT maternity_delivery_in_spell",
    "normal_birth": f"{PREFIX} = 'R24'",
    "assisted_birth": ASSISTED,
    "non_elective_section": f"{PREFIX} = 'R18'",
    "elective_section": f"{PREFIX} = 'R17'",
    "renal_elective": RENAL_ELECTIVE,
    "renal_regular_day_night": RENAL_REGULAR,
    "renal_daycase": f"{RENAL_ELECTIVE} OR {RENAL_REGULAR}",
    "haem_onc_daycase": HAEM_ONC,
    "endoscopy_daycase": ENDOSCOPIC,
    "specialty_daycase": SPECIALTY,
    "adult_medical_daycase": f"{DAYCASE} AND age >= 18 AND tretspef_type = 'Medical/Other' AND {NOT_SPECIALTY}",
    "adult_surgical_daycase": f"{DAYCASE} AND age >= 18 AND tretspef_type = 'Surgical' AND {NOT_SPECIALTY}",
    "child_medical_daycase": f"{DAYCASE} AND age < 18 AND tretspef_type = 'Medical/Other' AND {NOT_SPECIALTY}",
    "child_surgical_daycase": f"{DAYCASE} AND age < 18 AND tretspef_type = 'Surgical' AND {NOT_SPECIALTY}",
    "normal_birth_zero_los": f"{BIRTH} AND {PREFIX} = 'R24' AND speldur = 0",
    "assisted_birth_zero_los": f"{BIRTH} AND {ASSISTED} AND speldur = 0",
    "non_elective_section_zero_los": f"{BIRTH} AND {PREFIX} = 'R18' AND speldur = 0",
    "elective_section_zero_los": f"{BIRTH} AND {PREFIX} = 'R17' AND speldur = 0",
    "normal_birth_non_zero_los": f"{BIRTH} AND {PREFIX} = 'R24' AND speldur > 0",
    "assisted_birth_non_zero_los": f"{BIRTH} AND {ASSISTED} AND speldur > 0",
    "non_elective_section_non_zero_los": f"{BIRTH} AND {PREFIX} = 'R18' AND speldur > 0",
    "elective_section_non_zero_los": f"{BIRTH} AND {PREFIX} = 'R17' AND speldur > 0",
    "maternity_assessment": "grp = 'maternity' AND speldur = 0 AND NOT maternity_delivery_in_spell",
    "maternity_overnight": "grp = 'maternity' AND speldur > 0 AND NOT maternity_delivery_in_spell",
    "cardiology_procedure": "tretspef IN ('320','321') AND has_procedure",
    "catheter_procedure": f"has_procedure AND {PREFIX} IN ('K63','K75','K60','K62','K59','K57','K73','K49')",
    "cardiac_catheter_procedure": CATHETER,
    "interventional_radiology_procedure": RADIOLOGY,
    "adult_elective_surgery": THEATRE[0][1],
    "child_elective_procedure": THEATRE[3][1],
    "adult_non_elective_surgery": THEATRE[1][1],
    "child_non_elective_procedure": THEATRE[4][1],
    "adult_daycase_surgery": THEATRE[2][1],
    "child_daycase_procedure": THEATRE[5][1],
    "in_theatre_scope": "has_procedure AND NOT grp = 'maternity'",
}

VERSION_PARTS = """cast(split_part(ltrim({0}, 'v'), '.', 1) AS int) AS major, cast(split_part(ltrim({0}, 'v'), '.', 2) AS int) AS minor"""

PROCEDURE_OTHERS = ", ".join(f"'{name}'" for name in PROCEDURE_REQUIRED)

ORACLES: dict[str, str] = {
    "baseline_load": over("ip_raw")
    + "SELECT record_index AS rn, coalesce(sitetret, 'unknown') AS sitetret, age, 0 AS model_run FROM ip_raw",
    "specialty_lookup": over("specialties") + "SELECT code AS tretspef, tretspef_type FROM specialties",
    "theatre_times_clean": over("theatre_times") + "SELECT * FROM theatre_times",
    "default_results_filter": over("default_results")
    + "SELECT * FROM default_results WHERE pod LIKE 'aae%' AND model_run <> 0",
    "scenario_keys": over("scenario_paths")
    + """SELECT path, split_part(path, '/', 2) AS model_version, split_part(path, '/', 3) AS provider,
      split_part(path, '/', 4) AS scenario_name, split_part(path, '/', 5) AS scenario_runtime,
      cast(regexp_extract(params, '[0-9]{4}') AS int) AS fyear,
      'aggregated-' || substr(path, 6) AS aggregated_path FROM scenario_paths""",
    "scenario_params": over(
        "scenario_params",
        v="""SELECT *, CASE WHEN coalesce(json_valid(params), false) THEN json_type(params) END AS kind,
          CASE WHEN coalesce(json_valid(params), false) THEN json_extract_string(params, '$.start_year') END AS y FROM scenario_params""",
    )
    + """SELECT path, split_part(path, '/', 2) AS model_version, split_part(path, '/', 3) AS provider,
      split_part(path, '/', 4) AS scenario_name, split_part(path, '/', 5) AS scenario_runtime, try_cast(y AS int) AS fyear,
      'aggregated-' || substr(path, 6) AS aggregated_path,
      CASE WHEN params IS NULL THEN 'no parameters' WHEN kind IS DISTINCT FROM 'OBJECT' THEN 'no JSON object: ' || params
        WHEN y IS NULL THEN 'no start year' WHEN try_cast(y AS int) IS NULL THEN 'no start year: ' || y END AS problem FROM v""",
    "results_two_layouts": over("ip_results") + "SELECT * FROM ip_results",
    "batch_from_folders": "SELECT 'full-model-results/v4.1/R01/plan-' || n || '/2025/' AS path, a.* FROM ("
    + emergency() + ") a CROSS JOIN (VALUES (1), (2)) AS s(n)",
    "published_area": inpatient("ip_wards"),
    "version_asof": over(
        "version_catalogue",
        "version_requests",
        c=f"""SELECT name, {VERSION_PARTS.format("name")}, cast(split_part(ltrim(name, 'v'), '.', 3) AS int) AS patch
          FROM version_catalogue WHERE regexp_matches(name, '^v*[0-9]+[.][0-9]+[.][0-9]+$')""",
        q=f"SELECT DISTINCT model_version, {VERSION_PARTS.format('model_version')} FROM version_requests",
        best="""SELECT q.model_version, arg_max(c.name, (c.major * 1000 + c.minor) * 1000 + c.patch) AS data_version
          FROM q JOIN c ON c.major < q.major OR (c.major = q.major AND c.minor <= q.minor) GROUP BY 1""",
    )
    + """SELECT r.request_id, r.model_version, coalesce(b.data_version, 'N/A') AS data_version
      FROM version_requests r LEFT JOIN best b ON r.model_version = b.model_version""",
    "version_asof_prereleases": over(
        "version_prereleases",
        "version_requests",
        c="""SELECT name, cast(regexp_extract(name, '^v([0-9]+)', 1) AS int) AS major, cast(regexp_extract(name, '^v[0-9]+[.]([0-9]+)', 1) AS int) AS minor,
          cast(regexp_extract(name, '^v[0-9]+[.][0-9]+[.]([0-9]+)', 1) AS int) * 100
            + CASE WHEN name LIKE '%dev%' THEN 0 WHEN name LIKE '%a_' AND name NOT LIKE '%beta%' THEN 10 WHEN name LIKE '%beta%' THEN 20
                WHEN name LIKE '%rc%' THEN 30 WHEN name LIKE '%-_' THEN 50 ELSE 40 END
            + CASE WHEN regexp_matches(name, '(dev|a|beta|rc|-)[0-9]$') THEN cast(right(name, 1) AS int) ELSE 0 END AS o
          FROM version_prereleases""",
        q=f"SELECT DISTINCT model_version, {VERSION_PARTS.format('model_version')} FROM version_requests",
        best="""SELECT q.model_version, arg_max(c.name, (c.major * 1000 + c.minor) * 100000 + c.o) AS data_version
          FROM q JOIN c ON c.major < q.major OR (c.major = q.major AND c.minor <= q.minor) GROUP BY 1""",
    )
    + """SELECT r.request_id, r.model_version, coalesce(b.data_version, 'N/A') AS data_version
      FROM version_requests r LEFT JOIN best b ON r.model_version = b.model_version""",
    "predicates_emergency": over("aae_baseline") + truth("aae_baseline", EMERGENCY_TRUTH),
    "predicates_outpatient": over("op_baseline") + truth("op_baseline", OUTPATIENT_TRUTH),
    "predicates_inpatient": over("spells", "theatre_times")
    + truth(
        "(SELECT s.*, t.theatre_time FROM spells s LEFT JOIN theatre_times t ON s.primary_procedure = t.opcs_code)",
        INPATIENT_TRUTH,
    ),
    "aae_label_baseline": over("aae_baseline") + f'SELECT rn, {AAE_LABEL} AS "grouping" FROM aae_baseline',
    "daycase_label": over("spells") + f'SELECT rn, {DAYCASE_LABEL} AS "grouping" FROM spells',
    "maternity_label": over("spells") + f'SELECT rn, {MATERNITY_LABEL} AS "grouping" FROM spells',
    "ward_label": over("spells") + f'SELECT rn, {WARD_LABEL} AS "grouping" FROM spells',
    "procedures_label": over("theatre_spells")
    + f"SELECT rn, {PROCEDURE_LABEL} AS procedure_grouping FROM theatre_spells",
    "tretspef_join": over("spells") + "SELECT rn, tretspef, tretspef_type FROM spells",
    "theatre_join": over("theatre_spells")
    + "SELECT rn, primary_procedure, opcs_description, theatre_time FROM theatre_spells",
    "aae_run_overlay": over("aae_baseline", "aae_results")
    + """SELECT b.rn, r.model_run, b.sitetret, r.arrivals
      FROM aae_baseline b LEFT JOIN aae_results r ON b.rn = r.rn""",
    "op_run_overlay": over("op_baseline", "op_results")
    + """SELECT b.rn, r.model_run, b.sitetret, r.attendances, r.tele_attendances
      FROM op_baseline b LEFT JOIN op_results r ON b.rn = r.rn""",
    "ip_run_overlay": over("ip_baseline", "ip_results")
    + """SELECT b.rn, r.model_run, b.sitetret, r.speldur, r.classpat, b.admimeth
      FROM ip_baseline b LEFT JOIN ip_results r ON b.rn = r.rn""",
    "aae_baseline_agg": over("aae_baseline", labelled=AAE_LABELLED, agg=AAE_BASE)
    + 'SELECT model_run, sitetret, g AS "grouping", total FROM agg',
    "aae_overlay_runs": over("aae_baseline", "aae_results", labelled=AAE_LABELLED, runs=AAE_RUNS)
    + 'SELECT model_run, sitetret, g AS "grouping", total FROM runs',
    "sdec_conversion_agg": over("sdec_conversion")
    + """SELECT model_run, sitetret, 'sdec_attendances' AS "grouping", cast(sum(arrivals) AS bigint) AS total
      FROM sdec_conversion GROUP BY ALL""",
    "aae_merge_sdec": over("aae_baseline", "aae_results", "sdec_conversion", **emergency_steps())
    + 'SELECT model_run, sitetret, g AS "grouping", total FROM merged',
    "op_wide_agg": over("op_baseline") + f"SELECT model_run, sitetret, {OP_SUMS} FROM op_baseline GROUP BY ALL",
    "op_unpivot": over(
        "op_baseline",
        wide=f"SELECT model_run, sitetret, {OP_SUMS} FROM op_baseline GROUP BY ALL",
        long=OP_LONG.format(wide="wide"),
    )
    + 'SELECT model_run, sitetret, g AS "grouping", total FROM long',
    "op_conversion_agg": over("op_conversion")
    + """SELECT model_run, sitetret, 'op_procedures' AS "grouping", cast(sum(attendances) AS bigint) AS total
      FROM op_conversion GROUP BY ALL""",
    "daycase_totals": inpatient_totals("ip_daycase"),
    "maternity_totals": inpatient_totals("ip_maternity"),
    "ward_totals": inpatient_totals("ip_wards"),
    "procedure_totals": inpatient_totals("ip_procedures_and_theatres"),
    "run_site_universe": over("spells", "ip_results", **inpatient_steps("ip_wards"))
    + "SELECT DISTINCT model_run, sitetret FROM agg",
    "densify_zero_fill": inpatient("ip_wards"),
    "non_required_passthrough": over(
        "theatre_spells", "ip_results", **inpatient_steps("ip_procedures_and_theatres")
    )
    + f"""SELECT model_run, sitetret, g AS procedure_grouping, spells, total_theatre_time FROM agg
      WHERE g NOT IN ({PROCEDURE_OTHERS})""",
    "aae_areas": emergency(),
    "op_areas": outpatients(),
    "ip_daycase": inpatient("ip_daycase"),
    "ip_maternity": inpatient("ip_maternity"),
    "ip_wards": inpatient("ip_wards"),
    "ip_procedures_and_theatres": inpatient("ip_procedures_and_theatres"),
    "ip_all_areas_one_pass": all_inpatient(),
    "aae_areas_large_baseline": emergency(),
    "op_areas_large_baseline": outpatients(),
    "ip_all_areas_large_baseline": all_inpatient(),
    "aae_areas_site_filled": emergency("coalesce(sitetret, 'unknown')"),
    "ip_wards_matched_only": inpatient("ip_wards", keep="INNER"),
    "ip_procedures_dense_all": inpatient("ip_procedures_and_theatres", required=PROCEDURE_ALL),
    "ip_wards_by_scenario": "\nUNION ALL ".join(
        inpatient("ip_wards", scenario=number) for number in range(3)
    ),
    "ip_wards_by_dataset": "\nUNION ALL ".join(
        inpatient("ip_wards", scenario=number) for number in range(3)
    ),
    "records_without_run": over("ip_baseline", "ip_results")
    + "SELECT rn, sitetret FROM ip_baseline b WHERE NOT EXISTS (SELECT 1 FROM ip_results r WHERE r.rn = b.rn)",
    "sorted_by_run": inpatient("ip_wards"),
    "area_positions": "SELECT *, row_number() OVER (ORDER BY model_run NULLS LAST, sitetret NULLS FIRST, grouping NULLS FIRST, spells NULLS FIRST, "
    + "beddays NULLS FIRST) AS position FROM (" + inpatient("ip_wards") + ")",
    "manifest_append_check": over("manifest", "manifest_entries")
    + """SELECT e.*, NOT EXISTS (SELECT 1 FROM manifest m WHERE m.capacity_version = e.capacity_version
      AND m.run_id = e.run_id) AS accepted FROM manifest_entries e""",
    "reconcile_op_levels": "WITH area AS (" + outpatients() + "), " + over("op_conversion", "default_visits").removeprefix("WITH ").rstrip()
    + """, rows AS (SELECT model_run, sitetret, CASE WHEN grouping LIKE '%procedures%' THEN 'procedure' ELSE 'other' END AS kind, total AS o, 0 AS c, 0 AS t
        FROM area WHERE grouping NOT LIKE '%virtual%'
      UNION ALL SELECT model_run, sitetret, 'procedure', 0, attendances, 0 FROM op_conversion
      UNION ALL SELECT model_run, sitetret, kind, 0, 0, value FROM default_visits),
      sums AS (SELECT grouping(sitetret) AS gs, grouping(kind) AS gk, model_run, sitetret, kind, sum(o)::DOUBLE AS ours, sum(c)::DOUBLE AS converted,
        sum(t)::DOUBLE AS theirs FROM rows WHERE model_run <> 0 GROUP BY GROUPING SETS ((model_run), (model_run, sitetret), (model_run, kind)))
      SELECT 'model_run' || CASE WHEN gs = 0 THEN ',sitetret' WHEN gk = 0 THEN ',kind' ELSE '' END AS level, model_run, sitetret, kind, ours, converted,
        theirs, ours - converted - theirs AS difference FROM sums""",
    "reconcile_ip_levels": over("ip_baseline", "ip_results", "default_spells").rstrip()
    + """, rows AS (SELECT r.model_run, sitetret, 1 AS o, 0 AS t FROM ip_results r JOIN ip_baseline b ON r.rn = b.rn
      UNION ALL SELECT model_run, sitetret, 0, value FROM default_spells),
      sums AS (SELECT grouping(sitetret) AS gs, model_run, sitetret, sum(o)::DOUBLE AS ours, sum(t)::DOUBLE AS theirs
        FROM rows WHERE model_run <> 0 GROUP BY GROUPING SETS ((model_run), (model_run, sitetret)))
      SELECT 'model_run' || CASE WHEN gs = 0 THEN ',sitetret' ELSE '' END AS level, model_run, sitetret, ours, 0::DOUBLE AS converted, theirs,
        ours - theirs AS difference FROM sums""",
    "reconcile_runs": over(
        "aae_baseline", "aae_results", "sdec_conversion", "default_results", **emergency_steps(),
        area=dense(AAE_REQUIRED, ("total",)),
        l="SELECT model_run, cast(sum(total) AS bigint) AS ours FROM area WHERE model_run <> 0 GROUP BY 1",
        r="""SELECT model_run, cast(sum(value) AS bigint) AS theirs FROM default_results
          WHERE pod LIKE 'aae%' AND model_run <> 0 GROUP BY 1""",
    )
    + """SELECT coalesce(l.model_run, r.model_run) AS model_run, ours, theirs,
      coalesce(ours, 0) - coalesce(theirs, 0) AS difference FROM l FULL JOIN r ON l.model_run = r.model_run""",
}
