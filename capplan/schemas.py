"""Column contracts of the inputs, checked before a plan is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_FLAG, _NUMBER = T.BooleanType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_RECORD = {"rn": _LONG, "model_run": _INT, "sitetret": _TEXT}

INPATIENT_BASELINE = _struct(
    **_RECORD,
    age=_INT,
    admimeth=_TEXT,
    classpat=_TEXT,
    speldur=_INT,
    tretspef=_TEXT,
    group=_TEXT,
    primary_procedure=_TEXT,
    has_procedure=_FLAG,
    maternity_delivery_in_spell=_FLAG,
)
INPATIENT_RESULTS = _struct(rn=_LONG, model_run=_INT, speldur=_INT, classpat=_TEXT)
EMERGENCY_BASELINE = _struct(**_RECORD, age=_INT, aedepttype=_TEXT, acuity=_TEXT, arrivals=_NUMBER)
EMERGENCY_RESULTS = _struct(rn=_LONG, model_run=_INT, arrivals=_NUMBER)
OUTPATIENT_BASELINE = _struct(
    **_RECORD,
    has_procedures=_FLAG,
    is_first=_FLAG,
    attendances=_NUMBER,
    tele_attendances=_NUMBER,
)
OUTPATIENT_RESULTS = _struct(
    rn=_LONG, model_run=_INT, attendances=_NUMBER, tele_attendances=_NUMBER
)
SDEC_CONVERSION = _struct(model_run=_INT, sitetret=_TEXT, arrivals=_NUMBER)
OUTPATIENT_CONVERSION = _struct(model_run=_INT, sitetret=_TEXT, attendances=_NUMBER)
SPECIALTY_LOOKUP = _struct(tretspef=_LONG, tretspef_type=_TEXT)
THEATRE_TIMES = _struct(opcs_code=_TEXT, opcs_description=_TEXT, theatre_time=_NUMBER)

BASELINES = {"ip": INPATIENT_BASELINE, "aae": EMERGENCY_BASELINE, "op": OUTPATIENT_BASELINE}
RESULTS = {"ip": INPATIENT_RESULTS, "aae": EMERGENCY_RESULTS, "op": OUTPATIENT_RESULTS}


def _accepts(wanted: T.DataType, found: T.DataType) -> bool:
    if isinstance(wanted, (T.IntegerType, T.LongType)):
        return isinstance(found, T.IntegralType)
    if isinstance(wanted, T.DoubleType):
        return isinstance(found, T.NumericType)
    return isinstance(found, type(wanted))


def require(df: DataFrame, schema: T.StructType, what: str = "input") -> DataFrame:
    """``df`` unchanged, or a ``ValueError`` that names every missing or mistyped column.

    Any integer width passes for an integer and any number for a measure; further
    columns are allowed and pruned by the plans.
    """
    found = {field.name: field.dataType for field in df.schema.fields}
    problems = [
        f"{field.name}: missing"
        if field.name not in found
        else f"{field.name}: {found[field.name].simpleString()}, not {field.dataType.simpleString()}"
        for field in schema.fields
        if field.name not in found or not _accepts(field.dataType, found[field.name])
    ]
    if problems:
        raise ValueError(f"{what} does not fit: " + "; ".join(problems))
    return df
