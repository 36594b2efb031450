"""Declared schemas of the ten tables in both layers, as DDL.  Nothing is ever inferred."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructType, TimestampNTZType,
)

PROVENANCE_DDL = "_source_file STRING, _ingested_at TIMESTAMP_NTZ"
BUILD_STAMP_DDL = "_silver_built_at TIMESTAMP_NTZ NOT NULL"


@dataclass(frozen=True)
class Table:
    """One bronze table: its columns, where its text comes from, and how it is laid out."""

    ddl: str
    source: str
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    split_value: str | None = None
    year_of: tuple[str, str] | None = None  # (timestamp column, partition column)

    @property
    def columns(self) -> StructType:
        return checked(StructType.fromDDL(self.ddl))

    @property
    def schema(self) -> StructType:
        return checked(StructType.fromDDL(f"{self.ddl}, {PROVENANCE_DDL}"))


def checked(schema: StructType) -> StructType:
    """Refuse a type outside the small closed set both layers use."""
    scalars = (StringType, LongType, DoubleType, TimestampNTZType, BooleanType)
    for column in schema.fields:
        kind = column.dataType
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
            continue
        if not isinstance(kind, scalars):
            raise ValueError(f"column {column.name} has unsupported type {kind.simpleString()}")
    return schema


BRONZE: dict[str, Table] = {
    "patient_information": Table(
        source="patient_information.csv",
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, DISCH_DISP_C BIGINT, DISCH_DISP STRING,
            HOSP_ADMSN_TIME TIMESTAMP_NTZ, HOSP_DISCH_TIME TIMESTAMP_NTZ, LOS DOUBLE,
            ICU_ADMIN_FLAG STRING, SURGERY_DATE TIMESTAMP_NTZ, BIRTH_DATE BIGINT, HEIGHT STRING,
            WEIGHT DOUBLE, SEX STRING, PRIMARY_ANES_TYPE_NM STRING, ASA_RATING_C BIGINT,
            ASA_RATING STRING, PATIENT_CLASS_GROUP STRING, PATIENT_CLASS_NM STRING,
            PRIMARY_PROCEDURE_NM STRING, IN_OR_DTTM TIMESTAMP_NTZ, OUT_OR_DTTM TIMESTAMP_NTZ,
            AN_START_DATETIME TIMESTAMP_NTZ, AN_STOP_DATETIME TIMESTAMP_NTZ""",
    ),
    "patient_history": Table(
        source="patient_history.csv",
        ddl="mrn STRING NOT NULL, diagnosis_code STRING, dx_name STRING",
    ),
    "patient_visit": Table(
        source="patient_visit.csv",
        ddl="LOG_ID STRING NOT NULL, mrn STRING NOT NULL, diagnosis_code STRING, dx_name STRING",
    ),
    "patient_coding": Table(
        source="patient_coding.csv",
        ddl="""MRN STRING NOT NULL, SOURCE_KEY BIGINT, SOURCE_NAME STRING, NAME STRING,
            REF_BILL_CODE_SET_NAME STRING, REF_BILL_CODE STRING""",
    ),
    "patient_post_op_complications": Table(
        source="patient_post_op_complications.csv",
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, Element_Name STRING,
            CONTEXT_NAME STRING, Element_abbr STRING, SMRTDTA_ELEM_VALUE STRING""",
    ),
    "patient_lda": Table(
        source="patient_lda.csv",
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, description STRING,
            properties_display STRING, site STRING, placement_instant TIMESTAMP_NTZ,
            removal_instant TIMESTAMP_NTZ, flo_meas_name STRING, Line_Group_Name STRING""",
    ),
    "patient_procedure_events": Table(
        source="patient_procedure events.csv",
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, EVENT_DISPLAY_NAME STRING,
            EVENT_TIME TIMESTAMP_NTZ, NOTE_TEXT STRING""",
    ),
    "patient_labs": Table(
        source="patient_labs.csv",
        rename={
            "Lab Code": "Lab_Code", "Lab Name": "Lab_Name",
            "Observation Value": "Observation_Value", "Measurement Units": "Measurement_Units",
            "Reference Range": "Reference_Range", "Abnormal Flag": "Abnormal_Flag",
            "Collection Datetime": "Collection_Datetime",
        },
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, ENC_TYPE_NM STRING, Lab_Code STRING,
            Lab_Name STRING, Observation_Value DOUBLE, Measurement_Units STRING,
            Reference_Range STRING, Abnormal_Flag STRING, Collection_Datetime TIMESTAMP_NTZ""",
        year_of=("Collection_Datetime", "collection_year"),
    ),
    "patient_medications": Table(
        source="patient_medications.csv",
        ddl="""ENC_TYPE_C BIGINT, ENC_TYPE_NM STRING, LOG_ID STRING NOT NULL, MRN STRING NOT NULL,
            ORDERING_DATE TIMESTAMP_NTZ, ORDER_CLASS_NM STRING, MEDICATION_ID BIGINT,
            DISPLAY_NAME STRING, MEDICATION_NM STRING, START_DATE TIMESTAMP_NTZ,
            END_DATE TIMESTAMP_NTZ, ORDER_STATUS_NM STRING, RECORD_TYPE STRING,
            MAR_ACTION_NM STRING, MED_ACTION_TIME TIMESTAMP_NTZ, ADMIN_SIG DOUBLE,
            DOSE_UNIT_NM STRING, MED_ROUTE_NM STRING""",
        year_of=("MED_ACTION_TIME", "med_action_year"),
    ),
    "flowsheets": Table(
        source="flowsheets_cleaned/flowsheet_part*.csv",
        drop=("Unnamed: 0",),
        split_value="MEAS_VALUE",
        ddl="""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, FLO_NAME STRING,
            FLO_DISPLAY_NAME STRING, RECORD_TYPE STRING, RECORDED_TIME TIMESTAMP_NTZ,
            MEAS_VALUE_NUM DOUBLE, MEAS_VALUE_TXT STRING, UNITS STRING""",
        year_of=("RECORDED_TIME", "recorded_year"),
    ),
}

# Silver tables keep the bronze columns and add what is listed here.
_COUNT = "n_occurrences BIGINT NOT NULL"
_COUNTED = ("patient_coding", "patient_medications", "patient_post_op_complications", "flowsheets",
            "patient_labs", "patient_procedure_events")

SILVER_DDL: dict[str, str] = {
    "patient_information": f"""LOG_ID STRING NOT NULL, MRN STRING NOT NULL,
        mrn_corrupt BOOLEAN NOT NULL, log_id_collision BOOLEAN NOT NULL,
        has_conflicting_duplicate BOOLEAN NOT NULL, DISCH_DISP_C BIGINT, DISCH_DISP STRING,
        HOSP_ADMSN_TIME TIMESTAMP_NTZ, HOSP_DISCH_TIME TIMESTAMP_NTZ, LOS DOUBLE,
        ICU_ADMIN_FLAG STRING, SURGERY_DATE TIMESTAMP_NTZ, age_years BIGINT, age_capped BOOLEAN,
        height_in DOUBLE, weight_kg DOUBLE, SEX STRING, PRIMARY_ANES_TYPE_NM STRING,
        ASA_RATING_C BIGINT, ASA_RATING STRING, PATIENT_CLASS_GROUP STRING, PATIENT_CLASS_NM STRING,
        PRIMARY_PROCEDURE_NM STRING, IN_OR_DTTM TIMESTAMP_NTZ, OUT_OR_DTTM TIMESTAMP_NTZ,
        AN_START_DATETIME TIMESTAMP_NTZ, AN_STOP_DATETIME TIMESTAMP_NTZ, {_COUNT}""",
    "patient_history": f"MRN STRING NOT NULL, diagnosis_code STRING, dx_name STRING, {_COUNT}",
    "patient_visit": f"""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, diagnosis_code STRING,
        dx_name STRING, {_COUNT}""",
    "patient_lda": f"""LOG_ID STRING NOT NULL, MRN STRING NOT NULL, description STRING,
        properties_display STRING, site STRING, placement_instant TIMESTAMP_NTZ,
        removal_instant TIMESTAMP_NTZ, flo_meas_name STRING, line_group_names ARRAY<STRING>,
        multi_navigator BOOLEAN, {_COUNT}""",
    **{name: f"{BRONZE[name].ddl}, {_COUNT}" for name in _COUNTED},
}

@cache
def silver_schema(table: str) -> StructType:
    """Declared columns of a silver table, build stamp included (needs a running session)."""
    return checked(StructType.fromDDL(f"{SILVER_DDL[table]}, {BUILD_STAMP_DDL}"))


def silver_partition(table: str) -> tuple[str, str] | None:
    """Silver keeps the year layout of bronze."""
    return BRONZE[table].year_of
