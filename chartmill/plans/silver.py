"""Bronze to silver: one function per table, then stage, check, publish."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartmill.config import CleaningRules, Expectation, Layout
from chartmill.functions import columns as C
from chartmill.operators import clean, dedup, quality
from chartmill.schemas import BRONZE, silver_schema
from chartmill.sources import store

log = logging.getLogger(__name__)

BUILD_STAMP = "_silver_built_at"

# Category columns trimmed before grouping; keys, numbers and times are left alone.
TRIMMED = {
    "patient_history": ("diagnosis_code", "dx_name"),
    "patient_visit": ("diagnosis_code", "dx_name"),
    "patient_coding": ("SOURCE_NAME", "NAME", "REF_BILL_CODE_SET_NAME", "REF_BILL_CODE"),
    "patient_medications": (
        "ENC_TYPE_NM", "ORDER_CLASS_NM", "DISPLAY_NAME", "MEDICATION_NM", "ORDER_STATUS_NM", "RECORD_TYPE",
        "MAR_ACTION_NM", "DOSE_UNIT_NM", "MED_ROUTE_NM",
    ),
    "patient_post_op_complications": ("Element_Name", "CONTEXT_NAME", "Element_abbr", "SMRTDTA_ELEM_VALUE"),
    "patient_lda": ("description", "properties_display", "site", "flo_meas_name", "Line_Group_Name"),
    "flowsheets": ("FLO_NAME",),
    "patient_labs": ("ENC_TYPE_NM", "Lab_Code", "Lab_Name", "Measurement_Units", "Reference_Range", "Abnormal_Flag"),
    "patient_procedure_events": ("EVENT_DISPLAY_NAME", "NOTE_TEXT"),
    "patient_information": (
        "ICU_ADMIN_FLAG", "SEX", "PRIMARY_ANES_TYPE_NM", "ASA_RATING", "PATIENT_CLASS_GROUP", "PATIENT_CLASS_NM",
        "PRIMARY_PROCEDURE_NM",
    ),
}


def _source_columns(bronze: DataFrame, table: str) -> DataFrame:
    """The declared columns without provenance: copies from different files are still copies."""
    return bronze.select(*BRONZE[table].columns.names)


def _counted(bronze: DataFrame, table: str, trim: bool = True) -> DataFrame:
    df = clean.unify_key_case(_source_columns(bronze, table))
    return dedup.collapse_count(clean.trim_columns(df, TRIMMED[table]) if trim else df)


def patient_history(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_history")


def patient_visit(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_visit")


def patient_coding(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_coding")


def patient_medications(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_medications")


def patient_post_op_complications(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_post_op_complications")


def patient_labs(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The key is every column: a narrower one would merge results that differ in range or flag."""
    return _counted(bronze, "patient_labs", rules.trim_labs)


def patient_procedure_events(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return _counted(bronze, "patient_procedure_events", rules.trim_events)


def flowsheets(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    df = clean.trim_columns(_source_columns(bronze, "flowsheets"), TRIMMED["flowsheets"])
    return dedup.collapse_count(df.withColumn("UNITS", C.normalize_units(F.col("UNITS"))))


def patient_lda(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """One row per device event; the categories it was charted under become a list."""
    df = clean.trim_columns(_source_columns(bronze, "patient_lda"), TRIMMED["patient_lda"])
    keys = [name for name in df.columns if name != "Line_Group_Name"]
    return dedup.collapse_collect(df, keys, "Line_Group_Name", "line_group_names", "multi_navigator")


def patient_information(bronze: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """One row per surgery where that is true, and flags where it is not."""
    df = clean.drop_rows(_source_columns(bronze, "patient_information"), rules.phantom_rows, ["LOG_ID", "MRN"])
    df = clean.trim_columns(df, TRIMMED["patient_information"])
    df = df.withColumns({
        "DISCH_DISP": C.map_values(F.col("DISCH_DISP"), C.DISPOSITION_WORDING),
        "height_in": C.null_out(C.parse_feet_inches(F.col("HEIGHT")), F.col("LOG_ID"), rules.implausible_height),
        "weight_kg": C.ounces_to_kg(F.col("WEIGHT")),
    }).withColumnRenamed("BIRTH_DATE", "age_years").drop("HEIGHT", "WEIGHT")
    facts = [name for name in df.columns if name not in ("LOG_ID", "MRN")]
    resolved = dedup.classify_duplicates(df, ["LOG_ID"], "MRN", facts)
    return resolved.withColumnsRenamed(
        {"is_collision": "log_id_collision", "is_conflict": "has_conflicting_duplicate"}
    ).withColumns({
        "mrn_corrupt": C.flag_pattern(F.col("MRN")), "age_capped": C.flag_capped(F.col("age_years")),
    })


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "patient_information": patient_information,
    "patient_lda": patient_lda,
    "patient_history": patient_history,
    "patient_visit": patient_visit,
    "patient_coding": patient_coding,
    "patient_medications": patient_medications,
    "patient_post_op_complications": patient_post_op_complications,
    "flowsheets": flowsheets,
    "patient_labs": patient_labs,
    "patient_procedure_events": patient_procedure_events,
}


# Tables that only collapse copies, with their list columns and the flags of these.
COLLAPSED: dict[str, list[tuple[str, str]]] = {
    table: [("line_group_names", "multi_navigator")] if table == "patient_lda" else [] for table in BUILDERS if table != "patient_information"
}


def refine(bronze: DataFrame, table: str, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The silver rows of a table in the declared schema."""
    built = BUILDERS[table](bronze, rules)
    return clean.conform(clean.stamp(built, BUILD_STAMP), silver_schema(table))


def build_rules(table: str, bronze_rows: int, rules: CleaningRules) -> list[quality.Rule]:
    """What a build must satisfy before it is published."""
    expected = rules.expected.get(table, Expectation())
    checks = [quality.expect_not_larger(bronze_rows)]
    if table == "patient_information":
        checks += [
            quality.expect_paired("log_id_collision"),
            *[
                quality.expect_absent(f"phantom row {i}", (F.col("LOG_ID") == key) & (F.col("MRN") == entity))
                for i, (key, entity) in enumerate(rules.phantom_rows, start=1)
            ],
        ]
    else:
        checks.append(quality.expect_multiplicity(bronze_rows))
    if expected.rows is not None:
        checks.append(quality.expect_rows(expected.rows))
    if expected.rows_above is not None:
        checks.append(quality.rows_between(expected.rows_above, bronze_rows))
    if expected.distinct_key is not None:
        checks.append(quality.expect_distinct(*expected.distinct_key))
    return checks


def build(spark: SparkSession, layout: Layout, table: str, rules: CleaningRules = CleaningRules()) -> store.Build:
    """Recompute a table into a new version, check the files written, then publish them."""
    expected = store.require_complete(spark, layout, table)
    bronze = store.scan_bronze(spark, layout, table)
    bronze_rows = bronze.count()
    if bronze_rows != expected:
        raise store.IncompleteLoad(f"bronze.{table} has {bronze_rows} rows, its sources {expected}")
    staged = store.write_build(refine(bronze, table, rules), layout, table)
    return _checked(spark, layout, staged, bronze_rows, rules)


def _checked(spark: SparkSession, layout: Layout, staged: store.Build, bronze_rows: int, rules: CleaningRules) -> store.Build:
    """Publish a version if the files written satisfy the table's rules."""
    written = store.read_build(spark, staged)
    quality.gate(quality.evaluate(written, staged.table, build_rules(staged.table, bronze_rows, rules)))
    store.note_sources(spark, layout, staged, digest(rules))
    action = store.publish(spark, layout, staged)
    log.info("silver.%s published (%s)", staged.table, action)
    return staged


def digest(rules: CleaningRules) -> str:
    """Tells rules apart that would clean rows in different ways."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()


def update(spark: SparkSession, layout: Layout, table: str, rules: CleaningRules = CleaningRules()) -> store.Build:
    """Bring a table up to date with its loads, reading only those that came after the published version.

    A collapsed table is the sum of its parts: the new rows are collapsed by themselves and their counts
    added to the published ones.  Where that does not hold, the table is recomputed: no version yet, a
    file in it loaded anew, other rules, or a table whose rows are judged together.  Without new loads
    the published version stays.
    """
    state = store.arrivals(spark, layout, table, digest(rules)) if table in COLLAPSED else None
    if state is None:
        return build(spark, layout, table, rules)
    published, new = state
    if not new:
        return published
    expected = store.require_complete(spark, layout, table)
    arrived = refine(store.scan_arrivals(spark, layout, table, new), table, rules)
    lists = COLLAPSED[table]
    keys = [c for c in arrived.columns if c not in {dedup.COUNT, BUILD_STAMP, *[c for pair in lists for c in pair]}]
    present = store.read_build(spark, published).select(*[c for c in arrived.columns if c != BUILD_STAMP])
    merged = dedup.merge_counts(present, arrived.drop(BUILD_STAMP), keys, lists)
    staged = store.write_build(clean.conform(clean.stamp(merged, BUILD_STAMP), silver_schema(table)), layout, table)
    return _checked(spark, layout, staged, expected, rules)


def build_all(
    spark: SparkSession, layout: Layout, rules: CleaningRules = CleaningRules(), tables: tuple[str, ...] = tuple(BUILDERS)
) -> dict[str, store.Build]:
    """Build the chosen tables in fixed order and stop at the first failure."""
    store.ensure_namespaces(spark, layout)
    built = {}
    for table in tables:
        spark.sparkContext.setJobGroup(f"silver.{table}", f"build silver.{table}")
        log.info("building silver.%s", table)
        built[table] = build(spark, layout, table, rules)
    return built
