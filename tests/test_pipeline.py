"""CSV to verified silver, over the planted export."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from chartmill.config import CleaningRules, Expectation, Layout
from chartmill.operators import dedup, quality
from chartmill.plans import audit, bronze, explore, silver, verify
from chartmill.schemas import BRONZE, silver_schema
from chartmill.sources import scans, store, text
from chartmill.streaming.parts import incremental_parts
from tests import clinical

RULES = CleaningRules(
    phantom_rows=(clinical.PHANTOM,), implausible_height=(clinical.TALL,),
    expected={"patient_history": Expectation(rows=5), "patient_information": Expectation(distinct_key=("LOG_ID", 17)),
              "patient_lda": Expectation(rows_above=2)},
)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    source = clinical.write(str(root / "csv"))
    layout = Layout(str(root / "warehouse"))
    bronze.ingest_all(spark, layout, source, RULES)
    silver.build_all(spark, layout, RULES)
    return spark, layout, source


def rows(df):
    return [row.asDict() for row in df.collect()]


def test_every_source_record_is_loaded_once(lake):
    spark, layout, source = lake
    expected = {name: len(content[1]) for name, content in clinical.tables().items()}
    expected["flowsheets"] = sum(len(part) for part in clinical.flow_parts().values())
    for name in BRONZE:
        assert store.scan_bronze(spark, layout, name).count() == expected[name], name


def test_second_run_loads_nothing(lake):
    spark, layout, source = lake
    assert set(bronze.ingest_all(spark, layout, source, RULES).values()) == {0}


def test_bronze_schema_and_provenance(lake):
    spark, layout, _ = lake
    for name, spec in BRONZE.items():
        df = store.scan_bronze(spark, layout, name)
        declared = [(f.name, f.dataType) for f in spec.schema.fields]
        assert [(f.name, f.dataType) for f in df.schema.fields][:len(declared)] == declared
    files = store.scan_bronze(spark, layout, "flowsheets").select("_source_file").distinct().collect()
    assert {row[0] for row in files} == set(clinical.flow_parts())


def test_ledger_keeps_numeric_part_order_and_counts(lake):
    spark, layout, source = lake
    entries = store.current_loads(spark, layout, "flowsheets").withColumn("n", text.part_number(F.col("_source_file"))).orderBy("n").collect()
    assert [row._source_file for row in entries] == ["flowsheet_part1.csv", "flowsheet_part2.csv", "flowsheet_part10.csv"]
    assert [row.ingested_rows for row in entries] == [150, 66, 6]
    assert all(row.status == "done" and row.physical_lines == row.source_rows for row in entries)
    history = store.current_loads(spark, layout, "patient_history").first()
    assert history.physical_lines == history.source_rows + 1  # one record holds a line break
    stats = text.part_stats(spark, f"{source}/flowsheets_cleaned/*.csv", multi_line=False).collect()
    assert [row.rows for row in stats] == [150, 66, 6] and all(row.bytes > 0 for row in stats)


def test_typing(lake):
    spark, layout, _ = lake
    info = store.scan_bronze(spark, layout, "patient_information").where("LOG_ID = 'enc-codes'").first()
    assert info.DISCH_DISP_C == 12 and info.ASA_RATING_C is None
    assert str(info.SURGERY_DATE) == "2020-01-01 00:00:00" and str(info.AN_START_DATETIME) == "2020-01-01 08:50:00"
    doses = store.scan_bronze(spark, layout, "patient_medications").select("ADMIN_SIG", "MEDICATION_ID").collect()
    assert sorted((d.ADMIN_SIG is None, d.ADMIN_SIG or 0) for d in doses)[-1] == (True, 0)
    assert {d.MEDICATION_ID for d in doses} == {99999204200}
    values = store.scan_bronze(spark, layout, "flowsheets").where("FLO_DISPLAY_NAME = 'Rhythm'")
    got = sorted((r.MEAS_VALUE_NUM or -1, r.MEAS_VALUE_TXT or "") for r in values.collect())
    assert got == [(-1, ""), (-1, ""), (-1, "5d"), (-1, "NSR"), (100.0, "")]
    quoted = store.scan_bronze(spark, layout, "patient_history").where(F.col("dx_name").contains("said")).first()
    assert quoted.dx_name == 'said "no",\nthen yes'


def test_silver_schemas(lake):
    spark, layout, _ = lake
    for name in silver.BUILDERS:
        got = [(f.name, f.dataType) for f in store.scan_silver(spark, layout, name).schema.fields if not f.name.endswith("_year")]
        assert got == [(f.name, f.dataType) for f in silver_schema(name).fields]


def test_patient_information(lake):
    spark, layout, _ = lake
    df = store.scan_silver(spark, layout, "patient_information")
    by_key = {}
    for row in df.collect():
        by_key.setdefault(row.LOG_ID, []).append(row)
    assert len(by_key["enc-1"]) == 1 and by_key["enc-1"][0].n_occurrences == 2
    assert len(by_key["enc-1b"]) == 1
    assert [r.log_id_collision for r in by_key["enc-coll"]] == [True, True]
    (mangled,) = by_key["enc-mangled"]
    assert mangled.mrn_corrupt and mangled.MRN == "6.13048E+15" and mangled.n_occurrences == 3 and not mangled.log_id_collision
    assert [r.has_conflicting_duplicate for r in by_key["enc-conf"]] == [True, True]
    assert [r.has_conflicting_duplicate for r in by_key["enc-asa"]] == [True, True]
    (real,) = by_key[clinical.PHANTOM[0]]
    assert real.MRN == clinical.pid(5) and not real.log_id_collision and not real.has_conflicting_duplicate
    assert by_key["enc-1"][0].height_in == 70.0 and abs(by_key["enc-dec"][0].height_in - 67.325) < 1e-9
    assert [by_key[k][0].height_in for k in ("enc-quote", "enc-blank", clinical.TALL)] == [None, None, None]
    assert [by_key[k][0].age_capped for k in ("enc-89", "enc-90", "enc-noage")] == [False, True, None]
    assert abs(by_key["enc-1"][0].weight_kg - 28.3495) < 1e-9
    assert {by_key[k][0].DISCH_DISP for k in ("enc-word", "enc-word2")} == {"Designated Disaster Alternate Care Site"}
    assert df.agg(F.sum("n_occurrences")).first()[0] == len(clinical.tables()["patient_information"][1]) - 1


def test_known_groups(lake):
    spark, layout, _ = lake
    scan = lambda name: store.scan_silver(spark, layout, name)
    assert scan("patient_history").where("dx_name = 'Migraine'").first().n_occurrences == 37
    assert scan("patient_history").where("dx_name = 'Knee sprain' AND diagnosis_code IS NULL").first().n_occurrences == 2
    assert scan("patient_visit").agg(F.max("n_occurrences")).first()[0] == 21
    assert scan("patient_coding").where("REF_BILL_CODE = '0QS604Z'").first().n_occurrences == 88
    assert scan("patient_coding").where("REF_BILL_CODE = 'E11.649'").first().n_occurrences == 2
    marks = scan("patient_procedure_events").where("EVENT_DISPLAY_NAME = 'Timeout Done'").orderBy("EVENT_TIME").collect()
    assert [row.n_occurrences for row in marks] == [58, 1]
    assert scan("flowsheets").agg(F.max("n_occurrences")).first()[0] == 211
    labs = scan("patient_labs").where("Lab_Code = '2345-7' AND Observation_Value < 1000")
    assert sorted(row.n_occurrences for row in labs.collect()) == [1, 1, 1, 2]
    doses = scan("patient_medications").where("ADMIN_SIG = 5.5").collect()
    assert [row.n_occurrences for row in doses] == [3]
    units = [row.UNITS for row in scan("flowsheets").where("FLO_NAME = 'Ventilation'").orderBy("RECORDED_TIME").collect()]
    assert units == ["cmH2O", "L/min", "mL", "mL", None, None]


def test_devices(lake):
    spark, layout, _ = lake
    got = {row.LOG_ID: (row.line_group_names, row.multi_navigator, row.n_occurrences) for row in store.scan_silver(spark, layout, "patient_lda").collect()}
    assert got == {
        "enc-1": (["Drain", "Urinary Drainage"], True, 2), "enc-2": (["Drain"], False, 2),
        "enc-3": (["Drain", None], False, 2), "enc-4": ([None], False, 1),
    }


def test_verify_layer(lake):
    spark, layout, _ = lake
    extra = {
        "patient_history": [quality.expect_group("headaches", F.col("dx_name") == "Migraine", 37)],
        "patient_labs": [quality.expect_separate("units", F.col("Observation_Value") == 112.0, 4)],
    }
    results = verify.verify_layer(spark, layout, RULES, extra=extra)
    statuses = rows(results)
    assert {row["status"] for row in statuses} == {"PASS"}, [r for r in statuses if r["status"] != "PASS"]
    assert not verify.failed(results)
    wrong = verify.verify_layer(spark, layout, RULES, ("patient_history",), {"patient_history": [quality.expect_rows(1)]})
    assert verify.failed(wrong)


def test_unbuilt_table_is_skipped(spark, tmp_path):
    results = verify.verify_layer(spark, Layout(str(tmp_path)), RULES, ("patient_labs",))
    assert [row.status for row in results.collect()] == ["SKIP"]


def test_failed_gate_leaves_the_published_version(lake):
    spark, layout, _ = lake
    before = store.current_builds(spark, layout)["patient_visit"].build_id
    strict = CleaningRules(expected={"patient_visit": Expectation(rows=1)})
    with pytest.raises(quality.GateError):
        silver.build(spark, layout, "patient_visit", strict)
    assert store.current_builds(spark, layout)["patient_visit"].build_id == before


def test_catalog_follows_the_published_version(lake):
    spark, layout, _ = lake
    assert spark.table("silver.patient_visit").count() == 2
    silver.build(spark, layout, "patient_labs", RULES)
    assert spark.table("silver.patient_labs").where("collection_year = 2021").count() == 1
    assert "silver.flowsheets" in store.attach(spark, layout)


def test_catalog_entry_with_other_schema_or_layout_is_recreated(lake):
    spark, layout, _ = lake
    build = store.current_builds(spark, layout)["patient_labs"]
    args = (spark, "silver", "patient_labs", silver_schema("patient_labs"), build.path, "collection_year")
    assert store.ensure_table(*args) == "relocated"
    spark.sql("DROP TABLE silver.patient_labs")
    spark.sql(f"CREATE TABLE silver.patient_labs (LOG_ID string) USING parquet LOCATION '{build.path}'")
    assert "schema" in store.ensure_table(*args)
    spark.sql("DROP TABLE silver.patient_labs")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in silver_schema("patient_labs").fields)
    spark.sql(f"CREATE TABLE silver.patient_labs ({fields}) USING parquet LOCATION '{build.path}'")
    assert "partitioning" in store.ensure_table(*args)
    assert spark.table("silver.patient_labs").count() == 5


def test_year_predicate_prunes_folders(lake):
    spark, layout, _ = lake
    labs = store.scan_silver(spark, layout, "patient_labs")
    kept = scans.scan_time_range(labs, "Collection_Datetime", *scans.month_bounds(2022), "collection_year")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection_year" in plan and kept.count() == 4


def test_views_and_distributions(lake):
    spark, layout, _ = lake
    explore.register_layer(spark, layout, "silver")
    assert spark.sql("SELECT count(*) FROM patient_history").first()[0] == 5
    explore.register_layer(spark, layout, "bronze")
    assert spark.sql("SELECT count(*) FROM patient_history").first()[0] == 42
    found = explore.age_and_stay(store.scan_bronze(spark, layout, "patient_information"))
    assert found["age"].count() == 40 and found["stay"].count() == 60
    ages = {row.column: row for row in found["describe"].collect()}["age_years"]
    assert ages["max"] == 90 and ages["count"] == 24


def test_audit_of_the_exports(lake):
    spark, _, source = lake
    found = {(r.table, r.about, r.measure): r.value for r in audit.audit(spark, source, RULES, ("flowsheets", "patient_visit")).collect()}
    assert found["patient_visit", "mrn", "n_distinct"] == "2" and found["patient_visit", "dx_name", "n_null"] == "0"
    assert found["flowsheets", "flowsheet_part10.csv", "rows"] == "6" and found["flowsheets", "LOG_ID", "n_rows"] == "222"
    assert [found["flowsheets", "MEAS_VALUE", m] for m in ("n_numeric", "n_text")] == ["218", "2"]


def test_interrupted_load_is_invisible_and_repeatable(spark, tmp_path):
    source = clinical.write(str(tmp_path / "csv"))
    layout = Layout(str(tmp_path / "warehouse"))
    pattern = f"{source}/flowsheets_cleaned/flowsheet_part*.csv"
    # A load that wrote its files but died before the ledger entry.
    raw = text.read_csv_parts(spark, f"{source}/flowsheets_cleaned/flowsheet_part2.csv", False)
    raw = raw.drop(text.CORRUPT)
    store.write_load(bronze.to_bronze(raw, "flowsheets", RULES), layout, "flowsheets", "dead")
    assert store.scan_bronze(spark, layout, "flowsheets").count() == 0
    assert bronze.ingest(spark, layout, "flowsheets", pattern, RULES, batch_files=2) == 3
    assert store.scan_bronze(spark, layout, "flowsheets").count() == 222
    # Forcing one part again replaces it.
    part = [p for p in [("flowsheet_part1.csv", f"{source}/flowsheets_cleaned/flowsheet_part1.csv")]]
    bronze.load_parts(spark, layout, "flowsheets", part, RULES)
    assert store.scan_bronze(spark, layout, "flowsheets").count() == 222


LABS = '"LOG_ID","MRN","ENC_TYPE_NM","Lab Code","Lab Name","Observation Value","Measurement Units","Reference Range","Abnormal Flag","Collection Datetime"\n'


def lab(key, reference="70-99", tail=""):
    return f'"{key}","p{key}","Visit","2345-7","Glucose","{len(key)}","MG/DL","{reference}","N","2022-04-09 06:20:00"{tail}\n'


def labs_lake(tmp_path, *parts):
    folder = tmp_path / "labs"
    folder.mkdir()
    for i, lines in enumerate(parts):
        (folder / f"part{i}.csv").write_text(LABS + lines)
    return Layout(str(tmp_path / "it's here")), f"{folder}/part*.csv"


def test_a_quoted_line_break_stays_in_its_record(spark, tmp_path):
    layout, source = labs_lake(tmp_path, lab("a") + lab("b", 'low\n""and"" high,\n\nor so') + lab("c"), lab("d"))
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    got = {row.LOG_ID: row.Reference_Range for row in store.scan_bronze(spark, layout, "patient_labs").collect()}
    assert got == {"a": "70-99", "b": 'low\n"and" high,\n\nor so', "c": "70-99", "d": "70-99"}
    entries = {row._source_file: (row.status, row.source_rows, row.physical_lines) for row in store.current_loads(spark, layout, "patient_labs").collect()}
    assert entries == {"part0.csv": ("done", 3, 6), "part1.csv": ("done", 1, 1)}
    silver.build_all(spark, layout, RULES, ("patient_labs",))  # the path holds a quote
    assert store.scan_silver(spark, layout, "patient_labs").count() == 4


@pytest.mark.parametrize("bad", [lab("b", tail=',"more"'), '"b","p"\n'])
def test_a_ragged_record_stops_everything(spark, tmp_path, bad):
    layout, source = labs_lake(tmp_path, lab("a"), lab("c") + bad)
    with pytest.raises(store.IncompleteLoad, match="part1.csv"):
        bronze.ingest(spark, layout, "patient_labs", source, RULES)
    assert {row.status for row in store.current_loads(spark, layout, "patient_labs").collect()} == {"done", "mismatch"}
    with pytest.raises(store.IncompleteLoad):
        silver.build(spark, layout, "patient_labs", RULES)
    (tmp_path / "labs" / "part1.csv").write_text(LABS + lab("c"))
    assert bronze.ingest(spark, layout, "patient_labs", source, RULES) == 1
    assert store.scan_bronze(spark, layout, "patient_labs").count() == 2


def test_a_file_is_parsed_once(spark, tmp_path, monkeypatch):
    """Besides the header, the only frame that reads CSV and is run is the one that is written."""
    layout, source = labs_lake(tmp_path, lab("a") + lab("b"), lab("c"))
    readers, written = [], []
    read, write = text.read_csv_parts, store.write_load

    def watched_write(df, *args):
        written.append(df.inputFiles())
        return write(df, *args)

    monkeypatch.setattr(text, "read_csv_parts", lambda *args: readers.append(args) or read(*args))
    monkeypatch.setattr(store, "write_load", watched_write)
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    assert len(readers) == 1 and len(written) == 1 and len(written[0]) == 2
    rows = store.current_loads(spark, layout, "patient_labs")
    assert {(r._source_file, r.source_rows, r.ingested_rows, r.malformed_rows) for r in rows.collect()} == {("part0.csv", 2, 2, 0), ("part1.csv", 1, 1, 0)}
    load = rows.first().load_id
    counted = store.read_load(spark, layout, "patient_labs", [load], text.MALFORMED).groupBy(text.SOURCE_FILE).agg(F.count_if(text.MALFORMED))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "csv" not in plan.lower().replace("part0.csv", "") and f"ReadSchema: struct<{text.MALFORMED}:boolean>" in plan


def test_a_line_of_blanks_is_no_record(spark, tmp_path):
    layout, source = labs_lake(tmp_path, lab("a") + "\t\n" + "  \n" + lab("b"))
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    assert store.scan_bronze(spark, layout, "patient_labs").count() == 2


def test_verify_fails_on_an_incomplete_load(spark, tmp_path):
    layout, source = labs_lake(tmp_path, lab("a"), lab("b"))
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    silver.build_all(spark, layout, RULES, ("patient_labs",))
    assert not verify.failed(verify.verify_layer(spark, layout, RULES, ("patient_labs",)))
    (tmp_path / "labs" / "part2.csv").write_text(LABS + lab("c", tail=',"more"'))
    with pytest.raises(store.IncompleteLoad):
        bronze.ingest(spark, layout, "patient_labs", source, RULES)
    assert verify.failed(verify.verify_layer(spark, layout, RULES, ("patient_labs",)))


def silver_rows(spark, layout, table):
    return sorted(map(str, store.scan_silver(spark, layout, table).drop(silver.BUILD_STAMP).collect()))


def test_an_update_reads_new_loads_only_and_equals_a_rebuild(spark, tmp_path, monkeypatch):
    layout, source = labs_lake(tmp_path, lab("a") + lab("b") * 2, lab("c"))
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    store.ensure_namespaces(spark, layout)
    read, built = [], []
    arrivals, full = store.scan_arrivals, silver.build
    monkeypatch.setattr(store, "scan_arrivals", lambda *args: read.append(args[3]) or arrivals(*args))
    monkeypatch.setattr(silver, "build", lambda *args: built.append(args[2]) or full(*args))
    first = silver.update(spark, layout, "patient_labs", RULES)
    assert built == ["patient_labs"] and silver.update(spark, layout, "patient_labs", RULES) == first
    (tmp_path / "labs" / "part2.csv").write_text(LABS + lab("b") + lab("d") + lab("a") * 3)
    bronze.ingest(spark, layout, "patient_labs", source, RULES)
    silver.update(spark, layout, "patient_labs", RULES)
    assert built == ["patient_labs"] and [[file for _, file in new] for new in read] == [["part2.csv"]]
    counts = {row.LOG_ID: row.n_occurrences for row in store.scan_silver(spark, layout, "patient_labs").collect()}
    assert counts == {"a": 4, "b": 3, "c": 1, "d": 1}
    updated = silver_rows(spark, layout, "patient_labs")
    full(spark, layout, "patient_labs", RULES)
    assert silver_rows(spark, layout, "patient_labs") == updated
    # Other rules, or a file loaded anew, make a full build.
    silver.update(spark, layout, "patient_labs", CleaningRules(phantom_rows=(("x", "y"),)))
    assert len(built) == 2
    path = tmp_path / "labs" / "part2.csv"
    bronze.load_parts(spark, layout, "patient_labs", [("part2.csv", str(path))], RULES)
    silver.update(spark, layout, "patient_labs", CleaningRules(phantom_rows=(("x", "y"),)))
    assert len(built) == 3 and silver_rows(spark, layout, "patient_labs") == updated


def test_merged_lists_equal_collapsed_ones(spark):
    rows = [(k, v) for k in range(6) for v in ["p", "q", None, "r", "p"][: k]]
    halves = [spark.createDataFrame(rows[i::2], "k int, v string") for i in (0, 1)]
    parts = [dedup.collapse_collect(half, ["k"], "v", "vs", "several") for half in halves]
    whole = dedup.collapse_collect(spark.createDataFrame(rows, "k int, v string"), ["k"], "v", "vs", "several")
    assert sorted(dedup.merge_counts(*parts, ["k"], [("vs", "several")]).collect()) == sorted(whole.collect())


def test_incremental_parts(spark, tmp_path):
    source = clinical.write(str(tmp_path / "csv"))
    layout = Layout(str(tmp_path / "warehouse"))
    folder = str(tmp_path / "arriving")
    os.makedirs(folder)
    shutil.copy(f"{source}/flowsheets_cleaned/flowsheet_part1.csv", folder)
    for expected in (150, 222, 222):
        query = incremental_parts(spark, layout, "flowsheets", folder, "flowsheet_part*.csv", str(tmp_path / "state"), RULES)
        query.awaitTermination()
        assert query.exception() is None
        assert store.scan_bronze(spark, layout, "flowsheets").count() == expected
        for name in ("flowsheet_part2.csv", "flowsheet_part10.csv"):
            shutil.copy(f"{source}/flowsheets_cleaned/{name}", folder)


def test_arrivals_reach_silver(spark, tmp_path):
    layout, source = labs_lake(tmp_path, lab("a") + lab("b"))
    store.ensure_namespaces(spark, layout)
    for extra in ("", lab("b") + lab("c")):
        if extra:
            (tmp_path / "labs" / "later.csv").write_text(LABS + extra)
        query = incremental_parts(spark, layout, "patient_labs", str(tmp_path / "labs"), "*.csv", str(tmp_path / "state"), RULES, update_silver=True)
        query.awaitTermination()
        assert query.exception() is None
    assert {row.LOG_ID: row.n_occurrences for row in store.scan_silver(spark, layout, "patient_labs").collect()} == {"a": 1, "b": 2, "c": 1}


def test_required_column_must_be_set(spark):
    raw = spark.createDataFrame([(None, "250", "x")], "mrn string, diagnosis_code string, dx_name string")
    with pytest.raises(Exception, match="required column mrn is null"):
        bronze.to_bronze(raw, "patient_history", RULES).collect()


def test_rules_from_json(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"phantom_rows": [["a", "b"]], "implausible_height": ["c"], '
                    '"expected": {"patient_information": {"rows": 3, "distinct_key": ["LOG_ID", 2]}}}')
    rules = CleaningRules.from_json(str(path))
    assert rules.phantom_rows == (("a", "b"),) and rules.expected["patient_information"].distinct_key == ("LOG_ID", 2)
