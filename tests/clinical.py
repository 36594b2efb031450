"""A small clinical export with planted defects and known answers.  All ids are invented."""

import csv
import hashlib
import os

PHANTOM = ("enc-phantom", "pat-ghost")
TALL = "enc-tall"


def pid(n):
    return hashlib.md5(str(n).encode()).hexdigest()[:16]


INFO = [
    "LOG_ID", "MRN", "DISCH_DISP_C", "DISCH_DISP", "HOSP_ADMSN_TIME", "HOSP_DISCH_TIME", "LOS", "ICU_ADMIN_FLAG", "SURGERY_DATE",
    "BIRTH_DATE", "HEIGHT", "WEIGHT", "SEX", "PRIMARY_ANES_TYPE_NM", "ASA_RATING_C", "ASA_RATING", "PATIENT_CLASS_GROUP",
    "PATIENT_CLASS_NM", "PRIMARY_PROCEDURE_NM", "IN_OR_DTTM", "OUT_OR_DTTM", "AN_START_DATETIME", "AN_STOP_DATETIME",
]


def info(log_id, mrn, **other):
    row = {
        "LOG_ID": log_id, "MRN": mrn, "DISCH_DISP_C": "1", "DISCH_DISP": "Home Routine", "HOSP_ADMSN_TIME": "2020-01-01 08:00:00",
        "HOSP_DISCH_TIME": "2020-01-03 10:00:00", "LOS": "2", "ICU_ADMIN_FLAG": "No", "SURGERY_DATE": "1/1/20", "BIRTH_DATE": "50",
        "HEIGHT": "5' 10", "WEIGHT": "1000", "SEX": "Female", "PRIMARY_ANES_TYPE_NM": "General", "ASA_RATING_C": "2", "ASA_RATING": "Mild",
        "PATIENT_CLASS_GROUP": "Inpatient", "PATIENT_CLASS_NM": "Inpatient Admission", "PRIMARY_PROCEDURE_NM": "Biopsy",
        "IN_OR_DTTM": "2020-01-01 09:00:00", "OUT_OR_DTTM": "2020-01-01 10:00:00", "AN_START_DATETIME": "1/1/20 8:50",
        "AN_STOP_DATETIME": "1/1/20 10:10",
    }
    row.update(other)
    return [row[name] for name in INFO]


def tables():
    one = info("enc-1", pid(1))
    rows = {"patient_information": (INFO, [
        one, one,  # an exact copy
        info("enc-1b", pid(1), PRIMARY_ANES_TYPE_NM="General "), info("enc-1b", pid(1)),  # equal after trimming
        info("enc-coll", pid(2), BIRTH_DATE="30"), info("enc-coll", pid(3), BIRTH_DATE="60"),
        info("enc-mangled", "6.13E+15"), info("enc-mangled", "6.13048E+15"), info("enc-mangled", "6.13048E+15"),
        info("enc-conf", pid(4), BIRTH_DATE="64"), info("enc-conf", pid(4), BIRTH_DATE="66"),
        info(*PHANTOM), info(PHANTOM[0], pid(5)),
        info("enc-dec", pid(6), HEIGHT="5' 7.325"), info("enc-quote", pid(6), HEIGHT="5'10\""), info("enc-blank", pid(6), HEIGHT=""),
        info(TALL, pid(6), HEIGHT="8' 2.3"), info("enc-89", pid(7), BIRTH_DATE="89"), info("enc-90", pid(7), BIRTH_DATE="90"),
        info("enc-noage", pid(7), BIRTH_DATE="NULL"),
        info("enc-word", pid(8), DISCH_DISP="Designated Disaster Alternative Care Site"),
        info("enc-word2", pid(8), DISCH_DISP="Designated Disaster Alternative Care Site "),
        info("enc-codes", pid(9), DISCH_DISP_C="12.0", ASA_RATING_C="x"), info("enc-asa", pid(9), ASA_RATING="Mild"),
        info("enc-asa", pid(9), ASA_RATING="Severe"),
    ])}
    rows["patient_history"] = (["mrn", "diagnosis_code", "dx_name"], [
        *[[pid(1), "346.9", "Migraine"]] * 37, [pid(1), "IMO0001", "No known problems"], [pid(2), "", "Knee sprain "],
        [pid(2), "NA", " Knee sprain"], [pid(2), "844.9", 'said "no",\nthen yes'], ["6130480000000000", "844.9", "Knee sprain"],
    ])
    rows["patient_visit"] = (["LOG_ID", "mrn", "diagnosis_code", "dx_name"], [
        *[["enc-1", pid(1), "814.0", "Wrist fracture"]] * 21, ["enc-orphan", pid(99), "401.9", "Hypertension"],
    ])
    rows["patient_coding"] = (["MRN", "SOURCE_KEY", "SOURCE_NAME", "NAME", "REF_BILL_CODE_SET_NAME", "REF_BILL_CODE"], [
        *[[pid(1), "4", "ICD Procedure Primary Code Set", "Reposition", "ICD-10-PCS", "0QS604Z"]] * 88,
        [pid(2), "3", "Final Diagnosis Primary Code Set", "Diabetes", "ICD-10-CM", "E11.649"],
        [pid(2), "3", "Final Diagnosis Primary Code Set", "Diabetes", "ICD-10-CM", "E11.649 "], [pid(3), "3", "Final Di", "", "", ""],
    ])
    complication = ["LOG_ID", "MRN", "Element_Name", "CONTEXT_NAME", "Element_abbr", "SMRTDTA_ELEM_VALUE"]
    rows["patient_post_op_complications"] = (complication, [
        *[["enc-1", pid(1), "AN AQI POST-OP COMPLICATIONS", "NOTE", "AN Post-op Complications", ""]] * 17,
        *[["enc-1", pid(1), "Respiratory", "ENCOUNTER", "Resp", "Respiratory Failure"]] * 2,
        ["enc-coll", pid(2), "Cardiovascular", "ENCOUNTER", "CV", ""], ["enc-coll", pid(2), "Airway", "ORDER", "Airway", ""],
    ])
    device = ["enc-1", pid(1), "[REMOVED] Catheter", "Inserted By: RN", "Arm", "2020-01-01 07:00:00", "2020-01-02 07:00:00", "CATHETER"]
    rows["patient_lda"] = (
        ["LOG_ID", "MRN", "description", "properties_display", "site", "placement_instant", "removal_instant", "flo_meas_name",
         "Line_Group_Name"], [
            [*device, "Urinary Drainage"], [*device, "Drain"], ["enc-2", *device[1:], "Drain"], ["enc-2", *device[1:], "Drain "],
            ["enc-3", *device[1:], "Drain"], ["enc-3", *device[1:], ""], ["enc-4", *device[1:], ""],
        ])
    rows["patient_procedure_events"] = (["LOG_ID", "MRN", "EVENT_DISPLAY_NAME", "EVENT_TIME", "NOTE_TEXT"], [
        *[["enc-1", pid(1), "Timeout Done", "2020-01-01 09:41:00", ""]] * 58, ["enc-1", pid(1), "Timeout Done", "2020-01-01 09:43:00", ""],
        ["enc-1", pid(1), "Sign In", "2020-01-01 09:00:00", "alert, oriented"],
    ])
    lab = ["enc-1", pid(1), "Hospital Encounter", "2345-7", "Glucose", "112.0", "MG/DL", "70-99", "N", "2022-04-09 06:20:00"]
    rows["patient_labs"] = (
        ["LOG_ID", "MRN", "ENC_TYPE_NM", "Lab Code", "Lab Name", "Observation Value", "Measurement Units", "Reference Range", "Abnormal Flag",
         "Collection Datetime"], [
            lab, lab, [*lab[:6], "MG / DL", *lab[7:]], [*lab[:7], "65-105", *lab[8:]], [*lab[:8], "", lab[9]],
            [*lab[:5], "9999999.0", *lab[6:9], "2021-05-01 10:00:00"],
        ])
    med = ["3", "Hospital Encounter", "enc-1", pid(1), "2020-01-01", "Inpatient", "99999204200", "heparin", "HEPARIN (X)", "2020-01-01",
           "2020-01-02", "Discontinued", "INTRA-OP", "Given", "2020-01-01 09:30:00", "5.5", "mg", "IV"]
    rows["patient_medications"] = (
        ["ENC_TYPE_C", "ENC_TYPE_NM", "LOG_ID", "MRN", "ORDERING_DATE", "ORDER_CLASS_NM", "MEDICATION_ID", "DISPLAY_NAME", "MEDICATION_NM",
         "START_DATE", "END_DATE", "ORDER_STATUS_NM", "RECORD_TYPE", "MAR_ACTION_NM", "MED_ACTION_TIME", "ADMIN_SIG", "DOSE_UNIT_NM",
         "MED_ROUTE_NM"], [med, med, [*med[:13], "Given ", *med[14:]], [*med[:15], "0 NULL", *med[16:]],
                           [*med[:14], "2021-01-01 00:00:00", "7", *med[16:]]])
    return rows


FLOW = ["Unnamed: 0", "LOG_ID", "MRN", "FLO_NAME", "FLO_DISPLAY_NAME", "RECORD_TYPE", "RECORDED_TIME", "MEAS_VALUE", "UNITS"]


def flow_parts():
    def row(i, name, value, units="", time="2020-01-01 09:00:00", show="Pulse"):
        return [str(i), "enc-1", pid(1), name, show, "INTRA-OP", time, value, units]

    units = ["cmH20", "l/min", "ml", " mL", ',",4"', ""]
    return {
        "flowsheet_part1.csv": [row(i, "Vital Signs " if i < 23 else "Vital Signs", "98.6") for i in range(150)],
        "flowsheet_part2.csv": [row(i, "Vital Signs", "98.6") for i in range(61)]
        + [row(500 + i, "Vital Signs", value, time="2021-06-01 00:00:00", show="Rhythm") for i, value in enumerate(["NSR", "", "NaN", "5d", "1e2"])],
        "flowsheet_part10.csv": [row(i, "Ventilation", "1", u, f"2022-01-01 0{i}:00:00", "Resp") for i, u in enumerate(units)],
    }


def write(folder):
    from chartmill.schemas import BRONZE

    os.makedirs(f"{folder}/flowsheets_cleaned")
    files = {f"{folder}/{BRONZE[name].source}": content for name, content in tables().items()}
    files |= {f"{folder}/flowsheets_cleaned/{name}": (FLOW, rows) for name, rows in flow_parts().items()}
    for path, (header, rows) in files.items():
        with open(path, "w", newline="", encoding="utf-8") as handle:
            out = csv.writer(handle)
            out.writerow(header)
            out.writerows(rows)
    return folder
