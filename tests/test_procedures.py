"""Procedure-style entry points: messages, report tables, composite chains."""

from __future__ import annotations

import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from sluice.operators.load import read_table_rows
from sluice.operators.snapshot import create_table
from sluice.plans.master import Side
from sluice.plans.procedures import (CREATE_REPORT, LOAD_REPORT, create_schema_and_tables,
                                     land_and_unload, load_data_from_files, merge_data_to_master,
                                     prep_csv_files)
from sluice.sources.api import RESPONSES_SCHEMA
from sluice.sources.unload import read_unloaded

RUN = dt.datetime(2025, 1, 2, 3, 4, 5)


def gz(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_create_load_merge_procedures(spark, tmp):
    land, wh = f"{tmp}/land", f"{tmp}/wh"
    gz(f"{land}/patients_20250102000000_UTC.csv.gz", "master_patient_id,name\n1,a\n2,b\n3,c\n")
    gz(f"{land}/encounters_20250102000000_UTC.csv.gz",
       "master_patient_id,patient_encounter_id\n1,10\n1,11\n2,20\n")
    gz(f"{land}/encounters_20250103000000_UTC.csv.gz", "master_patient_id,patient_encounter_id\n3,x\n")
    msg = create_schema_and_tables(spark, land, wh)
    assert msg.startswith("2 of 2 tables created")
    made = {r["entity"]: r for r in spark.read.parquet(f"{wh}/{CREATE_REPORT}").collect()}
    assert made["ENCOUNTERS"]["created"] and "PATIENT_ENCOUNTER_ID" in made["ENCOUNTERS"]["columns"]
    msg = load_data_from_files(spark, land, wh, RUN)
    assert msg.startswith("loaded with failures: 2 loaded, 1 failed, 0 skipped")
    rep = {r["file_name"]: r for r in spark.read.parquet(f"{wh}/{LOAD_REPORT}").collect()}
    good = rep["patients_20250102000000_UTC.csv.gz"]
    assert good["all_loaded"] and good["rows_loaded"] == 3
    bad = rep["encounters_20250103000000_UTC.csv.gz"]
    assert not bad["all_loaded"] and '"status":"FAILED"' in bad["result_text"]
    assert "does not fit" in bad["message"]
    assert load_data_from_files(spark, land, wh, RUN).startswith("loaded with failures: 0 loaded")

    patients = read_table_rows(spark, wh, "PATIENTS")
    enc = read_table_rows(spark, wh, "ENCOUNTERS")
    sides = [Side(enc, "MASTER_PATIENT_ID", "PATIENT_ENCOUNTER_ID", "encounters_patient_encounter_id")]
    master = f"{wh}/MASTER_PATIENT_LOOKUP"
    r1 = merge_data_to_master(spark, patients, "MASTER_PATIENT_ID", "patients_master_patient_id",
                              sides, "master_patient_lookup_table_unique_key", master, RUN.date())
    assert r1.rows_inserted == 4          # 1 -> 10, 11; 2 -> 20; 3 -> none
    r2 = merge_data_to_master(spark, patients, "MASTER_PATIENT_ID", "patients_master_patient_id",
                              sides, "master_patient_lookup_table_unique_key", master, RUN.date())
    assert r2.rows_inserted == 0
    assert spark.read.parquet(master).count() == 4


def test_prep_csv_files_message(spark, tmp):
    gz(f"{tmp}/raw/a_20250102000000_UTC.csv.gz", "c\n x \n")
    msg = prep_csv_files(spark, f"{tmp}/raw", f"{tmp}/prep")
    assert msg.startswith("cleaning done: {")
    assert '"processed_files"' in msg
    empty = prep_csv_files(spark, f"{tmp}/none", f"{tmp}/prep2")
    assert "nothing to clean" in empty


class Fake:
    def __call__(self, api_name, start_date=None, end_date=None):
        if api_name == "neo_data":
            return {"near_earth_objects": {start_date: [{"id": "1"}]}}
        return '{"member": []}'


def test_land_and_unload(spark, tmp):
    created = create_table(spark, f"{tmp}/responses", RESPONSES_SCHEMA)
    assert created and not create_table(spark, f"{tmp}/responses", RESPONSES_SCHEMA)
    requests = spark.createDataFrame([("neo_data", "2025-01-02", "2025-01-02"),
                                      ("tle_data", None, None)],
                                     "api_name string, start_date string, end_date string")
    msg = land_and_unload(spark, requests, Fake, ["api_name", "start_date", "end_date"],
                          f"{tmp}/responses", f"{tmp}/out", dt.date(2025, 1, 2))
    assert msg.startswith("unloaded: {") and "neo_data_20250102.json.gz" in msg
    back = read_unloaded(spark, f"{tmp}/out")
    assert sorted(r["feed"] for r in back.collect()) == ["neo_data", "tle_data"]
    assert back.where(F.col("feed") == "neo_data").select(
        F.to_json("value")).first()[0] == '{"near_earth_objects":{"2025-01-02":[{"id":"1"}]}}'


def test_stream_chain_with_master_merge(spark, tmp):
    """M6: file arrival -> create -> load -> master lookup merge, twice."""
    from sluice.streaming.ingest import run_available

    land, wh, ck = f"{tmp}/land", f"{tmp}/wh", f"{tmp}/ck"
    master = f"{wh}/MASTER_PATIENT_LOOKUP"

    def merge(spark_, warehouse, result):
        patients = read_table_rows(spark_, warehouse, "PATIENTS")
        sides = []
        try:
            enc = read_table_rows(spark_, warehouse, "ENCOUNTERS")
            sides.append(Side(enc, "MASTER_PATIENT_ID", "PATIENT_ENCOUNTER_ID",
                              "encounters_patient_encounter_id"))
        except FileNotFoundError:
            pass
        merge_data_to_master(spark_, patients, "MASTER_PATIENT_ID", "patients_master_patient_id",
                             sides, "master_patient_lookup_table_unique_key", master, RUN.date())

    gz(f"{land}/patients_20250102000000_UTC.csv.gz", "master_patient_id\n1\n2\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN, after_load=merge) == 1
    assert spark.read.parquet(master).count() == 2
    gz(f"{land}/patients_20250103000000_UTC.csv.gz", "master_patient_id\n3\n")
    assert run_available(spark, land, wh, ck, loaded_at=RUN, after_load=merge) == 1
    ids = sorted(r[0] for r in spark.read.parquet(master)
                 .select("patients_master_patient_id").collect())
    assert [int(i) for i in ids] == [1, 2, 3]
