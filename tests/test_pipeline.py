"""Source files to mart, two days, silver appended and silver upserted."""

import json
import uuid
from datetime import datetime

import pytest

from caretiers.config import Layers, PipelineConfig
from caretiers.operators.upsert import versions_since
from caretiers.plans import pipeline
from caretiers.plans.gold import fact_encounter, mart_patient_summary
from caretiers.plans.pipeline import new_silver_patients, run_pipeline

from conftest import rows


def patient(id, given, family):
    return {"resourceType": "Patient", "id": id, "gender": "female",
            "name": [{"given": [given], "family": family}]}


def visit(id, patient_id, minutes):
    return {"resourceType": "Encounter", "id": id, "status": "finished",
            "subject": {"reference": f"urn:uuid:{patient_id}"},
            "period": {"start": "2024-01-01T10:00:00Z", "end": f"2024-01-01T10:{minutes}:00Z"},
            "class": {"code": "AMB"}}


def sources(folder, day, patients, visits, costs):
    path = folder / f"day{day}"
    (path / "fhir").mkdir(parents=True)
    document = {"entry": [{"resource": r} for r in [*patients, *visits]]}
    (path / "fhir" / "all.json").write_text(json.dumps(document, indent=1))
    (path / "fhir" / "bad.json").write_text("{")
    (path / "patients.csv").write_text("Id,FIRST,LAST,CITY,INCOME\np1,ann,dahl,Boston,100\n"
                                       "p9,Nora,Only,Lynn,5\n")
    lines = "".join(f"{k},p1,Pay,{v},{v},1\n" for k, v in costs.items())
    (path / "encounters.csv").write_text(
        "Id,PATIENT,PAYER,BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,PAYER_COVERAGE\n" + lines
    )
    return path


@pytest.mark.parametrize("mode, visits_of_ann", [("append", 3), ("upsert", 2)])
def test_two_days(spark, tmp_path, mode, visits_of_ann):
    suffix = uuid.uuid4().hex
    layers = Layers(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")
    ann = patient("p1", "Ann", "Dahl")
    days = {
        1: sources(tmp_path, 1, [ann, patient("p2", "Bea", "Berg")], [visit("e1", "p1", 30)],
                   {"e1": 10}),
        2: sources(tmp_path, 2, [patient("p1", "Ann", "Ek")], [visit("e2", "p1", 20)],
                   {"e1": 10, "e2": 20}),
    }
    for day, path in days.items():
        config = PipelineConfig(
            landing_root=str(tmp_path / "landing"),
            checkpoint_root=str(tmp_path / "checkpoints"),
            warehouse_root=str(tmp_path / "warehouse"),
            fhir_path=str(path / "fhir"),
            patients_csv=str(path / "patients.csv"),
            encounters_csv=str(path / "encounters.csv"),
            layers=layers,
            silver_mode=mode,
            compact_after=4,
            now=datetime(2024, 1, day, 12),
        )
        mart = run_pipeline(spark, config)

    assert rows(mart, "patient_id", "full_name", "city", "total_encounters") == [
        ("p1", "Ann Ek", "Boston", visits_of_ann), ("p2", "Bea Berg", None, 0),
        ("p9", "Nora Only", "Lynn", 0),
    ]
    ann_row = mart.where("patient_id = 'p1'").first()
    assert ann_row["total_claim_cost"] == {"append": 40.0, "upsert": 30.0}[mode]
    fact = spark.table(f"{layers.gold}.fact_encounter")
    dim = spark.table(f"{layers.gold}.dim_patient")
    assert mart.count() == dim.count()
    assert mart.agg({"total_claim_cost": "sum"}).first()[0] == (
        fact.agg({"total_claim_cost": "sum"}).first()[0]
    )
    aside = spark.read.json(str(tmp_path / "landing" / "quarantine"))
    assert {r["source_file"] for r in aside.collect()} == {"bad.json"}
    bronze = spark.table(f"{layers.bronze}.raw_patients_api")
    assert rows(bronze, "patient_id", "load_date", "source") == [
        ("p1", "2024-01-01", "api_fhir_patients"), ("p1", "2024-01-02", "api_fhir_patients"),
        ("p2", "2024-01-01", "api_fhir_patients"),
    ]


def test_incremental_gold_is_what_a_refresh_gives(spark, tmp_path, monkeypatch):
    suffix = uuid.uuid4().hex
    layers = Layers(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")
    days = {
        1: ([patient("p1", "Ann", "Dahl"), patient("p2", "Bea", "Berg")],
            [visit("e1", "p1", 30), visit("e0", "p7", 10)], {"e1": 10}),
        9: ([patient("p3", "Cleo", "Cole")], [visit("e3", "p3", 20), visit("e4", "p1", 10)], {"e3": 7}),
        # The visit of day 1 came before its patient did.
        17: ([patient("p7", "Gro", "Gran"), patient("p2", "Bea", "Bing")], [visit("e5", "p3", 40)],
             {"e5": 1}),
    }

    def config(day):
        path = tmp_path / f"day{day}"
        return PipelineConfig(
            landing_root=str(tmp_path / "landing"), checkpoint_root=str(tmp_path / "checkpoints"),
            warehouse_root=str(tmp_path / "warehouse"), fhir_path=str(path / "fhir"),
            patients_csv=str(path / "patients.csv"), encounters_csv=str(path / "encounters.csv"),
            layers=layers, buckets=2, compact_after=3, gold_mode="incremental", checks=True,
            now=datetime(2024, 1, day, 12),
        )

    def same_as_refresh():
        dim, silver = (spark.table(t) for t in (f"{layers.gold}.dim_patient", f"{layers.silver}.silver_encounters"))
        assert rows(spark.table(f"{layers.gold}.mart_patient_summary")) == rows(
            mart_patient_summary(dim, fact_encounter(silver))
        )

    def die(*args, **more):
        raise RuntimeError("lost driver")

    for day, inputs in days.items():
        sources(tmp_path, day, *inputs)
        if day == 9:
            # The fact is written, the sums are not; the next run has no new load for the fact.
            with monkeypatch.context() as patched:
                patched.setattr(pipeline, "patient_sums", die)
                with pytest.raises(RuntimeError, match="lost driver"):
                    run_pipeline(spark, config(day))
            pipeline.build_gold(spark, config(day))
        else:
            run_pipeline(spark, config(day))
        same_as_refresh()
        if day == 9:
            # p2 has neither a new visit nor a new record; the extract has p1 and p9 every day.
            mart = versions_since(spark, f"{layers.gold}.mart_patient_summary", "patient_id", 1)[0]
            assert rows(mart, "patient_id") == [("p1",), ("p3",), ("p9",)]
    pipeline.build_gold(spark, config(17))
    same_as_refresh()
    fact = spark.table(f"{layers.gold}.fact_encounter")
    assert pipeline.loads(spark, f"{layers.gold}.fact_encounter") == [1, 2, 3]
    assert rows(fact.groupBy("_load_day").count()) == rows(
        spark.table(f"{layers.silver}.silver_encounters").groupBy("_load_day").count()
    )


def test_incremental_gold_needs_appended_silver():
    with pytest.raises(ValueError, match="appended"):
        PipelineConfig(landing_root="", checkpoint_root="", silver_mode="upsert", gold_mode="incremental")


def test_incomplete_extract_stops_the_run(spark, tmp_path):
    path = sources(tmp_path, 1, [], [], {})
    suffix = uuid.uuid4().hex
    config = PipelineConfig(
        landing_root=str(tmp_path / "landing"), checkpoint_root=str(tmp_path / "cp"),
        warehouse_root=str(tmp_path / "warehouse"), encounters_csv=str(path / "encounters.csv"),
        layers=Layers(f"b_{suffix}", f"s_{suffix}", f"g_{suffix}"),
    )
    with pytest.raises(ValueError, match="no rows"):
        run_pipeline(spark, config)


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_people_of_a_run_that_died_before_gold_arrive_later(spark, tmp_path, monkeypatch, mode):
    suffix = uuid.uuid4().hex
    layers = Layers(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")

    def run(day, people):
        path = sources(tmp_path, day, people, [visit(f"e{day}", "p1", 30)], {f"e{day}": 10})
        config = PipelineConfig(
            landing_root=str(tmp_path / "landing"), checkpoint_root=str(tmp_path / "checkpoints"),
            warehouse_root=str(tmp_path / "warehouse"), fhir_path=str(path / "fhir"),
            encounters_csv=str(path / "encounters.csv"), patients_csv=str(path / "patients.csv"),
            layers=layers, silver_mode=mode, buckets=4, now=datetime(2024, 1, day, 12),
        )
        return config, run_pipeline(spark, config)

    def die(*args):
        raise RuntimeError("lost driver")

    run(1, [patient("p1", "Ann", "Dahl"), patient("p2", "Bea", "Berg")])
    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "build_gold", die)
        with pytest.raises(RuntimeError, match="lost driver"):
            run(2, [patient("p2", "Bea", "Bing"), patient("p3", "Cleo", "Cole")])
    # Bronze rows of day 2 are not recent any more on day 9.
    config, mart = run(9, [patient("p4", "Dan", "Dorn")])
    assert rows(mart, "patient_id", "full_name") == [
        ("p1", "ann dahl"), ("p2", "Bea Bing"), ("p3", "Cleo Cole"), ("p4", "Dan Dorn"), ("p9", "Nora Only"),
    ]
    people, last = new_silver_patients(spark, config)
    assert last == 3 and people.isEmpty()
    config, _ = run(10, [patient("p5", "Eva", "Ek")])
    taken = pipeline.taken_from_source(spark, f"{layers.gold}.dim_patient")
    assert taken == 4
    if mode == "append":
        # The dimension reads one load of one day.
        people, _ = pipeline.loads_since(spark, f"{layers.silver}.silver_patients", taken - 1)
        assert {f.split("_load_day=")[1][:10] for f in people.inputFiles()} == {"2024-01-10"}
