"""Bundles written by hand, with the irregularities real exports have."""

import json

import pytest

from caretiers.operators.flatten import (
    blank_missing,
    flatten_encounters,
    flatten_patients,
    without_id,
)
from caretiers.schemas import ENCOUNTER_COLUMNS, PATIENT_COLUMNS
from caretiers.sources.bundles import (
    corrupt_entries,
    read_bundles,
    resources,
    stage_resources,
)


def bundle(*found):
    return {"resourceType": "Bundle", "entry": [{"resource": r} for r in found]}


def coding(*codes):
    return {"coding": [{"code": c, "display": f"{c} text"} for c in codes]}


def write(folder, name, document):
    folder.mkdir(exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (folder / name).write_text(text)


FULL = {
    "resourceType": "Patient",
    "id": "full",
    "gender": "female",
    "birthDate": "1980-02-03",
    "name": [
        {"given": ["Ann", "Bea", "Cleo"], "family": "Dahl"},
        {"given": ["Other"], "family": "Other"},
    ],
    "telecom": [{"value": "555-1"}, {"value": "555-2"}],
    "identifier": [
        {"value": "untyped"},
        {"type": {"coding": []}, "value": "no coding"},
        {"type": coding("MR"), "value": "m1"},
        {"type": coding("MR", "SS"), "value": "m2"},
        {"type": coding("SS"), "value": "s1"},
        {"type": coding("DL"), "value": "d1"},
        {"type": coding("PPN"), "value": "p1"},
    ],
    "address": [
        {"city": "Boston", "state": "MA", "postalCode": "02139", "country": "US"},
        {"city": "Elsewhere"},
    ],
    "extension": [
        {"url": "x/us-core-ethnicity", "extension": [{}, {"valueString": "Not Hispanic"}]},
        {"url": "x/us-core-race", "extension": [{}, {"valueString": "first"}]},
        {"url": "x/us-core-race", "extension": [{}, {"valueString": "White"}]},
        {"url": "x/patient-mothersMaidenName", "valueString": "Maiden"},
        {"url": "x/us-core-birthsex", "valueCode": "F"},
        {"url": "x/patient-birthPlace", "valueAddress": {"city": "Lynn", "country": "US"}},
        {"url": "x/disability-adjusted-life-years", "valueDecimal": 1.5},
        {"url": "x/quality-adjusted-life-years", "valueDecimal": 40},
        {"url": "x/race-of-birthPlace", "valueAddress": {"city": "claimed by race"},
         "extension": [{}, {"valueString": "Last race"}]},
        {"valueString": "no url"},
    ],
    "maritalStatus": {"text": "Married"},
}
VISIT = {
    "resourceType": "Encounter",
    "id": "e1",
    "status": "finished",
    "subject": {"reference": "urn:uuid:full", "display": "Ann Dahl"},
    "period": {"start": "2020-01-01T10:00:00-05:00", "end": "2020-01-01T10:30:00-05:00"},
    "class": {"code": "AMB"},
    "type": [coding("t1", "t2"), coding("t3")],
    "participant": [{"individual": {"display": "Dr. A"}}, {"individual": {"display": "Dr. B"}}],
    "reasonCode": [coding("r1", "r2")],
    "serviceProvider": {"display": "Clinic"},
}


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "bundles"
    write(path, "full.json", bundle(FULL, VISIT))
    write(path, "empty.json", {"resourceType": "Bundle"})
    write(
        path,
        "short.json",
        bundle(
            {"resourceType": "Patient", "id": "bare"},
            {"resourceType": "Patient", "id": "no-given", "name": [{"given": [], "family": "X"}]},
            {"resourceType": "Patient", "id": "one-part",
             "extension": [{"url": "x/race", "extension": [{"valueString": "only"}]}]},
            {"resourceType": "Patient"},
            {"resourceType": "Encounter", "id": "e-bare"},
            {"resourceType": "Encounter", "id": "e-empty", "type": [], "participant": [],
             "reasonCode": [{"coding": []}]},
            {"resourceType": "Claim", "id": "ignored"},
        ),
    )
    write(path, "broken.json", '{"entry": [{"resource": ')
    write(path, "notes.txt", json.dumps(bundle({"resourceType": "Patient", "id": "txt"})))
    write(path / "deeper", "deep.json", bundle({"resourceType": "Patient", "id": "deep"}))
    return str(path)


def flat(spark, folder, kind, flatten):
    found = flatten(resources(read_bundles(spark, folder, kind), kind)).collect()
    return {r[0]: r.asDict() for r in found}


def test_full_patient(spark, folder):
    got = flat(spark, folder, "Patient", flatten_patients)["full"]
    assert tuple(got) == PATIENT_COLUMNS
    assert got == {
        "patient_id": "full", "first_name": "Ann", "middle_name": "Bea", "last_name": "Dahl",
        "gender": "female", "birth_date": "1980-02-03", "phone": "555-1", "mrn": "m2",
        "ssn": "s1", "driver_license": "d1", "passport": "p1", "city": "Boston", "state": "MA",
        "postal_code": "02139", "country": "US", "race": "Last race",
        "ethnicity": "Not Hispanic", "birth_city": "Lynn", "birth_state": None,
        "birth_country": "US", "birth_sex": "F", "mother_maiden_name": "Maiden",
        "marital_status": "Married", "daly": 1.5, "qaly": 40.0, "source_file": "full.json",
    }


def test_short_resources_do_not_cost_their_neighbours(spark, folder):
    got = flat(spark, folder, "Patient", flatten_patients)
    assert set(got) == {"full", "bare", "no-given", "one-part", None}
    assert got["no-given"]["first_name"] is None and got["no-given"]["last_name"] == "X"
    assert got["one-part"]["race"] is None
    rest = [v for k, v in got["bare"].items() if k not in ("patient_id", "source_file")]
    assert set(rest) == {None}


def test_full_encounter(spark, folder):
    found = resources(read_bundles(spark, folder, "Encounter"), "Encounter")
    got = {r[0]: r.asDict() for r in flatten_encounters(found, "2020-02-02").collect()}
    assert tuple(got["e1"]) == ENCOUNTER_COLUMNS
    assert got["e1"] == {
        "encounter_id": "e1", "status": "finished", "patient_id": "full",
        "patient_name": "Ann Dahl", "start_time": "2020-01-01T10:00:00-05:00",
        "end_time": "2020-01-01T10:30:00-05:00", "encounter_class": "AMB",
        "encounter_type": "t1 text", "encounter_type_code": "t1", "provider_name": "Dr. A",
        "organization_name": "Clinic", "reason_code": "r1", "reason_description": "r1 text",
        "load_date": "2020-02-02",
    }
    assert got["e-empty"]["encounter_type"] is None and got["e-empty"]["reason_code"] is None


def test_landing_form_has_blanks_but_keeps_missing_numbers(spark, folder):
    found = resources(read_bundles(spark, folder, "Patient"), "Patient")
    bare = blank_missing(flatten_patients(found)).where("patient_id = 'bare'").first()
    assert bare["phone"] == "" and bare["race"] == "" and bare["daly"] is None


def test_records_without_id(spark, folder):
    found = flatten_patients(resources(read_bundles(spark, folder, "Patient"), "Patient"))
    assert without_id(found, "patient_id").count() == 1
    assert without_id(blank_missing(found), "patient_id").count() == 1


def test_corrupt_files_are_set_aside(spark, folder):
    got = corrupt_entries(read_bundles(spark, folder, "Patient")).collect()
    assert [r["source_file"] for r in got] == ["broken.json"]


def test_corrupt_lines_are_set_aside_one_by_one(spark, tmp_path):
    good = json.dumps(bundle({"resourceType": "Patient", "id": "good"}))
    write(tmp_path / "lines", "a.json", f"{good}\n{{broken\n{good}\n")
    bundles = read_bundles(spark, str(tmp_path / "lines"), "Patient", multiline=False)
    assert resources(bundles, "Patient").count() == 2
    assert [r["content"] for r in corrupt_entries(bundles).collect()] == ["{broken"]


def test_staged_resources_equal_direct_ones(spark, folder, tmp_path):
    staged = stage_resources(spark, folder, str(tmp_path / "staged"))
    for kind, flatten in (
        ("Patient", flatten_patients),
        ("Encounter", lambda r: flatten_encounters(r, "2020-02-02")),
    ):
        direct = flatten(resources(read_bundles(spark, folder, kind), kind))
        via = flatten(staged.where(f"kind = '{kind}'"))
        assert via.columns == direct.columns
        assert via.exceptAll(direct).count() == 0 and direct.exceptAll(via).count() == 0
    aside = staged.where("content IS NOT NULL").select("source_file").collect()
    assert [r[0] for r in aside] == ["broken.json"]


def test_good_entries_of_a_partly_bad_bundle_stay(spark, tmp_path):
    document = bundle({"resourceType": "Patient", "id": "a"},
                      {"resourceType": "Patient", "id": "b", "telecom": "not a list"})
    write(tmp_path / "lines", "a.json", json.dumps(document))
    staged = stage_resources(spark, str(tmp_path / "lines"), str(tmp_path / "s"), multiline=False)
    ids = {r[0] for r in flatten_patients(staged.where("kind = 'Patient'")).collect()}
    assert "a" in ids
    assert staged.where("content IS NOT NULL").count() == 1


def test_a_bad_entry_is_set_aside_alone(spark, tmp_path):
    """Wrong types, no objects, missing entries: the others are read as if they stood alone."""
    bad = [{"resource": {"resourceType": "Patient", "id": "b", "telecom": "not a list"}}, 5, "text",
           {"resource": {"resourceType": "Patient", "id": "c", "name": [{"given": "x", "family": "F"}]}}]
    good = [{"resource": {"resourceType": "Patient", "id": f"g{k}", "gender": "female"}} for k in range(4)]
    mixed = [e for pair in zip(good, bad) for e in pair]
    mixed.insert(3, None)
    pretty = tmp_path / "files"
    write(pretty, "a.json", json.dumps({"entry": mixed}, indent=1))
    write(pretty, "b.json", json.dumps({"entry": good[:1]}))
    write(pretty, "c.json", json.dumps({"entry": {"resource": {}}}, indent=1))
    write(pretty, "d.json", '{"entry": [{"resource": ')
    bundles = read_bundles(spark, str(pretty), "Patient")
    found = flatten_patients(resources(bundles, "Patient"))
    assert sorted((r["patient_id"], r["gender"]) for r in found.collect()) == [
        ("b", None), ("c", None), ("g0", "female"), ("g0", "female"), *((f"g{k}", "female") for k in range(1, 4)),
    ]
    aside = {(r["source_file"], r["at"]): r["content"] for r in corrupt_entries(bundles).collect()}
    assert {k: v for k, v in aside.items() if k[0] == "a.json"} == {
        ("a.json", mixed.index(b)): b if b == "text" else json.dumps(b, separators=(",", ":")) for b in bad
    }
    assert set(aside) - {("a.json", mixed.index(b)) for b in bad} == {("c.json", None), ("d.json", None)}
