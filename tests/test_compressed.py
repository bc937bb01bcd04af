import gzip
import json
import uuid
from datetime import datetime

from caretiers.config import Layers, PipelineConfig
from caretiers.plans.pipeline import run_pipeline

from conftest import rows
from test_pipeline import patient, visit


def packed(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_compressed_sources_are_taken_in_and_landing_files_are_compressed(spark, tmp_path):
    suffix = uuid.uuid4().hex
    layers = Layers(f"bronze_{suffix}", f"silver_{suffix}", f"gold_{suffix}")
    bundle = {"entry": [{"resource": patient("p1", "Ann", "Dahl")}, {"resource": visit("e1", "p1", 30)}]}
    packed(tmp_path / "fhir" / "a.json.gz", json.dumps(bundle) + "\n")
    plain = {"entry": [{"resource": patient("p2", "Bea", "Berg")}]}
    (tmp_path / "fhir" / "b.json").write_text(json.dumps(plain) + "\n")
    people = packed(tmp_path / "patients.csv.gz", 'Id,FIRST,LAST,CITY,INCOME\np1,ann,dahl,"Bos\nton",100\n')
    bills = packed(
        tmp_path / "encounters.csv.gz",
        "Id,PATIENT,PAYER,BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,PAYER_COVERAGE\ne1,p1,Pay,10,10,1\n",
    )
    config = PipelineConfig(
        landing_root=str(tmp_path / "landing"), checkpoint_root=str(tmp_path / "checkpoints"),
        warehouse_root=str(tmp_path / "warehouse"), fhir_path=str(tmp_path / "fhir"), fhir_multiline=False,
        patients_csv=people, encounters_csv=bills, layers=layers, now=datetime(2024, 1, 1, 12),
    )
    mart = run_pipeline(spark, config)
    assert rows(mart, "patient_id", "full_name", "city", "total_encounters", "total_claim_cost") == [
        ("p1", "Ann Dahl", "Bos\nton", 1, 10.0), ("p2", "Bea Berg", None, 0, None),
    ]
    landed = [p.name for zone in ("api", "csv") for p in (tmp_path / "landing" / zone).glob("*/load_date=*/part-*")]
    assert len(landed) >= 4 and all(name.endswith(".csv.gz") for name in landed)
