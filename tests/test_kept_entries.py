from caretiers.sources.bundles import corrupt_entries, kept_entries, read_bundles, resources
from tests.conftest import plan_of, rows

GOOD = '{"entry":[{"resource":{"resourceType":"Patient","id":"a"}},{"resource":{"resourceType":"Other","id":"x"}}]}'
MIXED = '{"entry":[{"resource":{"resourceType":"Patient","id":"b","telecom":"no list"}},{"resource":{"resourceType":"Patient","id":"c"}}]}'
CUT = '{"entry":[{"resource":{"resourceType":"Pat'


def test_bundles_are_parsed_once_for_resources_and_corrupt_entries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bundles.json").write_text("\n".join([GOOD, MIXED, CUT]) + "\n")
    bundles = read_bundles(spark, str(tmp_path / "in"), "Patient", multiline=False)
    kept = kept_entries(bundles, str(tmp_path / "entries"))
    found, bad = resources(kept, "Patient"), corrupt_entries(kept)
    assert rows(found, "source_file", "r.id") == rows(resources(bundles, "Patient"), "source_file", "r.id")
    assert rows(bad) == rows(corrupt_entries(bundles))
    assert {r["id"] for r in found.select("r.id").collect()} == {"a", "b", "c"}
    assert sorted(r["content"] for r in bad.collect()) == sorted(
        [CUT, '{"resource":{"resourceType":"Patient","id":"b","telecom":"no list"}}']
    )
    for plan in plan_of(found), plan_of(bad):
        assert "json" not in plan.lower()
