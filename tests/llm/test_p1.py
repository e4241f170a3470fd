import pytest

from sitegrain.llm.p1_canonical import canonicalize, labels

SMALL = "/root/testdata/sf0.001"
SPECIALTIES = {
    "Veterinary Care": "", "veterinary care": "", "Veterinary Care 4": "", "Audiology": "", "Virology": "",
    "Pathologyy": "Pathology", "Lab Pathology": "Pathology", "Care Primary": "Primary Care", "Wou Care": "Wound Care", "Bariaitcs": "Bariatrics",
    "Behav Health": "Behavioral Health", "Asthma and Allergy": "Allergy/Immunology", "OB-GYNF/ertility": "OB-GYN/Fertility", "Men's eeallth": "Men's Health",
}
STATES = {"India": "", "Kanto": "", "Ontario": "", "NewY ork": "NY", "Nw York": "NY", "Atizna": "AZ", "Txlas": "TX", "Mile": "ME", "Indiaan": "IN"}


@pytest.fixture(scope="module")
def mapped(spark):
    rows = [("specialties", v) for v in SPECIALTIES] + [("address_state", v) for v in STATES]
    return {(r.field_name, r.value): r.canon_key for r in canonicalize(spark.createDataFrame(rows, "field_name string, value string"), labels(spark, SMALL)).collect()}


def test_values_that_fit_no_entry_and_slips_of_typing(mapped):
    want = {("specialties", v): k for v, k in SPECIALTIES.items()} | {("address_state", v): k for v, k in STATES.items()}
    assert mapped == want
