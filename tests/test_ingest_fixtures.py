"""Hand-written raw files for the edge cases of FIXTURES.md A6."""

import datetime as dt
import os

import pytest

from peerguard.operators import ingest
from peerguard.operators.profiles import build_beneficiary_profiles
from peerguard.sources import csv_files

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture(scope="module")
def normalized(spark):
    raw = csv_files.read_claim_files(spark, f"{FIX}/cms")
    rows = ingest.normalize_claims(raw).collect()
    return {(r.claim_id, r.claim_type): r for r in rows}


def _by_id(normalized, cid):
    return next(r for (c, _), r in normalized.items() if c == cid)


def test_blank_codes_are_absent(normalized):
    r = _by_id(normalized, "C1")
    assert r.diagnosis_codes == ["4019", "250"]          # D1: no "nan" code
    assert r.procedure_codes == ["9904"]
    assert r.admit_diagnosis_cd == "4019"


def test_dropped_and_malformed(normalized):
    assert _by_id(normalized, "C3").reject_reason == "dropped"      # blank provider
    assert _by_id(normalized, "C5").reject_reason == "malformed"    # D19 month 13
    blanks = [r for (c, _), r in normalized.items() if c is None]
    assert [r.reject_reason for r in blanks] == ["dropped"]         # blank claim id


def test_dates_and_los(normalized):
    c4 = _by_id(normalized, "C4")
    assert c4.claim_start_date == dt.date(2009, 3, 1)               # YYYYMM → day 01
    assert c4.length_of_stay_days == 4                               # blank _LOS → date difference
    assert _by_id(normalized, "C1").length_of_stay_days == 3        # '3.7' truncates
    assert _by_id(normalized, "C8").length_of_stay_days == 0        # end before start
    assert _by_id(normalized, "O1").length_of_stay_days == 0        # outpatient ignores _LOS


def test_bad_amounts_are_zero(normalized):
    assert _by_id(normalized, "C6").reimbursement_amt == 0.0        # D3 'abc'
    assert _by_id(normalized, "C7").reimbursement_amt == 0.0        # D3 blank
    assert _by_id(normalized, "C1").reimbursement_amt == 1000.5


def test_specialty_resolution(normalized):
    assert _by_id(normalized, "K2").provider_specialty == "Cardiology"
    assert _by_id(normalized, "K1").provider_specialty == "Cardiology"   # blank own → map
    assert _by_id(normalized, "O1").provider_specialty == "Cardiology"   # map by provider
    assert _by_id(normalized, "O2").provider_specialty == "Unknown"      # unknown provider
    assert _by_id(normalized, "K3").provider_specialty == "Unknown"      # blank, no map (D2)


def test_no_codes_claim(normalized):
    r = _by_id(normalized, "C9")
    assert r.diagnosis_codes == [] and r.admit_diagnosis_cd == ""


def test_reject_counts(spark):
    raw = csv_files.read_claim_files(spark, f"{FIX}/cms")
    counts = {(r.claim_type, r.outcome): r.n_rows for r in ingest.reject_counts(ingest.normalize_claims(raw)).collect()}
    assert counts[("inpatient", "dropped")] == 2
    assert counts[("inpatient", "malformed")] == 1
    assert counts[("inpatient", "accepted")] == 6


def test_missing_los_column_uses_dates(spark):
    raw = csv_files.read_claim_files(spark, f"{FIX}/cms_no_los")          # D20
    r = ingest.accepted(ingest.normalize_claims(raw)).collect()[0]
    assert r.length_of_stay_days == 7


def test_missing_beneficiary_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.read_beneficiaries(spark, str(tmp_path))


def test_profiles(spark):
    bene = csv_files.read_beneficiaries(spark, f"{FIX}/cms")
    claims = ingest.accepted(ingest.normalize_claims(csv_files.read_claim_files(spark, f"{FIX}/cms")))
    p = {r.beneficiary_id: r for r in build_beneficiary_profiles(bene, claims).collect()}
    assert p["B1"].birth_year == 1945 and p["B1"].chronic_conditions == ["Cancer", "Diabetes"]
    assert p["B2"].birth_year == 1940 and p["B3"].birth_year == 1940
    assert p["B2"].claim_count_ytd == 1        # latest year (2010) has one claim
    assert p["B5"].claim_count_ytd == 0        # no claims
