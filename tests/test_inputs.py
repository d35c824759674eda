"""Landed files: good, multi-line, cut off, unreadable codes and dates."""

import json

import pytest

from staffline.operators.flatten import flatten_workers
from staffline.operators.timecards import flatten_timecards
from staffline.sources import documents as DOC


def worker(i, **assignment):
    return {"associateOID": f"G{i}", "person": {"legalName": {"givenName": "A", "familyName1": "B"}, "birthDate": "1980-01-01",
            "legalAddress": {"lineOne": "1 St", "cityName": "C", "countrySubdivisionLevel1": {"codeValue": "CA"},
                             "postalCode": "95616-1"}},
            "workAssignments": [{"primaryIndicator": True, "payrollFileNumber": str(i), "hireDate": "2020-01-02",
                                 "jobCode": {"codeValue": "7", "shortName": "T"}, **assignment}]}


def land(folder, *texts):
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"page{i}.json").write_text(text)
    return str(folder)


def page(*workers, **kw):
    return json.dumps({"workers": list(workers)}, **kw)


def test_good_pages_and_multi_line(spark, tmp_path):
    path = land(tmp_path / "a", page(worker(1), worker(2)) + "\n" + page(worker(3)), page())
    assert sorted(r.id for r in flatten_workers(DOC.read_worker_pages(spark, path)).collect()) == [1, 2, 3]
    path = land(tmp_path / "b", page(worker(1), worker(2), indent=2))
    rows = flatten_workers(DOC.read_worker_pages(spark, path, multi_line=True)).collect()
    assert sorted(r.aoid for r in rows) == ["G1", "G2"] and str(rows[0].hire_date) == "2020-01-02"


def test_cut_off_page_fails_or_is_quarantined(spark, tmp_path):
    path = land(tmp_path / "a", page(worker(1), worker(2)), page(worker(3), worker(4))[:150], page(worker(5)))
    pages = DOC.read_worker_pages(spark, path)
    with pytest.raises(Exception, match="does not parse"):
        flatten_workers(pages).collect()
    with pytest.raises(Exception, match="does not parse"):
        flatten_workers(pages).select("id").count()
    good, bad = flatten_workers(pages, mode="quarantine")
    assert sorted(r.id for r in good.collect()) == [1, 2, 5]
    assert [r.errors for r in bad.collect()] == [["page does not parse"]]


def test_page_without_workers_fails(spark, tmp_path):
    with pytest.raises(Exception, match="does not parse"):
        flatten_workers(DOC.read_worker_pages(spark, land(tmp_path / "a", '{"other": 1}'))).collect()


@pytest.mark.parametrize("change, name", [
    ({"homeWorkLocation": {"nameCode": {"codeValue": "N/A"}}}, "location_id"),
    ({"assignedOrganizationalUnits": [{}, {"nameCode": {"codeValue": "x"}}]}, "department_id"),
    ({"reportsTo": [{"positionID": "T1"}]}, "reports_to_id"),
    ({"hireDate": "2020-13-99"}, "hire_date"),
    ({"actualStartDate": "soon"}, "start_date"),
    ({"payrollFileNumber": "x"}, "id"),
])
def test_unreadable_code_or_date(spark, tmp_path, change, name):
    pages = DOC.read_worker_pages(spark, land(tmp_path / "a", page(worker(1, **change), worker(2))))
    with pytest.raises(Exception, match=f"G1: {name}"):
        flatten_workers(pages).collect()
    good, bad = flatten_workers(pages, mode="quarantine")
    assert [r.id for r in good.collect()] == [2] and [r.errors for r in bad.collect()] == [[name]]


def test_missing_codes_still_take_their_defaults(spark, tmp_path):
    r = flatten_workers(DOC.read_worker_pages(spark, land(tmp_path / "a", page(worker(1))))).first()
    assert (r.location_id, r.department, r.reports_to_id, r.start_date) == (0, "Unassigned", None, None)


def test_timecards(spark, tmp_path):
    card = {"timeCards": [{"associateOID": "G1", "timePeriod": {"startDate": "2024-01-01"},
                           "dailyTotals": [{"entryDate": "2024-01-02", "timeDuration": "PT8H"}, {"timeDuration": "PT1H"}]}]}
    path = land(tmp_path / "a", json.dumps(card))
    assert [str(r.entry_date) for r in flatten_timecards(DOC.read_timecards(spark, path)).collect()] == ["2024-01-02"]
    path = land(tmp_path / "b", json.dumps(card, indent=1))
    assert flatten_timecards(DOC.read_timecards(spark, path, multi_line=True)).count() == 1
    path = land(tmp_path / "c", json.dumps(card), json.dumps(card)[:60])
    with pytest.raises(Exception, match="does not parse"):
        flatten_timecards(DOC.read_timecards(spark, path)).collect()
