"""Extraction by slices of the study window gives what the whole run gives."""

from __future__ import annotations

import os
import shutil
from datetime import date

from renalis import preset
from renalis.plans.pipeline import extract, extract_slices, spans
from tests.conftest import person, scr, site, stay


def test_spans_cover_the_window_once():
    assert spans(date(2010, 1, 1), date(2011, 12, 31), 12) == [
        (date(2010, 1, 1), date(2010, 12, 31)), (date(2011, 1, 1), date(2011, 12, 31)),
    ]
    assert spans(date(2010, 1, 31), date(2010, 3, 30), 1) == [
        (date(2010, 1, 31), date(2010, 2, 27)), (date(2010, 2, 28), date(2010, 3, 30)),
    ]
    assert spans(date(2010, 5, 1), date(2010, 5, 1), 6) == [(date(2010, 5, 1), date(2010, 5, 1))]
    assert spans(date(2010, 5, 2), date(2010, 5, 1), 6) == []


def a_site(spark):
    """Stays within a slice, over its end, of one discharge date from two slices, and without a time."""
    stays = [
        stay("in", "p", "2015-03-01 08:00", "2015-03-09 10:00"),
        stay("over", "q", "2015-12-29 08:00", "2016-01-06 10:00"),
        stay("early", "r", "2015-12-30 08:00", "2016-01-08 10:00"),
        stay("late", "r", "2016-01-02 08:00", "2016-01-08 10:00"),
        stay("dialysed", "p", "2016-05-01 08:00", "2016-05-09 10:00"),
        stay("untimed", "s", "2016-07-01", "2016-07-09 10:00"),
    ]
    labs = []
    for s in stays:
        low = date.fromisoformat(s["ADMIT_DATE"]).toordinal()
        for day, value in ((0, 1.0), (1, 1.1), (3, 1.7), (5, 2.4)):
            on = date.fromordinal(low + day).isoformat()
            labs.append(scr(s["PATID"], on, f"{on} 09:00", value, ENCOUNTERID=s["ENCOUNTERID"]))
    dx = [{"PATID": "p", "DX": "N18.6", "DX_TYPE": "10", "DX_DATE": "2015-06-01"}]
    return site(
        spark, ENCOUNTER=stays, DEMOGRAPHIC=[person(p) for p in "pqrs"], LAB_RESULT_CM=labs,
        DIAGNOSIS=dx,
    )


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


def test_slices_equal_the_whole_run(spark, work, tmp_path):
    cdm = a_site(spark)
    window = {"window_start": date(2015, 1, 1), "window_end": date(2016, 12, 31)}
    for name in ("oracle", "tsql"):
        cfg = preset(name, **window, split_date=date(2015, 12, 31))
        whole = extract(spark, cdm, cfg, work)
        sliced = extract_slices(spark, cdm, cfg, work, f"{tmp_path}/{name}", months=12)
        assert rows(sliced.onsets) == rows(whole.onsets) and whole.onsets.count() >= 2
        assert rows(sliced.consort_bc) == rows(whole.consort_bc)
        assert rows(sliced.consort_ad) == rows(whole.consort_ad)


def test_finished_slices_are_kept(spark, work, tmp_path):
    cdm, out = a_site(spark), f"{tmp_path}/out"
    cfg = preset("oracle", window_start=date(2015, 1, 1), window_end=date(2016, 12, 31))
    first = rows(extract_slices(spark, cdm, cfg, work, out).onsets)
    kept, lost = (f"{out}/onsets/admitted={year}-01-01" for year in (2015, 2016))
    before = os.stat(f"{kept}/_SUCCESS").st_mtime_ns
    shutil.rmtree(lost)
    assert rows(extract_slices(spark, cdm, cfg, work, out).onsets) == first
    assert os.stat(f"{kept}/_SUCCESS").st_mtime_ns == before
    assert os.path.exists(f"{lost}/_SUCCESS")
