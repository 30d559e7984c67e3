"""The views of the test tables, as the collection step asks for them."""

from __future__ import annotations

import os

import pytest

from renalis.operators.collect import COLLECTIONS
from verification.views import load_views

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted({c.table for c in COLLECTIONS.values()}))
def test_a_view_is_there_before_its_first_use(spark, name):
    views = load_views(spark, DATA)
    assert name in views
    assert "PATID" in views[name].columns


def test_a_table_without_a_view_is_absent(spark):
    assert "PAYMENT" not in load_views(spark, DATA)
