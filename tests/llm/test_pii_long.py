"""Personal data in long runs, and the scans against their patterns."""

import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from speechviews.llm import pii

from test_operators import brute_spans


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aA0129.@+- ()%é\n", max_size=60))
def test_scans_equal_their_patterns(text):
    if not re.search("[0-9]{20}", text):
        assert pii.joined(pii.base_spans(text)) == brute_spans(text)
    assert pii.emails(text) == [m.span() for m in pii.PATTERNS["email"].finditer(text)]


RUNS = {
    "digits": "7" * 1_000_000, "letters and one at sign": "a" * 1_000_000 + "@", "dots": "1." * 500_000, "at signs": "a@" * 500_000, "spelled out": "at-" * 300_000,
    "plus signs": "+1 " * 300_000, "blanks": "+1" + " " * 1_000_000, "addresses": "a@b.c " * 150_000, "no domain": "x@" + "y" * 1_000_000, "cards": "4111 1111 1111 1111, " * 40_000,
}


@pytest.mark.parametrize("name", RUNS)
def test_runs_of_a_million_characters_take_seconds(name):
    start = time.perf_counter()
    base = pii.base_spans(RUNS[name])
    pii.windows_of(RUNS[name])
    assert pii.reconciled(RUNS[name], base, [(0.99, 0, s, e) for _, s, e in base]) == base
    assert time.perf_counter() - start < 5
    assert len(base) == {"addresses": 150_000, "cards": 40_000}.get(name, 0) or name == "dots"


def test_numbers_of_thousands_of_digits_end_no_job(spark):
    rows = [(1, "1" * 5000 + ".1.2.3"), (2, "0" * 5000 + "9.1.2.3"), (3, "é" * 700 + " 8.8.8.8"), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, base string, n_ip long")
    found = {r.doc_id: (r.n_ip, r.base) for r in pii.found(docs).collect()}
    assert found == {1: (0, ""), 2: (1, "ip:0:5007"), 3: (1, "ip:701:708"), 4: (0, ""), 5: (0, "")}
    assert pii.found(docs.limit(0)).count() == 0
    kept = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert kept[2] == "<ip>" and kept[3].endswith(" <ip>") and kept[4] is None and kept[1] == rows[0][1]
