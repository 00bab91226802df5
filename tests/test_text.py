from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.text import java_split, java_trim

PATTERNS = {" ": " ", ",": ",", r"\s": r"[ \t\n\x0b\f\r]", "ab?": "ab?"}


def jvm_split(text: str, separator: str) -> list[str]:
    """What String.split documents: trailing empty fields go, an unmatched text stays whole."""
    if not re.search(PATTERNS[separator], text):
        return [text]
    parts = re.split(PATTERNS[separator], text)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_known_cases(make):
    cases = ["a b", "", "   ", "a b  ", " a  b"]
    rows = make([(c,) for c in cases], "value STRING").select(java_split(F.col("value"), r"\s").alias("w")).collect()
    assert [r.w for r in rows] == [["a", "b"], [""], [], ["a", "b"], ["", "a", "", "b"]]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab ,\t\n\x0b é", max_size=12), min_size=20, max_size=60))
def test_split_is_the_jvm_split(make, texts):
    table = make([(t,) for t in texts], "value STRING")
    columns = [java_split(F.col("value"), s).alias(f"s{i}") for i, s in enumerate(PATTERNS)]
    for row in table.select("value", *columns).collect():
        for i, separator in enumerate(PATTERNS):
            assert row[f"s{i}"] == jvm_split(row.value, separator), (row.value, separator)


def test_trim_removes_control_characters(make):
    row = make([("\t\x01 a b\n ",)], "value STRING").select(java_trim(F.col("value")).alias("t")).first()
    assert row.t == "a b"
