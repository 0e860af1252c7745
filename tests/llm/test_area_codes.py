"""Telephone numbers with any area code."""

import re

from fleetschema.llm import pii


def test_any_area_code_is_a_telephone_number(spark):
    text = "+1 (017) 555-7713, +1 (152) 555-8590, 043-011-0001, 1 134 555 1234"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    out = pii.pseudonymise(df)
    row = out.first()
    assert [s["kind"] for s in row["replaced"]] == ["phone"] * 4
    assert re.sub(r"\d", "0", row["text"]) == re.sub(r"\d", "0", text)
    assert not set(re.findall(r"\d{3}\D+\d{3}\D\d{4}", text)) & set(re.findall(r"\d{3}\D+\d{3}\D\d{4}", row["text"]))
    assert pii.pseudonymise(out.drop("replaced"), back=True).first()["text"] == text
