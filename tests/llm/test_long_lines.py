"""Single long lines in line dedup."""

from fleetschema.llm import linedup

LONG = " ".join(f"w{k}" for k in range(50))


def test_a_long_line_is_a_run(spark):
    short = LONG.rsplit(" ", 1)[0]
    docs = [(1, f"one\n{LONG}\ntwo\n{short}"), (2, LONG.upper()), (3, f"x\n{LONG}\ny\n{LONG}\nz\n{short}"), (4, f"{LONG}\ntwo")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in linedup.dedup_lines(df).collect()}
    assert got[1]["text"] == docs[0][1] and got[1]["removed"] == []
    assert got[2]["text"] == "" and got[3]["text"] == f"x\ny\nz\n{short}" and got[4]["text"] == ""
    assert [s["first"] for k in (2, 3, 4) for s in got[k]["removed"]] == [1, 1, 1, 1]
