"""Repeated units beside edited ones in substring dedup."""

from fleetschema.llm import substring


def test_units_beside_edited_ones_are_cut(spark):
    a, b, c = ("nine words that stand in both of the texts", "seven more words that stand in both", "a b c d e f g h i j k l")
    docs = [(1, f"{a}\n{b}\n{c}\nand so\nlast"), (2, f"edited here\n{a}\n{b}\n{c}\nedited there"), (3, f"new\n{b}\nand so\nother")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring.dedup_substrings(df).collect()}
    # a stretch of 27 words goes, one of 9 that stands alone is spared
    assert got == {1: docs[0][1], 2: "edited here\nedited there", 3: docs[2][1]}
    got = {r["doc_id"]: r["text"] for r in substring.dedup_substrings(df, min_words=3).collect()}
    assert got == {1: docs[0][1], 2: "edited here\nedited there", 3: "new\nother"}
    docs = [(1, "and so\nx"), (2, "and so\ny")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in substring.dedup_substrings(df, min_words=3).collect()} == dict(docs)
