"""Line dedup by a suffix array over line ids, made by distributed prefix doubling.

Lines that occur once part the documents into chains of repeated lines; the
suffixes of all chains are ranked by their first 1, 2, 4, ... lines until a round
parts none further. The suffix array gives each suffix the one before it, the
ranks of the rounds give the common prefix of the two, and intervals of the array
whose common prefixes have ``min_lines`` lines are repeated runs. Each interval
keeps its earliest suffix; the first lines of all others are deleted, which over
suffixes that follow each other adds up to the maximal repeated runs. A single
line of ``min_words`` words is a run as well: its intervals are the suffixes that
start with its id.

Documents with the same lines throughout are one for the suffix array; later ones
lose what the first one's lines say, and all the rest to the first one.

Windows below go over the lines of one document or the rows of one block of the
sorted array; a line or run that very many documents share is only ever counted
and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetschema.functions.ordering import numbered, sorted_blocks
from fleetschema.llm.lines import cut_lines, line_table
from fleetschema.staging import stage

MIN_LINES = 2
#: words that make a single line a run
MIN_WORDS = 50
DOC = ["none", "key", "mark"]  # none: the key is NULL
THERE = [f"b_{c}" for c in [*DOC, "n"]]  # the suffix before


def whole_copies(lines: DataFrame, min_lines: int) -> DataFrame:
    """(doc, total, first): documents of ``min_lines`` lines and more whose lines are all those of an earlier one."""
    doc = F.struct(*DOC)
    docs = lines.where((F.col("n") == 0) & (F.col("total") >= min_lines)).select(*DOC, "whole", "total")
    first = docs.groupBy("whole").agg(F.min(doc).alias("first"), F.max(doc).alias("last")).where("first != last")
    docs = docs.join(stage(first.drop("last"), "whole-firsts"), "whole").where(doc != F.col("first"))
    return stage(docs.select(*DOC, "total", "first").distinct(), "whole-copies")


def keyed(lines: DataFrame) -> DataFrame:
    """A line table with ``DOC``, none of them NULL."""
    none = F.col("key").isNull().alias("none")
    return lines.select(none, F.coalesce("key", F.lit(0)).alias("key"), *[c for c in lines.columns if c != "key"])


def chains(lines: DataFrame, min_lines: int, min_words: int = MIN_WORDS, copies: DataFrame | None = None) -> DataFrame:
    """(doc, n, id, left, size, long): repeated lines that are long or stand in chains of at least ``min_lines``.

    ``id`` names the line's text, ``left`` is how many lines the chain has from here,
    ``size`` how many it has, and a line of ``min_words`` words is long. Documents
    of ``copies`` are left out.
    """
    lines = lines if "none" in lines.columns else keyed(lines)
    lines = lines.select(*DOC, "n", "digest", (F.col("words") >= min_words).alias("long"))
    # lines that stand once, most of them, go before anything else is done
    often = lines.groupBy("digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("digest")
    lines = lines.join(stage(often, "repeated-digests"), "digest")
    if copies is not None:
        lines = lines.join(copies.select(DOC), DOC, "left_anti")
    lines = stage(lines.distinct(), "repeated-lines")
    repeated = lines.groupBy("digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ids = stage(repeated.select("digest", F.monotonically_increasing_id().alias("id")), "line-ids")
    found = lines.join(ids, "digest").select(*DOC, "n", "id", "long")
    found = found.withColumn("chain", F.col("n") - F.row_number().over(Window.partitionBy(*DOC).orderBy("n")))
    whole = Window.partitionBy(*DOC, "chain")
    found = found.withColumns({"left": F.max("n").over(whole) - F.col("n") + 1, "size": F.count(F.lit(1)).over(whole)})
    found = found.where((F.col("size") >= min_lines) | F.col("long"))
    return stage(found.select(*DOC, "n", "id", "left", "size", "long"), "line-chains")


def suffix_ranks(positions: DataFrame) -> list[DataFrame]:
    """Tables (doc, n, id, left, r): ranks of the suffixes by their first 1, 2, 4, ... lines.

    A chain's end sorts before every line. The last table parts the suffixes as far
    as they can be: those it leaves tied are equal to their chains' ends.
    """
    levels = [positions.select(*DOC, "n", "id", "left", F.col("id").alias("r"))]
    parts, step = positions.select("id").distinct().count(), 1
    while True:
        further = Window.partitionBy(*DOC).orderBy("n").rangeBetween(step, step)
        follows = F.when(F.col("left") > step, F.first("r").over(further)).otherwise(F.lit(-1)).cast("long")
        paired = stage(levels[-1].withColumn("s", follows), "suffix-pairs")
        pairs = paired.groupBy("r", "s").agg(F.count(F.lit(1)).alias("times")).drop("times")
        pairs = stage(numbered(pairs, [F.col("r"), F.col("s")], name="rank"), "pair-ranks")
        now = pairs.count()
        if now == parts:
            return levels
        ranked = paired.join(pairs, ["r", "s"]).select(*DOC, "n", "id", "left", F.col("rank").alias("r"))
        levels.append(stage(ranked, "suffix-ranks"))
        parts, step = now, step * 2


def _before(placed: DataFrame) -> DataFrame:
    """Each row of the array with the row before it: b_..., all NULL for the first."""
    here = F.struct(*[F.col(c).alias(f"b_{c}") for c in [*DOC, "n", "id", "r"]])
    in_block = Window.partitionBy("_block").orderBy("_pos")
    ends = placed.groupBy("_block").agg(F.max_by(here, "_pos").alias("end"))  # one row a block
    carried = ends.select("_block", F.lag("end").over(Window.partitionBy(F.lit(0)).orderBy("_block")).alias("carried"))
    rows = placed.withColumn("before", F.lag(here).over(in_block)).join(carried, "_block")
    return rows.withColumn("before", F.coalesce("before", "carried")).drop("carried").select("*", "before.*").drop("before")


def common_prefixes(levels: list[DataFrame]) -> DataFrame:
    """The suffix array: (doc, n, left, _block, _pos, lcp), lcp the lines shared with the suffix before.

    Suffixes that follow each other in one document mostly have neighbours that do
    so too; then the prefix is one line shorter than that of the suffix before in
    the document. Only where such a row of suffixes starts is it looked up, from
    the ranks of the rounds, the longest first.
    """
    placed = sorted_blocks(levels[-1], [F.col(c) for c in ["r", *DOC, "n"]])
    rows = stage(_before(placed), "suffix-array")
    in_doc = Window.partitionBy(*DOC).orderBy("n")
    was = F.lag(F.struct("n", "id", "b_id", *THERE)).over(in_doc)
    rows = rows.withColumn("was", was)
    goes_on = (F.col("was.n") == F.col("n") - 1) & (F.col("was.id") == F.col("was.b_id"))
    for c in THERE[:-1]:
        goes_on &= F.col(f"was.{c}") == F.col(c)
    goes_on &= F.col("was.b_n") == F.col("b_n") - 1
    tied = F.coalesce(F.col("r") == F.col("b_r"), F.lit(False))
    rows = rows.withColumns({"tied": tied, "start": ~F.coalesce(goes_on, F.lit(False))}).drop("was")
    rows = stage(rows, "suffix-neighbours")

    found = rows.where("start AND NOT tied AND b_n IS NOT NULL").select(*DOC, "n", *THERE, F.lit(0).alias("lcp"))
    for k in reversed(range(len(levels) - 1)):
        here = levels[k].select(*[F.col(c).alias(f"x_{c}") for c in DOC], F.col("n").alias("x_n"), F.col("r").alias("x_r"))
        there = here.select(*[F.col(c).alias("y" + c[1:]) for c in here.columns])
        found = found.join(here, _at("x", "") & (F.col("x_n") == F.col("n") + F.col("lcp")), "left")
        found = found.join(there, _at("y", "b_") & (F.col("y_n") == F.col("b_n") + F.col("lcp")), "left")
        equal = F.coalesce(F.col("x_r") == F.col("y_r"), F.lit(False))
        found = found.select(*DOC, "n", *THERE, (F.col("lcp") + F.when(equal, 2**k).otherwise(0)).alias("lcp"))
    found = stage(found.select(*DOC, "n", F.col("lcp").alias("looked_up")), "looked-up-prefixes")

    rows = rows.join(found, [*DOC, "n"], "left")
    at_start = F.when(F.col("tied"), F.col("left")).otherwise(F.coalesce("looked_up", F.lit(0)))
    last = F.last(F.when(F.col("start"), F.struct("n", at_start.alias("lcp"))), ignorenulls=True).over(
        in_doc.rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.withColumn("from", last)
    lcp = F.col("from.lcp") - (F.col("n") - F.col("from.n"))
    return stage(rows.select(*DOC, "n", "left", "_block", "_pos", lcp.alias("lcp")), "common-prefixes")


def _at(side: str, of: str) -> Column:
    both = [F.col(f"{side}_{c}") == F.col(f"{of}{c}") for c in DOC]
    return both[0] & both[1] & both[2]


def later_copies(array: DataFrame, min_lines: int) -> DataFrame:
    """(doc, n, first): the suffixes whose first ``min_lines`` lines stand earlier, and the key that keeps them."""
    breaks = F.when(F.col("lcp") < min_lines, F.col("_pos"))
    in_block = Window.partitionBy("_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    carried = array.groupBy("_block").agg(F.max(F.when(F.col("lcp") < min_lines, F.struct("_block", "_pos"))).alias("at"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("_block", F.max("at").over(earlier).alias("carried"))  # one row a block
    rows = array.withColumn("pos", F.max(breaks).over(in_block)).join(carried, "_block")
    own = F.when(F.col("pos").isNotNull(), F.struct(F.col("_block"), F.col("pos").alias("_pos")))
    rows = rows.withColumn("interval", F.coalesce(own, F.col("carried"))).select(*DOC, "n", "interval.*")
    rows = stage(rows, "intervals")
    place = F.struct(*DOC, "n")
    first = rows.groupBy("_block", "_pos").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    rows = rows.join(stage(first.drop("last"), "interval-firsts"), ["_block", "_pos"]).where(place != F.col("first"))
    return rows.select(*DOC, "n", F.when(~F.col("first.none"), F.col("first.key")).alias("first"))


def later_long_lines(positions: DataFrame) -> DataFrame:
    """(doc, n, first): the long lines that stand earlier, and the key that keeps them."""
    rows, place = positions.where("long").select(*DOC, "n", "id"), F.struct(*DOC, "n")
    first = rows.groupBy("id").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    rows = rows.join(stage(first.drop("last"), "long-line-firsts"), "id").where(place != F.col("first"))
    return rows.select(*DOC, "n", F.when(~F.col("first.none"), F.col("first.key")).alias("first"))


def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """Every row of ``df`` without later copies of runs of lines, and ``removed``: what was cut where.

    A run is ``min_lines`` or more lines that, case and white space aside, stand in
    the same order at another place, or one such line of ``min_words`` words. The earliest place (by key, NULL last, then by
    line) keeps it. Blank lines are not counted and do not interrupt a run. Where a run
    overlaps its own copy, as when one line is repeated over and over, what is left
    is its first lines. NULL and empty texts stay as they are; rows that agree in
    key and text are one document and are cut alike; an empty table gives no rows;
    the added column takes an underscore where the input has its name.
    """
    lines = stage(keyed(line_table(df, key, text, whole=True)), "lines")
    twice = whole_copies(lines, min_lines)
    positions = chains(lines, min_lines, min_words, twice)
    in_chains = positions.where(F.col("size") >= min_lines)
    copies = later_copies(common_prefixes(suffix_ranks(in_chains)), min_lines)
    gone = copies.withColumn("n", F.explode(F.sequence(F.col("n"), F.col("n") + min_lines - 1)))
    gone = gone.unionByName(later_long_lines(positions))
    gone = gone.groupBy(*DOC, "n").agg(F.min("first").alias("first")).groupBy(*DOC)
    gone = stage(gone.agg(F.map_from_entries(F.collect_list(F.struct("n", "first"))).alias("of")), "deleted-of-first")
    first = gone.select(F.struct(*DOC).alias("first"), "of")
    # a document has one row here, so one with very many copies is split by adaptive execution
    keeper = F.when(~F.col("first.none"), F.col("first.key"))
    number = F.sequence(F.lit(0), F.col("total") - 1)
    kept = F.transform(
        number, lambda n: F.struct(n.alias("n"), F.when(F.coalesce(F.map_contains_key("of", n), F.lit(False)), F.col("of")[n]).otherwise(keeper).alias("first"))
    )
    copied = twice.join(first, "first", "left").select(*DOC, kept.alias("lines"))
    own = F.transform(F.map_entries("of"), lambda e: F.struct(e["key"].alias("n"), e["value"].alias("first")))
    gone = gone.select(*DOC, own.alias("lines")).unionByName(copied)
    gone = gone.select(F.when(~F.col("none"), F.col("key")).alias("key"), "mark", "lines")
    return cut_lines(df, stage(gone, "deleted-lines"), key, text)
