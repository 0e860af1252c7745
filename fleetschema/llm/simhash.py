"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments that two fingerprints at the
allowed distance agree in one segment but for at most one bit. The index holds
each segment once for every bit, with that bit left out; an equality join on
these variants finds the candidates, and the whole fingerprints decide. Only
distinct fingerprints are joined, so copies cost nothing.

Groups of many near copies: links between fingerprints first go to the smallest
member of each exact segment value (a linear number), and the join then leaves
out pairs that these links already hold together. What is left out changes no
component. A pair that is found by several variants is emitted by the first.

Wide fingerprints have 1,024 bits and reach further than 64 can: bands of their
bits bring texts together, further bits tell near texts from chance (``jaccard``).
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, free, map_batches, row_hash
from fleetschema.llm.components import connected_components
from fleetschema.staging import stage

BITS = 64
#: XXH64 of the shingle's UTF-8 bytes with this seed
SEED = 42

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: of a wide fingerprint: 64-bit words, of these the first to compare, then bands of so many bits each
WORDS, COMPARED = 16, 2
BANDS, BAND_BITS = 74, 12
_STEPS = np.arange(1, 2 * WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set of 64-bit hashes, as ``64 * WORDS`` zeros and ones.

    Each hash votes in each bit with -3, -1, 1 or 3, two bits of its SplitMix64
    sequence; a bit is 1 if the votes are above 0. Four weights leave few ties, so
    that small sets differ in hardly more bits than large ones at the same cosine.
    """
    ones = np.zeros(128 * WORDS, np.int64)
    for k in range(0, len(hashes), 255):  # at most 255, so that a byte holds a count
        x = hashes[k : k + 255, None] + _STEPS
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        bits = np.unpackbits((x ^ (x >> np.uint64(31))).astype("<u8").view(np.uint8), axis=1)
        ones += bits.view(np.uint64).sum(axis=0).view(np.uint8)  # eight counts at a time
    return (4 * ones[: 64 * WORDS] + 2 * ones[64 * WORDS :] > 3 * len(hashes)).astype(np.uint8)


def compared_words(bits: np.ndarray) -> np.ndarray:
    """The bits of a wide fingerprint that are compared, as signed words."""
    return np.packbits(bits[: 64 * COMPARED]).view("<i8")


def bands(bits: np.ndarray) -> np.ndarray:
    """The value of each band of a wide fingerprint."""
    part = bits[64 * COMPARED :][: BANDS * BAND_BITS].reshape(BANDS, BAND_BITS)
    return part @ (1 << np.arange(BAND_BITS))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of a text as a signed 64-bit number; no words: 0.

    A bit is 1 if it is set in over half of the shingles' hashes, repeats
    included; a text of fewer words than a shingle is one shingle.
    """
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *(e + 1 for e in ends)]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65536):  # bounded memory for very long texts
        block = np.array(hashes[k : k + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0].astype(np.uint64).view(np.int64))


def with_fingerprints(df: DataFrame, text: str, name: str, shingle: int = 4) -> DataFrame:
    """``df`` without its text column but with the fingerprint, a signed long."""
    others = [c for c in df.columns if c != text]

    def mark(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.num_columns - 1)
        marks = [fingerprint(texts[i].as_py(), shingle) for i in range(batch.num_rows)]
        return [*batch.columns[:-1], pa.array(marks, pa.int64())]

    schema = extended(df.select(*map(col, others)), T.StructField(name, T.LongType()))
    return map_batches(df.select(*map(col, others), col(text)), schema, mark)


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of as many segments as leave one of them at most one differing bit."""
    n = distance // 2 + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _field(x: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << bits) - 1))


def fingerprint_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints ``f`` of ``prints`` as all pairs within ``distance`` bits do.

    Every link is a pair within the distance. Pairs that other links already hold
    together are left out, so that a large group of near copies gives few links;
    no pair that joins two components is lost.
    """
    parts = segments(distance)
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= distance

    # star links: to the smallest and largest fingerprint with the same exact segment
    exact = prints.select(
        "f", F.posexplode(F.array(*[_field(F.col("f"), low, bits) for low, bits in parts])).alias("part", "value")
    )
    hubs = exact.groupBy("part", "value").agg(F.min("f").alias("low"), F.max("f").alias("high")).where("low < high")
    stars = exact.join(hubs, ["part", "value"]).select(F.explode(F.array("low", "high")).alias("a"), F.col("f").alias("b"))
    stars = stage(stars.where((F.col("a") != F.col("b")) & near(F.col("a"), F.col("b"))).distinct(), "star-links")
    merged = stage(connected_components(stars, "a", "b"), "star-components")

    grouped = prints.join(merged, prints["f"] == merged["vertex"], "left").select(
        "f", F.coalesce("component", "f").alias("g")
    )
    variants = F.array(
        *[
            _field(F.col("f"), low, bits).bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << bit))) + F.lit((64 * k + low + bit) << 32)
            for k, (low, bits) in enumerate(parts)
            for bit in range(bits)
        ]
    )
    index = grouped.select("f", "g", F.explode(variants).alias("v"))
    x, y = index.alias("x"), index.alias("y")
    differing = F.col("x.f").bitwiseXOR(F.col("y.f"))
    # the variant that emits a pair: the first segment with at most one differing bit, and in it that bit or the first
    emits = None
    for k, (low, bits) in reversed(list(enumerate(parts))):
        part = _field(differing, low, bits)
        place = F.when(part == 0, F.lit(0)).otherwise(F.bit_count(part - 1)) + (64 * k + low)
        emits = F.when(F.bit_count(part) <= 1, place).otherwise(emits if emits is not None else F.lit(-1))
    pairs = x.join(
        y,
        (F.col("x.v") == F.col("y.v"))
        & (F.col("x.f") < F.col("y.f"))
        & (F.col("x.g") != F.col("y.g"))
        & near(F.col("x.f"), F.col("y.f"))
        & (F.shiftright("x.v", 32) == emits),
    ).select(F.col("x.f").alias("a"), F.col("y.f").alias("b"))
    return stars.unionByName(stage(pairs, "variant-links"))


def near_duplicate_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, group: str | None = None
) -> DataFrame:
    """Every row of ``df`` without its text, with ``fingerprint`` (signed long) and ``component_id``.

    The component is the smallest key reachable over links of fingerprints at
    ``distance`` or fewer differing bits, equal fingerprints included. Texts
    without words have fingerprint 0 and link like others. Rows with a NULL key
    take part in linking and get their group's smallest key, NULL if it has none.
    Repeated rows stay; an added column takes an underscore where the input has
    its name; an empty table gives no rows. ``group`` names a further column: the
    smallest fingerprint of the component, which is there without any key too.
    """
    print_name = free(df.columns, "fingerprint")
    group_name = free([*df.columns, print_name], "component_id")
    marked = stage(with_fingerprints(df, text, print_name, shingle), "fingerprints")
    prints = marked.groupBy(col(print_name).alias("f")).agg(F.min(col(key)).alias("least"))
    prints = stage(prints, "distinct-fingerprints")
    joined = connected_components(fingerprint_links(prints.select("f"), distance), "a", "b")
    groups = prints.join(joined, prints["f"] == joined["vertex"], "left").select(
        "f", "least", F.coalesce("component", "f").alias("g")
    )
    groups = stage(groups, "fingerprint-groups")
    first = groups.groupBy("g").agg(F.min("least").alias("__first"))
    named = groups.join(first, "g").select(F.col("f").alias("__f"), F.col("g").alias("__g"), "__first")
    others = [c for c in marked.columns if c != print_name]
    return marked.join(named, col(print_name) == F.col("__f")).select(
        *map(col, others),
        col(print_name),
        F.col("__first").alias(group_name),
        *([F.col("__g").alias(group)] if group else []),
    )


def hex_print(name: str) -> Column:
    return F.lower(F.lpad(F.hex(col(name)), 16, "0"))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``df``.

    The row with the smallest key stays (NULL keys last); among rows that tie on
    the key the one with the smallest hash of all columns, and of wholly equal
    rows one.
    """
    mark = free(df.columns, "row_hash")
    narrow = df.select(col(key).alias("key"), col(text).alias("text"), row_hash(df).alias("row"))
    marked = near_duplicate_groups(narrow, "key", "text", group="g", **options)
    best = marked.groupBy("g").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("b"))
    kept = best.select(F.col("b.key").alias("__key"), F.col("b.row").alias("__row"))
    # rows that are equal in all columns: only these are compared again
    repeated = marked.groupBy("key", "row").count().where("count > 1").select(F.col("row").alias("__row")).distinct()
    kept = stage(kept.join(repeated.withColumn("__many", F.lit(True)), "__row", "left"), "kept-rows")
    rows = df.withColumn(mark, row_hash(df))
    one = kept.where("__many IS NULL").select("__key", "__row")
    same = lambda k: (F.col(mark) == k["__row"]) & col(key).eqNullSafe(k["__key"])
    single = rows.join(one, same(one), "left_semi").drop(mark)
    many = kept.where("__many").select("__key", "__row")
    again = rows.join(many, same(many), "left_semi").dropDuplicates([mark]).drop(mark)
    return single.unionByName(again)
