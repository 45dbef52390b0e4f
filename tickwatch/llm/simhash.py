"""SimHash fingerprints, and the search for all fingerprints within a Hamming radius.

Every occurrence of a two-word term votes with its length on the 64 bits of its
hash: for a set bit, against a clear one; the sign of the sums is the
fingerprint. The votes are 32 ordinary sums, each of which counts two bits in
the halves of one 64-bit number, so a text's terms meet in a partial aggregate.

The search cuts fingerprints into ``blocks`` bit blocks. Fingerprints that
differ in at most ``radius`` bits agree in at least ``blocks - radius`` blocks;
there is one table for every choice of that many blocks, keyed by their bits. A
pair is counted in the first table in which it agrees. Equal fingerprints are
collapsed before, and a key with very many fingerprints is split over tasks.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import stored, text_or_empty, words

BITS = 64
_PAIR = 0x0000000100000001  # the lowest bit of both halves
#: Fingerprints of one key that one task compares at a time.
GROUP = 4096
#: Rows of a range of neighbouring ids, about, and most ranges.
RANGE_ROWS, MOST_RANGES = 512, 65536


def terms(text: Column | str) -> Column:
    """SQL array of (hash, weight) of a text's terms: pairs of neighbouring
    words in lower case, weighing their letters but at most 32; a single word, or
    a text without words as a whole, is one term of weight 1."""
    return F.transform(
        F.array(F.lower(text_or_empty(text))),
        lambda t: F.transform(F.array(F.array_remove(F.split(t, r"[\x20\x09-\x0D]+", -1), "")), lambda w: F.when(
            F.size(w) < 2, F.array(F.struct(F.xxhash64(F.coalesce(F.get(w, F.lit(0)), t)).alias("h"), F.lit(1).cast("long").alias("w")))
        ).otherwise(F.transform(F.slice(w, F.lit(2), F.size(w)), lambda x, i: F.struct(
            F.xxhash64(F.get(w, i), x).alias("h"),
            F.least(F.length(F.get(w, i)) + F.length(x), F.lit(32)).cast("long").alias("w")))))[0])[0]


def votes() -> list[Column]:
    """Aggregates over columns ``h`` and ``w``: two bits' weights per sum, and the weight of all."""
    return [F.sum(F.shiftright("h", j).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{j}") for j in range(32)] + [
        F.sum("w").alias("v_all")]


def fingerprint() -> Column:
    """The fingerprint of summed votes: a bit is set if more than half of the weight has it set."""
    out = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"v{j}", 32)
        for bit, weight in ((j, low), (j + 32, high)):
            out = out.bitwiseOR(F.when(weight * 2 > F.col("v_all"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return out


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Share of bits in which two fingerprints agree."""
    return (F.lit(BITS) - distance(a, b)) / F.lit(float(BITS))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _ranges(df: DataFrame, id_col: str) -> list[int]:
    """Ids that begin ranges of about RANGE_ROWS rows: every eighth of a
    hash-random choice of ids, at most about ``8 * MOST_RANGES`` of which reach the driver."""
    ids = df.select(F.col(f"`{id_col}`").cast("long").alias("id")).where("id IS NOT NULL")
    n, least = ids.agg(F.count("*"), F.min("id")).first()
    if not n:
        return []
    step = max(1, n // (8 * max(1, min(MOST_RANGES, n // RANGE_ROWS))))
    picked = ids.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(step)) == 0).distinct().orderBy("id")
    chosen = [r[0] for r in picked.collect()] if step > 1 else []
    return [least, *(x for x in chosen[8::8] if x > least)]


def in_ranges(df: DataFrame, id_col: str) -> DataFrame:
    """Adds ``range`` and ``carried``: rows go to the range of their id, and the
    first row of a range also, carried, to the end of the range before (from
    the first to the last), so that a window per range sees every row's next one."""
    bounds = _ranges(df, id_col)
    n = max(1, len(bounds))
    # Spark folds this into one literal; a lambda over the list would run again for every row and step.
    array = F.expr("CAST(split('{}', ',') AS ARRAY<BIGINT>)".format(",".join(map(str, bounds or [0]))))
    steps = [1 << k for k in reversed(range(max(1, n.bit_length())))]
    search = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda p, s: F.when(
        (p + s < n) & (F.get(array, p + s) <= F.col("_id")), p + s).otherwise(p))
    placed = df.withColumn("_id", F.col(f"`{id_col}`").cast("long")).withColumn(
        "range", F.when(F.col("_id").isNull(), n - 1).otherwise(search))
    first = F.col("_id") == F.get(array, F.col("range")) if bounds else F.lit(False)
    own = F.struct(F.col("range"), F.lit(False).alias("carried"))
    before = F.struct(((F.col("range") + n - 1) % n).alias("range"), F.lit(True).alias("carried"))
    both = placed.withColumn("_place", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
    return both.select(*[F.col(f"`{c}`") for c in df.columns], "_place.range", "_place.carried")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, in one shuffle of the texts.

    Edited: the last quarter (rounded down) of the code points gives way to as
    many from the start of the next text by ascending id; the first follows the
    last. Null texts are empty; null ids come last; equal ids come by text.
    Without any id in the table a text has an empty next one at the end.
    Returns ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    next_fingerprint`` (fingerprints as 64-bit integers), one row per row.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    order = Window.partitionBy("range").orderBy("carried", F.asc_nulls_last("id"), "text")
    pairs = in_ranges(rows, "id").select(
        "range", "carried", "id", F.row_number().over(order).alias("pos"), "text",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 4) AS INT))"),
                      F.substring("next", F.lit(1), quarter))
    texts = pairs.select("range", "carried", "id", "pos", F.length("text").cast("long").alias("n_chars"), "text",
                         edited.alias("edited")).withColumn("sha", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    sides = texts.select("range", "carried", "id", "pos", "n_chars", "sha",
                         F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
                                           F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s"))
    key = ["range", "carried", "id", "pos", "n_chars", "sha"]
    # The groups lie within ranges, so neither aggregate nor the last window shuffles again.
    summed = sides.select(*key, "s.side", F.inline(terms("s.t"))).groupBy(*key, "side").agg(*votes())
    both = summed.select(*key, "side", fingerprint().alias("fp")).groupBy(*key).agg(
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fingerprint"))
    after = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("pos"))
    return both.withColumn("next_fingerprint", F.coalesce(after, F.lit(0).cast("long"))).where(~F.col("carried")).select(
        "id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "next_fingerprint")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` of every row; null texts are empty, repeated rows each get their row."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                     F.inline(terms(F.col(f"`{text_col}`"))))
    return rows.groupBy("row", "id").agg(*votes()).select("id", fingerprint().alias("fingerprint"))


def _tables(radius: int, blocks: int) -> list[tuple[int, list[int]]]:
    """For every table its key mask, and the masks of the blocks in which a pair
    must differ for this to be the first table that holds it."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    out = []
    for chosen in combinations(range(blocks), blocks - radius):
        passed = [b for b in range(chosen[-1]) if b not in chosen]
        out.append((sum(masks[b] for b in chosen), [masks[b] for b in passed]))
    return out


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def count_within(queries: DataFrame, rows: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """For every distinct ``fingerprint`` of ``queries``: ``n_within``, the number
    of ``rows`` whose fingerprint differs in at most ``radius`` bits (its own
    included). Exact; pairs are counted in their tasks and not written out."""
    if not radius < blocks <= BITS:
        raise ValueError("needs more blocks than the radius")
    tables = _tables(radius, blocks)
    distinct = rows.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count("*").alias("n"))
    keyed = lambda df: df.select("*", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(_signed(m)) for m, _ in tables]))
                                 .alias("table", "key"))
    index = keyed(distinct)
    large = index.groupBy("table", "key").agg(F.count("*").alias("size")).where(F.col("size") > GROUP).select(
        "table", "key", F.ceil(F.col("size") / GROUP).alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    lists = (
        index.join(large, ["table", "key"], "left")
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), parts))
        .groupBy("table", "key", "part").agg(F.collect_list(F.struct("fingerprint", "n")).alias("members"))
    )
    asked = (
        keyed(queries.where("fingerprint IS NOT NULL").select("fingerprint").distinct())
        .join(large, ["table", "key"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    )
    both = asked.join(lists, ["table", "key", "part"])
    passed = F.array(*[F.array(*[_signed(m) for m in p]).cast("array<bigint>") for _, p in tables])

    def first_here(diff: Column) -> Column:
        return F.forall(F.get(passed, F.col("table")), lambda m: diff.bitwiseAND(m) != 0)

    near = F.aggregate("members", F.lit(0).cast("long"), lambda total, x: total + F.when(
        (distance(x["fingerprint"], F.col("fingerprint")) <= radius)
        & first_here(x["fingerprint"].bitwiseXOR(F.col("fingerprint"))), x["n"]).otherwise(F.lit(0).cast("long")))
    return both.select("fingerprint", near.alias("near")).groupBy("fingerprint").agg(F.sum("near").alias("n_within"))


def fingerprint_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
                      query_step: int = 20) -> DataFrame:
    """:func:`edited_fingerprints` with likenesses, and for rows whose id is
    divisible by ``query_step`` ``n_near``: how many other rows have a
    fingerprint within the radius (null for other rows). The fingerprints are stored once.

    An empty table gives no rows; other columns, whatever their names, are not read; repeated rows each get
    their row. Null, empty and very long texts: as in :func:`edited_fingerprints`, whole texts always."""
    made = stored(edited_fingerprints(df, id_col, text_col), "simhash")
    asks = F.col("id") % query_step == 0
    found = count_within(made.where(asks), made, radius).withColumnRenamed("fingerprint", "asked")
    return made.join(found, F.col("fingerprint") == F.col("asked"), "left").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        as_hex(F.col("fingerprint")).alias("fingerprint"), as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.when(asks, F.col("n_within") - 1).alias("n_near"),
    )
