"""Mixing sources to target weights by distributed prefix sums.

Every row gets a hash-random key. Its leading bits name one of ``2**bucket_bits``
ranges, so the rows of a source are range-partitioned by key without sampling
and evenly whatever the source's size. Word counts are summed per (source,
range), running sums over the ranges of a source give each range's offset, and
a window inside the range finishes the prefix sums. A source's budget is cut
exactly: whole passes over the source first, then the rows in key order until
the rest is spent, the last row in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import fresh_name, stored, without, words


def hash_key(id_col: str, seed: str) -> Column:
    """60 random bits of a row id (md5, so that other engines can repeat them)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to a table of (source, source_size), one row per source.

    The sources, by code point with null last, weigh ``weights`` in turn and
    share ``share`` times all sizes; no target exceeds ``cap`` times the
    source's size, and what is above goes to the others by weight. The level
    at which the caps bind follows from running sums over the sources in the
    order in which they reach their caps.
    """
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_cap = everything.orderBy(F.col("most") / F.col("w"), F.asc_nulls_last("source"))
    capped = F.coalesce(F.sum("most").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - capped) / F.sum("w").over(
        by_cap.rowsBetween(0, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", level).withColumn("at", F.row_number().over(by_cap))
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct("at", "level"))).over(everything)["level"]
    return leveled.withColumn("all_level", first).select(
        "source", "source_size", F.coalesce(F.least("most", F.col("all_level") * F.col("w")), F.col("most")).alias("target"))


def mix(df: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_bits: int = 10) -> DataFrame:
    """Adds ``size`` (words), ``source_size``, ``target`` and ``taken`` (words the mix takes, repeats counted).

    One row per input row; all columns stay, but for columns of these four
    names, which are replaced. A null text has size 0 and takes 0; null sources
    form one source; a null id has a key like any other. Rows with equal keys
    (repeated ids) are taken in order of their size, and equal ones are
    interchangeable. An empty table gives an empty one.
    """
    made = ["size", "source_size", "target", "taken"]
    names = {n: fresh_name(df, n) for n in ("mix_key", "mix_bucket", "mix_source", "mix_before", "mix_budget")}
    key, bucket, group, before, budget = names.values()
    source = F.col(f"`{source_col}`")
    sized = (
        df.withColumns({key: hash_key(f"`{id_col}`", seed), group: F.coalesce(F.concat(F.lit("="), source), F.lit(""))})
        .select(*without(df, made), F.size(words(f"`{text_col}`")).cast("long").alias("size"), key, group,
                F.shiftright(key, 60 - bucket_bits).alias(bucket))
    )
    sums = stored(sized.groupBy(F.col(f"`{source_col}`").alias("source"), F.col(group), F.col(bucket))
                  .agg(F.sum("size").alias("size")), "mix-sums")
    per_source = sums.groupBy("source", group).agg(F.sum("size").alias("source_size"))
    aims = targets(per_source.drop(group), weights, share, cap).withColumn(
        group, F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    plan = (sums.select(group, bucket, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(before))
            .join(aims, group).withColumn(budget, F.floor(F.col("target") + 0.5)))
    inside = Window.partitionBy(group, bucket).orderBy(key, F.col(f"`{id_col}`"), "size").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = sized.join(plan, [group, bucket]).withColumn(
        before, F.col(before) + F.sum("size").over(inside) - F.col("size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col(budget) / F.col("source_size"))).otherwise(0)
    rest = F.col(budget) - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col(before)))
    return placed.select(*without(df, made), "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(df: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself, in the columns of ``df``: one row per pass that takes a document.

    A document that the cut goes through keeps its first words in that pass,
    joined by single spaces; documents of which nothing is taken, also blank
    ones, are absent. ``n_chars_col`` (if present) follows the text.
    """
    copy, cut = fresh_name(df, "mix_copy"), fresh_name(df, "mix_cut")
    plain = df.withColumnsRenamed({c: fresh_name(df, c + "_own") for c in df.columns
                                   if c.lower() in ("size", "source_size", "target", "taken")})
    mixed = mix(plain, text_col=text_col, **options).where("taken > 0")
    rows = mixed.withColumn(cut, F.col("taken") % F.col("size")).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    in_part = (F.col(cut) > 0) & (F.col(copy) * F.col("size") > F.col("taken"))
    text = F.when(in_part, F.array_join(F.slice(words(f"`{text_col}`"), F.lit(1), F.col(cut).cast("int")), " ")).otherwise(
        F.col(f"`{text_col}`"))
    rows = rows.withColumn(text_col, text)
    if n_chars_col and n_chars_col in df.columns:
        rows = rows.withColumn(n_chars_col, F.length(f"`{text_col}`").cast(df.schema[n_chars_col].dataType))
    return rows.select(*[F.col(f"`{p}`").alias(c) for p, c in zip(plain.columns, df.columns)])
