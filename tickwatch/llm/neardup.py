"""Near-duplicate groups by min-max hashing of word shingles.

A text's set holds its distinct 4-word shingles. Under every permutation both
the smallest and the largest value are kept, so ``PERMUTATIONS`` hash
evaluations give twice as many signature values; bands of ``ROWS`` values are
the buckets of the search. Equal sets are collapsed first. Every link is
confirmed on the full sets of both texts.

Groups are connected in two rounds, so that a bucket of many near copies never
has its pairs listed. First every set is compared with one partner, the
smallest set of its buckets; most groups are connected then. In buckets that
still hold several groups, members outside the bucket's largest group are
compared with the members of other groups, where a 128-bit sketch and the set
sizes leave a similarity of 0.8 possible. The pairs are compared where blocks
of texts meet, and only links leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored, text_or_empty, worker_cache
from tickwatch.llm.components import components

SHINGLE = 4
#: Smallest similarity of a link, in percent.
PERCENT = 80
PERMUTATIONS = 75
#: Values of a band. 30 bands of 5 miss a pair of similarity 0.8 with probability (1 - 0.8**5)**30 = 7e-6.
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Agreeing bits of 128 that a link must have: 115 are expected at similarity 0.8, and this is five deviations below (3e-7).
LEAST_BITS = 98
#: Members of a comparison that one task checks against one text, about.
CHECKED = 256
#: Members of a bucket in one list, and texts whose sets a task holds at a time, about.
PART, BLOCK = 256, 1024
#: Word hashes kept per Python worker (a cache).
WORDS_KEPT = 250_000


class Shingler:
    """Sets of 64-bit shingle hashes."""

    _MIX = np.uint64(0x9E3779B97F4A7C15)
    _LAST = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= WORDS_KEPT:
            self.known.clear()
        h = self.known[word] = xxhash.xxh64_intdigest(word)
        return h

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes: of the 4-word shingles, or of a shorter text's
        words as one; none without words. Only A-Z are lower-cased, as bytes.lower does,
        and bytes.split takes the same six characters for white space."""
        words = (text or "").encode("utf-8").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        get = self.known.get
        h = np.fromiter((get(w) or self._hash(w) for w in words), np.uint64, len(words))
        n = min(SHINGLE, len(words))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = out * self._MIX + h[i:len(h) - n + 1 + i]
            out ^= out >> np.uint64(29)
        out *= self._LAST
        out ^= out >> np.uint64(32)
        return np.unique(out)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the permutations of 64-bit numbers."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    draw = lambda: rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest, then largest values of non-empty sets under every permutation, a row per set."""
    a, b = _permutations()
    ends = np.cumsum([0, *map(len, sets)])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    moved = np.empty_like(flat)
    for j in range(PERMUTATIONS):
        np.multiply(flat, a[j], out=moved)
        np.add(moved, b[j], out=moved)
        out[:, j] = np.minimum.reduceat(moved, ends[:-1])
        out[:, PERMUTATIONS + j] = np.maximum.reduceat(moved, ends[:-1])
    return out


def bands_and_sketches(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of the bands (signed 64-bit), and 128 single bits of the values as two numbers."""
    k = np.uint64(0x9E3779B97F4A7C15)
    keys = np.empty((len(signature), BANDS), np.uint64)
    for i in range(BANDS):
        key = np.full(len(signature), i + 1, np.uint64)
        for j in range(ROWS):
            key = key * k + signature[:, i * ROWS + j]
            key ^= key >> np.uint64(31)
        keys[:, i] = key
    bits = ((signature[:, :128] * k) >> np.uint64(63)).astype(np.uint8)
    sketch = np.packbits(bits, axis=1).view(">u8").astype(np.uint64)
    return keys.view(np.int64), sketch.view(np.int64)


SIGNED = "n_shingles bigint, digest binary, bands array<bigint>, s0 bigint, s1 bigint"


def signed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, digest`` (of the set), ``bands, s0, s1`` of every row; no digest and bands without words."""
    ship_code()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))

    def some(shingler: Shingler, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        sets = [shingler.shingles(t) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        s0: list = [None] * len(sets)
        s1: list = [None] * len(sets)
        if full:
            keys, sketch = bands_and_sketches(signatures([sets[i] for i in full]))
            for row, i in enumerate(full):
                bands[i], s0[i], s1[i] = keys[row], sketch[row, 0], sketch[row, 1]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())],
            names=["id", "n_shingles", "digest", "bands", "s0", "s1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_cache("shingler", Shingler)
        for batch in batches:
            texts, size = [], 0
            for i, text in enumerate(batch.column(1), 1):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size > 1 << 19 or i == batch.num_rows:  # sets that stay in the processor's cache
                    yield some(shingler, batch.column(0).slice(i - len(texts), len(texts)), texts)
                    texts, size = [], 0

    id_type = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, {SIGNED}")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are alike enough; ``texts``: ``id, text``, an id once.

    The partners of one text are cut into parts of about CHECKED; each part is
    one run of sorted rows that begins with the text itself, so a task holds
    one set and one partner at a time.
    """
    ship_code()
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHECKED).alias("parts"))
    asked = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    asked = asked.unionByName(asked.select("a", F.col("a").alias("b"), "part").distinct())
    rows = asked.join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text")
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_cache("shingler", Shingler)
        a_now, a_set = None, np.empty(0, np.uint64)
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 2)), batch.column(3)):
                own = shingler.shingles(text.as_py())
                if a == b:
                    a_now, a_set = a, own
                    continue
                assert a_now == a, "a text's rows begin with the text itself"
                both = len(np.intersect1d(a_set, own, assume_unique=True))
                if 100 * both >= PERCENT * (len(a_set) + len(own) - both):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def candidate_lists(mixed: DataFrame) -> DataFrame:
    """``a, partners``: for members outside their bucket's largest group, the
    members of other groups that sizes and sketches allow, as one list.

    A bucket's members are packed into parts of about PART; a member meets
    the parts, not the single members, and what a part leaves of it is a list.
    Every bucket a pair shares holds both its groups, so it is enough to take
    a pair in the first band it shares.
    """
    parts = mixed.groupBy("key").agg(F.ceil(F.count("*") / PART).alias("parts"))
    member = F.struct("rep", "label", "n_shingles", "s0", "s1", "bands")
    packed = (mixed.join(parts, "key").groupBy("key", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part"))
              .agg(F.collect_list(member).alias("members")).drop("part"))
    met = mixed.where("label <> largest").join(packed, "key")

    def possible(y):
        small, large = F.least("n_shingles", y["n_shingles"]), F.greatest("n_shingles", y["n_shingles"])
        differing = F.bit_count(F.col("s0").bitwiseXOR(y["s0"])) + F.bit_count(F.col("s1").bitwiseXOR(y["s1"]))
        before = lambda bands: F.slice(bands, F.lit(1), F.col("band"))  # noqa: E731  keys differ from band to band
        return ((y["label"] != F.col("label")) & ((y["label"] == F.col("largest")) | (F.col("rep") < y["rep"]))
                & (differing <= 128 - LEAST_BITS) & (small * 100 >= large * PERCENT)
                & ~F.arrays_overlap(before(F.col("bands")), before(y["bands"])))

    left = met.select(F.col("rep").alias("a"), F.transform(F.filter("members", possible), lambda y: y["rep"]).alias("found"))
    return left.where(F.size("found") > 0).groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("partners"))


def confirmed_lists(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """The links ``(a, b)`` among ``(a, partners)``.

    The partners' texts are dealt into blocks of about BLOCK texts by a hash
    of their id. A text goes, once, to every block that holds partners of it; a
    task holds one block's sets and compares the texts sent there with their partners.
    """
    ship_code()
    blocks = max(1, -(-texts.count() // BLOCK))
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    sent = asked.withColumn("block", F.explode(F.array_distinct(F.transform("partners", block_of)))).select(
        "block", F.col("a").alias("id"),
        F.filter("partners", lambda p: block_of(p) == F.col("block")).alias("partners"))
    held = texts.select(block_of(F.col("id")).alias("block"), "id", F.lit(None).cast("array<bigint>").alias("partners"), "text")
    rows = held.unionByName(sent.join(texts, "id").select("block", "id", "partners", "text"))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("partners").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_cache("shingler", Shingler)
        now, sets = None, {}
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for block, a, partners, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), batch.column(3)):
                if block != now:
                    now, sets = block, {}
                own = shingler.shingles(text.as_py())
                if partners is None:
                    sets[a] = own
                    continue
                for b in partners:
                    both = len(np.intersect1d(own, sets[b], assume_unique=True))
                    if 100 * both >= PERCENT * (len(own) + len(sets[b]) - both):
                        found[0].append(a)
                        found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_shingles, component_id`` (smallest id reachable over links), ``kept`` (its own is the smallest).

    Texts without words (null, empty, blank) link with nothing; rows without
    an id neither (their component is null, they are kept); rows that share an id are one document.
    Whole texts are compared, however long. An empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = stored(signed_rows(rows, "id"), "signatures")
    sets = stored(
        signed.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
            F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("n_shingles", "s0", "s1", "bands")]), "sets")
    keyed = sets.select("rep", "n_shingles", "s0", "s1", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center <> last")
    members = stored(keyed.join(shared.select("key", "center"), "key"), "members")

    wanted = members.select(F.col("rep").alias("id")).distinct()
    texts = stored(rows.join(wanted, "id"), "texts")
    first = members.where("rep <> center").groupBy("rep").agg(F.min("center").alias("center"))
    links = stored(confirmed(first.select(F.col("center").alias("a"), F.col("rep").alias("b")), texts), "links")
    labels = components(links, "groups")

    grouped = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep"))
    by_group = grouped.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"), F.count("*").alias("groups")).where("groups > 1")
    mixed = stored(grouped.drop("center").join(by_group.drop("groups"), "key").join(sets.select("rep", "bands"), "rep"), "mixed")
    more = stored(confirmed_lists(candidate_lists(mixed), texts), "more-links")
    label = components(links.unionByName(more), "components")

    of_set = sets.select("digest", "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("component_id"))
    out = signed.select("id", "n_shingles", "digest").join(of_set, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
