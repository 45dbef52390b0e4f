"""Trie of conversation prefixes through composable fingerprints.

A rebuilt conversation is the head of its base followed by its own later
turns. No rebuilt text is made: a run of turns is an element ``(n, G)`` with
``G = x1*B + x2*B^2 + ... + xn*B^n`` in four prime fields, where ``x`` comes
from a turn's hash. Runs compose, ``(n, G) * (m, H) = (n + m, G + B^n * H)``,
and a prefix can be taken off again. So the stored turns are scanned once, in
sorted ranges (a conversation cut by ranges gets the product of the earlier
ranges), and every rebuilt prefix is one head product times one suffix product.

Prefixes with equal depth and fingerprint are a node. Equality is proved, not
assumed: every turn refers to its stored content, whose hash must stand for one
role and text only, and all members of a node must agree in the reference of
their last turn and in their parent. By induction over depth they are then the
same turns. If a hash or fingerprint ever stood for two, everything is computed
anew with other bases.

Sums over subtrees need no walk over depths. A conversation is the smallest
member of its nodes from some depth ``s`` on, and of none above. Every node
below that it shares counts one repeated turn; so a subtree's repeats are, over
its members, the words between the node and depth ``s``, and its leaves are
its members that are the smallest of a childless node.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored, text_or_empty, words

#: The four largest primes below 2^31. Products of two residues fit a 64-bit number.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
K = range(len(PRIMES))
#: Turns that a head has at most, and the step between conversations that are bases.
HEAD, STEP = 3, 20
#: Bytes of joined ids in one row while a node's ends are hashed.
CHUNK = 1 << 16


def _bases(seed: int) -> list[int]:
    rng = random.Random(f"prefix-trie-{seed}")
    return [rng.randrange(1 << 20, p - 1) for p in PRIMES]


def powers(exponents: np.ndarray, bases: list[int]) -> np.ndarray:
    """``bases[k] ** exponent % PRIMES[k]``, a row per exponent."""
    p = np.array(PRIMES, np.int64)
    out = np.ones((len(exponents), len(PRIMES)), np.int64)
    square, left = np.array(bases, np.int64), exponents.copy()
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * square % p
        square, left = square * square % p, left >> 1
    return out


class RunScanner:
    """Running products of every conversation's turns, over rows sorted by conversation and turn."""

    def __init__(self, bases: list[int]):
        self.bases = bases
        self.conv, self.n, self.words = None, 0, 0
        self.g = np.zeros(len(PRIMES), np.int64)

    def scan(self, conv: np.ndarray, x: np.ndarray, w: np.ndarray):
        """``(start of each run, place in its conversation, terms, products, words so far)``."""
        p = np.array(PRIMES, np.int64)
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(conv)]))
        goes_on = (run == 0) & (conv == self.conv if self.conv is not None else False)
        place = np.arange(len(conv)) - starts[run] + 1 + np.where(goes_on, self.n, 0)
        term = x % p * powers(place, self.bases) % p
        since = lambda v: np.cumsum(v, axis=0) - (np.cumsum(v, axis=0) - v)[starts][run]
        g = (since(term) + np.where(goes_on[:, None], self.g, 0)) % p
        so_far = since(w) + np.where(goes_on, self.words, 0)
        self.conv, self.n, self.g, self.words = int(conv[-1]), int(place[-1]), g[-1], int(so_far[-1])
        return starts, place, term, g, so_far


_G = [f"g{k}" for k in K]
_T = [f"t{k}" for k in K]


def _power(base: int, exponent: Column, p: int) -> Column:
    """``base ** exponent % p`` of a column below 2^40."""
    squares = F.array(*[F.lit(pow(base, 1 << i, p)) for i in range(40)])
    bits = F.filter(F.transform(squares, lambda s, i: F.when(F.getbit(exponent, i) == 1, s)), lambda s: s.isNotNull())
    return F.aggregate(bits, F.lit(1).cast("long"), lambda acc, s: acc * s % F.lit(p))


def turn_products(df: DataFrame, bases: list[int], seed: int) -> DataFrame:
    """Every stored turn with the product of its conversation up to it:
    ``conv, pos`` (from 1), ``ref, ref2`` (its content's hash), ``w`` (its words), ``cw`` (words up to it), ``g*``,
    ``t*`` (the last term)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    content = F.unhex(F.md5(F.concat_ws(":", F.lit(str(seed)), F.length(role), role, text).cast("binary")))
    turns = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), content.alias("m"), F.size(words("text")).cast("long").alias("w"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "m"]

    names = ["kind", "pid", "conv", "pos", "ref", "ref2", "w", "cw", *_G, *_T]

    def rows(kind, pid, conv, pos, refs, w, cw, g, t):
        columns = [np.full(len(conv), kind, np.int64), np.full(len(conv), pid, np.int64), conv, pos, *refs.T, w, cw, *g.T, *t.T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, scanner, first = TaskContext.get().partitionId(), RunScanner(bases), True
        total = lambda s: rows(1, pid, np.array([s.conv]), np.array([s.n]), np.zeros((1, 2)), np.zeros(1), np.array([s.words]), s.g[None], s.g[None])
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            m = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, 4)
            w = batch.column(2).to_numpy()
            # The range's first conversation ends where another begins: its total may follow on earlier ranges.
            if first and scanner.conv is not None and conv[0] != scanner.conv:
                yield total(scanner)
                first = False
            starts, pos, t, g, cw = scanner.scan(conv, m.astype(np.int64), w)
            if first and len(starts) > 1:
                i = starts[1] - 1
                yield rows(1, pid, conv[i:i + 1], pos[i:i + 1], np.zeros((1, 2)), np.zeros(1), cw[i:i + 1], g[i:i + 1], t[i:i + 1])
                first = False
            yield rows(0, pid, conv, pos, m.view("<i8"), w, cw, g, t)
        if scanner.conv is not None:
            yield total(scanner)

    schema = ", ".join(f"{n} bigint" for n in names)
    cut = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "m", "w").mapInArrow(scan, schema), "turn-runs")
    # At most two totals a range, whatever the data: what precedes a range inside the same conversation.
    before = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0).cast("long"))
    totals = cut.where("kind = 1").groupBy("conv", "pid").agg(*[F.max(c).alias(c) for c in ("pos", "cw", *_G)])
    totals = totals.withColumns({"n0": sums("pos"), "w0": sums("cw")})
    totals = totals.withColumns({f"f{k}": _power(bases[k], F.col("n0"), PRIMES[k]) for k in K})
    totals = totals.withColumns({f"b{k}": sums(F.col(f"f{k}") * F.col(f"g{k}") % PRIMES[k]) % PRIMES[k] for k in K})
    carry = stored(totals.where("n0 > 0").select("conv", "pid", "n0", "w0", *[f"f{k}" for k in K], *[f"b{k}" for k in K]), "turn-carry")
    joined = cut.where("kind = 0").join(carry, ["conv", "pid"], "left")
    late = F.col("n0").isNotNull()
    moved = {f"g{k}": F.when(late, (F.col(f"b{k}") + F.col(f"f{k}") * F.col(f"g{k}") % PRIMES[k]) % PRIMES[k]).otherwise(F.col(f"g{k}")) for k in K}
    moved |= {f"t{k}": F.when(late, F.col(f"f{k}") * F.col(f"t{k}") % PRIMES[k]).otherwise(F.col(f"t{k}")) for k in K}
    zero = F.lit(0).cast("long")
    return joined.select("conv", (F.col("pos") + F.coalesce("n0", zero)).alias("pos"), "ref", "ref2", "w",
                         (F.col("cw") + F.coalesce("w0", zero)).alias("cw"), *[c.alias(n) for n, c in moved.items()])


def _packed(parts: list[Column]) -> list[Column]:
    return [F.shiftleft(parts[0], 31).bitwiseOR(parts[1]), F.shiftleft(parts[2], 31).bitwiseOR(parts[3])]


def rebuilt_prefixes(turns: DataFrame, bases: list[int], step: int) -> DataFrame:
    """Every prefix of every rebuilt conversation, symbolically: ``conv, depth, a, b`` (fingerprint), ``pa, pb`` (the
    parent's), ``ref, ref2, w, cw`` (last turn's content and words, words so far), ``total`` (words of all), ``ends``."""
    at = lambda i, c: F.max(F.when(F.col("pos") == i, F.col(c)))
    info = turns.groupBy("conv").agg(
        F.max("pos").alias("n"), F.max("cw").alias("words"),
        *[at(i, c).alias(f"{c}_{i}") for i in range(1, HEAD + 1) for c in (*_G, "cw", "ref", "ref2")])
    info = info.withColumns({f"{c}_0": F.lit(0).cast("long") for c in (*_G, "cw", "ref", "ref2")})
    heads = info.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), *[
        F.array(*[F.col(f"{c}_{i}") for i in range(HEAD + 1)]).alias(f"head_{c}") for c in (*_G, "cw", "ref", "ref2")])
    own = lambda c: F.element_at(F.array(*[F.col(f"{c}_{i}") for i in range(HEAD + 1)]), (F.least("h", "n") + 1).cast("int"))
    plan = info.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).select(
        "conv", "n", "words", "h", (F.col("conv") - F.col("conv") % step).alias("base"), *[own(c).alias(f"own_{c}") for c in (*_G, "cw")])
    plan = plan.join(heads, "base", "left").withColumn("hh", F.least("h", F.coalesce("base_n", F.lit(0))))
    head = lambda c, d: F.coalesce(F.element_at(f"head_{c}", (d + 1).cast("int")), F.lit(0).cast("long"))
    plan = stored(plan.withColumns({
        "len": F.col("hh") + F.greatest(F.col("n") - F.col("h"), F.lit(0)),
        "total": head("cw", F.col("hh")) + F.col("words") - F.col("own_cw"),
        **{f"at_{c}": head(c, F.col("hh")) for c in (*_G, "cw")}}), "rebuilt")

    d = F.col("depth")
    before = F.greatest(d - 1, F.lit(0))
    from_head = plan.withColumn("depth", F.explode(F.sequence(F.lit(0).cast("long"), "hh"))).select(
        "conv", "depth", "total", (d == F.col("len")).alias("ends"), head("ref", d).alias("ref"),
        head("ref2", d).alias("ref2"), head("cw", d).alias("cw"),
        (head("cw", d) - head("cw", before)).alias("w"),
        *[c.alias(n) for c, n in zip(_packed([head(g, d) for g in _G]) + _packed([head(g, before) for g in _G]), ("a", "b", "pa", "pb"))])

    # An own turn moves hh - h places (0 to -HEAD): its product is divided by that power of the base.
    p = [F.lit(x) for x in PRIMES]
    inverse = [F.element_at(F.array(*[F.lit(pow(pow(bases[k], -1, PRIMES[k]), i, PRIMES[k])) for i in range(HEAD + 1)]),
                            (F.col("h") - F.col("hh") + 1).cast("int")) for k in K]
    fp = [(F.col(f"at_g{k}") + inverse[k] * ((F.col(f"g{k}") - F.col(f"own_g{k}") + p[k]) % p[k]) % p[k]) % p[k] for k in K]
    parent = [(F.col(f"fp{k}") - inverse[k] * F.col(f"t{k}") % p[k] + p[k]) % p[k] for k in K]
    later = turns.join(plan.select("conv", "h", "hh", "len", "total", "own_cw", "at_cw", *[f"own_g{k}" for k in K], *[f"at_g{k}" for k in K]), "conv")
    later = later.where("pos > h").withColumns({f"fp{k}": fp[k] for k in K} | {"depth": F.expr("pos - h + hh")}).select(
        "conv", "depth", "total", (d == F.col("len")).alias("ends"), "ref", "ref2", (F.col("at_cw") + F.col("cw") - F.col("own_cw")).alias("cw"), "w",
        *[c.alias(n) for c, n in zip(_packed([F.col(f"fp{k}") for k in K]) + _packed(parent), ("a", "b", "pa", "pb"))])
    return from_head.unionByName(later)


def _ends(enders: DataFrame) -> DataFrame:
    """``rep, depth, ends_sha256`` of nodes in which several conversations end, from ``rep, depth, conv``.

    Ids are joined to texts of about :data:`CHUNK` bytes in sorted ranges; a node's texts are then hashed as a stream."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([first]), pa.array([",".join(ids)])],
                                              names=["rep", "depth", "first", "ids"])

        key, first, ids, size = None, 0, [], 0
        for batch in batches:
            for rep, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (key != (rep, depth) or size > CHUNK):
                    yield out()
                    ids, size = [], 0
                if not ids:
                    key, first = (rep, depth), conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        done: list[tuple[int, int, str]] = []

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.int64()), pa.array([r[1] for r in done], pa.int64()),
                                               pa.array([r[2] for r in done], pa.string())], names=["rep", "depth", "ends_sha256"])
            done.clear()
            return rows

        for batch in batches:
            for rep, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == (rep, depth):
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (rep, depth), hashlib.sha256(ids.encode())
            yield out()
        if key is not None:
            done.append((*key, sha.hexdigest()))
        yield out()

    order = ["rep", "depth", "conv"]
    chunks = enders.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pieces, "rep bigint, depth bigint, first bigint, ids string")
    return chunks.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first").mapInArrow(
        digests, "rep bigint, depth bigint, ends_sha256 string")


def prefix_trie(df: DataFrame, step: int = STEP) -> DataFrame:
    """The trie of all rebuilt conversations of ``df(conv_id, turn, role, text)``.

    Conversation ``c`` is rebuilt as the first ``h`` turns of conversation
    ``c - c % step`` (all, if it has fewer; none, if there is no such
    conversation) and then its own turns after its first ``h``, with ``h =
    crc32(c) % 4``. Returns a row per node: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, as the module says.

    Turns are ordered by number, null first; turns that share a number by role,
    then by the MD5 of role and text. Repeated rows are turns of their own. A null role or text is
    empty. Rows without a conversation id take no part. An empty table has no
    nodes. Other columns are not read. The largest unit of one task is a range
    of turns, or the stream of one node's ids.
    """
    ship_code()
    key = ["depth", "a", "b"]
    seed = 0
    while True:
        bases = _bases(seed)
        turns = stored(turn_products(df, bases, seed), "turn-products")
        rows = stored(rebuilt_prefixes(turns, bases, step), "prefixes")
        nodes = stored(rows.groupBy(*key).agg(
            F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"),
            F.min(F.when(F.col("ends"), F.col("conv"))).alias("end"), F.max("cw").alias("cw"), F.max("w").alias("w"),
            *[f(c).alias(f"{n}_{c}") for c in ("pa", "pb", "ref", "ref2") for n, f in (("lo", F.min), ("hi", F.max))]), "trie-nodes")
        if _proved(df, nodes, seed):
            break
        seed += 1
    nodes = nodes.withColumnsRenamed({"lo_pa": "pa", "lo_pb": "pb"}).drop("hi_pa", "hi_pb", "lo_ref", "hi_ref", "lo_ref2", "hi_ref2")

    # Where a conversation becomes the smallest member, the words above that, and whether it ends a branch.
    chain = nodes.groupBy(F.col("rep").alias("conv")).agg(
        F.min("depth").alias("s"), F.min(F.col("cw") - F.col("w")).alias("above"), F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"))
    shared = F.col("s").isNull() | (F.col("depth") < F.col("s"))
    members = rows.join(chain, "conv", "left").select(
        *key, F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"), shared.cast("long").alias("repeats"),
        F.when(shared, F.coalesce("above", "total")).otherwise(F.lit(0).cast("long")).alias("upto"), F.lit(0).cast("long").alias("child"))
    zero = F.lit(0).cast("long")
    children = nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), zero.alias("leaf"), zero.alias("repeats"),
        zero.alias("upto"), F.lit(1).cast("long").alias("child"))
    sums = members.unionByName(children).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("leaf", "repeats", "upto", "child")])

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("rep").alias("parent_conv_id"))
    several = nodes.where("n_ends > 1").select(*key, "rep")
    digests = _ends(rows.where("ends").select(*key, "conv").join(several, key))
    no_ends = hashlib.sha256(b"").hexdigest()
    out = nodes.join(sums, key).join(parents, ["depth", "pa", "pb"], "left").join(digests, ["rep", "depth"], "left")
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.col("child").alias("n_children"), F.col("leaf").alias("n_leaves"),
        (F.col("upto") - F.col("repeats") * (F.col("cw") - F.col("w"))).alias("saved_tokens"),
        F.when(F.col("n_ends") == 0, F.lit(no_ends)).when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256))
        .otherwise(F.col("ends_sha256")).alias("ends_sha256"))


def _proved(df: DataFrame, nodes: DataFrame, seed: int) -> bool:
    """Whether every content hash stands for one role and text, and the members of every node agree."""
    role, text = text_or_empty("role"), text_or_empty("text")
    content = F.md5(F.concat_ws(":", F.lit(str(seed)), F.length(role), role, text).cast("binary"))
    contents = df.where("conv_id IS NOT NULL").groupBy(content.alias("m")).agg(
        F.min(role).alias("r0"), F.max(role).alias("r1"), F.min(text).alias("t0"), F.max(text).alias("t1"))
    torn = nodes.where("lo_pa <> hi_pa OR lo_pb <> hi_pb OR lo_ref <> hi_ref OR lo_ref2 <> hi_ref2").limit(1).count()
    return not torn and not contents.where("r0 <> r1 OR t0 <> t1").limit(1).count()
