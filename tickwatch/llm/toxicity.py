"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Learning reads a bounded sample of labelled rows (:data:`EXAMPLES`, chosen by a
hash of the id). All texts are compared with examples twice: over the telling
terms, whose texts are toxic clearly more often than others, with the whole
sample; and over all terms, with the first :data:`WHOLE_EXAMPLES` of it.
Document frequencies count all documents. Each comparison goes through a
block-max index: examples lie in blocks, an inverted index holds each term's
largest weight in every block, and the sums of these bound a block's cosines.
Blocks are scored in the order of their bounds until no block can hold a nearer
example, so the nearest ones are exact. Their labels vote with the squared
cosine. A logistic curve over both votes, fitted to leave-one-out votes of the
examples, calibrates the score. Texts without any of the terms get the rate of
such examples. The evidence is that of all terms.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored, text_or_empty, worker_cache

#: Labelled rows to learn from, about: bounds what is broadcast and what the driver and each worker hold.
EXAMPLES = 20_000
#: Examples that are compared over all their terms.
WHOLE_EXAMPLES = 1_536
#: Telling terms at most.
TERMS = 1024
#: Fewest examples with a term, and how many times the overall rate its lower confidence bound must reach.
LEAST_EXAMPLES, LEAST_LIFT, DEVIATIONS = 5, 2.0, 3.0
#: Distinct example vectors that vote, entries of a block, and examples named as evidence.
NEIGHBOURS, BLOCK, EVIDENCE = 10, 256, 3
#: Score from which a text counts as toxic.
THRESHOLD = 0.3

TERM = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> Counter:
    return Counter(TERM.findall(text.lower()))


def sample(labels: DataFrame, id_col: str, label_col: str, examples: int) -> DataFrame:
    """``id, label`` of about ``examples`` rows that may be learned from, an id once, chosen by hash."""
    held = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2
    rows = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & ~held).groupBy(
        F.col(f"`{id_col}`").alias("id")).agg(F.max(f"`{label_col}`").cast("int").alias("label"))
    share = min(1.0, examples / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))


def informative_terms(labelled: DataFrame, most: int = TERMS) -> list[str]:
    """Terms of ``(text, label)`` whose texts are toxic clearly more often than all, most telling first."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t in set(TERM.findall(text.lower())):
                    n = found.setdefault(t, [0, 0])
                    n[0] += 1
                    n[1] += label
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *(pa.array([n[i] for n in found.values()], pa.int64()) for i in (0, 1))],
                names=["term", "n", "toxic"])

    # Most near copies count once: the smallest hash of a text's 3-word windows stands for the text.
    parted = labelled.select("text", "label", F.split(F.lower("text"), r"[^\p{L}]+").alias("w"))
    alike = F.when(F.size("w") < 3, F.xxhash64("text")).otherwise(F.expr(
        "array_min(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"))
    labelled = parted.groupBy("label", alike.alias("alike")).agg(F.min("text").alias("text"))
    total = labelled.agg(F.count("*"), F.sum("label")).first()
    if not total[0] or not total[1]:
        return []
    rate, z = total[1] / total[0], DEVIATIONS
    p, n = F.col("toxic") / F.col("n"), F.col("n")
    lower = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    counts = labelled.select("text", "label").mapInArrow(distinct, "term string, n bigint, toxic bigint")
    ranked = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).withColumn("lower", lower).where(
        (F.col("n") >= LEAST_EXAMPLES) & (F.col("lower") >= min(LEAST_LIFT * rate, (1 + rate) / 2)))
    return [r["term"] for r in ranked.orderBy(F.desc("lower"), "term").limit(most).collect()]


def telling_vectors(learned: DataFrame, terms: list[str]) -> DataFrame:
    """``label, terms, counts`` of ``(label, text)``: which of the terms every whole text has, and how often."""
    number = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [Counter(number[t] for t in TERM.findall(text.lower()) if t in number) for text in batch.column(1).to_pylist()]
            found = [sorted(h.items()) for h in hits]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([[x[i] for x in f] for f in found], ints) for i in (0, 1))],
                                             names=["label", "terms", "counts"])

    return learned.select("label", "text").mapInArrow(run, "label int, terms array<int>, counts array<int>")


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and values of a list column."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def example_terms(learned: DataFrame) -> DataFrame:
    """``id, label, terms, counts`` of ``(id, label, text)``: all terms of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(term_counts(t).items()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string())),
                 pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32()))], names=["id", "label", "terms", "counts"])

    kind = learned.schema["id"].dataType.simpleString()
    return learned.select("id", "label", "text").mapInArrow(run, f"id {kind}, label int, terms array<string>, counts array<int>")


def _ranges(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, one after another, and the range each belongs to."""
    owner = np.repeat(np.arange(len(begin)), length)
    return np.arange(len(owner)) + (begin - np.cumsum(length) + length)[owner], owner


class _Entries:
    """Rows of a sparse matrix as ((term, count), ...)."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        self.starts, self.terms, self.counts = starts, terms, counts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __getitem__(self, i: int) -> tuple:
        if not 0 <= i < len(self):
            raise IndexError(i)
        part = slice(self.starts[i], self.starts[i + 1])
        return tuple(zip(self.terms[part].tolist(), self.counts[part].tolist()))


class Index:
    """Examples in blocks, under an inverted index of each term's largest weight per block."""

    def __init__(self, idf: np.ndarray, examples: Iterable[tuple[int, list[int], list[int], int]]):
        """examples: (id, terms, counts, label), terms in order. Equal vectors become one entry; those without terms the blank rate."""
        self.idf = idf
        members: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
        labels: list[int] = []
        blank: list[int] = []
        for number, terms, counts, label in examples:
            labels.append(label)
            if len(terms):
                members.setdefault(self._key(terms, counts), []).append((label, number))
            else:
                blank.append(label)
        self.rate = (sum(labels) + 0.5) / (len(labels) + 10.0)
        self.blank_score = (sum(blank) + self.rate) / (len(blank) + 1.0)
        keys = sorted(members)
        self.digests = {hashlib.sha256(b"|".join(k)).digest(): i for i, k in enumerate(keys)}
        self.n = np.array([len(members[k]) for k in keys], float)
        self.toxic = np.array([sum(x[0] for x in members[k]) for k in keys], float)
        self.shown = [[(number, label) for label, number in sorted(members[k])[:EVIDENCE]] for k in keys]
        starts = np.cumsum([0, *(len(k[0]) // 4 for k in keys)])
        terms = np.frombuffer(b"".join(k[0] for k in keys), np.int32)
        counts = np.frombuffer(b"".join(k[1] for k in keys), np.int32)
        self.entries = _Entries(starts, terms, counts)
        weight = (1 + np.log(counts)) * idf[terms] if len(terms) else np.zeros(0)
        norm = np.sqrt(np.add.reduceat(weight * weight, starts[:-1])) if len(keys) else np.ones(0)
        weight /= np.repeat(norm, np.diff(starts))
        # Postings by term, then entry; a pair is the run of a term's postings in one block.
        order = np.argsort(terms, kind="stable")
        at = np.repeat(np.arange(len(keys), dtype=np.int32), np.diff(starts))[order]
        term, block = terms[order], at // BLOCK
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(order) else order
        self.at, self.weight = at % BLOCK, weight[order]
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.pair_block, self.pair_begin = block[first].astype(np.int16 if len(keys) < BLOCK << 15 else np.int32), first
        self.pair_length = np.diff(np.r_[first, len(order)])
        self.begin = np.searchsorted(term[first], np.arange(len(idf) + 1))
        self.blocks = -(-len(keys) // BLOCK)
        self.scored = 0  # blocks, of all searches

    @staticmethod
    def _key(terms, counts) -> tuple[bytes, bytes]:
        return np.asarray(terms, np.int32).tobytes(), np.asarray(counts, np.int32).tobytes()

    def entry_of(self, terms, counts) -> int:
        """The number of the entry of this very vector, -1 without one."""
        return self.digests.get(hashlib.sha256(b"|".join(self._key(terms, counts))).digest(), -1)

    def weigh(self, entry: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF vector of ((term, count), ...)."""
        t = np.array([e[0] for e in entry])
        w = (1 + np.log([e[1] for e in entry])) * self.idf[t]
        return t, w / np.sqrt(np.dot(w, w))

    def nearest(self, entry: tuple, k: int = NEIGHBOURS, unseen: float = 0.0) -> list[tuple[float, int]]:
        """The k entries of largest cosine (ties: smaller entry number); entries of cosine 0 are none.

        unseen: the squared TF-IDF length of the text's terms that no example has.
        """
        return self.search(np.array([e[0] for e in entry], np.int64), np.array([e[1] for e in entry], float), k, unseen)

    def search(self, t: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS, unseen: float = 0.0) -> list[tuple[float, int]]:
        """:meth:`nearest` of terms, each once, and their counts."""
        if not len(t) or not len(self.n):
            return []
        w = (1 + np.log(counts)) * self.idf[t]
        w = w / np.sqrt(np.dot(w, w) + unseen)
        pairs, owner = _ranges(self.begin[t], self.begin[t + 1] - self.begin[t])
        block = self.pair_block[pairs]
        bound = np.bincount(block, self.most[pairs] * w[owner], minlength=self.blocks)
        by_block = np.argsort(block, kind="stable")
        pairs, share = pairs[by_block], w[owner[by_block]]
        cut = np.searchsorted(block[by_block], np.arange(self.blocks + 1)).tolist()
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(best) == k and bound[b] + 1e-9 < -best[-1][0]):
                break
            self.scored += 1
            part = slice(cut[b], cut[b + 1])
            postings, pair = _ranges(self.pair_begin[pairs[part]], self.pair_length[pairs[part]])
            scores = np.bincount(self.at[postings], self.weight[postings] * share[part][pair])
            hits = np.flatnonzero(scores >= -best[-1][0] if len(best) == k else scores > 0)
            if len(hits) > 2 * k:
                hits = hits[scores[hits] >= np.partition(scores[hits], len(hits) - k)[len(hits) - k]]
            best = sorted([*best, *((-x, b * BLOCK + i) for x, i in zip(scores[hits].tolist(), hits.tolist()))])[:k]
        return [(-s, i) for s, i in best]

    def vote(self, near: list[tuple[float, int]], entry: int = -1, label: int = 0) -> float:
        """Weighted share of toxic neighbours, drawn to the overall rate; an example given by ``entry`` and ``label`` is left out."""
        weight, toxic = 1.0, self.rate
        for s, i in near:
            n, t = self.n[i], self.toxic[i]
            if i == entry:
                n, t = n - 1, t - label
            weight += s * s * n
            toxic += s * s * t
        return toxic / weight


def _log_odds(p: float) -> float:
    return math.log(p / (1 - p))


def calibration(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> list[float]:
    """Factors of the columns of ``x`` and a constant of the logistic curve of ``y``, by Newton's method with a small penalty.

    A column with a falling curve, which would turn its votes around, is left out.
    """
    columns = list(range(x.shape[1]))
    start = [1.0 / len(columns)] * len(columns) + [0.0]
    if not len(y) or len(set(y.tolist())) < 2:
        return start
    while columns:
        z = np.column_stack([x[:, columns], np.ones(len(y))])
        first = np.array([1.0 / len(columns)] * len(columns) + [0.0])
        p = first.copy()
        for _ in range(rounds):
            s = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
            g = z.T @ (s - y) + (p - first)
            h = (z * (s * (1 - s))[:, None]).T @ z + np.eye(len(p))
            p = p - np.linalg.solve(h, g)
        if np.all(p[:-1] > 0):
            out = [0.0] * x.shape[1] + [float(p[-1])]
            for c, v in zip(columns, p):
                out[c] = float(v)
            return out
        columns.pop(int(np.argmin(p[:-1])))
    return start


class Scorer:
    """Votes of all terms and of the telling terms."""

    def __init__(self, number: dict[str, int], keep: np.ndarray, whole: Index, focused: Index, rare_idf: float):
        """number: of every term; keep: a term's number among the telling ones, or -1."""
        self.number = number
        self.keep = keep
        self.whole, self.focused, self.rare = whole, focused, rare_idf
        self.known: dict[tuple, float] = {}

    def votes(self, found: dict[str, int], label: int | None = None) -> tuple[float, float, list[tuple[float, int]]]:
        """Log odds of both votes, and the nearest examples over all terms; an example's label is left out of its votes."""
        t = np.fromiter(map(self.number.get, found, itertools.repeat(-1)), np.int64, len(found))
        n = np.fromiter(found.values(), np.int64, len(found))
        rest = (1 + np.log(n[t < 0])) * self.rare
        t, n = t[t >= 0], n[t >= 0]
        near = self.whole.search(t, n, NEIGHBOURS + (label is not None), float(np.dot(rest, rest)))
        own = -1
        if label is not None and len(t):
            by_term = np.argsort(t)
            own = self.whole.entry_of(t[by_term], n[by_term])
        if own >= 0:  # an example alone with its vector takes no place among its neighbours
            near = [x for x in near if x[1] != own or self.whole.n[own] > 1]
        near = near[:NEIGHBOURS]
        every = self.whole.vote(near, own, label or 0) if len(t) else self.whole.blank_score
        said = self.keep[t]
        entry = tuple(sorted(zip(said[said >= 0].tolist(), n[said >= 0].tolist())))
        if not entry:
            return _log_odds(every), _log_odds(self.focused.blank_score), near
        told = self.known.get(entry) if label is None else None
        if told is None:
            own = self.focused.entry_of(*zip(*entry)) if label is not None else -1
            told = _log_odds(self.focused.vote(self.focused.nearest(entry), own, label or 0))
            if label is None:
                if len(self.known) >= 200_000:
                    self.known.clear()
                self.known[entry] = told
        return _log_odds(every), told, near


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             examples: int = EXAMPLES) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``held_out``, ``score``, ``predicted`` and ``evidence``.

    Rows whose ``crc32(id as text) % 4`` is 2 are held out: their labels are
    never read. Null texts are empty; ids in no label, null ids and repeated
    rows are scored like others; without any usable labels all rows get one
    low score. Labels, language, source and id are no inputs of a score.
    Whole texts are scored, however long; examples of equal cosine rank by their
    vectors; an empty table gives no rows. The driver and each worker hold the
    terms of WHOLE_EXAMPLES texts, and a few numbers for each of EXAMPLES.
    """
    ship_code()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    few = stored(sample(labels, id_col, label_col, examples), "toxicity-sample")
    labelled = rows.join(F.broadcast(few), "id")  # about EXAMPLES rows of an id and a label
    telling = informative_terms(labelled)
    once = labelled.groupBy("id").agg(F.min(F.struct("text", "label")).alias("e")).select("id", "e.label", "e.text")  # repeated ids teach once
    # The nested sample for all terms: the first by the same hash.
    first = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30))
    bound = few.select(F.max(first)).first()[0] or 0
    most = int((bound + 1) * min(1.0, WHOLE_EXAMPLES / max(1, few.count())))
    once = stored(once, "toxicity-texts")
    told = telling_vectors(once, telling).toArrow()  # a few numbers for each of the sample
    learned = stored(example_terms(once.where(first < most)), "toxicity-examples")
    table = learned.orderBy("id").toArrow().combine_chunks()
    if len(table):
        offsets, flat = _lists(table["terms"].chunk(0))
        coded = flat.dictionary_encode()
        vocabulary, codes, counts = coded.dictionary, coded.indices.to_numpy(), _lists(table["counts"].chunk(0))[1].to_numpy()
    else:
        flat = coded = None
        offsets, vocabulary, codes, counts = np.zeros(1, int), pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int32)
    ids, ys = table["id"].to_pylist(), table["label"].to_pylist()
    # Broadcasts are small bytes, as every executor keeps them on disk; a worker builds its index from them once.
    send = lambda x: rows.sparkSession.sparkContext.broadcast(zlib.compress(cloudpickle.dumps(x)))
    receive = lambda sent: cloudpickle.loads(zlib.decompress(sent.value))
    vocabulary = list(dict.fromkeys([*vocabulary.to_pylist(), *telling]))
    shared = send("\n".join(vocabulary))  # terms are letters
    key = uuid.uuid4().hex

    def numbers() -> dict[str, int]:
        return worker_cache(f"{key}-terms", lambda: {t: i for i, t in enumerate(filter(None, receive(shared).split("\n")))})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers()
        seen = np.zeros(len(number) + 1, np.int64)  # the last counts texts
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0).to_pylist():
                found.update(set(TERM.findall(text.lower())))
            for t, n in found.items():
                if (i := number.get(t)) is not None:
                    seen[i] += n
            seen[-1] += batch.num_rows
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], names=["t", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(vocabulary) + 1)
    df[counted["t"].to_numpy()] = counted["n"].to_numpy()
    idf, rare = np.log((1 + df[-1]) / (1 + df[:-1])) + 1, math.log(1 + df[-1]) + 1

    number = {t: i for i, t in enumerate(telling)}
    keep = np.array([number.get(t, -1) for t in vocabulary], np.int32)
    ends, n_telling = np.array(offsets), len(telling)
    order = np.lexsort((codes, np.repeat(np.arange(len(ys)), np.diff(ends))))  # each example's terms by number
    told_rows = list(zip(told["terms"].to_pylist(), told["counts"].to_pylist(), told["label"].to_pylist()))
    indexed = send((codes[order], counts[order], ends, ys, idf, keep, told_rows))
    del table, flat, coded, order, codes, counts, vocabulary, told, told_rows

    def build() -> Scorer:
        codes, counts, ends, ys, idf, keep, told_rows = receive(indexed)
        whole = ((i, codes[ends[i]:ends[i + 1]], counts[ends[i]:ends[i + 1]], y) for i, y in enumerate(ys))
        focused_idf = np.ones(n_telling)
        focused_idf[keep[keep >= 0]] = idf[keep >= 0]
        focused = Index(focused_idf, ((i, t, c, y) for i, (t, c, y) in enumerate(told_rows)))
        return Scorer(numbers(), keep, Index(idf, whole), focused, rare)

    scorer = lambda: worker_cache(key, build)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys, terms, counts = (batch.column(i).to_pylist() for i in (1, 2, 3))
            found = [scorer().votes(dict(zip(t, c)), y) for y, t, c in zip(ys, terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))],
                                             names=["label", "every", "told"])

    own = learned.repartition("id").mapInArrow(left_out, "label int, every double, told double").orderBy("label", "every", "told").toArrow()
    curve = calibration(np.column_stack([own["every"].to_numpy(), own["told"].to_numpy()]), own["label"].to_numpy().astype(float))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = [], []
            judge = scorer()
            for text in batch.column(1).to_pylist():
                every, told, near = judge.votes(term_counts(text))
                odds = curve[0] * every + curve[1] * told + curve[2]
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
                evidence.append([{"id": ids[number], "cosine": round(c, 6), "label": y}
                                 for c, i in near[:EVIDENCE] for number, y in judge.whole.shown[i]][:EVIDENCE])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array(evidence, pa.list_(pa.struct([("id", batch.schema.field(0).type), ("cosine", pa.float64()), ("label", pa.int32())])))],
                names=["id", "score", "evidence"])

    scored = rows.mapInArrow(run, f"id {kind}, score double, evidence array<struct<id:{kind},cosine:double,label:int>>")
    held = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2
    return scored.select(F.col("id").alias(id_col), F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
