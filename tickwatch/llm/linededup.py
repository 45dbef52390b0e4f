"""Line dedup: a line that many documents share stays in one of them.

Every document gives its long lines' key hashes. The hashes are dealt by range
and sorted by hash, document (the largest id first) and row, so a key's first
occurrences come first and its rows are streamed: the first document's lines
stay, those of the others go once enough documents were seen. Nothing but the
first few documents of the current key is held. A key that the edge of a range
cuts, however many rows it has, leaves its rows undecided; their documents are
counted by a small aggregate, and a join decides them. The result is a
compressed bitmap of the lines each document keeps, not its text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, stored, text_or_empty

#: Code points that a key has at least, and documents that hold it at least, for its lines to go.
KEY_CHARS, DOCUMENTS = 40, 5
#: Rows of one key held while its documents are counted; a key with more (rows that repeat an id) is decided by the join.
HELD = 4096
_SPACES = " \t\n\x0b\x0c\r"


def row_key(id_col: str, text_col: str) -> Column:
    """What stands for a row: rows with equal id and text keep the same lines."""
    name = F.coalesce(F.concat(F.lit("#"), F.col(id_col).cast("string")), F.lit("null"))
    return F.unhex(F.md5(F.concat(name, F.lit("\n"), text_or_empty(text_col)).cast("binary")))


def line_keys(text: str, key_chars: int = KEY_CHARS) -> dict[bytes, list[int]]:
    """Hash of every long key of a text, and the numbers of its lines."""
    found: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.split("\n")):
        if len(line) >= key_chars and len(key := line.strip(_SPACES)) >= key_chars:
            # bytes.lower changes A-Z only.
            h = hashlib.blake2b(key.encode("utf-8").lower(), digest_size=16).digest()
            found.setdefault(h, []).append(i)
    return found


def _key_rows(df: DataFrame, id_col: str, text_col: str, key_chars: int) -> DataFrame:
    """``h1, h2`` (the hash), ``id, row, n_lines`` and ``at`` (line numbers, 32-bit) for every long key of a row."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, n_lines, hashes, at = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = line_keys(text, key_chars)
                of.extend([i] * len(found))
                n_lines.extend([text.count("\n") + 1] * len(found))
                hashes.extend(found)
                at.extend(np.array(x, "<i4").tobytes() for x in found.values())
            h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), batch.column(0).take(of), batch.column(1).take(of),
                 pa.array(n_lines, pa.int64()), pa.array(at, pa.binary())], names=["h1", "h2", "id", "row", "n_lines", "at"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(keys, f"h1 bigint, h2 bigint, id {kind}, row binary, n_lines bigint, at binary")


class _Streamer:
    """Goes through the rows of one range in order. ``out`` takes rows that go (open: false)
    and rows the range cannot decide alone (open: true)."""

    def __init__(self, documents: int):
        self.documents = documents
        self.key = self.doc = None
        self.cut = True  # the key may have begun in an earlier range
        self.seen, self.full = 0, False
        self.held: list[tuple[int, pa.RecordBatch]] = []
        self.out: list[tuple[pa.RecordBatch, bool]] = []

    def put(self, rows: pa.RecordBatch, is_open: bool) -> None:
        if rows.num_rows:
            self.out.append((rows, is_open))

    def close(self, last: bool = False) -> None:
        """End of a key, or (``last``) of the range, beyond which the key may go on."""
        for number, rows in self.held:
            if last or self.full:
                self.put(rows, True)
            elif self.seen >= self.documents and number > 1:
                self.put(rows, False)
        self.held, self.seen, self.full = [], 0, False

    def run(self, batch: pa.RecordBatch, lo: int, hi: int, key: tuple[int, int]) -> None:
        """The next rows of one key."""
        if key != self.key:
            self.close()
            self.cut = self.key is None
            self.key, self.doc = key, object()
        if self.cut:
            return self.put(batch.slice(lo, hi - lo), True)
        gone, undecided = [], []
        for i, doc in enumerate(batch.column(2).slice(lo, hi - lo).to_pylist(), lo):
            if doc != self.doc:
                self.seen, self.doc = self.seen + 1, doc
            if self.seen > self.documents:
                gone.append(i)
            elif len(self.held) < HELD:
                self.held.append((self.seen, batch.take(pa.array([i]))))
            else:
                self.full = True
                undecided.append(i)
        self.put(batch.take(pa.array(gone, pa.int64())), False)
        self.put(batch.take(pa.array(undecided, pa.int64())), True)

    def batch(self, batch: pa.RecordBatch) -> None:
        h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        ends = np.r_[starts[1:], len(h1)]
        # Short keys that begin and end inside the batch cannot reach the number of documents.
        todo = ends - starts >= self.documents
        todo[[0, -1]] = True
        for lo, hi in zip(starts[todo].tolist(), ends[todo].tolist()):
            self.run(batch, lo, hi, (int(h1[lo]), int(h2[lo])))


def _streamed(rows: DataFrame, documents: int) -> DataFrame:
    """The rows of :func:`_key_rows` that go (``open`` false) or are undecided (``open`` true)."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            for part, is_open in s.out:
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([is_open] * part.num_rows)], names=[*part.schema.names, "open"])
            s.out = []

        s = _Streamer(documents)
        for batch in batches:
            if batch.num_rows:
                s.batch(batch)
                yield from flush()
        s.close(last=True)
        yield from flush()

    order = ["h1", "h2", F.col("id").desc_nulls_last(), "row"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(stream, f"{fields}, open boolean")


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_chars: int = KEY_CHARS,
                 documents: int = DOCUMENTS) -> DataFrame:
    """Which lines stay, of every document that loses some.

    A line's key is the line without white space at its ends, with A-Z
    lower-cased. Keys of at least ``key_chars`` code points that at least
    ``documents`` documents hold lose all their lines but those in the document
    with the largest id. Returns ``row`` (see :func:`row_key`), ``id_col``,
    ``n_lines``, ``n_dropped`` and ``keep``: a bit per line (most significant
    first, 1 stays), compressed by zlib. Documents that keep everything have no row.

    A null or empty text is one empty line and loses nothing. Rows that share
    an id count as one document; equal rows share one result row. Rows without
    an id count as one document with the smallest id. An empty table gives no
    rows; other columns, whatever their names, are not read. No text is
    shuffled; a task holds one batch of rows and :data:`HELD` rows of a key.
    """
    ship_code()
    rows = stored(_key_rows(df, id_col, text_col, key_chars), "line-keys")
    found = stored(_streamed(rows, documents), "shared-lines")
    # Keys at the edges of ranges: about two a range, whatever the data.
    cut = found.where("open")
    counted = cut.groupBy("h1", "h2", "id").agg(F.lit(1)).groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.max("id").alias("largest")).where(F.col("n") >= documents).drop("n")
    late = cut.join(counted, ["h1", "h2"]).where("id IS NULL OR id <> largest").select("id", "row", "n_lines", "at")
    gone = found.where("NOT open").select("id", "row", "n_lines", "at").unionByName(late)
    per_row = gone.groupBy("row").agg(F.first("id").alias("id"), F.first("n_lines").alias("n_lines"), F.collect_set("at").alias("at"))

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped, keep = [], []
            for n, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                bits = np.ones(n, bool)
                bits[np.frombuffer(b"".join(at), "<i4")] = False
                dropped.append(n - int(bits.sum()))
                keep.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
                names=["row", "id", "n_lines", "n_dropped", "keep"])

    kind = df.schema[id_col].dataType.simpleString()
    return per_row.select("row", "id", "n_lines", "at").mapInArrow(
        bitmaps, f"row binary, id {kind}, n_lines bigint, n_dropped bigint, keep binary").withColumnRenamed("id", id_col)


def kept_texts(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's ``id_col``, ``n_lines`` (before dropping), ``n_dropped`` and its text of the lines that stay.

    One row per input row, with null and empty texts as one empty line; the
    texts are shuffled once, by row."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, dropped, keeps = batch.columns
            n_lines, out = [], []
            for text, keep in zip(texts.to_pylist(), keeps.to_pylist()):
                n = text.count("\n") + 1
                if keep is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n)
                    text = "\n".join(x for x, b in zip(text.split("\n"), bits.tolist()) if b)
                n_lines.append(n)
                out.append(text)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_lines, pa.int64()), dropped, pa.array(out, pa.string())],
                                             names=["id", "n_lines", "n_dropped", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"), text_or_empty(text_col).alias("text"))
    joined = rows.join(bitmaps.select("row", "n_dropped", "keep"), "row", "left").select(
        "id", "text", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep")
    out = joined.mapInArrow(apply, f"id {kind}, n_lines bigint, n_dropped bigint, text string")
    return out.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("text").alias(text_col))
