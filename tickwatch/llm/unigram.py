"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The pieces and their log scores come from a model file. The trie is a pair of
integer arrays: from ``node``, character code ``c`` leads to ``base[node] + c``
if ``check`` there is ``node``. The driver builds it once and ships the arrays
(their size follows the model file, not the data).

Encoding picks the split with the largest sum of scores. A character that no
single-character piece covers costs ten less than the lowest score and is
spelled in byte pieces. Sums are exact in double precision; of equal sums the
one whose last piece starts first wins. No piece crosses the start of a run of
space markers, so texts are encoded chunk by chunk and equal chunks once.
"""

from __future__ import annotations

import re
from array import array
from collections import ChainMap
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.common import ship_code, text_or_empty, without, worker_cache
from tickwatch.llm.piece_model import MARK, NORMAL, PieceModel, marked, read_model, read_model_file

#: Fixed value of the Unigram model: what an unknown character costs below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Distinct chunks kept per Python worker (a cache).
CHUNKS_KEPT = 300_000
#: Chunks of at most so many characters are encoded many at once, and kept.
TOGETHER = 48
#: Fixed value: what the library prints for an unknown piece without byte fallback.
UNKNOWN_SURFACE = " ⁇ "


@dataclass
class DoubleArray:
    """``codes`` maps characters to 1.., ``value`` nodes to piece ids (-1: none)."""

    codes: dict[str, int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def build_trie(pieces: dict[str, int]) -> DoubleArray:
    """Place every node's children at the first offset where all their slots are free."""
    codes = {c: i + 1 for i, c in enumerate(sorted({c for p in pieces for c in p}))}
    children: list[dict[int, int]] = [{}]
    ids = [-1]
    for piece, number in pieces.items():
        node = 0
        for c in piece:
            nxt = children[node].get(codes[c])
            if nxt is None:
                nxt = children[node][codes[c]] = len(children)
                children.append({})
                ids.append(-1)
            node = nxt
        ids[node] = number
    size = 2 * len(children) + 2 * len(codes) + 2
    base, check = [0] * size, [-1] * size
    value = [-1] * size
    check[0] = 0
    place = {0: 0}
    free = 1  # where the search for free slots starts
    level = [0]  # parents before children; within a level, nodes with many children first
    while level:
        following = []
        for node in sorted(level, key=lambda n: -len(children[n])):
            kids = sorted(children[node])
            if not kids:
                continue
            while check[free] >= 0:
                free += 1
            offset = first = max(free - kids[0], 0)
            while True:
                if offset + kids[-1] >= len(check):
                    grow = offset + kids[-1] + 1 - len(check) + size
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                if all(check[offset + k] < 0 for k in kids) and offset + kids[0] > 0:
                    break
                offset += 1
            if offset - first > 256:  # the slots passed over are nearly full: search on from here
                free = offset + kids[0]
            base[place[node]] = offset
            for k in kids:
                check[offset + k] = place[node]
                place[children[node][k]] = offset + k
                value[offset + k] = ids[children[node][k]]
                following.append(children[node][k])
        level = following
    as_array = lambda x: np.array(x, dtype=np.int32)
    return DoubleArray(codes, as_array(base), as_array(check), as_array(value))


class Codec:
    """Encodes and decodes with one model. ``trie``: its double array, built here if not given."""

    def __init__(self, model: PieceModel, trie: DoubleArray | None = None):
        trie = trie or build_trie(model.normal_ids())
        self.codes = trie.codes
        self.base, self.check, self.value = trie.base.tolist(), trie.check.tolist(), trie.value.tolist()
        self.scores = [float(s) for s in model.scores]
        self.unknown_score = min(s for s, k in zip(model.scores, model.kinds) if k == NORMAL) - UNKNOWN_PENALTY
        self.byte_ids = model.byte_ids()
        self.unknown_id = model.unknown_id
        self.add_prefix = model.add_dummy_prefix
        self.chunks = (re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall if model.words_start_with_marks()
                       else lambda s: [s])
        self.known: dict[str, bytes] = {}
        reach = max(self.codes.values()) + 1  # slots past the end that a step may look at
        self.base_array = np.concatenate([trie.base, np.zeros(reach, np.int32)])
        self.check_array = np.concatenate([trie.check, np.full(reach, -1, np.int32)])
        self.value_array = np.concatenate([trie.value, np.full(reach, -1, np.int32)])
        self.score_array = np.array(self.scores)
        # What an unknown character becomes: for ASCII its byte piece, -1 for those that take several or the unknown piece.
        self.unknown_as = np.array([*(self.byte_ids or [-1] * 256)[:128], -1], np.int32)
        self.code_of = np.zeros(0x110000, np.int32)
        self.code_of[[ord(c) for c in self.codes]] = list(self.codes.values())
        byte_of = {i: b for b, i in enumerate(self.byte_ids or [])}
        self.surface = [
            bytes([byte_of[i]]) if i in byte_of else p.replace(MARK, " ").encode("utf-8") if k == NORMAL
            else UNKNOWN_SURFACE.encode("utf-8") if i == model.unknown_id else b""
            for i, (p, k) in enumerate(zip(model.pieces, model.kinds))
        ]

    def best_split(self, chunk: str) -> list[tuple[int, int, int]]:
        """The best path through a chunk's pieces: (start, end, piece id or -1 for an unknown character)."""
        n = len(chunk)
        codes = [self.codes.get(c, 0) for c in chunk]
        base, check, value, scores = self.base, self.check, self.value, self.scores
        limit = len(check)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back = [(0, -1)] * (n + 1)
        for i in range(n):
            here, node, single = best[i], 0, False
            for j in range(i, n):
                c = codes[j]
                at = base[node] + c
                if not c or at >= limit or check[at] != node or at == 0:
                    break
                node = at
                piece = value[at]
                if piece >= 0:
                    if j == i:
                        single = True
                    if here + scores[piece] > best[j + 1]:
                        best[j + 1] = here + scores[piece]
                        back[j + 1] = (i, piece)
            if not single and here + self.unknown_score > best[i + 1]:
                best[i + 1] = here + self.unknown_score
                back[i + 1] = (i, -1)
        path, end = [], n
        while end:
            start, piece = back[end]
            path.append((start, end, piece))
            end = start
        return path[::-1]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """:meth:`_ids` of many short chunks at once: the steps of :meth:`best_split` on arrays, a chunk per column.

        All chunks' paths from position ``i`` go down the trie together; a chunk leaves when it leaves the trie."""
        length = np.array([len(c) for c in chunks])
        width = int(length.max())
        points = np.ascontiguousarray(np.array(chunks, dtype=f"<U{width}").view(np.uint32).reshape(len(chunks), width).T)
        codes = self.code_of[points]
        best = np.full((width + 1, len(chunks)), -np.inf)
        best[0] = 0.0
        start = np.zeros((width + 1, len(chunks)), np.int32)
        piece = np.full((width + 1, len(chunks)), -1, np.int32)
        for i in range(width):
            at = np.nonzero(length > i)[0]
            here, node = best[i][at], np.zeros(len(at), np.int32)
            for j in range(i, width):
                code = codes[j][at]
                to = self.base_array[node] + code
                ok = (self.check_array[to] == node) & (code > 0) & (to > 0)
                value = np.where(ok, self.value_array[to], -1)
                score = here + self.score_array[value]  # of value -1 the last entry, not used
                better = (value >= 0) & (score > best[j + 1][at])
                if j == i:  # an unknown character, where no piece is just this character
                    unknown = (value < 0) & (here + self.unknown_score > best[i + 1][at])
                    better |= unknown
                    score = np.where(unknown, here + self.unknown_score, score)
                    value = np.where(unknown, self.unknown_as[np.minimum(points[i][at], 128)], value)
                won = at[better]
                best[j + 1][won] = score[better]
                start[j + 1][won] = i
                piece[j + 1][won] = value[better]
                stay = ok & (length[at] > j + 1)
                at, here, node = at[stay], here[stay], to[stay]
                if not len(at):
                    break
        found, count, end, column = [], np.zeros(len(chunks), np.int64), length.copy(), np.arange(len(chunks))
        while (on := end > 0).any():
            found.append(np.where(on, piece[end, column], 0))
            count += on
            end = np.where(on, start[end, column], 0)
        ids = np.ascontiguousarray(np.array(found, np.int32).T[:, ::-1])
        spelled = (ids < 0).any(axis=1)
        width = ids.shape[1]
        return [self._ids(c, self.best_split(c)) if odd else row[width - n:].tobytes()
                for c, odd, row, n in zip(chunks, spelled.tolist(), ids, count.tolist())]

    def _ids(self, chunk: str, path: list[tuple[int, int, int]]) -> bytes:
        """Ids of a chunk's path as native 32-bit integers."""
        ids: list[int] = []
        for start, end, piece in path:
            if piece >= 0:
                ids.append(piece)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in chunk[start:end].encode("utf-8")]
            else:
                ids.append(self.unknown_id)
        return array("i", ids).tobytes()

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of whole texts, without begin and end pieces."""
        split = [self.chunks(marked(t, self.add_prefix)) for t in texts]
        if len(self.known) >= CHUNKS_KEPT:
            self.known.clear()
        fresh = {c for chunks in split for c in chunks}.difference(self.known)
        long = {c: self._ids(c, self.best_split(c)) for c in fresh if len(c) > TOGETHER}
        short = sorted((c for c in fresh if len(c) <= TOGETHER), key=len)
        for at in range(0, len(short), 4096):
            some = short[at:at + 4096]
            self.known.update(zip(some, self.encode_chunks(some)))
        known = ChainMap(long, self.known) if long else self.known
        return [self._joined(b"".join(map(known.__getitem__, chunks))) for chunks in split]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def _joined(self, data: bytes) -> np.ndarray:
        ids = np.frombuffer(data, dtype=np.int32)
        if self.byte_ids is None and len(ids):  # a run of unknown characters is one unknown piece
            unknown = ids == self.unknown_id
            ids = ids[~(unknown & np.concatenate([[False], unknown[:-1]]))]
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids: markers become spaces, byte pieces are joined
        and read as UTF-8 (replacement characters where they are not), the leading marker goes."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.add_prefix and data[:1] == b" " and self.surface[ids[0]][:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


def _codec_maker(model_path: str):
    """Reads the model and builds the trie here, on the driver; returns what workers call for their codec."""
    ship_code()
    data = read_model_file(model_path)
    trie = build_trie(read_model(data).normal_ids())
    return lambda: worker_cache(("unigram", hash(data)), lambda: Codec(read_model(data), trie))


Batches = Iterator[pa.RecordBatch]


def _encoder(codec, text_at: int, ids_col: str):
    """Task function: the text column, at ``text_at``, becomes a last column of ids."""
    def run(batches: Batches) -> Batches:
        c = codec()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # the ids of a few texts at a time
                part = batch.slice(at, 1024)
                ids = c.encode_many(part.column(text_at).to_pylist())
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))
                keep = [i for i in range(part.num_columns) if i != text_at]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), column],
                                                 names=[*(part.schema.names[i] for i in keep), ids_col])
    return run


def _decoder(codec, ids_at: int, text_col: str):
    """Task function: adds a last column, the texts of the ids at ``ids_at``."""
    def run(batches: Batches) -> Batches:
        c = codec()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = pa.array([c.decode(ids or []) for ids in part.column(ids_at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, text_col])
    return run


def _texts(df: DataFrame, text_col: str, replaced: list[str]) -> DataFrame:
    """The columns of ``df`` but for ``replaced``, the text last."""
    return df.select(*without(df, [text_col, *replaced]), text_or_empty(f"`{text_col}`").alias(text_col))


def _ids_field(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType(), False), False)


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace ``text_col`` by ``ids_col``, an array of piece ids.

    A null text counts as empty (no ids); other columns pass through; a column
    already named ``ids_col`` is replaced. No shuffle.
    """
    rows = _texts(df, text_col, [ids_col])
    schema = T.StructType([*rows.schema.fields[:-1], _ids_field(ids_col)])
    return rows.mapInArrow(_encoder(_codec_maker(model_path), len(rows.columns) - 1, ids_col), schema)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``, the text of the piece ids (null ids: an empty text)."""
    rows = df.select(*without(df, [text_col]))
    schema = T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType(), False)])
    return rows.mapInArrow(_decoder(_codec_maker(model_path), rows.columns.index(ids_col), text_col), schema)


def encoded_and_decoded(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids again: ``ids``, ``n_pieces``,
    ``n_byte_pieces``, ``decoded_sha256`` and ``round_trip`` (the decoded text is
    the text) beside the other columns, instead of the text.

    A null text counts as empty. The five columns replace columns of their names.
    """
    made = ["ids", "n_pieces", "n_byte_pieces", "decoded_sha256", "round_trip", "_sha256", "_decoded"]
    model = read_model(read_model_file(model_path))
    byte_ids = model.byte_ids() or []
    low, high = (min(byte_ids), max(byte_ids)) if byte_ids else (0, -1)
    rows = df.select(*without(df, [*made, text_col]), F.sha2(text_or_empty(f"`{text_col}`").cast("binary"), 256).alias("_sha256"),
                     text_or_empty(f"`{text_col}`").alias(text_col))
    schema = T.StructType([*rows.schema.fields[:-1], _ids_field("ids"), T.StructField("_decoded", T.StringType(), False)])
    codec, last = _codec_maker(model_path), len(rows.columns) - 1
    encoder, decoder = _encoder(codec, last, "ids"), _decoder(codec, last, "_decoded")
    both = rows.mapInArrow(lambda batches: decoder(encoder(batches)), schema)  # one worker, one codec for both
    sha = F.sha2(F.col("_decoded").cast("binary"), 256)
    return both.select(
        *without(both, ["ids", "_sha256", "_decoded"]),
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.size(F.filter("ids", lambda x: x.between(low, high))).cast("long").alias("n_byte_pieces"),
        sha.alias("decoded_sha256"),
        (sha == F.col("_sha256")).alias("round_trip"),
    )
