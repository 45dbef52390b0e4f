"""Token counts of a byte-pair SentencePiece model by finite-state transducer.

A byte-pair encoding is the only split of a text whose neighbouring tokens are
all *compatible*: encoding the two tokens' joined text gives the two tokens
back. So the encoding of every prefix ends in one known token, and the last
token after a character follows from a bounded look-back. The transducer's
state holds, for every start from which a longer token may still grow, the
characters since that start, the token that ended there and the tokens emitted
since. Reading a character moves to another state and emits a (possibly
negative) number of tokens: ``abc`` may have fewer tokens than ``ab``. States
are made when first reached and kept for the life of the Python worker.

No token crosses the start of a run of space markers, so the transducer is in
its start state there: a *chunk* (marker run plus word) maps every state to the
same state and count. Chunk maps compose by adding counts, which makes the
scan over a text's chunks a sum, and equal chunks share one map. Long texts
are cut into segments at white space before they reach Python, so a worker
holds segments, not whole texts; the segments' maps are added per document in
a scan over the rows of the partition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import ship_code, text_or_empty, worker_cache
from tickwatch.llm.piece_model import MARK, PieceModel, read_model, read_model_file

#: Distinct chunk counts kept per Python worker; the table is emptied beyond it (a cache, results do not depend on it).
CHUNKS_KEPT = 1_000_000
#: Transducer states kept per Python worker, likewise.
STATES_KEPT = 300_000


class Transducer:
    """Deterministic token-counting transducer, compiled from a model as far as texts need it."""

    def __init__(self, model: PieceModel):
        self.byte_fallback = model.byte_fallback
        self.by_words = model.words_start_with_marks()
        ids = model.normal_ids()
        self.score = {p: model.scores[i] for p, i in ids.items()}
        self.split: dict[str, tuple[str, str] | None] = {}
        reachable = [p for p in ids if self._derive(p)]
        self.tokens = set(reachable)
        self.ordered: set[str] = set()  # tokens whose merges, and those of their parts, come in falling score
        for p in sorted(reachable, key=len):
            parts = self.split[p]
            if parts is None or all(q in self.ordered and (len(q) == 1 or self.score[q] > self.score[p]) for q in parts):
                self.ordered.add(p)
        self.under: dict[str, list[str]] = {}  # proper prefix -> tokens that begin with it
        for p in sorted(reachable, key=len):
            for n in range(1, len(p)):
                self.under.setdefault(p[:n], []).append(p)
        self._pairs: dict[tuple[str, str], bool] = {}
        self._grows: dict[tuple[str, str], bool] = {}
        self._reset()

    # ---- the model's merges -------------------------------------------------

    def encode(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none can be merged."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _derive(self, piece: str) -> bool:
        """Record the last merge that makes ``piece``; False if encoding its text gives something else."""
        parts = list(piece)
        last = None
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return False
            last = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        self.split[piece] = last
        return True

    def compatible(self, a: str | None, b: str) -> bool:
        """Whether the joined text of tokens ``a`` and ``b`` encodes to just these two."""
        if a is None:
            return True
        ok = self._pairs.get((a, b))
        if ok is None:
            ok = self._pairs[a, b] = self._crosses_nothing(a, b)
        return ok

    def _crosses_nothing(self, a: str, b: str) -> bool:
        """Undo the merges of ``a``'s right edge and ``b``'s left edge, newest
        first: a merge across the border must not be preferred to the one just
        undone. That needs merges that come in falling score; for other tokens, encode."""
        if a not in self.ordered or b not in self.ordered:
            return self.encode(a + b) == [a, b]
        score, split = self.score, self.split
        bound, wins_ties = float("-inf"), False
        while True:
            across = score.get(a + b)
            if across is not None and (across > bound or (wins_ties and across == bound)):
                return False
            sa, sb = split.get(a), split.get(b)
            if sa is None and sb is None:
                return True
            if sb is None or (sa is not None and score[a] < score[b]):
                bound, wins_ties, a = score[a], False, sa[1]
            else:  # of equal scores the left merge comes first
                bound, wins_ties, b = score[b], True, sb[0]

    def grows(self, a: str | None, begun: str) -> bool:
        """Whether some token that begins with ``begun`` and is longer can follow token ``a``."""
        longer = self.under.get(begun)
        if not longer:
            return False
        if a is None:
            return True
        ok = self._grows.get((a, begun))
        if ok is None:
            ok = self._grows[a, begun] = any(self.compatible(a, t) for t in longer)
        return ok

    # ---- states -------------------------------------------------------------

    def _reset(self) -> None:
        start = (("", None, 0),)
        self.states: list[tuple] = [start]
        self.number: dict[tuple, int] = {start: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def _move(self, state: int, ch: str) -> tuple[int, int]:
        """The next state and the number of tokens emitted on reading ``ch``."""
        token, emitted = None, 0
        if ch in self.tokens:
            for begun, before, since in self.states[state]:
                t = begun + ch
                if t in self.tokens and self.compatible(before, t):
                    token, emitted = t, 1 - since
                    break
            live = [(begun + ch, before, since + emitted) for begun, before, since in self.states[state]
                    if self.grows(before, begun + ch)]
            entries = (*live, ("", token, 0))
        else:  # in no piece: spelled in bytes, or one unknown token
            emitted = len(ch.encode("utf-8")) if self.byte_fallback else 1
            entries = (("", None, 0),)
        at = self.number.get(entries)
        if at is None:
            at = self.number[entries] = len(self.states)
            self.states.append(entries)
            self.moves.append({})
        self.moves[state][ch] = at, emitted
        return at, emitted

    def run(self, chunk: str, state: int = 0) -> tuple[int, int]:
        """State map of a chunk at one state: (state after it, tokens emitted)."""
        total, moves = 0, self.moves
        for ch in chunk:
            step = moves[state].get(ch)
            if step is None:
                step = self._move(state, ch)
            state, emitted = step
            total += emitted
        return state, total


class ChunkCounter:
    """Counts of chunks from the start state, remembered for equal chunks."""

    def __init__(self, model: PieceModel):
        self.transducer = Transducer(model)
        self.prefix = MARK if model.add_dummy_prefix else ""
        self.known: dict[str, int] = {}
        if self.transducer.by_words:
            self.chunks = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        else:
            self.chunks = lambda s: [s]

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        text = text.replace(" ", MARK)
        return self.count_chunks(self.chunks(self.prefix + text)) if text else 0

    def count_chunks(self, chunks: list[str]) -> int:
        """Tokens of whole chunks: the composition of their maps."""
        known = self.known
        try:
            return sum(map(known.__getitem__, chunks))
        except KeyError:
            return sum(map(self._chunk, chunks))

    def _chunk(self, chunk: str) -> int:
        n = self.known.get(chunk)
        if n is None:
            self._make_room()
            n = self.transducer.run(chunk)[1]
            if len(chunk) <= 64:
                self.known[chunk] = n
        return n

    def _make_room(self) -> None:
        if len(self.known) >= CHUNKS_KEPT:
            self.known.clear()
        if len(self.transducer.states) >= STATES_KEPT:
            self.transducer._reset()

    def scan(self, segments: Iterator[str]) -> int:
        """Tokens of a text given in segments cut anywhere: the prefix scan of their maps.

        A segment's map is known but for its head, the rest of the chunk that
        the cut went through: the head runs from the state carried over.
        """
        total, state, carried = 0, 0, ""
        for segment in segments:
            segment = segment.replace(" ", MARK)
            if not segment:
                continue
            if not carried:
                segment, head = self.prefix + segment, 0
                self._make_room()
            elif not self.transducer.by_words:
                head = len(segment)
            else:
                head = len(segment) - len(segment.lstrip(MARK)) if carried == MARK else 0
                end = segment.find(MARK, head)
                head = len(segment) if end < 0 else end
            state, n = self.transducer.run(segment[:head], state)
            total += n
            if chunks := self.chunks(segment[head:]) if head < len(segment) else []:
                total += self.count_chunks(chunks[:-1])
                state, n = self.transducer.run(chunks[-1])
                total += n
            carried = segment[-1]
        return total


#: Characters of a text that reach a Python worker in one row.
SEGMENT = 1 << 16


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 segment: int = SEGMENT) -> DataFrame:
    """Tokens of every text, as the model's library counts them without begin and end tokens.

    Returns one row per input row: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens``.
    A null text counts as empty (0 tokens), a null id stays null, repeated rows
    each get their row, other columns are not read. No shuffle.
    """
    ship_code()
    data = read_model_file(model_path)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(("token_counts", hash(data)), lambda: ChunkCounter(read_model(data)))
        held: list[str] = []  # segments so far of a text that has more in the next rows
        for batch in batches:
            ids, sizes, parts, lasts, texts = (batch.column(i) for i in range(5))
            out, at = [], []
            for i, (part, last, text) in enumerate(zip(parts.to_pylist(), lasts.to_pylist(), texts.to_pylist())):
                if part == 0 == last:
                    n = counter.count(text)
                else:
                    held.append(text)
                    if part < last:
                        continue
                    n = counter.scan(iter(held))
                    held = []
                out.append(n)
                at.append(i)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(at), sizes.take(at), pa.array(out, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    last = F.greatest(F.ceil(F.length("text") / segment) - 1, F.lit(0)).cast("int")
    rows = (
        df.select(F.col(id_col).alias("id"), text.alias("text"))
        .select("id", F.octet_length("text").cast("long").alias("n_bytes"), last.alias("last"), "text")
        .select("id", "n_bytes", "last", F.explode(F.expr(
            f"transform(sequence(0, last), i -> named_struct('part', i, 'text', "
            f"if(last = 0, text, substring(text, i * {segment} + 1, {segment}))))")).alias("s"))
        .select("id", "n_bytes", "s.part", "last", "s.text")
    )
    id_type = df.schema[id_col].dataType.simpleString()
    return (rows.mapInArrow(counts, f"id {id_type}, n_bytes bigint, n_tokens bigint")
            .withColumnRenamed("id", id_col))
