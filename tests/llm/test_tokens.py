from __future__ import annotations

import random

import pytest
import sentencepiece
from conftest import SF_SMALL

from tickwatch.llm import token_counts, unigram
from tickwatch.llm.piece_model import PieceModel, marked, read_model, read_model_file
from tickwatch.llm.queries import model_path, op2_token_counts, op5_sentencepiece

from .conftest import edge_rows

ALPHABET = " ▁▁  abethin\n\r\té世界😀()\"';{}/*\x00"


@pytest.fixture(scope="module")
def data():
    return read_model_file(model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_counts_equal_the_librarys_on_random_texts_and_cuts(data, library):
    counter = token_counts.ChunkCounter(read_model(data))
    rng = random.Random(2)
    for text in [*random_texts(3000), "tbbb bbb aaaa   x", "    ", "<s> </s> <unk> <0x0A>"]:
        expected = len(library.encode(text))
        assert counter.count(text) == expected, repr(text)
        parts, rest = [], text
        while rest:
            cut = rng.randint(1, 7)
            parts.append(rest[:cut])
            rest = rest[cut:]
        assert counter.scan(iter(parts)) == expected, parts


def test_op2_equals_the_library_on_whole_tables(spark, library):
    rows = op2_token_counts(spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id").collect()
    assert len(rows) == 200
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (
            len(r.text.encode()), len(library.encode(r.text)), len(library.encode(r.text)) > 4096)


def test_op2_edge_cases(clashing, nothing, library):
    out = token_counts.token_counts(clashing, model_path(), segment=1000)
    got = sorted(((r.doc_id is None, r.doc_id, r.n_tokens) for r in out.collect()), key=str)
    assert got == sorted(((r[0] is None, r[0], len(library.encode(r[1] or ""))) for r in edge_rows()), key=str)
    assert token_counts.token_counts(nothing, model_path()).collect() == []


def brute_split(model: PieceModel, text: str) -> float:
    """Best score of any split of a marked text, by trying all pieces at all places."""
    ids = model.normal_ids()
    unknown = min(model.scores[i] for i in ids.values()) - unigram.UNKNOWN_PENALTY
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            piece = text[start:end]
            if piece in ids:
                best[end] = max(best[end], best[start] + model.scores[ids[piece]])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + unknown)
    return best[-1]


def test_codec_finds_best_splits_alone_and_together(data):
    model = read_model(data)
    codec = unigram.Codec(model)
    ids = model.normal_ids()
    unknown = codec.unknown_score
    for text in random_texts(800, 3):
        text = marked(text)
        path = codec.best_split(text)
        assert "".join(text[a:b] for a, b, _ in path) == text
        assert sum(unknown if p < 0 else model.scores[p] for _, _, p in path) == brute_split(model, text)
        assert all(p < 0 or ids[text[a:b]] == p for a, b, p in path)
    chunks = sorted({c for t in random_texts(2000, 4) for c in codec.chunks(marked(t)) if c}, key=len)
    assert codec.encode_chunks(chunks) == [codec._ids(c, codec.best_split(c)) for c in chunks]


def test_codec_equals_the_librarys_unigram(data):
    """The library in Unigram mode; its marker runs get a score that its single precision can add up."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(data)
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.score < -1e8:
            piece.score = -40000
    changed = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    codec = unigram.Codec(read_model(changed))
    for text in random_texts(3000, 5):
        ids = codec.encode(text).tolist()
        assert ids == library.encode(text), repr(text)
        assert codec.decode(ids) == library.decode(ids)


def test_unknown_pieces_without_byte_fallback(data):
    model = read_model(data)
    model.byte_fallback = False
    codec = unigram.Codec(model)
    ids = codec.encode("a\x00\x00 b").tolist()
    assert ids.count(model.unknown_id) == 1  # a run is one piece
    assert codec.decode(ids) == "a" + unigram.UNKNOWN_SURFACE + " b"


def test_op5_round_trips_whole_tables(spark):
    out = op5_sentencepiece(spark, SF_SMALL).collect()
    assert len(out) == 200 and all(r.round_trip and r.n_pieces == len(r.ids) for r in out)


def test_op5_edge_cases(clashing, nothing):
    rows = unigram.encoded_and_decoded(clashing, model_path()).collect()
    assert len(rows) == len(edge_rows())
    texts = {r[0]: r[1] or "" for r in edge_rows()}
    assert all(r.round_trip == ("▁" not in texts[r.doc_id]) for r in rows)  # a marker in a text decodes to a space
    assert all(r.ids == [] for r in rows if texts[r.doc_id] == "")
    assert unigram.encoded_and_decoded(nothing, model_path()).collect() == []
