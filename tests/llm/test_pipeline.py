from __future__ import annotations

from collections import Counter

import corpus_pipeline
import sentencepiece  # noqa: F401
from conftest import SF_SMALL

from tickwatch.llm import mixing, quality, secret_scan, unigram
from tickwatch.llm.common import stored
from tickwatch.llm.piece_model import read_model, read_model_file
from tickwatch.llm.queries import model_path

from .test_documents import WORD, near_components


def test_stages_equal_brute_force(spark):
    """Every stage on its own input: what it drops, changes, repeats and encodes."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    codec = unigram.Codec(read_model(read_model_file(model_path())))
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        after = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            kept = {r.doc_id for r in quality.quality_table(spark.createDataFrame(before)).where("kept").collect()}
            assert sorted(after) == sorted(r for r in before if r.doc_id in kept) and 0 < len(after) < len(before)
        elif name == "near_dedup":
            label = near_components({r.doc_id: r.text for r in before})
            assert sorted(after) == sorted(r for r in before if label[r.doc_id] == r.doc_id) and len(after) < len(before)
        elif name == "secret_scans":
            want = [(r.doc_id, t := secret_scan.redact_text(r.text), r.lang, r.source, len(t)) for r in before]
            assert sorted(map(tuple, after)) == sorted(want) and any("[SECRET]" in r.text for r in after)
        elif name == "source_mix":
            words = Counter()
            for r in after:
                words[r.source] += len(WORD.findall(r.text))
            plan = mixing.mix(spark.createDataFrame(before)).collect()
            assert words == {r.source: int(r.target + 0.5) for r in plan}
            assert {r.text for r in after if r.text not in {b.text for b in before}} <= {
                " ".join(WORD.findall(b.text)[:n]) for b in before for n in range(len(WORD.findall(b.text)))}
        else:
            assert Counter((r.doc_id, tuple(r.ids)) for r in after) == Counter(
                (r.doc_id, tuple(codec.encode(r.text).tolist())) for r in before)
            assert all(r.round_trip for r in after)


def test_registered_and_runs(spark):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    assert entry.queries()["pipeline"](spark, SF_SMALL).count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
