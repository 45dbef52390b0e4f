from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from tickwatch.llm import mixing, neardup, quality, simhash, toxicity
from tickwatch.llm.components import components
from tickwatch.llm.queries import op1_fingerprints, op4_quality_rules, op7_minhash_neardup, op9_toxicity

from .conftest import edge_rows, text_of

SF_LARGE = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, sf=SF_SMALL):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


# ---- fingerprints ---------------------------------------------------------------


def edited(texts: list[str]) -> list[str]:
    out = []
    for i, t in enumerate(texts):
        q = len(t) // 4
        out.append(t[:len(t) - q] + texts[(i + 1) % len(texts)][:q])
    return out


@pytest.mark.parametrize("range_rows", [512, 4])
def test_op1_equals_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(simhash, "RANGE_ROWS", range_rows)
    texts = documents(spark)
    ids = sorted(texts)
    rows = sorted(op1_fingerprints(spark, SF_SMALL).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == ids
    fps = [int(r.fingerprint, 16) for r in rows]
    for i, (r, e) in enumerate(zip(rows, edited([texts[i] for i in ids]))):
        assert (r.n_chars, r.edited_sha256) == (len(texts[ids[i]]), hashlib.sha256(e.encode()).hexdigest())
        assert r.near_next == 1 - (fps[i] ^ fps[(i + 1) % len(fps)]).bit_count() / 64
        assert r.near_edited == 1 - (fps[i] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        near = sum((fps[i] ^ f).bit_count() <= 3 for f in fps) - 1 if r.doc_id % 20 == 0 else None
        assert r.n_near == near
    by_text = {}
    assert all(by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint for r in rows)


def test_edited_texts_are_nearer_than_others(spark):
    rows = op1_fingerprints(spark, SF_MID).where("n_chars > 1500").collect()
    assert sum(r.near_edited > r.near_next for r in rows) > 0.97 * len(rows)


@pytest.mark.parametrize("radius, blocks, group", [(3, 5, 4096), (2, 4, 4096), (3, 6, 2), (0, 1, 3)])
def test_permuted_tables_find_all(spark, monkeypatch, radius, blocks, group):
    import random

    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(radius)
    centers = [rng.getrandbits(64) for _ in range(6)]
    fps = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centers for _ in range(25)]
    fps += fps[:10]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed] + [(None,)], "fingerprint bigint")
    got = {r.fingerprint: r.n_within for r in simhash.count_within(rows.limit(60), rows, radius, blocks).collect()}
    for f in got:
        assert got[f] == sum(((f ^ g) & ((1 << 64) - 1)).bit_count() <= radius for g in fps)
    assert len(got) == len(set(signed[:60]))


def test_op1_edge_cases(clashing, nothing, spark):
    rows = simhash.fingerprint_table(clashing).collect()
    assert len(rows) == len(edge_rows())
    order = sorted(edge_rows(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = Counter((r[0], hashlib.sha256(e.encode()).hexdigest()) for r, e in zip(order, edited([r[1] or "" for r in order])))
    # after the last row (a null id) comes the first, which only rows with an id carry over
    assert Counter((r.doc_id, r.edited_sha256) for r in rows) == want
    assert simhash.fingerprint_table(nothing).collect() == []
    one = simhash.fingerprint_table(spark.createDataFrame([(7, "abcdefgh")], "doc_id bigint, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


# ---- quality --------------------------------------------------------------------


def measured(text: str):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_op4_measures_equal_brute_force(spark):
    texts = documents(spark, SF_MID)
    rows = op4_quality_rules(spark, SF_MID).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    right = total = 0
    for r in rows:
        m = measured(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.kept and r.base_failed)
        if r.doc_id in labels and not r.base_failed:
            total += 1
            right += r.kept == bool(labels[r.doc_id])
    assert right > 0.97 * total  # the labels were not used


def test_lines_are_those_with_a_word(spark):
    """Repeated one-word lines count; lines of spaces, tabs or carriage returns alone do not."""
    texts = ["Menu\nhello\nMenu\nhello\nx90\n2\n2\n\\\n\\", "one line\n \n \n\t\n\t\nother line", "a b\r\n\r\n\r\n\r\nc d\r\n\r\n",
             "\x0b\n\x0b\n\x0c\n\x0c", "hello\r\nhello\r\n\r\n", "\x1f\n\x1f\n\xa0\n\xa0\n\x1c"]
    lines = [[x for x in t.split("\n") if WORD.search(x)] for t in texts]
    out = quality.measures(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).collect()
    assert {r.id: (r.n_lines, r.n_dup_lines) for r in out} == {i: (len(x), len(x) - len(set(x))) for i, x in enumerate(lines)}
    assert {r.id: r.n_dup_lines for r in out} == {i: measured(t)[3] for i, t in enumerate(texts)}


def test_windows_that_share_a_hash_are_compared_by_words(spark, monkeypatch):
    """With a hash that separates nothing, the words decide."""
    real = quality.F.expr
    monkeypatch.setattr(quality.F, "expr", lambda e: real(re.sub(r"xxhash64\([^)]*\)", "5L", e)))
    texts = [text_of(1, 90), "a b c x y z a b c d e f g x y z", "a a a a a", "one two", ""]
    out = quality.measures(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).collect()
    assert {r.id: r.n_repeat_words for r in out} == {i: measured(t)[4] for i, t in enumerate(texts)}


def test_expectation_maximisation_recovers_rates():
    import random

    rng, patterns = random.Random(1), Counter()
    for _ in range(20000):
        good = rng.random() < 0.7
        patterns["".join(rng.choices("+0-", (0.85, 0.1, 0.05) if good else (0.1, 0.3, 0.6))[0] for _ in quality.RULES)] += 1
    model = quality.fit(patterns)
    assert abs(model.good_share - 0.7) < 0.03
    assert all(abs(g["+"] - 0.85) < 0.05 for g in model.on_good) and all(abs(b["-"] - 0.6) < 0.06 for b in model.on_bad)
    assert quality.fit({}).good_share == 0.8


def test_op4_edge_cases(clashing, nothing, edge):
    rows = quality.quality_table(clashing).collect()
    want = Counter((r[0], *measured(r[1] or "")) for r in edge_rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert quality.quality_table(nothing).collect() == [] and quality.kept_documents(nothing).collect() == []
    kept = Counter(map(str, quality.kept_documents(edge).collect()))
    assert kept and not kept - Counter(map(str, edge.collect()))
    assert quality.kept_documents(clashing).columns == clashing.columns


# ---- near copies ------------------------------------------------------------------


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingle_set(text: str) -> frozenset:
    words = WORD.findall(ascii_lower(text))
    return frozenset(zip(*(words[i:] for i in range(4)))) if len(words) >= 4 else frozenset([tuple(words)] if words else [])


def near_components(texts: dict[int, str]) -> dict[int, int]:
    sets = {i: shingle_set(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    holders: dict = {}
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders.get(s, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    return {i: find(i) for i in texts}


def test_op7_equals_brute_force(spark):
    texts = documents(spark, SF_MID)
    want = near_components(texts)
    rows = op7_minhash_neardup(spark, SF_MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(shingle_set(texts[r.doc_id])), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_chains_and_dense_groups_of_near_copies(spark):
    """A chain whose ends are unlike, many near copies of one text, and unlike texts with one passage."""
    words = text_of(9, 120).split()
    texts, at = {}, 0
    for step in range(25):
        texts[at] = " ".join(words)
        at += 1
        words[step * 4] = f"new{step}"
    for i in range(150):
        w = text_of(10, 150).split()
        w[i % 150] = f"edit{i}"
        texts[at] = " ".join(w)
        at += 1
    passage = text_of(11, 40)
    for i in range(60):
        texts[at] = text_of(100 + i, 60) + " " + passage
        at += 1
    want = near_components(texts)
    got = {r.doc_id: r.component_id for r in neardup.near_groups(
        spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert got == want


def test_op7_edge_cases(clashing, nothing):
    rows = neardup.near_groups(clashing).collect()
    assert len(rows) == len(edge_rows())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].component_id == 0 == by_id[2].component_id and by_id[15].component_id == 14
    for blank in (3, 4, 5):
        assert (by_id[blank].n_shingles, by_id[blank].component_id, by_id[blank].kept) == (0, blank, True)
    assert by_id[6].n_shingles == by_id[8].n_shingles == 1 and by_id[None].component_id is None and by_id[None].kept
    assert neardup.near_groups(nothing).collect() == []


def test_components_of_random_graphs(spark):
    import random

    rng = random.Random(4)
    links = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)]
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(300):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: m for n, m in label.items() if n != m}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# ---- mixing -------------------------------------------------------------------------


def shares(sizes: list[int], weights=(5, 2, 1), share=1.5, cap=2.0) -> list[float]:
    """Reshare what is above a cap among the others, again and again."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    target, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(w[i] for i in open_)
        over = [i for i in open_ if rest * w[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                target[i] = rest * w[i] / total
            break
        for i in over:
            target[i] = cap * sizes[i]
            rest -= target[i]
            open_.discard(i)
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 1, 1], [5], [0, 0], [0, 7, 3000, 20, 1, 1, 900], [10] * 9])
def test_targets_equal_resharing(spark, sizes):
    rows = [(None if i == len(sizes) - 1 else f"s{i:02d}", n) for i, n in enumerate(sizes)]
    out = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint"), (5, 2, 1), 1.5, 2.0).collect()
    got = {r.source: r.target for r in out}
    assert [got[s] for s, _ in rows] == pytest.approx(shares(sizes))


def test_op8_budgets_are_exact(edge, clashing, nothing):
    for table in (edge, clashing):
        rows = mixing.mix(table).collect()
        assert len(rows) == len(edge_rows())
        for source in {r.source for r in rows}:
            own = [r for r in rows if r.source == source]
            assert sum(r["size"] for r in own) == own[0].source_size
            assert sum(r.taken for r in own) == int(own[0].target + 0.5)
        assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert sorted(map(str, mixing.mix(edge).collect())) == sorted(map(str, mixing.mix(edge.repartition(7)).collect()))
    assert mixing.mix(nothing).collect() == [] and mixing.mixed_documents(nothing).collect() == []


def test_mixed_documents_hold_what_is_taken(edge, clashing):
    for table in (edge, clashing):
        mixed = mixing.mixed_documents(table)
        assert mixed.columns == table.columns
        words = Counter()
        for r in mixed.collect():
            words[r.source] += len(WORD.findall(r.text))
            assert r.n_chars == len(r.text)
        want = {r.source: int(r.target + 0.5) for r in mixing.mix(edge).collect()}
        assert words == {s: n for s, n in want.items() if n}


def test_range_bounds_are_one_literal(spark):
    """The list of bounds must not be evaluated for every row: no split is left in the optimized plan."""
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    placed = simhash.in_ranges(rows, "doc_id")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "lambdafunction(cast" not in plan
    got = placed.where("NOT carried").groupBy("range").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("range").collect()
    assert len(got) >= 5 and all(a.hi < b.lo for a, b in zip(got, got[1:]))


# ---- toxicity -----------------------------------------------------------------------


def test_op9_is_accurate_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = op9_toxicity(spark, SF_MID)
    assert rows.count() == 1000
    held = rows.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in held) > 0.9 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in held)


def test_nearest_equals_all_cosines():
    import random

    import numpy as np

    rng = random.Random(6)
    draw = lambda: sorted({rng.randrange(40) for _ in range(rng.randint(1, 6))})
    examples = [(i, t := draw(), [rng.randint(1, 4) for _ in t], rng.randint(0, 1)) for i in range(700)]
    index = toxicity.Index(np.array([1 + rng.random() for _ in range(40)]), examples)
    dense = np.zeros((len(index.entries), 40))
    for i, e in enumerate(index.entries):
        t, w = index.weigh(e)
        dense[i, t] = w
    for _ in range(200):
        t = draw()
        entry = tuple(zip(t, [rng.randint(1, 4) for _ in t]))
        q = np.zeros(40)
        q[index.weigh(entry)[0]] = index.weigh(entry)[1]
        cosines = dense @ q
        got = index.nearest(entry)
        want = sorted(-cosines[cosines > 0])[:toxicity.NEIGHBOURS]
        assert [-s for s, _ in got] == pytest.approx(want)
        assert all(cosines[i] == pytest.approx(s) for s, i in got)


def test_op9_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: {r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()}
    assert score(labels) == score(turned)


def test_texts_are_compared_over_all_terms(spark):
    """A text without telling terms meets its own copy among the examples; unlike texts do not have cosine 1."""
    rows = [(i, text_of(200 + i, 40) + f" only{chr(97 + i % 26)}{chr(97 + i // 26)}x", 0) for i in range(0, 80)]
    rows = [(i, t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    rows[5] = (rows[5][0], "quaint zephyr gambol", 1)
    free = [i for i in range(1000, 1010) if zlib.crc32(str(i).encode()) % 4 == 2][0]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(free, "gambol zephyr quaint"), (free + 4000, "zephyr, newer words")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert [(e.id, e.cosine, e.label) for e in out[free].evidence] == [(rows[5][0], 1.0, 1)]
    assert [e.id for e in out[free + 4000].evidence] == [rows[5][0]] and 0 < out[free + 4000].evidence[0].cosine < 0.5
    assert out[free].score > max(out[i].score for i, _, y in rows if not y)


def test_op9_edge_cases(clashing, nothing, spark):
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, None), (None, 1), (99, 0)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(clashing, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    none = labels.limit(0)
    assert all(r.predicted == 0 for r in toxicity.toxicity(clashing, none).collect())
    assert toxicity.toxicity(nothing, labels).collect() == []


def test_blocks_that_cannot_hold_a_nearer_example_are_skipped():
    """Examples in well-parted groups: a search scores the blocks of its own group only, and finds all cosines."""
    import numpy as np

    size = toxicity.BLOCK
    examples = [(i, [10 * (i // size) + j for j in range(4)], [1 + i % size // 32, 1 + i % 32, 1, 2], i % 2) for i in range(10 * size)]
    index = toxicity.Index(np.ones(100), examples)
    assert index.blocks == 10
    got = index.nearest(((30, 2), (31, 3), (32, 1)))
    assert index.scored == 1 and len(got) == toxicity.NEIGHBOURS


def test_op9_score_and_evidence_equal_all_cosines(spark):
    """The query's evidence over all terms against cosines worked out plainly, on all rows of a small table."""
    import math
    from collections import Counter

    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.where("toxic IS NOT NULL").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    counts = {i: toxicity.term_counts(t) for i, t in texts.items()}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in df.items()}
    held = {t for i in known for t in counts.get(i, ())}
    rare = math.log(1 + len(texts)) + 1

    def vector(c):
        w = {t: (1 + math.log(n)) * (idf[t] if t in held else rare) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    examples = {i: vector(counts[i]) for i in known if counts.get(i)}
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(texts)
    for r in out:
        q = vector(counts[r.doc_id]) if counts[r.doc_id] else {}
        best = sorted((-sum(x * e.get(t, 0.0) for t, x in q.items()) for e in examples.values()))[:1]
        if r.evidence:
            assert r.evidence[0].cosine == pytest.approx(-best[0], abs=2e-6)
            assert all(e.label == known[e.id] for e in r.evidence)
        else:
            assert not best or best[0] > -1e-12


def test_op9_finds_toxic_rows_that_were_held_out(spark):
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    held = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    toxic = [r for r in held if r.toxic]
    found = sum(r.predicted for r in toxic)
    wrong = sum(r.predicted for r in held if not r.toxic)
    assert len(toxic) >= 50 and found >= 0.7 * len(toxic)
    assert wrong <= 0.1 * (len(held) - len(toxic))
