"""What the pipeline's stages remove, beside brute force and columns of clashing names."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm.ngram_join import ngram_components
from orderloom.llm.scratch import Scratch, collected


def prose(seed, n):
    random = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in random.integers(0, 4000, n))


A, B, C, D = (prose(seed, 90) for seed in (1, 2, 3, 4))
ROWS = [
    (1, A), (2, A), (2, A), (None, A), (3, A + " tail"), (4, B), (5, "few words"), (6, None), (7, ""),
    (8, B + " tail"), (9, C), (9, D), (None, D + " tail"), (10, " ".join(["again"] * 60)), (11, C),
]
CLASHING = ("_sha", "_kept_id", "_kept_sha", "_mix", "mix", "_row", "_near_doc", "_near_mark", "_near_key", "c", "token")


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in ROWS],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_by_hand(rows):
    """One row of each component, by all pairs: the smallest doc_id, then the text's mark."""
    sets = [shingles((t or "").lower()) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    groups = {}
    for i, (row, s) in enumerate(zip(rows, sets)):
        groups.setdefault(label[i] if s else -1 - i, []).append(row)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def test_stages_against_brute_force(spark, docs, sf_dir):
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir).cache()
    good = [r for r in ROWS if r[1] and len(r[1].split()) >= 50 and r[0] != 10]
    assert texts(kept) == sorted(good, key=str)
    exact = corpus_pipeline.exact_stage(spark, kept, sf_dir).cache()
    by_text = {}
    for i, t in good:
        by_text.setdefault(t, set()).add(i)
    largest = [(max((i for i in ids if i is not None), default=None), t) for t, ids in by_text.items()]
    assert texts(exact) == sorted(largest, key=str)
    near = corpus_pipeline.near_stage(spark, exact, sf_dir).cache()
    assert texts(near) == sorted(near_by_hand(largest), key=str)
    for frame in (kept, exact, near):
        assert frame.columns == docs.columns
        for name in CLASHING:
            assert {r[0] for r in frame.select(name).distinct().collect()} == {f"own {name}"}


def test_run_leaves_its_result_alone(spark, sf_dir):
    import os

    roots = []
    made = Scratch.__init__

    def noted(self, *args):
        made(self, *args)
        roots.append(self)

    Scratch.__init__ = noted
    try:
        result = corpus_pipeline.run(spark, sf_dir)
    finally:
        Scratch.__init__ = made
    assert result.count() > 0
    left = [os.path.join(s.root, d) for s in roots if os.path.isdir(s.root) for d in os.listdir(s.root)]
    assert len(left) == 1 and left[0].endswith("packing")


def test_collected_folders_nest(spark):
    with collected() as outer:
        a = Scratch(spark, "a")
        with collected() as inner:
            b = Scratch(spark, "b")
        c = Scratch(spark, "c")
    Scratch(spark, "d")
    assert (outer, inner) == ([a, c], [b])


def test_texts_that_share_half_make_no_pairs(spark, monkeypatch):
    """2,000 texts share a passage, and 20 of them have a near copy."""
    import orderloom.llm.ngram_join as join

    passage = prose(0, 100)
    own = [f"{passage} {prose(1000 + i, 100)}" for i in range(2000)]
    rows = [*enumerate(own), *[(5000 + i, own[i] + " tail") for i in range(20)]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    met = []
    store = join.Scratch.store

    def noted(self, name, table):
        stored = store(self, name, table)
        if name == "met":
            met.append(stored.count())
        return stored

    monkeypatch.setattr(join.Scratch, "store", noted)
    got = {r.doc_id: r.component_id for r in ngram_components(frame).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert 0 < sum(met) < 200


def test_family_in_many_blocks_against_all_pairs(spark, monkeypatch):
    """Noisy copies of one text, of which many link only through others, and short blocks."""
    import random

    import orderloom.llm.ngram_join as join

    monkeypatch.setattr(join, "BLOCK", 2_000)
    draw, base = random.Random(5), prose(7, 120).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randrange(6)):
            words[draw.randrange(len(words))] = f"w{i}x{draw.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, prose(300 + i, 60)) for i in range(30)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    want = {i: i for i, _ in rows}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 100 * len(a & b) >= 80 * len(a | b) and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = {k: low if v == high else v for k, v in want.items()}
    steps = []
    store = join.Scratch.store
    monkeypatch.setattr(join.Scratch, "store", lambda self, name, t: steps.append(name) or store(self, name, t))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_components(frame).collect()} == want
    assert len({want[i] for i in range(150)}) > 1 and "live" in steps


def test_sha_names_the_text(spark, sf_dir):
    frame = spark.createDataFrame([(1, "x"), (None, "x"), (None, "y")], "doc_id long, text string")
    assert texts(corpus_pipeline.exact_stage(spark, frame, sf_dir)) == [(1, "x"), (None, "y")]
    assert hashlib.sha256(b"x").hexdigest()[:4] == "2d71"
