"""How much work and memory operators take on the way to their results."""

import tracemalloc

import numpy as np
import pyarrow as pa

from llm import language_id
from llm.nearest import BlockIndex


def test_few_candidates_need_an_exact_cosine(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((3000, 32))
    vectors[7] = vectors[8]
    index = BlockIndex(np.arange(3000), vectors)
    exact = []
    real = BlockIndex.cosines
    monkeypatch.setattr(BlockIndex, "cosines", lambda self, at, query: exact.append(len(at)) or real(self, at, query))
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for q in range(0, 3000, 100):
        found, scores = index.nearest(q, vectors[q], 5)
        cosines = unit @ unit[q]
        cosines[q] = -2
        hits += len(set(np.argsort(-cosines)[:5]) & set(found.tolist()))
        assert np.array_equal(scores, real(index, found, vectors[q])) and (np.diff(scores) <= 0).all()
    assert hits >= 0.9 * 5 * 30
    assert sum(exact) < 0.1 * 30 * 3000   # before: most of the vectors


def test_vectors_beyond_single_precision_are_all_verified():
    vectors = np.array([[1e200, 0.0], [1e200, 1.0], [1.0, 0.0], [0.0, 1.0], [1.0, 1.0]])
    with np.errstate(all="ignore"):
        found, _ = BlockIndex(np.arange(5), vectors).nearest(4, vectors[4], 4)
    assert sorted(found.tolist()) == [0, 1, 2, 3]


def test_only_a_slices_texts_are_held(monkeypatch):
    monkeypatch.setattr(language_id, "SLICE_CHARS", 20_000)
    texts = pa.array([None, "", *(f"{i} abc " * 1500 for i in range(2000)), "é漢" * 30_000, None])
    list(language_id.text_slices(texts.slice(0, 5)))  # what is kept for good
    tracemalloc.start()
    rows = 0
    for first, end, s in language_id.text_slices(texts):
        assert first == rows and len(s.letters) == end - first
        rows = end
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts)
    assert peak < 8_000_000   # before: 20 MB and more, all texts of the batch


def test_counts_of_shorter_grams_take_two_shuffles(spark):
    rng = np.random.default_rng(5)
    rows = {(lang, int(g)) for lang in "ab" for g in rng.integers(0, 4, (400, 5)) @ (1 << (12 * np.arange(5)))}
    grams = spark.createDataFrame([(lang, g, 1 + i % 3) for i, (lang, g) in enumerate(sorted(rows))], language_id.GRAMS)
    got = language_id.kneser_ney_counts(grams)
    want = {(5, lang, g): 1 + i % 3 for i, (lang, g) in enumerate(sorted(rows))}
    longer = rows
    for size in range(4, 0, -1):
        shorter: dict = {}
        for lang, g in longer:
            key = (lang, g & ((1 << (12 * size)) - 1))
            shorter[key] = shorter.get(key, 0) + 1
        want.update({(size, *k): n for k, n in shorter.items()})
        longer = set(shorter)
    assert {(r["size"], r["lang"], r["gram"]): r["n"] for r in got.collect()} == want and got.count() == len(want)
    got = language_id.kneser_ney_counts(grams)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2   # before: ten
