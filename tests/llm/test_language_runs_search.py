"""Language identification, periodic runs and ranked search: against plain versions, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import language_id as L
from llm import ranked_search as R
from llm.periodic_runs import find_runs, periodic_runs
from llm.queries import QUERIES
from llm.textcodes import mix

from llm_cases import SF_SMALL, awkward, empty, make_docs  # noqa: F401  fixtures


# -- periodic runs ----------------------------------------------------------------

def plain_runs(ws, exponent=4, least=6):
    found = {}
    for q in range(1, len(ws) // exponent + 1):
        i = 0
        while i + q < len(ws):
            s = i
            while i + q < len(ws) and ws[i] == ws[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, exponent * q):
                found.setdefault((s, i + q - s), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 5)])
def test_runs_equal_the_plain_version(exponent, least):
    r = random.Random(exponent)
    docs = []
    for _ in range(300):
        n, kinds = r.randrange(130), r.choice([1, 2, 3, 8])
        w = [r.randrange(kinds) for _ in range(n)]
        if n and r.random() < .6:
            a = r.randrange(n)
            p = r.randrange(1, max(2, (n - a) // 2 + 1))
            w[a:] = [w[a + (i - a) % p] for i in range(a, n)]
        docs.append(w)
    codes = mix(np.array([x for d in docs for x in d], dtype=np.uint64) + np.uint64(7))
    got = [[] for _ in docs]
    for d, *run in zip(*find_runs(codes, np.cumsum([0] + [len(d) for d in docs]), exponent, least)):
        got[d].append(tuple(map(int, run)))
    assert got == [plain_runs(d, exponent, least) for d in docs]


def test_runs_of_a_very_long_text():
    codes = mix(np.tile(np.arange(1000, dtype=np.uint64), 200))
    codes[150_000] = 1
    got = [tuple(map(int, x)) for x in zip(*find_runs(codes, np.array([0, len(codes)])))]
    assert got == [(0, 0, 150_000, 1000), (0, 150_001, 49_999, 1000)]
    same = np.full(100_000, codes[0])
    assert [tuple(map(int, x)) for x in zip(*find_runs(same, np.array([0, 100_000])))] == [(0, 0, 100_000, 1)]


def test_periodic_runs_awkward(awkward, empty, make_docs):
    docs = awkward.withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit(1))
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count() and rows[0].size == "clash"
    assert all(r.runs == [] for r in rows)
    assert all((r.collapsed is None) == (r.text is None) for r in rows)
    assert all(r.n_words == len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in rows)
    assert periodic_runs(empty).count() == 0
    got = periodic_runs(make_docs([(1, " a b  a b\ta b a b\n c c c c c c d", None, None, None)])).first()
    assert [tuple(x) for x in got.runs] == [(0, 8, 2), (8, 6, 1)] and got.collapsed == "a b c d"


def test_registered_runs_equal_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == docs.count()
    with_runs = 0
    for d in docs.collect():
        ws = re.findall("[^\x20\x09-\x0d]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(ws)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws[a:] = [ws[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(ws)
        with_runs += bool(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        r = got[d.doc_id]
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(runs), best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(ws) if i not in gone).encode()).hexdigest()
    assert with_runs > 10


# -- ranked search ----------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, queries, k):
    held = [(d, collections.Counter(plain_terms(t))) for d, t in docs if plain_terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        scores = []
        for d, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(R.term_weight(n_docs, df[t]) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        for rank, (s, there, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, d if there else None, -s))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("block_postings,pass_terms", [(1_000_000, 1000), (60, 1000), (300, 12)])
def test_search_equals_the_plain_version(spark, make_docs, block_postings, pass_terms):
    r = random.Random(3)
    vocabulary = ["The", "of", "ändern", "你好", "x1"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choices(vocabulary, [1 / (i + 1) for i in range(65)], k=r.randrange(0, 90))) for _ in range(150)]
    docs = [(i if i % 29 else None, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[8]), (900, None), (901, " .-\n"), (902, "THE the tHe")]
    queries = [(i, " ".join(r.choices(vocabulary, k=r.randrange(1, 12)))) for i in range(12)] + [(50, None), (51, ""), (52, "nowhere"), (3, "the THE of")]
    got = R.ranked_search(make_docs([(d, t, None, None, None) for d, t in docs]).repartition(3),
                          spark.createDataFrame(queries, "item_id long, text string"), 10, block_postings, pass_terms).collect()
    assert in_order(got) == in_order(plain_search(docs, queries, 10))


def test_search_awkward(spark, awkward, empty):
    queries = spark.createDataFrame([(1, "alpha beta word5x5 Üß"), (2, None)], "item_id long, text string")
    got = R.ranked_search(awkward.withColumn("rank", F.lit("clash")), queries.withColumn("doc_id", F.lit(9))).collect()
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert in_order(got) == in_order(plain_search(rows, [(1, "alpha beta word5x5 Üß")], 50))
    assert R.ranked_search(empty, queries).count() == 0
    assert R.ranked_search(awkward, queries.limit(0)).count() == 0


def test_pair_bounds_skip_what_single_bounds_read():
    r = np.random.default_rng(5)
    n, terms = 20_000, 24
    row, term, impact = [], [], []
    for t in range(terms):  # frequent terms come in halves of the documents that hardly meet
        side = np.arange(n)[(np.arange(n) % 2) == t % 2]
        some = np.sort(r.choice(side, 4000 if t < 16 else 150, replace=False))
        row.append(some)
        term.append(np.full(len(some), t))
        impact.append(r.integers(200, 400, len(some)) if t < 16 else r.integers(2000, 4000, len(some)))
    args = (np.concatenate(row), np.concatenate(term), np.concatenate(impact))
    places = np.arange(terms)
    dense = np.zeros(n, np.int64)
    np.add.at(dense, args[0], args[2])
    want = np.lexsort((np.arange(n), -dense))[:10]
    touched = []
    for paired in (True, False):
        block = R.Block(n, *args, terms, np.arange(n))
        block.add_pairs([places], 10)
        rows, score = block.best(places, 10, paired)
        assert rows.tolist() == want.tolist() and score.tolist() == dense[want].tolist()
        assert (block.bounds(block.order(places), True) <= block.bounds(block.order(places), False)).all()
        touched.append(block.touched)
    assert touched[0] < touched[1] < len(args[0])


# -- language identification ------------------------------------------------------

def plain_symbols(text):
    out = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    return " " + out + " " if out else ""


def plain_models(rows, order):
    """Interpolated Kneser-Ney by dictionaries: bits of a text in each language."""
    models = {}
    for lang in sorted({x for x, _ in rows}):
        tables = [collections.Counter() for _ in range(order + 1)]
        for text in (plain_symbols(t) for x, t in rows if x == lang):
            padded = " " * (order - 1) + text[1:]
            for i in range(order - 1, len(padded)):
                tables[order][padded[i + 1 - order:i + 1]] += 1
        for k in range(order - 1, 0, -1):
            tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
        discount = [0.5] * (order + 1)
        for k in range(1, order + 1):
            ones, twos = (sum(v == x for v in tables[k].values()) for x in (1, 2))
            if ones and twos:
                discount[k] = ones / (ones + 2 * twos)
        models[lang] = (tables, discount)

    def p(lang, gram):
        tables, discount = models[lang]
        if not gram:
            return 1 / 4096
        k = len(gram)
        same = [(g, c) for g, c in tables[k].items() if g[:-1] == gram[:-1]]
        total = sum(c for _, c in same)
        if not total:
            return p(lang, gram[1:])
        return max(tables[k][gram] - discount[k], 0) / total + discount[k] * len(same) / total * p(lang, gram[1:])

    def bits(text):
        padded = " " * order + plain_symbols(text)[1:]
        return [sum(-math.log2(p(lang, padded[i + 1 - order:i + 1])) for i in range(order, len(padded))) for lang in sorted(models)]

    return bits


LEARNT = [("a", "Abra kadabra, abra!"), ("a", "bar  barka"), ("b", "sim sala bim"), ("b", "Simsa bims 22 bim"), ("b", ""), ("c", "löl")]
READ = ["abra", "Sim bim bara", "ö", "xyz", "bar, bar 1", "a b", "", None, "123"]


@pytest.mark.parametrize("order,cells", [(3, 10**6), (5, 10**6), (4, 30)])
def test_cross_entropies_equal_plain_kneser_ney(spark, order, cells):
    docs = spark.createDataFrame([(t, x) for x, t in LEARNT], "text string, lang string")
    model = L.fit(docs, order, cells)
    assert (model.slice_of.max() > 0) == (cells < 100)
    read = spark.createDataFrame([(i, t) for i, t in enumerate(READ)], "i int, text string")
    got = {r.i: r for r in L.cross_entropies(read, model).collect()}
    bits = plain_models(LEARNT, order)
    for i, t in enumerate(READ):
        if plain_symbols(t):
            assert got[i]._bits == pytest.approx(bits(t), rel=1e-4)
            assert got[i]._symbols == len(plain_symbols(t)) - 1
        else:
            assert got[i]._letters == 0


def test_language_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_language_id"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out and langs[r.doc_id]]
    assert sum(held) >= 0.97 * len(held) > 20


def test_foreign_texts_are_rejected(spark):
    r = random.Random(1)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10**6 + i, " ".join("".join(r.choices("qxzjkwvyпщыю", k=7)) for _ in range(60)), None) for i in range(20)]
    got = L.identify_language(docs.unionByName(spark.createDataFrame(odd, docs.schema))).collect()
    assert all(x.rejected for x in got if x.doc_id >= 10**6)
    assert sum(x.rejected for x in got if x.doc_id < 10**6) <= 0.1 * len(got)


def test_language_awkward(spark, awkward, empty):
    docs = awkward.withColumn("entropy", F.lit("clash")).withColumn("_bits", F.lit("clash")).withColumn("Text_", F.lit(2))
    rows = L.identify_language(docs).collect()
    assert len(rows) == docs.count() and rows[0]["size"] == "clash" and rows[0]["_bits"] == "clash"
    learnt = {"en", "de"}
    for r in rows:
        assert r.lang_pred == "und" if not re.search(r"[^\W\d_]", r.text or "") else r.lang_pred in learnt
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or (r.score == 0 and r.rejected and r.entropy is None))
    assert {x.lang_pred for x in rows if x.doc_id == 3} == {"en"}
    assert L.identify_language(empty).count() == 0
    none = L.identify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows) and {r.lang_pred for r in none} == {"und"}
