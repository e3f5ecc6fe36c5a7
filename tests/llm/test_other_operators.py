"""Neighbours, surrogates, URL rules, the quality classifier and the pipeline."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import queries as Q
from llm.nearest import nearest_vectors
from llm.quality import fit_attention, passages, score_documents, train
from llm.surrogates import KINDS, SYLLABLES, collisions, replace_entities, surrogate
from llm.url_filters import rules_frame, url_verdicts

from llm.mixing import mix_sources

from test_text_operators import check_packed, encode_ids, plain_groups
from llm_cases import SF_SMALL, awkward, empty, make_docs  # noqa: F401  fixtures


# -- neighbours -------------------------------------------------------------------

def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    data = sorted((r.vec_id, r.embedding) for r in df.collect())
    ids, x = np.array([d[0] for d in data]), np.array([d[1] for d in data], dtype=float)
    norm = np.sqrt((x * x).sum(axis=1))
    hit = total = 0
    got = nearest_vectors(df).toPandas()
    assert set(got.query_id) == {i for i in ids if i % 50 == 0}
    for q, g in got.groupby("query_id"):
        i = int(np.searchsorted(ids, q))
        cos = (x * x[i]).sum(axis=1) / (norm * norm[i])
        cos[i] = -2
        best = np.lexsort((ids, -cos))[:5]
        hit, total = hit + len(set(ids[best]) & set(g.vec_id)), total + 5
        assert list(g.sort_values("rank")["rank"]) == [1, 2, 3, 4, 5]
        for v, s in zip(g.vec_id, g.score):
            assert s == pytest.approx(cos[np.searchsorted(ids, v)], abs=1e-14)
    assert hit / total >= 0.9


def test_neighbours_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (100, [0.0, 0.0]), (150, None), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]),
            (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 1.0]), (None, [1.0, 0.0]), (350, [1.0, 2.0, 3.0])]
    rows += [(i, [1.0, 0.0]) for i in range(1001, 1041)]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<double>, label int, score string")
    got = {}
    for r in nearest_vectors(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    assert [v for v, _ in got[0]] == [1, 2, 3, 1001, 1002] and {s for _, s in got[0]} == {1.0}
    assert got[50][0] == (4, round(0.5 ** 0.5, 6)) and [v for v, _ in got[50][1:]] == [0, 1, 2, 3]
    assert 350 not in got and set(got) == {0, 50, 1050} - {1050}
    assert nearest_vectors(df.limit(0)).count() == 0


# -- surrogates -------------------------------------------------------------------

def test_surrogates(spark, awkward, empty):
    text = ("Mr. John Smith and Mrs. Anna Smith wrote to john.smith@mail.example.org, +1 (017) 555-7713, card 4111 1111 1111 1111, "
            "192.168.7.1, SSN 123-45-6789, key 9b0b3c6a43eb78aa99cbd7049c572391524f37a8. Госпожа Анна Каренина.")
    df = spark.createDataFrame([(1, text), (2, "john.smith@mail.example.org again, Mr. Smith"), (3, None), (4, ""), (5, "nothing 12 here")],
                               "doc_id long, text string")
    out = {r.doc_id: r for r in replace_entities(df, "k").collect()}
    new = out[1].text
    for value in ("John", "Smith", "Anna", "john.smith@mail.example.org", "555-7713", "4111 1111 1111 1111", "192.168.7.1", "123-45-6789",
                  "9b0b3c6a43eb78aa99cbd7049c572391524f37a8", "Каренина"):
        assert value not in new
    m = re.fullmatch(r"Mr\. (\w+n) (\w+r) and Mrs\. (\w+na) (\w+r) wrote to ([a-z]+\.[a-z]+@[a-z]+\.[a-z]+\.org), (\+1 \(\d{3}\) \d{3}-\d{4}), "
                     r"card (\d{4} \d{4} \d{4} \d{4}), ([\d.]+), SSN (\d{3}-\d{2}-\d{4}), key ([0-9a-f]{40})\. Госпожа ([А-Я][а-я]+на) ([А-Я][а-я]+р)\.", new)
    assert m and m[2] == m[4]  # coreference of the family name
    assert out[2].text == f"{m[5]} again, Mr. {m[2]}"  # the same across documents
    digits = [int(c) for c in m[7].replace(" ", "")]
    assert sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    assert (out[3].text, out[3].n_entities, out[4].text, out[5].text) == (None, 0, "", "nothing 12 here")
    assert replace_entities(df, "other").where("doc_id = 1").first().text != new
    assert replace_entities(awkward, "k").count() == awkward.count() and replace_entities(empty, "k").count() == 0


def test_surrogates_stay_distinct(spark):
    # 26 one-letter addresses: first draws collide, and results may not be another's value
    values = [f"{c}@a.co" for c in "abcdefghijklmnopqrstuvwxyz"]
    entities = spark.createDataFrame([("email", v) for v in values], "kind string, value string")
    assert collisions(entities, "k").count() > 0
    df = spark.createDataFrame([(i, f"to {v} now") for i, v in enumerate(values)], "doc_id long, text string")
    got = [r.text for r in replace_entities(df, "k").collect()]
    found = [re.search(KINDS["email"].replace("++", "+"), t)[0] for t in got]
    assert len(set(found)) == 26 and not set(found) & set(values)


def test_names_outgrow_any_corpus(spark, monkeypatch):
    # two syllables: 8 names at the first draw, 16 at the second, ...
    monkeypatch.setitem(SYLLABLES, "latin", ["ba", "de"] * 8)
    entities = spark.createDataFrame([("family", f"Name{i}") for i in range(60)], "kind string, value string")
    new = {r.value: r.surrogate for r in collisions(entities, "k").collect()}
    first = {r.value: r.s for r in entities.select("value", surrogate(F.col("kind"), F.col("value"), "k", F.lit(0)).alias("s")).collect()}
    assert len({**first, **new}) == len(set({**first, **new}.values())) == 60 and max(map(len, new.values())) > 9


PHONES = ["(555) 123-4567", "555-123-4567", "1-555-123-4567", "01 23 45 67 89", "0612345678", "0171 1234567", "030/1234567", "020 7946 0958", "(030) 123 4567",
          "+33 1 23 45 67 89", "+34 912 34 56 78", "912 34 56 78", "+49 (0)171 1234567", "0033 1 23 45 67 89", "+1 (017) 555-7713"]
NAMES = ["Mr. McDonald", "Mr. O'Brien", "Mr. John F. Kennedy", "Mrs. Anne-Marie Stone", "Dr. Ada Lovelace", "Prof. Dr. J.-P. Serre", "Dra. García", "Herr von Stein",
         "Herr Dr. Müller", "Mr. John Fitzgerald Kennedy", "Ms. D’Angelo", "Mr. SMITH", "Mlle. Jeanne d'Arc"]
ADDRESSES = ["2001:db8::8a2e:370:7334", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1"]


def test_surrogates_of_each_form(spark):
    values = PHONES + NAMES + ADDRESSES
    df = spark.createDataFrame([(i, f"so <{v}>, see") for i, v in enumerate(values)], "doc_id long, text string")
    out = {r.doc_id: r for r in replace_entities(df, "k").collect()}
    for i, v in enumerate(values):
        new = re.fullmatch("so <(.*)>, see", out[i].text)[1]
        assert out[i].n_entities == 1 and new != v, v
        if v in PHONES:
            assert re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", v) and (new[0] == "0") == (v[0] == "0")
        elif v in NAMES:
            kept = {"Mr", "Mrs", "Ms", "Mlle", "Dr", "Prof", "Dra", "Herr", "von"}
            was, now = ([w for w in re.split(r"[ .]+", x) if w and w not in kept] for x in (v, new))
            assert not set(was) & set(now) and len(was) == len(now) and new.split()[0] == v.split()[0], new
        else:
            assert re.fullmatch("[0-9a-f:]+", new) and new.count(":") >= v.count(":") and new.split(":")[0] == v.split(":")[0]
    kennedy = {out[len(PHONES) + NAMES.index(n)].text.split()[-2].rstrip(">,") for n in ("Mr. John F. Kennedy", "Mr. John Fitzgerald Kennedy")}
    assert len(kennedy) == 1
    clean = ["at 12:30:45 on 2024-01-15, 01.02.2024", "a[1::2], std::add, Face::add", "Mr. T the end", "x 1990-1995, 1 234 567", "see Dr. a", "3.14159265"]
    plain = spark.createDataFrame([(i, t) for i, t in enumerate(clean)], "doc_id long, text string")
    assert [r.text for r in replace_entities(plain, "k").orderBy("doc_id").collect()] == clean


def test_registered_surrogates_leave_clean_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in Q.op5_pii_surrogates(spark, SF_SMALL).collect():
        if r.n_entities == 0:
            assert r.text == docs[r.doc_id]
        else:
            assert r.text != docs[r.doc_id]


# -- URL rules ---------------------------------------------------------------------

def test_url_rules(spark):
    urls = [None, "", "example.org/es/", "http://EXAMPLE.org/es/1", "http://a.example.org/en/1", "http://a.example.org/en/2", "http://x.org",
            "http://notexample.org/es/", "https://u.com/de/x?y#z", "https://u.com/fr/", "http://org/", "http://É.com/de/", "http://a.b.c.com?/de/",
            "http://org//x://y.com/de/", "http://example.org/en/1", "http://example.org/en/1", "http://.org/", "://com/de/"]
    df = spark.createDataFrame([(i, u, "<p>", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, _key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(df, rules_frame(spark)).collect()}
    assert len(got) == len(urls)
    none = (None, "allow")
    assert got[0] == got[1] == got[2] == ("", "", *none)
    assert got[3] == ("example.org", "/es/1", "example.org/es/", "block") and got[4] == ("a.example.org", "/en/1", "example.org/en/1", "block")
    assert got[5][2:] == ("org/", "allow") and got[6] == ("x.org", "", *none) and got[7][2:] == ("org/", "allow")
    assert got[8] == ("u.com", "/de/x", "com/de/", "block") and got[9][2:] == ("com/fr/", "allow") and got[10][2:] == ("org/", "allow")
    assert got[11] == ("É.com", "/de/", "com/de/", "block") and got[12] == ("a.b.c.com", "", *none) and got[13][0] == "org"
    assert got[14] == got[15] and got[16][2:] == ("org/", "allow") and got[17][2:] == ("com/de/", "block")
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841  read by the SQL
    con.register("pages", pages)
    assert {tuple(r) for r in con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({Q.URL_SQL})").fetchall()} == {(k, *v) for k, v in got.items()}
    both = spark.createDataFrame([("com", "/a", "allow"), ("com", "/a", "block"), (None, "/a", "block"), ("net", None, "block")],
                                 "host string, path string, verdict string")
    some = spark.createDataFrame([(1, "http://x.com/a"), (2, "http://x.net")], "page_id long, url string")
    assert sorted((r.page_id, r.rule, r.verdict) for r in url_verdicts(some, both).collect()) == [(1, "com/a", "block"), (2, "net", "block")]
    assert url_verdicts(some, both.limit(0)).where("verdict = 'allow'").count() == 2 and url_verdicts(some.limit(0), both).count() == 0


# -- quality -----------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = Q.op10_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 0, 0), (None, 1, 0), (8, None, 0), (9, 0, 1), (10, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = score_documents(awkward, labels).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == awkward.count() and by[1] == by[2] and by[4] == by[5] == by[6]
    assert {r.score for r in score_documents(awkward, labels.limit(0)).collect()} == {0.5}
    assert score_documents(empty, labels).count() == 0


def test_training_takes_a_repeated_document_once(spark, make_docs):
    docs = make_docs([(i, f"words of document {i} " * 9 + "!" * (i % 2), "en", "s", 1) for i in range(12)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(12)], "doc_id long, quality int")
    hot = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(300)).drop("id"))
    for a, b in zip(train(docs, labels).params.values(), train(hot, labels).params.values()):
        assert np.array_equal(a, b)


def test_attention_finds_the_one_bad_passage():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (200 * 6, 15))
    owner, y = np.repeat(np.arange(200), 6), np.ones(200)
    for d in range(0, 200, 4):
        y[d], x[d * 6 + rng.integers(6), 3] = 0, 6
    model = fit_attention(x, owner, y)
    assert np.mean((model.scores(x, owner, 200) > 0.5) == (y > 0.5)) > 0.97


def test_passages_read_whole_texts():
    data = np.frombuffer(b"a b " * 60 + b"X!", dtype=np.uint8)
    x, owner = passages(data, np.array([0, 0, len(data)]))
    assert list(owner) == [0, 1, 1, 1] and not x[0].any() and x[-1, 13] > 0


# -- pipeline ----------------------------------------------------------------------

def test_pipeline_stages_equal_plain_versions(spark):
    """Each stage, on what the one before kept, against the operator's plain version or SQL."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]

    def step(name, docs):
        out = stages[name](spark, docs, SF_SMALL)
        assert out.columns == corpus_pipeline.COLUMNS
        rows = out.collect()
        return rows, spark.createDataFrame(rows, docs.schema)

    scores = {r.doc_id: r.predicted for r in Q.op10_quality_classifier(spark, SF_SMALL).collect()}
    before = {r.doc_id: r for r in docs.collect()}
    rows, docs = step("quality", docs)
    assert {r.doc_id for r in rows} == {d for d, p in scores.items() if p == 1} and all(r == before[r.doc_id] for r in rows)

    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841  read by the SQL
    con.register("documents", documents)
    want = dict(con.execute(f"SELECT doc_id, text FROM ({Q.LINES_SQL})").fetchall())
    rows, docs = step("line_dedup", docs)
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    groups = plain_groups([(r.doc_id, r.text) for r in rows])
    rows, docs = step("near_dedup", docs)
    assert sorted(r.doc_id for r in rows) == sorted(set(groups.values())) and all(r.text == want[r.doc_id] for r in rows)

    texts = {r.doc_id: r.text.split() for r in rows}
    taken = {r.doc_id: r.taken for r in mix_sources(docs).collect()}
    rows, docs = step("mixing", docs)
    for doc_id, n in taken.items():
        copies = sorted((r.text.split() for r in rows if r.doc_id == doc_id), key=len, reverse=True)
        whole, part = divmod(n, len(texts[doc_id])) if n else (0, 0)
        assert copies == [texts[doc_id]] * whole + ([texts[doc_id][:part]] if part else [])

    packed = stages["packing"](spark, docs, SF_SMALL).collect()
    check_packed(packed)
    ids = sum(len(encode_ids(r.text)) for r in rows)
    assert sum(r.length for r in packed) == ids
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(packed)


def test_pipeline_on_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMALL)
            rows = docs.collect()
            docs = spark.createDataFrame(rows, docs.schema)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({Q.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want))


def test_short_addresses_never_run_out(spark):
    """300 addresses of a shape that has 676 values: distinct surrogates, none of them an address of the corpus."""
    values = [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    docs = spark.createDataFrame([(i, f"write to {v} now") for i, v in enumerate(values)], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in replace_entities(docs, "k").collect()}
    got = [rows[i].removeprefix("write to ").removesuffix(" now") for i in range(len(values))]
    assert len(set(got)) == len(values) and not set(got) & set(values)
    assert all(g.endswith(".com") and g.count("@") == 1 for g in got)


def test_formats_grow_when_they_are_used_up(spark, monkeypatch):
    """Every surrogate of the values' own format counts as taken: those that grow come out distinct."""
    from llm import surrogates as S

    monkeypatch.setattr(S, "GROW_AFTER", 0)
    kinds = {"ssn": "123-45-6789", "card": "4111 1111 1111 1111", "ip": "10.0.0.1", "phone": "+49 30 1234567", "iban": "DE89370400440532013000",
             "secret": "0123456789abcdef0123456789abcdef", "email": "x@y.com"}
    rows = [(k, v, a) for k, v in kinds.items() for a in range(1, 12)]
    df = spark.createDataFrame(rows, "kind string, value string, attempt int")
    got = df.select("kind", "attempt", S.surrogate(F.col("kind"), F.col("value"), "key", F.col("attempt")).alias("s")).collect()
    assert len({(r.kind, r.s) for r in got}) == len(rows) and all(r.s for r in got)
    for k, v in kinds.items():
        assert max(len(r.s) for r in got if r.kind == k) > len(v)


def test_a_long_labelled_text_is_in_the_sample_whole(spark, make_docs, monkeypatch):
    """The one odd passage of a text of 250 is seen in training, wherever it stands."""
    from llm import quality as Q

    seen = {}
    monkeypatch.setattr(Q, "fit_attention", lambda x, owner, y: seen.update(x=x, owner=owner, y=y) or None)
    plain = " ".join(["plain words of a long text here"] * 2000)  # 14,000 words, 280 passages
    docs = make_docs([(i, plain, "en", "s", 1) for i in range(1, 6)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, quality int")
    kept = [i for i in range(1, 6) if __import__("zlib").crc32(str(i).encode()) % 5]
    Q.train(docs, labels)
    assert np.bincount(seen["owner"]).tolist() == [280] * len(kept)
    Q.train(docs, labels, max_passages=600)  # whole documents, as many as fit
    assert np.bincount(seen["owner"]).tolist() == [280] * 2
    Q.train(docs, labels, max_passages=5)
    assert np.bincount(seen["owner"]).tolist() == [280]
