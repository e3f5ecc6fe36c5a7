"""Ranked lexical search by pair-bound MaxScore.

An index of all documents is written, restricted to the terms that queries hold: per document its
number of terms and the positions (in the query vocabulary) and frequencies of its query terms. Tasks read
it in blocks of documents. A block gets, before any query is run on it, posting lists with each
term's maximum impact and, for pairs of terms that stand next to each other in some query's order
of impacts, the intersection list with the greatest joint impact. A query adds its lists from the
greatest maximum impact down. What the lists not yet added can give a document that no list so far
held is bounded by combining pairs: two terms that hardly meet in a document bound it by little more
than the greater of them, where MaxScore by itself takes their sum. Once the bound is below the k-th best
score, the lists that are left only complete documents already found, and those that can't reach that score go.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import materialize, ship_code
from llm.textcodes import slices, span_codes, words

TOP = 50
#: Postings that a task holds at a time; a document's own are never parted.
BLOCK_POSTINGS = 4_000_000
#: Query terms (with repeats over queries) of one pass over the documents; more make more passes.
PASS_TERMS = 200_000
#: Groups that a query's finds of all tasks are merged in, before the groups are.
MERGE_GROUPS = 64

# Bytes as the terms take them: what separates is a space, A-Z is lower-cased, all from 0x80 on stay.
_TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
_TERM_BYTES[0x80:] = np.arange(0x80, 0x100)
for _first, _last, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0)):
    _TERM_BYTES[_first:_last + 1] = np.arange(_first, _last + 1) + _shift


def terms(texts: pa.Array):
    """(first row, end row, term codes, row of each code from the first row on) of slices of a column.

    Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased."""
    for first, end, data, offsets in slices(texts):
        data = _TERM_BYTES[data]
        begins, ends, doc = words(data, offsets)
        yield first, end, span_codes(data, begins, ends), doc


@dataclass
class Queries:
    """Queries of one pass: row ids, the sorted codes of all their terms, each query's places in them."""

    rows: list
    vocabulary: np.ndarray
    places: list


def read_queries(rows: list) -> Queries:
    """``rows``: (row id, text) of the queries of one pass."""
    codes: list = [np.zeros(0, np.uint64)] * len(rows)
    for first, end, code, doc in terms(pa.array([t for _, t in rows], pa.large_string())):
        for i in range(first, end):
            codes[i] = np.unique(code[doc == i - first])
    vocabulary = np.unique(np.concatenate([*codes, np.zeros(0, np.uint64)]))
    return Queries([r for r, _ in rows], vocabulary, [np.searchsorted(vocabulary, c) for c in codes])


INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"


def forward_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, number of terms, and the places in ``vocabulary`` and frequencies of the terms that
    are in it, of every document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a pass's terms: bounded by PASS_TERMS

    def run(batches):
        wanted = shared.value
        for batch in batches:
            for first, end, codes, doc in terms(batch.column(1)):
                n = np.bincount(doc, minlength=end - first)
                at = np.searchsorted(wanted, codes)
                at[at == len(wanted)] = 0
                hit = wanted[at] == codes if len(wanted) else np.zeros(len(codes), bool)
                key, tf = np.unique(doc[hit] * max(1, len(wanted)) + at[hit], return_counts=True)
                owner, term = np.divmod(key, max(1, len(wanted)))
                ends = pa.array(np.searchsorted(owner, np.arange(end - first + 1)), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX)


class Block:
    """Posting lists of some documents with maximum impacts, and pair lists with joint ones.

    Postings are given by ascending row (documents are rows from 0 on)."""

    def __init__(self, n_docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int, tie: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.rows, self.impacts = row[order], impact[order]
        self.ends = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, dtype=np.int64)
        full = np.flatnonzero(np.diff(self.ends))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.impacts, self.ends[full])
        self.n_docs, self.tie = n_docs, tie
        self.pairs: dict = {}
        self.touched = 0

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.ends[t], self.ends[t + 1])
        return self.rows[at], self.impacts[at]

    def order(self, places: np.ndarray) -> np.ndarray:
        """The query's terms that the block holds, from the least maximum impact up."""
        places = places[self.most[places] > 0]
        return places[np.lexsort((places, self.most[places]))]

    def add_pairs(self, queries: list, k: int) -> None:
        """Pair lists for the neighbours in each query's order of impacts: of the documents that hold
        both terms, the ``k`` greatest joint impacts, greatest first."""
        partners: dict = {}
        for places in queries:
            t = self.order(places)
            for a, b in zip(t[:-1].tolist(), t[1:].tolist()):
                partners.setdefault(a, set()).add(b)
        dense = np.zeros(self.n_docs, dtype=np.int64)
        for a, others in partners.items():
            rows, impacts = self.postings(a)
            dense[rows] = impacts
            for b in others:
                rows_b, impacts_b = self.postings(b)
                both = dense[rows_b]
                joint = (both + impacts_b)[both > 0]
                if len(joint) > k:
                    joint = np.partition(joint, len(joint) - k)[-k:]
                self.pairs[a, b] = np.sort(joint)[::-1]
            dense[rows] = 0

    def bounds(self, t: np.ndarray, paired: bool = True) -> np.ndarray:
        """For each j, what the first j terms of ``t`` can give one document at most: every split of
        them into neighbouring pairs and single terms bounds it, and the least such bound is taken."""
        most = self.most[t].tolist()
        out = [0]
        for j, m in enumerate(most):
            least = out[j] + m
            if paired and j:
                joint = self.pairs[int(t[j - 1]), int(t[j])]
                either = max(most[j - 1], m, int(joint[0]) if len(joint) else 0)
                least = min(least, out[j - 1] + either)
            out.append(least)
        return np.array(out, dtype=np.int64)

    def best(self, places: np.ndarray, k: int, paired: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best documents (score above 0), ties by ``tie``; no order."""
        t = self.order(places)
        bound = self.bounds(t, paired)
        reach = 0  # the k-th best score is at least this: k documents hold a term, or a pair, of such impact
        for j in range(len(t)):
            lists = [self.postings(t[j])[1]]
            if paired and j:
                lists.append(self.pairs[int(t[j - 1]), int(t[j])])
            for some in lists:
                if len(some) >= k:
                    reach = max(reach, int(np.partition(some, len(some) - k)[len(some) - k]))
        score = np.zeros(self.n_docs, dtype=np.int64)
        j = len(t)
        found = np.zeros(0, dtype=np.int64)
        while j and bound[j] >= reach:  # a document in none of the lists so far could still get in
            rows, impacts = self.postings(t[j - 1])
            found = np.append(found, rows[score[rows] == 0])
            score[rows] += impacts
            self.touched += len(rows)
            j -= 1
            if len(found) >= k:
                reach = max(reach, int(np.partition(score[found], len(found) - k)[len(found) - k]))
        while j:  # complete those that can still reach the k-th best score
            found = found[score[found] + bound[j] >= reach]
            rows, impacts = self.postings(t[j - 1])
            if len(found) < len(rows) // 8:
                at = np.minimum(np.searchsorted(rows, found), len(rows) - 1)
                score[found] += np.where(rows[at] == found, impacts[at], 0)
                self.touched += len(found)
            else:
                score[rows] += impacts
                self.touched += len(rows)
            j -= 1
            if len(found) >= k:
                reach = max(reach, int(np.partition(score[found], len(found) - k)[len(found) - k]))
        found = found[score[found] >= max(reach, 1)]
        keep = np.lexsort((self.tie[found], -score[found]))[:k]
        return found[keep], score[found[keep]]


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one term adds to a document's score, in 64-bit integers."""
    m = 50 + (50 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def search_blocks(batches, q: Queries, weight: np.ndarray, n_docs: int, n_terms: int, k: int, block_postings: int):
    """The ``k`` best documents of each query in one task's documents: row id, doc_id and score."""

    def blocks():
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch) + len(pc.list_flatten(batch.column(2)))
            if size >= block_postings:
                yield held
                held, size = [], 0
        if held:
            yield held

    best: list = [None] * len(q.rows)
    for held in blocks():
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["doc_id"]
        null = ids.is_null().to_numpy()
        # null ids come first in a tie
        tie = np.where(null, np.iinfo(np.int64).min, ids.fill_null(0).to_numpy())
        counts = pc.list_value_length(t["terms"]).to_numpy()
        row = np.repeat(np.arange(len(t)), counts)
        term, tf = (pc.list_flatten(t[c]).to_numpy().astype(np.int64) for c in ("terms", "tfs"))
        value = impacts(weight[term], tf, t["n"].to_numpy()[row], n_docs, n_terms)
        some = value > 0
        block = Block(len(t), row[some], term[some], value[some], len(weight), tie)
        block.add_pairs(q.places, k)
        for i, places in enumerate(q.places):
            rows, score = block.best(places, k)
            here = (score, tie[rows], null[rows])
            if best[i] is not None:
                here = tuple(np.concatenate(x) for x in zip(best[i], here))
                keep = np.lexsort((here[1], -here[0]))[:k]
                here = tuple(x[keep] for x in here)
            best[i] = here
    for i, got in enumerate(best):
        if got is not None and len(got[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(got[0]), q.rows[i]), pa.int64()), pa.array(got[1], pa.int64(), mask=got[2]),
                 pa.array(got[0], pa.int64())], names=["_query", "doc_id", "score"])


def _searched(docs: DataFrame, q: Queries, k: int, block_postings: int) -> DataFrame:
    """_query, doc_id and score of the best documents that the tasks found for the queries of one pass."""
    index = materialize(forward_index(docs, q.vocabulary), "forward-index")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(q.vocabulary), dtype=np.int64)
    # a row for each term of the pass
    for place, df in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weight[place] = term_weight(n_docs, df)
    shared = docs.sparkSession.sparkContext.broadcast((q, weight))
    return index.mapInArrow(lambda batches: search_blocks(batches, *shared.value, n_docs, n_terms, k, block_postings),
                            "_query long, doc_id long, score long")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, block_postings: int = BLOCK_POSTINGS,
                  pass_terms: int = PASS_TERMS) -> DataFrame:
    """The ``k`` best documents of every query: item_id, rank (from 1), doc_id, score.

    ``docs`` has doc_id and text, ``queries`` item_id and text; other columns are ignored. A term's
    weight, a document's length and a score are those of ``term_weight`` and ``impacts``, over all
    documents; a query's repeated term counts once. Documents of score 0 aren't found, a query may have
    fewer than ``k``. Ties go to the smaller doc_id, null before all; rows of one doc_id are documents of
    their own, as are rows of equal texts, and queries of one item_id are ranked each for itself. Null,
    empty and termless texts are no documents and find nothing. Texts are read whole, however long. An
    empty table on either side gives no rows.

    The scores are exact: bounds only leave out documents that can't be among the best. Queries that hold more
    than ``pass_terms`` terms together are run in passes, each of which reads the documents anew. A task holds
    ``block_postings`` postings, and the ``k`` best of each query of a pass.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = materialize(queries.select(F.col("item_id"), F.col("text").cast("string"))
                       .withColumn("_query", F.monotonically_increasing_id()), "queries")
    # no term is shorter than a byte, and one byte stands between two
    size = rows.agg(F.coalesce(F.sum((F.octet_length("text") + 1) / 2), F.lit(0)).cast("long")).first()[0]
    passes = max(1, -(-size // pass_terms))
    parts = []
    for i in range(passes):
        some = rows.where(F.pmod(F.xxhash64("_query"), F.lit(passes)) == i).select("_query", "text").collect()
        parts.append(_searched(docs, read_queries([tuple(r) for r in some]), k, block_postings))
    found = reduce(DataFrame.unionByName, parts).withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    near = F.row_number().over(Window.partitionBy("_query", "_group").orderBy(*order))
    best = found.withColumn("_near", near).where(F.col("_near") <= k)
    best = (best.withColumn("rank", F.row_number().over(Window.partitionBy("_query").orderBy(*order)))
            .where(F.col("rank") <= k))
    return best.join(rows.select("_query", "item_id"), "_query").select("item_id", "rank", "doc_id", "score")
