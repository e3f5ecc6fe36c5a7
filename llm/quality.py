"""Quality classifier: gated-attention multiple-instance learning over passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from llm.common import materialize, ship_code, text_or_empty
from llm.textcodes import slices, span_codes, words

PASSAGE_WORDS = 50
#: Bounds of the sample that the model is fitted on: documents, and passages of all of them together
#: (a document is in it with all its passages or not at all). Scoring has no bound.
TRAIN_DOCUMENTS, TRAIN_PASSAGES = 4096, 150_000
#: Documents that score less are rejected.
KEEP_SCORE = 0.3
FEATURES = 15


def _byte_classes() -> np.ndarray:
    table = np.zeros((8, 256), dtype=np.int32)
    table[0, ord("A"):ord("Z") + 1] = 1
    table[1, ord("0"):ord("9") + 1] = 1
    table[2, [ord(c) for c in "!?"]] = 1
    table[3, [ord(c) for c in "#$%&*@^~+=<>/\\_"]] = 1
    table[4, [ord(c) for c in "|{}[]()"]] = 1
    table[5, [ord(c) for c in ".,;:"]] = 1
    table[6, 0x80:] = 1
    table[7, ord("\n")] = 1
    return table


CLASSES = _byte_classes()


def passages(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Feature vectors of all passages (runs of ``size`` words, the last one shorter) of a slice of
    texts, and the document of each. A document without words is one passage of zeros."""
    n_docs = len(offsets) - 1
    starts, ends, doc = words(data, offsets)
    counts = np.bincount(doc, minlength=n_docs)
    per_doc = np.maximum(1, -(-counts // size))
    owner = np.repeat(np.arange(n_docs), per_doc)
    x = np.zeros((len(owner), FEATURES))
    if not len(starts):
        return x, owner
    first_word = np.cumsum(counts) - counts
    first_passage = np.cumsum(per_doc) - per_doc
    of = first_passage[doc] + (np.arange(len(doc)) - first_word[doc]) // size
    n = np.bincount(of, minlength=len(owner))
    has = np.flatnonzero(n)
    begin = np.cumsum(n)[has] - n[has]
    stop = begin + n[has] - 1
    lo, hi = starts[begin], ends[stop]
    length = (ends - starts).astype(np.float64)
    chars = np.add.reduceat(length, begin)
    total = np.zeros(len(data) + 1, dtype=np.int64)
    for k, table in enumerate(CLASSES):
        np.cumsum(table[data], out=total[1:])
        x[has, k] = (total[hi] - total[lo]) / (chars if k != 7 else n[has])
    codes = span_codes(data, starts, ends)
    same = np.zeros(len(codes))
    same[1:] = (codes[1:] == codes[:-1]) & (of[1:] == of[:-1])
    key = np.sort((of.astype(np.uint64) << np.uint64(40)) | (codes >> np.uint64(24)))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(owner))
    m = n[has]
    mean = chars / m
    x[has, 8] = mean / 10
    x[has, 9] = np.sqrt(np.maximum(0, np.add.reduceat(length * length, begin) / m - mean * mean)) / 10
    x[has, 10] = np.add.reduceat(same, begin) / m
    x[has, 11] = distinct[has] / m
    x[has, 12] = np.add.reduceat((length == 1).astype(np.float64), begin) / m
    x[has, 13] = np.log1p(m) / 4
    x[has, 14] = (hi - lo - chars) / m
    return x, owner


@dataclass(frozen=True)
class AttentionModel:
    """Standardised features -> tanh encoder -> gated attention -> logistic score."""

    mean: np.ndarray
    scale: np.ndarray
    params: dict

    def scores(self, x: np.ndarray, owner: np.ndarray, n_docs: int) -> np.ndarray:
        p = self.params
        h, _, _, a = _forward((x - self.mean) / self.scale, owner, n_docs, p)
        z = np.zeros((n_docs, h.shape[1]))
        np.add.at(z, owner, a[:, None] * h)
        return 1.0 / (1.0 + np.exp(-np.clip(z @ p["c"] + p["b"], -35, 35)))


def _forward(x, owner, n_docs, p):
    h = np.tanh(x @ p["E"] + p["e"])
    t, g = np.tanh(h @ p["V"]), 1.0 / (1.0 + np.exp(-(h @ p["U"])))
    s = (t * g) @ p["w"]
    top = np.full(n_docs, -np.inf)
    np.maximum.at(top, owner, s)
    a = np.exp(s - top[owner])
    return h, t, g, a / np.bincount(owner, a, n_docs)[owner]


def fit_attention(x: np.ndarray, owner: np.ndarray, y: np.ndarray, hidden: int = 16, gate: int = 8,
                  epochs: int = 250, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Fit by Adam on the documents' log loss; the attention weights are learnt from document
    labels alone. With one class, or none, the score is constant (0.5 without labels)."""
    n_docs = len(y)
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = (x.std(axis=0) if len(x) else np.zeros(FEATURES)) + 1e-3
    r = np.random.default_rng(seed)
    p = {"E": r.normal(0, 0.3, (FEATURES, hidden)), "e": np.zeros(hidden), "V": r.normal(0, 0.3, (hidden, gate)),
         "U": r.normal(0, 0.3, (hidden, gate)), "w": r.normal(0, 0.3, gate), "c": np.zeros(hidden),
         "b": np.zeros(())}
    share = (y.sum() + 1) / (n_docs + 2)
    p["b"] = np.array(np.log(share / (1 - share)) if n_docs else 0.0)
    if n_docs == 0 or y.min() == y.max():
        return AttentionModel(mean, scale, p)
    x = (x - mean) / scale
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, epochs + 1):
        h, t, g, a = _forward(x, owner, n_docs, p)
        z = np.zeros((n_docs, hidden))
        np.add.at(z, owner, a[:, None] * h)
        out = 1.0 / (1.0 + np.exp(-np.clip(z @ p["c"] + p["b"], -35, 35)))
        err = (out - y) / n_docs
        dz = err[:, None] * p["c"]
        da = (dz[owner] * h).sum(axis=1)
        ds = a * (da - np.bincount(owner, a * da, n_docs)[owner])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz[owner] + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h * h)
        grads = {"E": x.T @ dpre, "e": dpre.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds,
                 "c": z.T @ err, "b": err.sum()}
        for k, d in grads.items():
            d = d + decay * p[k]
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            p[k] = p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return AttentionModel(mean, scale, p)


def held_out(doc_id="doc_id"):
    """crc32 of the doc_id as text, modulo 5, is 0; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_documents: int = TRAIN_DOCUMENTS,
          max_passages: int = TRAIN_PASSAGES) -> AttentionModel:
    """Fit on at most ``max_documents`` labelled documents that aren't held out, those of least
    hash, all passages of each; the last of them go if they are more than ``max_passages`` together
    (the first stays in any case). Only their passage vectors reach the driver.

    Null labels and doc_ids are left out; a document labelled both ways takes the more frequent
    label (1 in a tie), and one that has two texts counts with the smaller."""
    ship_code(docs.sparkSession)
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg("quality").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_documents))
    sample = (docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty().alias("text"))
              .join(F.broadcast(chosen), "_id")  # at most `max_documents` rows of two numbers
              .groupBy("_id", "_y").agg(F.min("text").alias("text")))  # repeated rows of a document are one

    def encode(batches):
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(2)):
                x, owner = passages(data, offsets)
                lists = [x[owner == i].ravel().tolist() for i in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                     pa.array(lists, pa.list_(pa.float64()))], names=["_id", "_y", "_x"])

    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    sample = materialize(sample.withColumn("_n", F.greatest(F.lit(1), F.ceil(n_words / PASSAGE_WORDS))), "quality-sample")
    # at most max_documents rows of two numbers, in the order they were chosen in
    in_order = Window.orderBy(F.xxhash64("_id"), "_id")
    fits = (sample.select("_id", F.sum("_n").over(in_order).alias("_sum"), F.row_number().over(in_order).alias("_nth"))
            .where((F.col("_sum") <= max_passages) | (F.col("_nth") == 1)).select("_id"))
    got = (sample.join(F.broadcast(fits), "_id").select("_id", "_y", "text").mapInArrow(encode, "_id long, _y double, _x array<double>")
           .toArrow().to_pylist())
    got.sort(key=lambda r: r["_id"])
    vectors = [np.array(r["_x"]).reshape(-1, FEATURES) for r in got]
    y = np.array([float(r["_y"] >= 0.5) for r in got])
    owner = np.repeat(np.arange(len(got)), [len(v) for v in vectors]) if got else np.zeros(0, np.int64)
    return fit_attention(np.concatenate(vectors) if got else np.zeros((0, FEATURES)), owner, y)


def score_column(model: AttentionModel):
    """Score (0 to 1) of a text column, every passage of the whole text read."""

    @arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = []
        for first, end, data, offsets in slices(text):
            out.append(model.scores(*passages(data, offsets), end - first))
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score(text_or_empty())


def score_documents(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE,
                    max_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """The input's rows and columns with held_out, score and predicted (1 from ``keep_score``).

    The score reads the text alone: passages of 50 words are encoded by their surface (letter
    case, digits, marks, word lengths, repeats), gated attention weighs them, and the weighted
    mean is classified. Null and empty texts are one passage of zeros and get its score; a
    text of any length is read whole. Equal texts score equally, repeated rows stay repeated.
    Without labels every score is 0.5. Columns of those names in the input are replaced.
    """
    model = train(docs, labels, max_documents)
    docs = docs.drop("held_out", "score", "predicted")
    scored = docs.withColumn("score", score_column(model))
    return scored.select(*docs.columns, held_out().alias("held_out"), "score",
                         (F.col("score") >= keep_score).cast("int").alias("predicted"))
