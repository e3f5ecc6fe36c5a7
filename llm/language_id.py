"""Language identification by interpolated Kneser-Ney character models, one for each language.

Texts are read as symbols: lower-cased letters (and marks), everything between them one space. The counts of
all five-symbol grams of all training texts are summed by Spark; the tables of shorter grams,
which count the symbols that a gram follows, are groupings of those. The models of all languages
stand side by side in arrays sorted by gram hash: a gram's row holds its interpolated log-probability in each
language, a context's row its back-off weights. A text's language is the one of least cross-entropy
a symbol. A part of the training documents is kept back to calibrate: how often a lead of that size was
right gives the score, and how high the entropy of right ones gets sets the bound of rejection.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import materialize, ship_code, text_or_empty
from llm.textcodes import mix

ORDER = 5
SYMBOL_BITS = 12
#: Of the training documents, one in so many calibrates instead.
CALIBRATION_SHARE = 4
#: Of right answers in calibration, at most this share is rejected.
REJECTED_SHARE = 0.002
#: Numbers (grams times languages) of the models that tasks hold at once; larger models are used slice after slice.
MODEL_CELLS = 8_000_000
#: Grams that a task sums before it hands them on.
TASK_GRAMS = 1_000_000
#: Texts are worked on in slices of about this many characters; one longer text is a slice.
SLICE_CHARS = 400_000
UNDETERMINED = "und"

_SYMBOLS = 1 << SYMBOL_BITS


class _Alphabet:
    """Symbol of each code point, worked out when it is first met: 0 for what is neither letter nor
    mark, the lower-cased code point below 2048, else one of 2048 hashed symbols."""

    def __init__(self):
        self.symbol = np.zeros(0x110000, dtype=np.uint16)
        self.letter = np.zeros(0x110000, dtype=bool)
        self.known = np.zeros(0x110000, dtype=bool)

    def learn(self, points: np.ndarray) -> None:
        for p in np.unique(points[~self.known[points]]).tolist():
            kind = unicodedata.category(chr(p))[0]
            if kind in "LM":
                low = ord(chr(p).lower()[0])
                fold = 2048 + int(mix(np.array([low], np.uint64))[0]) % 2048
                self.symbol[p] = low if low < 2048 else fold
            self.letter[p] = kind == "L"
            self.known[p] = True


_ALPHABET: list = []


def alphabet() -> _Alphabet:
    if not _ALPHABET:
        _ALPHABET.append(_Alphabet())
    return _ALPHABET[0]


@dataclass
class Symbols:
    """Symbols of texts laid end to end: each text starts with a space that isn't predicted."""

    symbol: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    letters: np.ndarray

    def grams(self, order: int) -> np.ndarray:
        """The gram of ``order`` symbols that ends at each symbol; before a text there are spaces."""
        out = self.symbol.astype(np.uint64)
        for back in range(1, order):
            before = np.zeros_like(self.symbol)
            before[back:] = np.where(self.place[back:] >= back, self.symbol[:-back], 0)
            out |= before.astype(np.uint64) << np.uint64(SYMBOL_BITS * back)
        return out


def text_slices(texts: pa.Array):
    """(first row, end row, Symbols) of slices of a string column; null is empty."""
    # only a slice's texts become Python's, not those of the whole column
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    first = 0
    while first < len(sizes):
        end, size = first, 0
        while end < len(sizes) and (end == first or size + sizes[end] <= SLICE_CHARS):
            size += sizes[end]
            end += 1
        yield first, end, symbols([t or "" for t in texts.slice(first, end - first).to_pylist()])
        first = end


def symbols(texts: list) -> Symbols:
    # a space before and one behind every text
    raw = "\n" + "\n\n".join(texts) + "\n" if texts else ""
    points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = alphabet()
    known.learn(points)
    lengths = np.array([len(t) + 2 for t in texts], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(texts)), lengths)
    symbol = known.symbol[points]
    letters = np.add.reduceat(known.letter[points].astype(np.int64), starts) if texts else np.zeros(0, np.int64)
    keep = symbol != 0
    keep[1:] |= symbol[:-1] != 0
    keep[starts] = True
    symbol, doc = symbol[keep], doc[keep]
    counts = np.bincount(doc, minlength=len(texts))
    place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return Symbols(symbol, doc, place, letters)


GRAMS = "lang string, gram long, n long"


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram and count of all grams of ``order`` symbols of all texts with a language."""

    def run(batches):
        held: dict = {}
        size = 0

        def summed():
            for lang, parts in held.items():
                gram, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                held[lang] = [(gram, n)]
            return sum(len(p[0][0]) for p in held.values())

        def told():
            for lang, parts in held.items():
                for gram, n in parts:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                                                      pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, end, s in text_slices(batch.column(1)):
                grams = s.grams(order)
                predicted = (s.place > 0) & (s.letters[s.doc] > 0)
                for lang in set(langs[first:end]):
                    own = predicted & (langs[first:end] == lang)[s.doc]
                    gram, n = np.unique(grams[own], return_counts=True)
                    held.setdefault(lang, []).append((gram, n.astype(np.int64)))
                    size += len(gram)
                if size > 2 * TASK_GRAMS:
                    size = summed()
                    if size > TASK_GRAMS:
                        yield from told()
                        held.clear()
                        size = 0
        summed()
        yield from told()

    return (docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string"), text_or_empty().alias("text"))
            .mapInArrow(run, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _tail(gram: Column, symbols: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (SYMBOL_BITS * symbols)) - 1))


def kneser_ney_counts(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """size, lang, gram, n: the counts of the full grams, and for each shorter one in how many
    different grams one symbol longer it is the end.

    All shorter sizes are one table, so that two shuffles make them, not one more for each size."""
    full = grams.select(F.lit(order).alias("size"), "lang", "gram", "n")
    if order == 1:
        return full
    size = F.col("size")
    tails = lambda sizes: F.explode(F.array(*[F.struct(F.lit(k).alias("size"), _tail(F.col("gram"), k).alias("gram")) for k in sizes]))
    # the different grams of sizes 2 to order - 1, and those of size order; each counts for its end one symbol shorter
    longer = full.select("size", "lang", "gram")
    if order > 2:
        shorter = grams.select("lang", tails(range(2, order)).alias("t")).select("t.size", "lang", "t.gram").distinct()
        longer = longer.unionByName(shorter)
    end = F.element_at(F.array(*[_tail(F.col("gram"), k) for k in range(1, order)]), size - 1)
    ends = longer.groupBy((size - 1).alias("size"), "lang", end.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    return full.unionByName(ends)


class HashArrays:
    """Rows of numbers by 64-bit key: the keys' hashes sorted, with the place where each range of
    leading hash bits starts, so that a look-up reads one or two neighbours."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashed = mix(keys)
        order = np.argsort(hashed)
        self.hashed, self.values = hashed[order], values[order]
        self.bits = max(1, int(len(keys)).bit_length())
        self.starts = np.searchsorted(self.hashed >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1))
        self.widest = int(np.diff(self.starts).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        hashed = mix(keys)
        lead = (hashed >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        open_ = np.flatnonzero(at < end)
        for step in range(self.widest):
            row = at[open_] + step
            same = self.hashed[row] == hashed[open_]
            out[open_[same]] = row[same]
            open_ = open_[~same & (row + 1 < end[open_])]
            if not len(open_):
                break
        return out


class LanguageModels:
    """Interpolated Kneser-Ney models of ``langs``: log-probabilities of grams, log back-off of contexts."""

    def __init__(self, langs: list, counts: list, discounts: np.ndarray, singles: tuple):
        """``counts``: for each size from 2 on, sorted grams and their counts by language (a matrix);
        ``discounts``: by size and language; ``singles``: symbols and counts of size 1."""
        self.langs = langs
        symbol, n = singles
        total = np.maximum(n.sum(axis=0), 1)
        spare = np.where(n.sum(axis=0) > 0, discounts[0] * (n > 0).sum(axis=0) / total, 1.0) / _SYMBOLS
        table = np.tile(spare, (_SYMBOLS, 1))
        table[symbol.astype(np.int64)] += np.maximum(n - discounts[0], 0) / total
        self.single = np.log(table).astype(np.float32)
        lower, p_lower = np.arange(_SYMBOLS, dtype=np.uint64), table
        self.grams, self.contexts = [], []
        for size, (gram, n) in enumerate(counts, 2):
            context, first = np.unique(gram >> np.uint64(SYMBOL_BITS), return_index=True)
            if len(gram):
                at = np.searchsorted(context, gram >> np.uint64(SYMBOL_BITS))
                total = np.add.reduceat(n, first)
                kinds = np.add.reduceat((n > 0).astype(np.float64), first)
                back = np.where(total > 0, discounts[size - 1] * kinds / np.maximum(total, 1), 1.0)
                end = np.searchsorted(lower, gram & np.uint64((1 << (SYMBOL_BITS * (size - 1))) - 1))
                p = np.maximum(n - discounts[size - 1], 0) / np.maximum(total, 1)[at] + back[at] * p_lower[end]
            else:
                back = p = np.zeros((0, len(langs)))
            self.grams.append(HashArrays(gram, np.log(p).astype(np.float32)))
            self.contexts.append(HashArrays(context, np.log(back).astype(np.float32)))
            lower, p_lower = gram, p

    def log_probabilities(self, s: Symbols, at: np.ndarray) -> np.ndarray:
        """Of the symbols at the places ``at``, in each language."""
        out = np.zeros((len(at), len(self.langs)), dtype=np.float32)
        open_ = np.arange(len(at))
        for size in range(len(self.grams) + 1, 1, -1):
            grams = s.grams(size)[at[open_]]
            row = self.grams[size - 2].find(grams)
            out[open_[row >= 0]] += self.grams[size - 2].values[row[row >= 0]]
            open_, grams = open_[row < 0], grams[row < 0]
            row = self.contexts[size - 2].find(grams >> np.uint64(SYMBOL_BITS))
            out[open_[row >= 0]] += self.contexts[size - 2].values[row[row >= 0]]
        out[open_] += self.single[s.symbol[at[open_]]]
        return out


@dataclass
class ModelTable:
    """Counts of the models, written, and what is small of them: languages, discounts, slices.

    A slice holds the grams whose last symbol but one is its own, with all ends of theirs: it has
    all that the probability of a symbol after one of its symbols needs."""

    table: DataFrame
    langs: list
    discounts: np.ndarray
    slice_of: np.ndarray
    order: int

    def models(self, which: int) -> LanguageModels:
        spot = {x: i for i, x in enumerate(self.langs)}
        mine = np.flatnonzero(self.slice_of == which)
        own = self.table.where((F.col("size") == 1) | F.col("before").isin(mine.tolist())) if self.slice_of.max() else self.table
        t = own.select("size", "lang", "gram", "n").toArrow()
        size, gram, n = (t[c].to_numpy() for c in ("size", "gram", "n"))
        coded = t["lang"].combine_chunks().dictionary_encode()
        lang = np.array([spot[x] for x in coded.dictionary.to_pylist()], dtype=np.int64)[coded.indices.to_numpy()]
        tables = []
        for k in range(1, self.order + 1):
            here = size == k
            keys, at = np.unique(gram[here].astype(np.uint64), return_inverse=True)
            counts = np.zeros((len(keys), len(self.langs)))
            counts[at, lang[here]] = n[here]
            tables.append((keys, counts))
        return LanguageModels(self.langs, tables[1:], self.discounts, tables[0])


def fit(docs: DataFrame, order: int = ORDER, cells: int = MODEL_CELLS) -> ModelTable:
    """Count the grams of all of ``docs`` (text, lang) that have a language."""
    counts = kneser_ney_counts(materialize(gram_counts(docs, order), "grams"), order)
    before = F.shiftright(_tail(F.col("gram"), 2), SYMBOL_BITS)
    table = materialize(counts.withColumn("before", before), "gram-tables")
    # one row for each language and size
    stats = (table.groupBy("lang", "size").agg(F.sum((F.col("n") == 1).cast("long")).alias("ones"),
                                               F.sum((F.col("n") == 2).cast("long")).alias("twos")).collect())
    langs = sorted({r["lang"] for r in stats})
    discounts = np.full((order, max(1, len(langs))), 0.5)
    for r in stats:
        if r["ones"] and r["twos"]:
            discounts[r["size"] - 1, langs.index(r["lang"])] = r["ones"] / (r["ones"] + 2 * r["twos"])
    # one row for each of the 4096 symbols; a slice takes symbols until it is full
    sizes = dict(table.where("size > 1").groupBy("before").agg(F.count_distinct("size", "gram")).collect())
    slice_of = np.zeros(_SYMBOLS, dtype=np.int64)
    held, which = 0, 0
    for symbol in range(_SYMBOLS):
        more = sizes.get(symbol, 0) * max(1, len(langs))
        if held and held + more > cells:
            held, which = 0, which + 1
        held += more
        slice_of[symbol] = which
    return ModelTable(table, langs, discounts, slice_of, order)


def cross_entropies(docs: DataFrame, model: ModelTable) -> DataFrame:
    """The rows of ``docs`` with ``_bits`` (negative log2-likelihood in each language), ``_symbols`` and ``_letters``.

    Models within one slice's size are one broadcast and one pass. Larger ones are used slice after
    slice, each a pass over the texts that adds up the symbols it covers."""
    spark, langs = docs.sparkSession, len(model.langs)
    text_at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields + [T.StructField("_bits", T.ArrayType(T.DoubleType())),
                                               T.StructField("_symbols", T.LongType()), T.StructField("_letters", T.LongType())])

    def scored(which: int) -> DataFrame:
        shared = spark.sparkContext.broadcast(model.models(which))  # at most MODEL_CELLS numbers
        covered = model.slice_of == which

        def run(batches):
            for batch in batches:
                for first, end, s in text_slices(batch.column(text_at)):
                    before = np.append(0, s.symbol[:-1])
                    at = np.flatnonzero((s.place > 0) & covered[before])
                    bits = np.zeros((end - first, langs))
                    p = shared.value.log_probabilities(s, at)
                    for k in range(langs):
                        bits[:, k] = np.bincount(s.doc[at], p[:, k], end - first) / -np.log(2)
                    n = np.bincount(s.doc, minlength=end - first) - 1
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(end - first + 1) * langs, pa.int32()),
                                                     pa.array(bits.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(first, end - first) for c in batch.columns] + [lists, pa.array(n, pa.int64()), pa.array(s.letters, pa.int64())],
                        names=schema.fieldNames())

        return docs.mapInArrow(run, schema)

    slices = int(model.slice_of.max()) + 1
    if slices == 1:
        return scored(0)
    rows = docs  # a row is known by its place in a written table
    docs = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "texts")
    text_at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields + schema.fields[len(rows.columns):])
    sums = None
    for which in range(slices):
        part = scored(which).select("_at", F.posexplode("_bits").alias("_lang", "_b"), "_symbols", "_letters")
        sums = part if sums is None else sums.unionByName(part)
    sums = (sums.groupBy("_at", "_lang").agg(F.sum("_b").alias("_b"), F.max("_symbols").alias("_symbols"), F.max("_letters").alias("_letters"))
            .groupBy("_at").agg(F.transform(F.array_sort(F.collect_list(F.struct("_lang", "_b"))), lambda x: x["_b"]).alias("_bits"),
                                F.max("_symbols").alias("_symbols"), F.max("_letters").alias("_letters")))
    return docs.join(sums, "_at").drop("_at")


def _decided(df: DataFrame, langs: list) -> DataFrame:
    """Adds the best language, its entropy, the lead over the next (bits of the whole text) and their bins."""
    ranked = F.array_sort(F.arrays_zip(F.col("_bits").alias("b"), F.array(*[F.lit(x) for x in langs]).alias("l")))
    df = df.withColumn("_ranked", F.when(F.col("_letters") > 0, ranked))
    second = F.get("_ranked", F.lit(1))["b"]
    return (df.withColumn("_best", F.get("_ranked", F.lit(0))["l"])
            .withColumn("entropy", F.get("_ranked", F.lit(0))["b"] / F.col("_symbols"))
            .withColumn("_lead", F.least(F.lit(40), F.floor(2 * F.log2(1 + F.coalesce(second - F.get("_ranked", F.lit(0))["b"], F.lit(0.0))))).cast("int"))
            .withColumn("_long", F.least(F.lit(20), F.floor(F.log2(F.greatest(F.lit(1), F.col("_symbols"))))).cast("int")))


def fold(doc_id="doc_id") -> Column:
    """crc32 of the doc_id as text, a null one being empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def _rising(right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Shares of right answers in bins that rise from bin to bin (pooled where they would fall)."""
    pools: list = []
    for r, t in zip(right, total):
        pools.append([r, t, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            r2, t2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + r2, pools[-1][1] + t2, pools[-1][2] + k2]
    return np.concatenate([np.full(k, r / t) for r, t, k in pools])


def identify_language(docs: DataFrame, order: int = ORDER, cells: int = MODEL_CELLS) -> DataFrame:
    """The input's rows and columns with held_out, lang_pred, score, entropy and rejected.

    Models are learnt from the text and lang of the rows with a lang whose ``crc32`` of the doc_id
    modulo 5 isn't 0 (``held_out`` marks the others; a null doc_id counts as the empty text), one in
    ``CALIBRATION_SHARE`` of them being kept for calibration. ``lang_pred`` is the learnt language of least
    entropy (bits a symbol), the first by name in a tie, ``und`` for a text that is null, empty or without a
    letter, or if nothing was learnt. ``score`` is the share of right answers that calibration found at such a
    lead over the next language, 0 for ``und``. ``rejected`` marks texts whose entropy is beyond that of
    all but ``REJECTED_SHARE`` of the right answers of their length in calibration (and ``und``): they
    look like none of the languages, and ``lang_pred`` is then the nearest.

    A prediction reads nothing but the text, the whole of it; equal texts get equal results, repeated
    rows stay, and count in the models as often as they are there. An empty table gives an empty one.
    Input columns of the new names are replaced; their and other extra columns have no influence.
    The models of a slice are broadcast, ``cells`` numbers at most (but one symbol's are never parted).
    """
    ship_code(docs.sparkSession)
    names = ["held_out", "lang_pred", "score", "entropy", "rejected"]
    docs = docs.drop(*names)
    part = fold() % 5
    calibrates = (part != 0) & (F.shiftright(fold(), 8) % CALIBRATION_SHARE == 0)
    plain = docs.select("doc_id", "text", "lang")
    model = fit(plain.where((part != 0) & ~calibrates), order, cells)
    if not model.langs:
        return docs.select(*docs.columns, (part == 0).alias("held_out"), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"))
    inner = [f"_in{i}" for i in range(len(docs.columns))]  # so that no column's name clashes with those used here
    renamed = docs.toDF(*inner).withColumn("text", F.col(inner[docs.columns.index("text")]).cast("string"))
    renamed = renamed.drop(inner[docs.columns.index("text")])

    seen = _decided(cross_entropies(plain.where(calibrates & F.col("lang").isNotNull()).select("lang", F.col("text").cast("string")), model), model.langs)
    seen = materialize(seen.where("_letters > 0").select((F.col("_best") == F.col("lang")).alias("right"), "_lead", "_long", "entropy"), "calibration")
    right, total = np.ones(41), np.full(41, 2.0)  # one right and one wrong answer beforehand in each bin
    for r in seen.groupBy("_lead").agg(F.sum(F.col("right").cast("long")).alias("r"), F.count(F.lit(1)).alias("n")).collect():
        right[r["_lead"]] += r["r"]
        total[r["_lead"]] += r["n"]
    shares = _rising(right, total)
    limit = np.full(21, np.nan)
    for r in seen.where("right").groupBy("_long").agg(F.percentile_approx("entropy", 1 - REJECTED_SHARE, 10000).alias("e")).collect():
        limit[r["_long"]] = r["e"]
    # a length that calibration lacks takes the limit of the next shorter one, the shortest have none
    for i in range(21):
        if np.isnan(limit[i]):
            limit[i] = limit[i - 1] if i else np.inf
    got = _decided(cross_entropies(renamed, model), model.langs)
    known = F.col("_best").isNotNull()
    share = F.get(F.array(*[F.lit(float(x)) for x in shares]), F.col("_lead"))
    bound = F.get(F.array(*[F.lit(float(x)) for x in limit]), F.col("_long"))
    back = [F.col("text" if c == "text" else i).alias(c) for c, i in zip(docs.columns, inner)]
    doc_id = inner[docs.columns.index("doc_id")]
    return got.select(*back, (fold(doc_id) % 5 == 0).alias("held_out"), F.coalesce("_best", F.lit(UNDETERMINED)).alias("lang_pred"),
                      F.when(known, share).otherwise(0.0).alias("score"), "entropy",
                      (~known | (F.col("entropy") > bound)).alias("rejected"))
