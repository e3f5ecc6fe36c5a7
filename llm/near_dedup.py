"""Near-duplicate groups: ProbMinHash signatures, banding, exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import materialize, ship_code, text_or_empty
from llm.textcodes import counted, mix, shingle_codes, slices, span_codes, words

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: A pair of probability Jaccard 0.8 shares no band with probability (1 - 0.8^4)^24 = 3e-6.
BANDS, BAND_ROWS = 24, 4
#: Rounds that compare a bucket's documents with one of them before the pairs that are
#: still possible between different components are all compared.
STAR_ROUNDS = 2


def document_shingles(texts: pa.Array, k: int = SHINGLE_WORDS):
    """For each slice of a string column: first row, rows, and the distinct shingle codes with
    their row (from the slice's first) and count."""
    for first, end, data, offsets in slices(texts):
        for at in range(first, end, 1 << 15):  # `counted` packs the row into 16 bits
            upto = min(end, at + (1 << 15))
            o = offsets[at - first:upto - first + 1]
            part = data[o[0]:o[-1]]
            starts, ends, doc = words(part, o - o[0])
            codes, doc = shingle_codes(span_codes(part, starts, ends), doc, upto - at, k)
            yield at, upto - at, *counted(codes, doc, upto - at)


def shingle_weight(count: np.ndarray) -> np.ndarray:
    """Sublinear weight, 1 + ln(count): one endlessly repeated phrase doesn't make two texts alike."""
    return 1.0 + np.log(count.astype(np.float64))


def prob_minhash(codes: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """ProbMinHash signatures (n_docs x m): each element is a Poisson process of its weight's
    rate whose arrivals fall on uniform registers; a register keeps the element that arrives
    first. Arrivals come round by round for all documents, and an element stops as soon as its
    time passes its document's latest register. Two signatures agree in a register with the
    probability Jaccard of the weighted sets. Zero where a document has no element."""
    best = np.full(n_docs * m, np.inf)
    sig = np.zeros(n_docs * m, dtype=np.uint64)
    seed, rate = mix(codes + np.uint64(0x2545F4914F6CDD1D)), weight
    time = np.zeros(len(codes))
    step = 0
    while len(codes):
        step += 1
        bits = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        # 53 bits for the waiting time, and a second mix for the register
        wait = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53))
        time = time + wait / rate
        reg = (mix(bits) % np.uint64(m)).astype(np.int64) + doc * m
        better = time < best[reg]
        r, t, c = reg[better], time[better], codes[better]
        np.minimum.at(best, r, t)
        won = best[r] == t
        sig[r[won]] = c[won]
        latest = best.reshape(n_docs, m).max(axis=1)
        go = time < latest[doc]
        codes, doc, seed, rate, time = codes[go], doc[go], seed[go], rate[go], time[go]
    return sig.reshape(n_docs, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    mult = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    parts = sig[:, :bands * rows].reshape(len(sig), bands, rows)
    return mix((parts * mult).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def text_hash() -> Column:
    return F.md5(text_or_empty().cast("binary"))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, text hash and the band keys of every document (none for a text without words)."""

    def run(batches):
        kind = pa.list_(pa.int64())
        for batch in batches:
            texts = batch.column(2)
            for first, n, codes, doc, count in document_shingles(texts):
                keys = band_keys(prob_minhash(codes, doc, shingle_weight(count), n, bands * rows), bands, rows)
                has = np.bincount(doc, minlength=n) > 0
                ends = np.concatenate([[0], np.cumsum(has * bands)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[has].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n), lists.cast(kind)],
                    names=["doc_id", "_text_hash", "_bands"])

    return (docs.select(F.col("doc_id").cast("long"), text_hash().alias("_text_hash"),
                        text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, _text_hash string, _bands array<long>"))


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> tuple[float, float, float]:
    """Exact probability Jaccard of two weighted sets (sorted distinct codes and weights), the sum
    over common elements d of 1 / sum over d' of max(wa(d')/wa(d), wb(d')/wb(d)), and the
    common elements' weight in either."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0, 0.0
    xa, xb = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - xa.sum(), wb.sum() - xb.sum()
    ratio, inv = np.unique(xa / xb, return_inverse=True)
    at_a, at_b = np.bincount(inv, xa, len(ratio)), np.bincount(inv, xb, len(ratio))
    # elements of ratio at least d's count by their weight in a, the others by that in b
    high = np.cumsum(at_a[::-1])[::-1] + only_a
    low = np.cumsum(at_b) - at_b + only_b
    return float(np.sum(1.0 / (high[inv] / xa + low[inv] / xb))), float(xa.sum()), float(xb.sum())


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id (here the class), shingle codes and counts of the classes in ``wanted``: _class, its
    least doc_id ``_least`` (null: it has none) and _text_hash."""

    def shingle(batches):
        for batch in batches:
            for first, n, codes, doc, count in document_shingles(batch.column(1)):
                ends = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n),
                     pa.ListArray.from_arrays(ends, pa.array(codes.view(np.int64), pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32), pa.int32()))],
                    names=["doc_id", "_codes", "_counts"])

    # of a class's copies only the rows of its least doc_id are read, and rows that repeat are one
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), text_hash().alias("_h"), text_or_empty().alias("text"))
    texts = texts.join(wanted, (F.col("_h") == F.col("_text_hash")) & F.col("_id").eqNullSafe(F.col("_least")))
    texts = texts.groupBy(F.col("_class").alias("doc_id")).agg(F.min("text").alias("text"))
    return texts.mapInArrow(shingle, "doc_id long, _codes array<long>, _counts array<int>")


def set_weights(sets: DataFrame) -> DataFrame:
    """For each document its total weight W, the weight U of shingles that no other document of
    ``sets`` has, and its largest weight M. No pair's similarity exceeds :func:`pair_bound` of them."""
    flat = sets.select("doc_id", F.explode(F.arrays_zip("_codes", "_counts")).alias("_s")).select(
        "doc_id", F.col("_s._codes").alias("_code"), F.col("_s._counts").alias("_count"))
    alone = (flat.groupBy("_code").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("doc_id"), F.min("_count").alias("_count"))
             .where("_n = 1").groupBy("doc_id").agg(F.sum(1 + F.log("_count")).alias("_u")))
    total = F.aggregate("_counts", F.lit(0.0), lambda acc, c: acc + 1 + F.log(c))
    return (sets.select("doc_id", total.alias("_w"), (1 + F.log(F.array_max("_counts"))).alias("_m"))
            .join(alone, "doc_id", "left")
            .select(F.col("doc_id").alias("_class"), "_w", F.coalesce("_u", F.lit(0.0)).alias("_u"), "_m"))


def pair_bound(x: str, y: str) -> Column:
    """An upper bound of the probability Jaccard of documents x and y of one bucket.

    Common weight is at most what either shares with any document (W - U). Where both were
    compared with the bucket's head (_c: own weight common with it), common elements are either
    in the head, at most what either has in common with it, or outside, at most what either
    shares beyond that. A common element d counts at most w / (W + what the other has alone)."""
    def w(side, c):
        return F.col(f"{side}.{c}")

    def shared(a):
        return w(a, "_w") - w(a, "_u")

    def common(a, b):
        m = w(a, "_m")
        plain = F.least(shared(a), m * shared(b))
        split = F.least(w(a, "_c"), m * w(b, "_c")) + F.least(shared(a) - w(a, "_c"), m * (shared(b) - w(b, "_c")))
        return F.least(plain, F.coalesce(split, plain))  # no head: split is null

    def half(a, b):
        return common(a, b) / (w(a, "_w") + F.greatest(w(b, "_u"), w(b, "_w") - common(b, a)) / w(b, "_m"))

    return F.least(half(x, y), half(y, x))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with their exact probability Jaccard ``sim`` and the weight that each
    has in common with the other (``ca``, ``cb``)."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("_codes").alias("_ca"), F.col("_counts").alias("_na"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("_codes").alias("_cb"), F.col("_counts").alias("_nb"))

    def compare(batches):
        for batch in batches:
            a, b, *cols = batch.columns
            views = [(c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in cols]
            out = np.zeros((3, batch.num_rows))
            for i in range(batch.num_rows):
                ca, na, cb, nb = (v[o[i]:o[i + 1]] for v, o in views)
                out[:, i] = probability_jaccard(ca, shingle_weight(na), cb, shingle_weight(nb))
            yield pa.RecordBatch.from_arrays([a, b, *map(pa.array, out)], names=["a", "b", "sim", "ca", "cb"])

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "_ca", "_na", "_cb", "_nb")
    return both.mapInArrow(compare, "a long, b long, sim double, ca double, cb double")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b): node, label (least node). Labels spread to
    neighbours and jump to their label's label; each round is a written table."""
    e = materialize(edges.union(edges.select("b", "a")).distinct().toDF("a", "b"), "edges")
    labels = e.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = materialize(labels.select("node", "label", F.lit(True).alias("_moved")), "labels")
    while labels.where("_moved").limit(1).count():
        near = (e.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near")))
        new = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        up = labels.select(F.col("node").alias("_new"), F.col("label").alias("_up"))
        jump = F.least(F.col("_new"), F.coalesce("_up", F.col("_new")))
        labels = materialize(new.join(up, "_new", "left").select("node", jump.alias("label"), (jump != F.col("_old")).alias("_moved")), "labels")
    return labels.select("node", "label")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: doc_id, class_id (least doc_id of an equal text), group_id
    (least doc_id of the connected near-duplicates), kept (true for that document).

    Shingles are runs of five words (ASCII white space separates words), weighted 1 + ln(count);
    documents are linked at an exact probability Jaccard of 0.8 or more, and a group is what links
    connect. Exact copies become a class first, so a class of any size is one row from then on.

    Documents that share a band bucket are candidates. The one that shares most of its weight
    with others (near copies: the one closest to their common source) is compared with the rest
    of its bucket, as many pairs as members, and what is connected so far is computed. A
    document whose own weight rules out every partner in the bucket by :func:`pair_bound` is
    out. After ``star_rounds`` such rounds the pairs that remain possible between different
    components are all compared. No link between candidates is lost, no cap holds, and pairs
    inside a component, or pairs that the bound excludes, are not made.

    A text, not a doc_id, is what is compared: rows that share a doc_id but no text are linked
    only by their own likeness, and rows with a null doc_id link and stand for texts as others do.
    Of a group, the rows with the least doc_id are kept, of several such texts the one of the least
    hash. A null text is empty. Texts without words (empty, white space) have no shingles: they
    are near only to equal texts. For a row with a null doc_id, class_id and group_id are null and
    kept is true (:func:`keep_one_of_each` drops it where another row stands for its group). An
    empty table gives no rows; other columns are ignored.
    """
    sig, groups = _grouped(docs, **options)
    named = (sig.where(F.col("doc_id").isNotNull()).join(groups, "_text_hash")
             .select("doc_id", "class_id", "group_id", (F.col("_stands") & (F.col("doc_id") == F.col("group_id"))).alias("kept")))
    none = F.lit(None).cast("long")
    return named.unionByName(sig.where(F.col("doc_id").isNull()).select(
        "doc_id", none.alias("class_id"), none.alias("group_id"), F.lit(True).alias("kept")))


def _grouped(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = BAND_ROWS,
             star_rounds: int = STAR_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The rows' doc_id and _text_hash, and for each text its class_id and group_id (null where no
    row of the class or group has a doc_id) and whether it ``_stands`` for its group."""
    ship_code(docs.sparkSession)
    sig = materialize(signatures(docs, bands, rows), "signatures")
    classes = materialize(sig.groupBy("_text_hash").agg(F.min("doc_id").alias("_least"), F.first("_bands").alias("_bands"))
                          .withColumn("_class", F.monotonically_increasing_id()), "classes")
    slots = classes.select("_class", F.posexplode("_bands").alias("_band", "_key"))
    shared = (slots.groupBy("_band", "_key").agg(F.min("_class").alias("_low"), F.max("_class").alias("_high"))
              .where("_low < _high").select("_band", "_key"))
    members = materialize(slots.join(shared, ["_band", "_key"]), "buckets")
    wanted = classes.drop("_bands").join(members.select("_class").distinct(), "_class")
    sets = materialize(shingle_sets(docs, wanted), "shingle-sets")
    weights = materialize(set_weights(sets), "set-weights")
    members = materialize(members.join(weights, "_class"), "bucket-members")
    least = similarity - 1e-9

    tried = labels = edges = None
    own = ["_class", "_w", "_u", "_m", "_c", "label"]
    cleanest = F.struct((F.col("_u") / F.col("_w")).alias("_own"), *own)
    members = members.withColumn("_c", F.lit(None).cast("double"))
    for turn in range(star_rounds + 1):
        if labels is None:
            m = members.withColumn("label", F.col("_class"))
        else:
            m = members.join(labels.withColumnRenamed("node", "_class"), "_class", "left")
            m = m.withColumn("label", F.coalesce("label", F.col("_class")))
        # x can have a partner y of another component only if W_y is small enough for x's own weight
        reach = similarity ** -1 * F.col("_most") * (F.col("_w") - F.col("_u")) - F.col("_u") / F.col("_m")
        bounds = m.groupBy("_band", "_key").agg(F.min("_w").alias("_light"), F.max("_m").alias("_most"))
        m = m.join(bounds, ["_band", "_key"]).where(F.col("_light") <= reach + 1e-6).drop("_light", "_most")
        heads = m.groupBy("_band", "_key").agg(F.min(cleanest).alias("_head"), F.min("label").alias("_min"),
                                               F.max("label").alias("_max")).where("_min < _max").drop("_min", "_max")
        m = materialize(m.join(heads, ["_band", "_key"]), "open-buckets")
        if turn == 0:
            pairs = m.select(F.col("_head").alias("x"), F.struct(*own).alias("y")).where("x._class <> y._class")
        else:
            last, fields = turn == star_rounds, own
            if last:
                m, fields = m.join(classes.select("_class", "_bands"), "_class"), [*own, "_bands"]
            rest = m.where(F.col("label") != F.col("_head.label"))
            if last:
                x = rest.select("_band", "_key", F.struct(*fields).alias("x"))
            else:
                x = rest.groupBy("_band", "_key").agg(F.min(cleanest).alias("x"))
            possible = (F.col("x.label") != F.col("y.label")) & (pair_bound("x", "y") >= least)
            if last:  # a pair is made in the first band that it shares; a bound that excludes it there holds
                possible &= F.expr("array_position(transform(x._bands, (k, i) -> k = y._bands[i]), true) = _band + 1")
            pairs = x.join(m.select("_band", "_key", F.struct(*fields).alias("y")), ["_band", "_key"]).where(possible)
        pairs = pairs.select(F.least("x._class", "y._class").alias("a"), F.greatest("x._class", "y._class").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = materialize(compared(pairs, sets), "compared-pairs")
        if turn == 0:  # from here on, what each member has in common with its bucket's head
            head = F.col("_head._class")
            stars = found.select("a", "b", "ca", "cb")
            members = m.select("_band", "_key", "_class", "_w", "_u", "_m", head.alias("_h0"),
                               F.least("_class", head).alias("a"), F.greatest("_class", head).alias("b"))
            members = materialize(
                members.join(stars, ["a", "b"], "left")
                .withColumn("_c", F.when(F.col("_class") == F.col("_h0"), F.col("_w") - F.col("_u"))
                            .otherwise(F.when(F.col("_class") == F.col("a"), F.col("ca")).otherwise(F.col("cb"))))
                .select("_band", "_key", "_class", "_w", "_u", "_m", "_c"), "starred-members")
        found = found.where(F.col("sim") >= similarity - 1e-12).select("a", "b")
        if turn and not found.limit(1).count():
            continue
        edges = found if edges is None else edges.unionByName(found)
        labels = components(edges)
    own = classes.select("_text_hash", "_least", "_class").join(labels.withColumnRenamed("node", "_class"), "_class", "left")
    own = own.withColumn("label", F.coalesce("label", "_class"))
    stands = own.groupBy("label").agg(F.min(F.struct(F.col("_least").isNull().alias("_none"), "_least", "_text_hash")).alias("_rep"))
    groups = own.join(stands, "label").select(
        "_text_hash", F.col("_least").alias("class_id"), F.col("_rep._least").alias("group_id"),
        (F.col("_rep._text_hash") == F.col("_text_hash")).alias("_stands"))
    return sig.select("doc_id", "_text_hash"), materialize(groups, "groups")


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without all but one, the least doc_id, of each near-duplicate group; columns
    as in the input. Of rows that repeat that document one stays (the least in its columns' order).
    Rows with a null doc_id are members like others; one stays where its group has no doc_id. No
    row goes whose text isn't in the group of a row that stays."""
    kept = _grouped(docs, **options)[1].where("_stands").select(F.col("_text_hash").alias("_kh"), F.col("class_id").alias("_kd"))
    others = [c for c in docs.columns if c != "doc_id"]
    rows = docs.select("doc_id", text_hash().alias("_kt"), F.struct(*others).alias("_row"))
    chosen = rows.join(kept, (F.col("_kt") == F.col("_kh")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_kd")), "left_semi")
    one = chosen.groupBy("doc_id", "_kt").agg(F.min("_row").alias("_row"))
    return one.select(*[F.col("doc_id") if c == "doc_id" else F.col("_row").getField(c).alias(c) for c in docs.columns])
