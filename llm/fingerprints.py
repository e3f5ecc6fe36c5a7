"""Order MinHash document fingerprints [native]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import let, text_or_empty

#: Words of a k-mer, k-mers of a tuple, and tuples (registers) of a fingerprint.
KMER_WORDS, TUPLE, REGISTERS = 3, 2, 64
#: A token is a run of non-space characters, cut after this many.
TOKEN_CHARS = 32
#: Bits of a token's place in its text, and hex digits of a register.
PLACE_BITS, DIGITS = 26, 4

_PLACE = (1 << PLACE_BITS) - 1


def _bits(c: Column, mask: int) -> Column:
    return c.bitwiseAND(F.lit(mask).cast("long"))


def _run_starts(codes: Column, shift: int) -> Column:
    """Indices at which the sorted ``codes``, without their low ``shift`` bits, change."""
    return F.filter(F.sequence(F.lit(0), F.size(codes) - 1),
                    lambda i: (i == 0) | (F.shiftright(F.get(codes, i), shift) != F.shiftright(F.get(codes, i - 1), shift)))


def kmer_codes(text: Column) -> Column:
    """64-bit codes of the runs of ``KMER_WORDS`` tokens; a shorter text is one run."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(rf"\S{{1,{TOKEN_CHARS}}}"), F.lit(0)), lambda t: F.xxhash64(t))
    return let(tokens, lambda t: F.when(F.size(t) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(t) - KMER_WORDS)),
                    lambda i: F.xxhash64(*[F.get(t, i + j) for j in range(KMER_WORDS)]))))


def numbered(kmers: Column) -> Column:
    """Occurrence-numbered k-mers: register (6 bits), order value (31 bits) and place (26 bits).

    Codes with their places are sorted, so equal k-mers stand together in text order. The first
    of each run has number 0; the others, few in most texts, are numbered inside their runs."""
    def same(s, i):
        return F.shiftright(F.get(s, i), PLACE_BITS) == F.shiftright(F.get(s, i - 1), PLACE_BITS)

    def element(v, n):
        g = F.xxhash64(F.shiftright(v, PLACE_BITS), n)
        return _bits(F.shiftrightunsigned(g, 1), ~_PLACE).bitwiseOR(_bits(v, _PLACE))

    def repeats(s):
        return let(F.filter(s, lambda v, i: F.coalesce(same(s, i), F.lit(False))), lambda d: F.when(
            F.size(d) == 0, F.array().cast("array<bigint>")).otherwise(let(_run_starts(d, PLACE_BITS), lambda starts: F.flatten(
                F.transform(starts, lambda start, r: F.transform(
                    F.slice(d, start + 1, F.coalesce(F.get(starts, r + 1), F.size(d)) - start),
                    lambda v, n: element(v, n + 1)))))))

    placed = F.sort_array(F.transform(kmers, lambda h, i: _bits(h, ~_PLACE).bitwiseOR(i.cast("long"))))
    return let(placed, lambda s: F.sort_array(F.concat(
        F.transform(F.filter(s, lambda v, i: ~F.coalesce(same(s, i), F.lit(False))), lambda v: element(v, F.lit(0))),
        repeats(s))))


def _sparse(elements: Column, register: Column) -> Column:
    """The first ``TUPLE`` elements in the order of a register that few elements fall into: those
    in it first, then all others by a hash of their own for this register."""
    low = _bits  # value and place, or 2^31 + hash and place
    keyed = F.transform(elements, lambda e: F.when(
        F.shiftright(e, 31 + PLACE_BITS) == register, low(e, (1 << (31 + PLACE_BITS)) - 1)).otherwise(
        F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.shiftright(e, PLACE_BITS), register), 33)
                    .bitwiseOR(F.lit(1 << 31).cast("long")), PLACE_BITS).bitwiseOR(low(e, _PLACE))))
    return F.slice(F.sort_array(keyed), 1, TUPLE)


def fingerprint(text: Column) -> Column:
    """Order MinHash fingerprint of a text: ``REGISTERS`` hashes of ``DIGITS`` hex digits.

    Every register has its own total order of occurrence-numbered k-mers, takes the least
    ``TUPLE``, puts them back into text order and hashes the tuple, so that two texts agree in a
    register as often as they share k-mers in the same order. A hash sends each numbered k-mer to
    one register, where it goes by its value; all that fall elsewhere come after, by a second
    hash. So a long text is read once for all registers, and only registers that fewer than
    ``TUPLE`` k-mers fall into look at the others. A text with fewer k-mers than a tuple takes all
    it has; one without words is all zeros.
    """
    def register_hash(kmers, elements, starts, heads, b):
        at = F.array_position(heads, b).cast("int")  # from 1; 0: none fell here
        start = F.get(starts, at - 1)
        count = F.when(at == 0, F.lit(0)).otherwise(F.coalesce(F.get(starts, at), F.size(elements)) - start)
        chosen = F.when(count >= TUPLE, F.slice(elements, start + 1, F.lit(TUPLE))).otherwise(_sparse(elements, b))
        places = F.sort_array(F.transform(chosen, lambda e: _bits(e, _PLACE)))
        code = F.xxhash64(F.transform(places, lambda p: F.get(kmers, p.cast("int"))))
        return F.lpad(F.hex(_bits(code, 16 ** DIGITS - 1)), DIGITS, "0")

    def registers(kmers):
        return let(numbered(kmers), lambda e: let(_run_starts(e, 31 + PLACE_BITS), lambda starts: let(
            F.transform(starts, lambda i: F.shiftright(F.get(e, i), 31 + PLACE_BITS)), lambda heads: F.array_join(
                F.transform(F.sequence(F.lit(0).cast("long"), F.lit(REGISTERS - 1).cast("long")),
                            lambda b: register_hash(kmers, e, starts, heads, b)), ""))))

    return let(kmer_codes(text), lambda k: F.when(F.size(k) == 0, F.lit("0" * (REGISTERS * DIGITS))).otherwise(registers(k)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the registers in which two fingerprints agree."""
    same = F.filter(F.sequence(F.lit(0), F.lit(REGISTERS - 1)), lambda i: (
        F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS))))
    return F.size(same) / F.lit(float(REGISTERS))


def _numbers(values: list[int]) -> Column:
    """A constant array, folded from one short expression however many numbers there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bounds_below(bounds: list[int], key: Column) -> Column:
    """How many of the sorted ``bounds`` are less than ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    table = _numbers(bounds)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(
        F.get(table, n + s - 1) < key, n + s).otherwise(n))


def with_next(docs: DataFrame, key: str, carried: list[str], tie: str, buckets: int) -> DataFrame:
    """Each row with ``_next_c``, the value of c in the next row by descending ``key`` (after the last:
    in the first). Rows are dealt into ranges of the key; the first row of each range also
    goes to the range before it, so every range finds its last row's next one by itself."""
    bounds = sorted({int(b) for b in docs.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.2 / buckets)})
    place = bounds_below(bounds, F.col(key))
    firsts = dict(docs.groupBy(place.alias("_b")).agg(F.max(key)).collect())  # a row for each range
    used = sorted(firsts)
    if not used:
        return docs.select("*", *[F.col(c).alias(f"_next_{c}") for c in carried])
    following = dict(zip(used, used[1:] + used[:1]))
    first = _numbers([firsts.get(b, 0) for b in range(len(bounds) + 1)])  # of unused ranges no row asks
    above = _numbers([following.get(b, 0) for b in range(len(bounds) + 1)]).cast("array<int>")
    homes = let(place, lambda p: F.filter(
        F.array(F.struct(p.alias("b"), F.lit(False).alias("copy")),
                F.struct(F.when(F.get(first, p) == F.col(key), F.get(above, p)).alias("b"), F.lit(True).alias("copy"))),
        lambda h: h["b"].isNotNull()))
    rows = docs.withColumn("_home", F.explode(homes)).select("*", "_home.b", "_home.copy").drop("_home")
    order = Window.partitionBy("b").orderBy("copy", F.col(key).desc(), tie)
    rows = rows.select("*", *[F.lead(c).over(order).alias(f"_next_{c}") for c in carried])
    return rows.where(~F.col("copy")).drop("b", "copy")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last third of its code points (rounded down) replaced by as many
    first ones, or all, of the next document's text, by descending doc_id, the first after the
    last. Texts are shuffled once, with their fingerprints, into ranges of doc_id.

    A null text is empty and has the fingerprint of zeros. Null doc_ids come last. Rows of
    equal doc_id follow each other in their texts' order; wholly equal rows are interchangeable.
    A single document's next one is itself. An empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), text_or_empty().alias("text"))
    own = ids.withColumn("fingerprint", fingerprint(F.col("text")))
    t = with_next(own, "_id", ["text", "fingerprint"], "text", buckets)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("_next_text", F.lit(1), cut))
    t = t.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "_next_fingerprint", edited.alias("_edited"))
    t = t.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint",
                 fingerprint(F.col("_edited")).alias("edited_fingerprint"), "_next_fingerprint")
    return t.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("_next_fingerprint")).alias("near_next"))
