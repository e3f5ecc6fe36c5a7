"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks [native]."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import materialize, ordered, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
#: Buckets of the seeded order inside a source, so that a hot source is many groups.
ORDER_BITS = 10
#: Blocks are smaller than asked for where the mix would have fewer than so many.
LEAST_BLOCKS = 256


def sized_documents(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size in words, the seeded place ``_h`` and a 128-bit hash ``_m`` of the text of each document."""
    crc = F.crc32(text_or_empty().cast("binary"))
    # "0" + source, or "1" for null: code-point order with null last
    key = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    return docs.select("doc_id", key.alias("_k"), F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                       crc.alias("_crc"), F.md5(text_or_empty().cast("binary")).alias("_m"),
                       F.xxhash64(F.lit(seed), F.col("doc_id"), crc, key).alias("_h"))


def source_targets(sources: DataFrame, weights=(1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Target words of each source (``_k``, ``_s``): all words are shared by weight, no source
    above ``max_repeat`` times its size; what is over goes to the others by weight again.

    Sources weigh 1, 2, 3, 1, ... in code-point order, null last. Each round fetches three
    numbers; rounds end when no further source reaches its limit.
    """
    s = ordered(sources, ["_k"], (), "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_row") % len(weights) + 1).cast("int"))
    s = materialize(s.select("_k", "_s", F.col("_row").alias("_rank"), w.alias("_w"),
                             (F.col("_s") * max_repeat).cast("double").alias("_cap")), "source-weights")
    total = float(s.agg(F.coalesce(F.sum("_s"), F.lit(0))).first()[0])
    level, full = 0.0, -1
    while True:
        capped = F.col("_cap") <= F.col("_w") * level
        n, taken, rest = s.agg(F.count(F.when(capped, 1)), F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)),
                               F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0.0))).first()
        if n == full or rest == 0:
            break
        level, full = (total - taken) / rest, n
    return s.withColumn("target", F.least(F.col("_cap"), F.col("_w") * F.lit(level)))


def block_size(targets: DataFrame, block_tokens: int) -> int:
    """``block_tokens``, or what gives a small mix ``LEAST_BLOCKS`` blocks: one of a few words has its share, too."""
    total = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    return max(1, min(block_tokens, int(total / LEAST_BLOCKS)))


def shard_quotas(targets: DataFrame, block_tokens: int = 64, shards: int = 8) -> DataFrame:
    """Blocks of each source in each shard: ``_k``, ``mix_shard``, ``quota`` (integers).

    Shard k takes the awards that Sainte-Laguë (highest quotients t / (2j - 1)) makes after
    those of shards before it; as the method is house-monotone no quota is negative. Every
    source surely holds the awards of a divisor a little too large, so that only the few
    quotients between two close divisors are ranked, however many blocks there are. Equal
    quotients go to the earlier source.
    """
    live = targets.where("target > 0")
    total, n = live.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count(F.lit(1))).first()
    blocks = int(round(total / block_tokens))
    houses = [(k, blocks * k // shards) for k in range(1, shards + 1)]
    rows = F.array(*[F.struct(F.lit(k).alias("_shard"), F.lit(b).cast("long").alias("_blocks")) for k, b in houses])
    t = live.select("*", F.inline(rows))
    share = F.col("target") / F.lit(total or 1.0)
    low = F.greatest(F.lit(0), F.floor(share * (F.col("_blocks") - n / 2) + 0.5) - 1).cast("long")
    high = (F.floor(share * (F.col("_blocks") + n / 2) + 0.5) + 1).cast("long")
    t = materialize(t.select("_k", "_rank", "target", "_shard", "_blocks", low.alias("_low"), high.alias("_high")), "quota-bounds")
    sure = t.groupBy("_shard").agg((F.first("_blocks") - F.sum("_low")).alias("_open"))
    q = (t.select("_k", "_rank", "_shard", "target", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j"))
         .select("_k", "_rank", "_shard", (F.col("target") / (2 * F.col("_j") - 1)).alias("_quotient")))
    q = ordered(q, [F.col("_shard"), F.col("_quotient").desc(), F.col("_rank")], (), "quotients")
    starts = q.groupBy("_shard").agg(F.min("_row").alias("_start"))
    won = (q.join(F.broadcast(starts.join(sure, "_shard")), "_shard")  # a row for each shard
           .where(F.col("_row") - F.col("_start") < F.col("_open"))
           .groupBy("_k", "_shard").agg(F.count(F.lit(1)).alias("_won")))
    cumulative = (t.join(won, ["_k", "_shard"], "left")
                  .select("_k", "_shard", (F.col("_low") + F.coalesce("_won", F.lit(0))).alias("_q")))
    earlier = F.lag("_q", 1, 0).over(Window.partitionBy("_k").orderBy("_shard"))
    return cumulative.select("_k", F.col("_shard").alias("mix_shard"), (F.col("_q") - earlier).alias("quota"))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), max_repeat: int = 3, block_tokens: int = 64,
                shards: int = 8, seed: int = 17) -> DataFrame:
    """Words the mix takes of every document: doc_id, size, source_size, target, taken.

    A source's documents stand one after another in a seeded order, and its quota, blocks of
    ``block_tokens`` words (fewer in a mix too small for ``LEAST_BLOCKS`` of them), is read from that stream, again from the start after its end, so
    the words of a document that the mix takes are its overlap with the blocks read. A source
    is read ``max_repeat`` times at most, hence no document more often. The running sum
    inside a source is taken in 1024 buckets of the seeded order and completed by bucket
    totals, so a source with a third of all rows is no single task. Same input, same result.

    A null text has 0 words and nothing is taken of it; null sources are one source, the last.
    Null or repeated doc_ids are rows like others. Equal places in the seeded order need
    equal doc_id and text: such rows are interchangeable. Other columns are ignored.
    """
    base = materialize(sized_documents(docs, seed), "mix-documents")
    sources = base.groupBy("_k").agg(F.sum("size").alias("_s"))
    targets = source_targets(sources, weights, max_repeat)
    block_tokens = block_size(targets, block_tokens)
    quotas = (shard_quotas(targets, block_tokens, shards).groupBy("_k")
              .agg((F.sum("quota") * block_tokens).alias("_quota")))
    plan = targets.join(quotas, "_k", "left").select(
        "_k", "_s", "target", F.least(F.coalesce("_quota", F.lit(0)), F.col("_s") * max_repeat).alias("_take"))
    b = base.withColumn("_b", F.shiftrightunsigned("_h", 64 - ORDER_BITS))
    totals = b.groupBy("_k", "_b").agg(F.sum("size").alias("_t"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_k", "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o")).join(plan, "_k")
    inside = (Window.partitionBy("_k", "_b").orderBy("_h", "doc_id", "_m", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    t = b.withColumn("_i", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["_k", "_b"])
    whole, start = F.expr("if(_s = 0, 0, _take div _s)"), F.col("_i") + F.col("_o")
    rest = F.expr("if(_s = 0, 0, _take % _s)")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return t.select("doc_id", "size", F.col("_s").alias("source_size"), "target", taken.cast("long").alias("taken"),
                    F.expr("if(_k = '1', null, substr(_k, 2))").alias("source"), F.col("_crc").alias("text_crc32"), F.col("_m").alias("text_md5"))


def take_words(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each is repeated whole as often as its taken words hold it, and
    what is left over is a row with that many of its first words (joined by single spaces);
    documents of which nothing is taken go. Columns as in the input.

    Rows equal in doc_id, text and source count as one document with their words together.
    A source ends inside one document at most, so partial rows are as few as sources. The
    texts are shuffled once, by document.
    """
    d, k = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1"))
    key = ["_d", "_k", "_m"]
    taken = (mix_sources(docs, **options).select(d.alias("_d"), k.alias("_k"), F.col("text_md5").alias("_m"), "size", "taken")
             .groupBy(*key).agg(F.max("size").alias("_size"), F.sum("taken").alias("_taken")).where("_taken > 0"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(d.alias("_d"), k.alias("_k"), F.md5(text_or_empty().cast("binary")).alias("_m"), "text",
                       F.struct(*others).alias("_rest"))
    # one row a key, chosen in each task before the shuffle: a document that repeats is no hot key;
    # rows that differ in another column only are told apart by a hash of those, so reruns agree
    one = Window.partitionBy(*key).orderBy(F.col("text").isNull(), F.xxhash64(F.to_json("_rest")))
    both = rows.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").join(taken, key)
    copies = F.expr("sequence(1, cast((_taken + _size - 1) div _size as int))")
    both = both.withColumn("_copy", F.explode(copies))
    left = (F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")).cast("int")
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), left), " ")
    text = F.when(left >= F.col("_size"), F.col("text")).otherwise(first)
    return both.select(*[text.alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns])
