"""Packing documents into token windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import base64
import heapq
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import materialize, ship_code

#: Id that ends every document.
END_ID = 1
#: Longest piece of a document's last, partial window.
PIECE_TOKENS = 512
#: Windows and pieces that one differencing task aims at.
BATCH_WINDOWS, BATCH_PIECES = 96, 4096

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _encoder(ranks_path: str):
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_ranks_path() -> str:
    """The ranks of ``byte_bpe_50k.json``: the same vocabulary, ids and merges."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cut_points(n: int, window: int, piece: int) -> list[tuple[int, int]]:
    """Pieces (start, length) of a document of ``n`` ids: whole windows, then the rest in
    pieces of at most ``piece`` ids."""
    whole = n // window * window
    cuts = [(s, window) for s in range(0, whole, window)]
    return cuts + [(s, min(piece, n - s)) for s in range(whole, n, piece)]


def token_pieces(docs: DataFrame, window: int = 2048, piece: int = PIECE_TOKENS,
                 ranks_path: str | None = None) -> DataFrame:
    """Tokenize every whole text and cut it: one row for each piece. Ids stay in the task;
    only their CRC-32 leaves it."""
    ship_code(docs.sparkSession)
    path = ranks_path or default_ranks_path()

    def run(batches):
        enc = _encoder(path)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            ids_col = batch.column(0).to_pylist()
            texts = batch.column(1)
            for i, doc_id in enumerate(ids_col):
                ids = enc.encode_ordinary(texts[i].as_py() or "")
                ids.append(END_ID)
                n = len(ids)
                raw = memoryview(np.array(ids, dtype="<u4").tobytes())
                for start, length in cut_points(n, window, piece):
                    for col, v in zip(rows, (doc_id, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), n)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def difference(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: partial partitions, each a vector of ``ways`` sums, of which the two of
    largest spread are merged, the fullest part of one with the emptiest of the other, until
    one is left. Gives the indices in each part."""
    if ways == 1:
        return [list(range(len(sizes)))]
    heap: list = []
    for i, s in enumerate(sizes):
        sums = np.zeros(ways, dtype=np.int64)
        sums[-1] = s
        heap.append((-s, i, sums, [[] for _ in range(ways - 1)] + [[i]]))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]  # both ascending
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        joined = [x + y if x and y else x or y for x, y in zip(in_a, reversed(in_b))]
        sums -= sums[0]
        heapq.heappush(heap, (-int(sums[-1]), serial, sums, [joined[j] for j in order]))
        serial += 1
    return heap[0][3]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of at most ``capacity`` each: as few windows as the total needs, one more
    whenever differencing leaves a part above the capacity."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = difference(sizes, ways)
        if max(sum(sizes[i] for i in p) for p in parts) <= capacity:
            return [p for p in parts if p]
        ways += 1


def pack_documents(docs: DataFrame, window: int = 2048, piece: int = PIECE_TOKENS,
                   ranks_path: str | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids: one row for each piece with
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's whole windows are sequences of their own; the rest, in pieces of at most
    ``piece`` ids, is dealt at random into batches of some ``BATCH_WINDOWS`` windows, and each
    batch is partitioned by multiway differencing. Batches are bounded in ids and pieces
    whatever the corpus holds, so no source or copy group meets in one task. Padding: a
    batch's windows are near equal, and some percent of one window a batch is lost.

    A null or empty text is the end id alone. Repeated rows and null doc_ids are packed row by
    row. An empty table gives no rows. Other columns are ignored.
    """
    pieces = materialize(token_pieces(docs, window, piece, ranks_path), "pieces")
    t = pieces.withColumn("_rid", F.monotonically_increasing_id())
    whole = (t.where(F.col("length") == window)
             .select(*pieces.columns, (F.col("_rid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    part = t.where(F.col("length") < window)
    ids, n = pieces.where(F.col("length") < window).agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    batches = max(1, round(ids / (window * BATCH_WINDOWS)), -(-n // BATCH_PIECES))
    # rows dealt one after another in a hashed order of the written table
    part = part.withColumn("_batch", F.pmod(F.xxhash64("_rid"), F.lit(batches)))
    columns = pieces.columns

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("_rid")
        sizes = t["length"].to_numpy()
        seq, off = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        first = t["_batch"][0].as_py() << 24
        for k, members in enumerate(pack_sizes(sizes.tolist(), window)):
            members.sort()
            seq[members] = (first + k) * 2 + 1
            off[members] = np.cumsum(sizes[members]) - sizes[members]
        return t.select(columns).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    packed = (part.select("_batch", "_rid", *columns).groupBy("_batch")
              .applyInArrow(pack, PIECES + ", sequence_id long, offset long"))
    return whole.unionByName(packed)
