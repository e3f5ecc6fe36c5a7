"""Word and shingle codes of whole Arrow string columns, computed by numpy on the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII white space separates words, as in ``[^\\x20\\x09-\\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

#: Texts are worked on in slices of about this many bytes; one longer text is a slice.
SLICE_BYTES = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection on 64-bit integers with well spread bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * SLICE_BYTES:  # tables for one very long text aren't kept
            _POWERS[name] = have
    return have[:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of slices of a string column; null is empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the document (row) of each."""
    solid = ~SPACE[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[inner]
    stops[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of byte spans: equal bytes, equal code (polynomial, then mixed)."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers("down", _UNBASE, n + 1)[starts])


def shingle_codes(codes: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of ``k`` words of each document, and their document. A document of
    1 to k-1 words has one shingle, all its words; one without words has none."""
    n = len(codes)
    counts = np.bincount(doc, minlength=n_docs)
    last = np.cumsum(counts)
    end = last[doc]
    at = np.arange(n)
    mult = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        m = n - j
        if m <= 0:
            break
        term = codes[j:] * mult[j]
        total[:m] += np.where(at[:m] + j < end[:m], term, np.uint64(0))
    keep = (at + k <= end) | (at == end - counts[doc])
    return mix(total[keep]), doc[keep]


def counted(codes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes (48 bits) of each document, sorted, with their document and count."""
    if n_docs > 1 << 15:
        raise ValueError("too many documents in a slice")
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (codes >> np.uint64(16)))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    weight = np.diff(np.append(at, len(key)))
    key = key[at]
    return key & np.uint64((1 << 48) - 1), (key >> np.uint64(48)).astype(np.int64), weight
