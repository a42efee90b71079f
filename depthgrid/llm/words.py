"""Word and shingle hashes of whole text batches, in numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Its hash is a
polynomial over its bytes modulo 2**64, mixed; a shingle's hash is the same over word hashes.
Texts are read in slices of a few MB, so memory follows the slice or the longest text, never
the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, so equal results mean equal inputs."""
    x = values.astype(_U64, copy=True)
    x ^= x >> _U64(31)
    x *= _U64(0x7FB5D329728EA185)
    x ^= x >> _U64(27)
    x *= _U64(0x81DADEF4BC2DD44D)
    x ^= x >> _U64(33)
    return x


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U64))[_LOWER]
_PLACE = mix(np.arange(1001, 1001 + SHINGLE_WORDS, dtype=_U64)) | _U64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, _U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, BLOCK_BYTES + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the offsets of its rows."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def _block_words(data, fixed, begin, end, separator, prefixes):
    """Start, end and hashes of the words in data[begin:end]; no word crosses its borders."""
    part = data[begin:end]
    word = ~separator[part]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inside = fixed[(fixed > begin) & (fixed < end)] - begin
    first[inside] = word[inside]
    last[inside - 1] = word[inside - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = len(part)
    up, down = (_UP, _DOWN) if size <= BLOCK_BYTES else (
        _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1)
    )
    total = np.zeros(size + 1, _U64)
    np.cumsum(_BYTE_VALUE[part] * up[:size], out=total[1:])
    out = [starts + begin, ends + begin, mix((total[ends] - total[starts]) * down[starts])]
    for k in prefixes:
        upto = np.minimum(starts + k, ends)
        out.append(mix((total[upto] - total[starts]) * down[starts] + _U64(k)))
    return out


def word_hashes(column: pa.Array, separator: np.ndarray = _SEPARATOR, prefixes: tuple = ()):
    """(starts, ends, hashes, bounds): words of all rows; row i has words bounds[i]:bounds[i+1].

    ``separator`` tells for each byte whether it parts words. For each length in ``prefixes``
    one more array follows, the hashes of the words' first so many bytes.
    """
    data, offsets = text_bytes(column)
    fixed = np.unique(offsets)
    parts, begin = [], 0
    while begin < len(data):
        end = min(begin + BLOCK_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(separator[data[begin:end]])
            row = fixed[(fixed > begin) & (fixed <= end)]
            cut = max(begin + int(gaps[-1]) + 1 if len(gaps) else 0, int(row[-1]) if len(row) else 0)
            while cut <= begin:  # one word longer than a block
                more = np.flatnonzero(separator[data[end : end + BLOCK_BYTES]])
                row = fixed[fixed > end]
                stop = min(end + BLOCK_BYTES, len(data))
                found = [end + int(more[0]) + 1] if len(more) else []
                found += [int(row[0])] if len(row) and row[0] <= stop else []
                cut, end = (min(found) if found else len(data) if stop == len(data) else 0), stop
            end = cut
        parts.append(_block_words(data, fixed, begin, end, separator, prefixes))
        begin = end
    if parts:
        starts, ends, *hashes = (np.concatenate(x) for x in zip(*parts))
    else:
        starts = ends = np.zeros(0, np.int64)
        hashes = [np.zeros(0, _U64)] * (1 + len(prefixes))
    bounds = np.searchsorted(starts, offsets)
    return starts, ends, hashes[0], bounds, *hashes[1:]


def shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of each row's shingles in text order, repeats included.

    A row of one to four words has one shingle, all its words; a row without words has none.
    """
    words = np.diff(bounds)
    counts = np.where(words >= SHINGLE_WORDS, words - SHINGLE_WORDS + 1, np.minimum(words, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(words)), counts)
    at = bounds[row] + np.arange(out_bounds[-1]) - out_bounds[row]
    padded = np.concatenate([hashes, np.zeros(SHINGLE_WORDS, _U64)])
    span = np.minimum(words[row], SHINGLE_WORDS)
    value = span.astype(_U64)
    for k in range(SHINGLE_WORDS):
        value += np.where(k < span, padded[at + k] * _PLACE[k], _U64(0))
    return mix(value), out_bounds


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Each row's distinct shingle hashes, sorted as unsigned numbers."""
    _, _, hashes, bounds = word_hashes(column)
    values, ends = shingles(hashes, bounds)
    return [np.unique(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def list_column(rows: list[np.ndarray]) -> pa.Array:
    """Rows of 64-bit values as an Arrow list<int64> column."""
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, _U64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(_U64).view(np.int64)))
