"""Passages that repeat across documents, by a sparse suffix array over words.

1. Of every WINDOW consecutive GRAM-word hashes the smallest marks its position. So each stretch of
   MIN_WORDS words holds a mark among its first WINDOW words, which depends on its words alone: equal
   stretches have the same words marked. The suffixes at the marks form the array; those whose first
   CORE words occur once in the corpus are dropped (a map-side combined count).
2. A suffix carries a hash of its CORE words and SIDE words more on either side, three bytes of the
   hash of each. A stretch that begins o words left of the mark is the core, o words to the left and
   SIDE - o to the right of it, so two suffixes of one core share it if what they have in common to
   the left is o words or more, and to the right SIDE - o or more.
3. The suffixes are sorted over the whole cluster by core, words to the right and words to the left
   (range partitions by content, document and place, so that a passage in a third of all documents
   spreads over many tasks). Each is compared with its neighbours from other documents, which have
   most in common with it to the right, and matches are extended to the left. A second sort by core,
   words to the left and words to the right does the same the other way round. Rows at partition
   borders are compared in a second, small pass. In a run of one document all rows have the run's
   neighbours, so runs need not be held beyond their core.
4. By then each suffix knows the most it has in common with any other document on either side, and
   a span that neighbours confirm. Where the two sides come from different partners, a stretch that
   only a third one shares might reach further: the stretches in question are hashed to 96 bits and
   looked up among all suffixes of their cores.
5. Confirmed spans of a document are merged where they overlap or touch.

So every stretch is judged against all others, in no bounded group, and spans are those of the rule:
what is covered by stretches of MIN_WORDS words that another id has.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased, numbered from 0.

Defined cases: texts of fewer than MIN_WORDS words (null and empty ones too) have no spans; a
repeat inside one document alone is none; rows with a null id are left out; rows that share an id
are one document; a very long text gives its marks like any other, slice by slice; empty tables give
an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthgrid.llm import words
from depthgrid.llm.shared import BITMAP_BITS, bitmap, counted, mark, stored

MIN_WORDS, GRAM, WINDOW = 50, 8, 24
#: A mark is one of the first WINDOW words of its stretches, so they share this many from it on.
CORE = MIN_WORDS - WINDOW + 1
SIDE = MIN_WORDS - CORE
BYTES = 3

_U64 = np.uint64
_PLACE = words.mix(np.arange(5001, 5001 + GRAM, dtype=_U64)) | _U64(1)
_CORE_PLACE = words.mix(np.arange(6001, 6001 + CORE, dtype=_U64)) | _U64(1)
#: Two independent hashes of a stretch: factors of the core, the offset, words to the left and right.
_STRETCH = words.mix(np.arange(7001, 7001 + 2 * (2 + 2 * SIDE), dtype=_U64)).reshape(2, -1) | _U64(1)


def marks(hashes: np.ndarray) -> np.ndarray:
    """Places of the marked words of one text."""
    if len(hashes) < MIN_WORDS:
        return np.zeros(0, np.int64)
    count = len(hashes) - GRAM + 1
    grams = np.zeros(count, _U64)
    for k in range(GRAM):
        grams += hashes[k : k + count] * _PLACE[k]
    grams = words.mix(grams)
    rows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[: len(hashes) - MIN_WORDS + 1]
    return np.unique(rows.argmin(axis=1) + np.arange(len(rows)))


def _cores(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the CORE words from each position; a mark always has so many."""
    total = np.zeros(len(at), _U64)
    for k, factor in enumerate(_CORE_PLACE):
        total += hashes[at + k] * factor
    return words.mix(total).view(np.int64)


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, __at, __core) of every mark."""
    for batch in batches:
        for part in words.slices(batch, "__text"):
            _, _, hashes, bounds = words.word_hashes(part.column("__text"))
            places = [marks(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            owner = np.repeat(np.arange(len(places)), [len(p) for p in places])
            at = np.concatenate(places)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__id").take(pa.array(owner, pa.int64())),
                    pa.array(at.astype(np.int32)),
                    pa.array(_cores(hashes, at + bounds[owner])),
                ],
                ["__id", "__at", "__core"],
            )


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes, all of one width, as a binary column."""
    rows = np.ascontiguousarray(rows, np.uint8)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _side(codes: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Codes at the positions (one row of SIDE for each suffix), 0 outside the text, as bytes."""
    inside = (at >= low[:, None]) & (at < high[:, None])
    found = np.where(inside, codes[np.clip(at, 0, max(len(codes) - 1, 0))], 0).astype(np.uint32)
    return np.stack([found >> 16, found >> 8, found], axis=2).astype(np.uint8).reshape(len(at), -1)


_SUFFIX = ["__id", "__at", "__core", "__right", "__left"]


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the places of their marks to the suffixes there."""
    for batch in batches:
        for part in words.slices(batch, "__text"):
            _, _, hashes, bounds = words.word_hashes(part.column("__text"))
            codes = ((hashes >> _U64(40)) % _U64((1 << 24) - 1)).astype(np.uint32) + 1
            lists = part.column("__at")
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = bounds[owner] + lists.flatten().to_numpy(zero_copy_only=False)
            # Of rows that share an id, a shorter one may end before a longer one's marks.
            inside = at + CORE <= bounds[owner + 1]
            owner, at = owner[inside], at[inside]
            for lo in range(0, len(at), 1 << 15):
                piece = slice(lo, lo + (1 << 15))
                a, low, high = at[piece], bounds[owner[piece]], bounds[owner[piece] + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__id").take(pa.array(owner[piece], pa.int64())),
                        pa.array((a - low).astype(np.int32)),
                        pa.array(_cores(hashes, a)),
                        _binary(_side(codes, a[:, None] + CORE + np.arange(SIDE), low, high)),
                        _binary(_side(codes, a[:, None] - 1 - np.arange(SIDE), low, high)),
                    ],
                    _SUFFIX,
                )


def _slots(values: np.ndarray) -> np.ndarray:
    return words.mix(values.view(_U64)) & _U64(BITMAP_BITS - 1)


def _held(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit of each value is set: surely not, or maybe."""
    slot = _slots(values)
    return ((table[(slot >> _U64(6)).astype(np.int64)] >> (slot & _U64(63))) & _U64(1)).astype(bool)


def _bits(rows: DataFrame, name: str):
    """A bitmap of the values of a column, to be sent to every task: 2 MB whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BITMAP_BITS // 64, _U64)
        for batch in batches:
            slot = _slots(batch.column(name).to_numpy())
            np.bitwise_or.at(table, (slot >> _U64(6)).astype(np.int64), _U64(1) << (slot & _U64(63)))
        word = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word.astype(np.int32)), pa.array(table[word].view(np.int64))], ["w", "b"]
        )

    found = (
        rows.select(name).mapInArrow(run, "w int, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    table = np.zeros(BITMAP_BITS // 64, np.int64)
    table[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return rows.sparkSession.sparkContext.broadcast(table.view(_U64))


# ---------------------------------------------------------------- neighbours


def _words_of(column: pa.Array) -> np.ndarray:
    """Word codes of a column of equally wide binaries, one row of SIDE each."""
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int32)[column.offset]
    raw = np.frombuffer(data, np.uint8)[begin : begin + len(column) * SIDE * BYTES].reshape(-1, SIDE, BYTES)
    raw = raw.astype(np.uint32)
    return raw[:, :, 0] << 16 | raw[:, :, 1] << 8 | raw[:, :, 2]


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that rows a and b have in common from their beginnings; none beyond a text's end."""
    out = np.zeros(len(a), np.int64)
    for lo in range(0, len(a), 8192):
        x, y = codes[a[lo : lo + 8192]], codes[b[lo : lo + 8192]]
        differ = (x != y) | (x == 0)
        out[lo : lo + 8192] = np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE)
    return out


_FOUND = ["__id", "__at", "__r", "__l", "__low", "__high", "__other", "__border", "__core", "__right", "__left"]


def _found_type(kind: str) -> str:
    return (
        f"__id {kind}, __at int, __r int, __l int, __low int, __high int, __other {kind}, __border boolean, "
        "__core bigint, __right binary, __left binary"
    )


def _run_starts(rows: pa.RecordBatch) -> np.ndarray:
    """Where a run of rows of one core and one document begins."""
    core = rows.column("__core").to_numpy()
    ids = rows.column("__id").dictionary_encode().indices.to_numpy()
    return np.flatnonzero(np.r_[True, (core[1:] != core[:-1]) | (ids[1:] != ids[:-1])])


def _compared(rows: pa.RecordBatch, starts: np.ndarray, first: int, end: int) -> pa.RecordBatch:
    """Rows first..end against the last row before their run and the first one after it, of the same core."""
    core = rows.column("__core").to_numpy()
    ends = np.r_[starts[1:], rows.num_rows]
    run = np.searchsorted(starts, np.arange(first, end), side="right") - 1
    own = np.arange(first, end)
    right, left = _words_of(rows.column("__right")), _words_of(rows.column("__left"))
    best_r, best_l = np.full(len(own), -1), np.full(len(own), -1)
    low, high, other = np.full(len(own), WINDOW), np.full(len(own), -1), np.full(len(own), -1)
    for there in (starts[run] - 1, ends[run]):
        known = (there >= 0) & (there < rows.num_rows)
        known[known] = core[there[known]] == core[own[known]]
        i, j = own[known], there[known]
        r, l = _common(right, i, j), _common(left, i, j)
        best_r[known], best_l[known] = np.maximum(best_r[known], r), np.maximum(best_l[known], l)
        good = np.flatnonzero(known)[r + l >= SIDE]
        low[good] = np.minimum(low[good], SIDE - r[r + l >= SIDE])
        high[good] = np.maximum(high[good], l[r + l >= SIDE])
        other[good] = there[good]
    kept = np.flatnonzero(best_r >= 0)
    ids = rows.column("__id")
    partner = ids.take(pa.array(np.where(other[kept] >= 0, other[kept], 0), mask=other[kept] < 0))
    at = pa.array(own[kept])
    sure = high[kept] >= 0
    return pa.RecordBatch.from_arrays(
        [
            ids.take(at), rows.column("__at").take(at),
            pa.array(best_r[kept], pa.int32()), pa.array(best_l[kept], pa.int32()),
            pa.array(low[kept], pa.int32(), mask=~sure), pa.array(high[kept], pa.int32(), mask=~sure),
            partner, pa.array(np.zeros(len(kept), bool)), *[rows.column(c).take(at) for c in _SUFFIX[2:]],
        ],
        _FOUND,
    )


def _edge(rows: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(rows.num_rows, pa.int32())
    ids = rows.column("__id")
    return pa.RecordBatch.from_arrays(
        [
            ids, rows.column("__at"), none, none, none, none, pa.nulls(rows.num_rows, ids.type),
            pa.array(np.ones(rows.num_rows, bool)), *[rows.column(c) for c in ("__core", "__right", "__left")],
        ],
        _FOUND,
    )


def _neighbours(border: bool):
    """Compare a sorted partition's suffixes with their neighbours; with ``border`` also return the
    runs at its two ends, with the row beyond each, for the pass over borders.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, begun = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = batch.select(_SUFFIX)
            rows = fresh if held is None else pa.Table.from_batches([held, fresh]).combine_chunks().to_batches()[0]
            starts = _run_starts(rows)
            last = int(starts[-1])
            if len(starts) > 1 and border and not begun:
                yield _edge(rows.slice(0, int(starts[1]) + 1))
                begun = True
            if last > done:
                yield _compared(rows, starts, done, last)
            # The last run goes on, perhaps; the row before it stays as its neighbour.
            held, done = (rows.slice(last - 1), 1) if last else (rows, 0)
        if held is not None:
            yield _compared(held, _run_starts(held), done, held.num_rows)
            if border:
                yield _edge(held)

    return run


def _sorted_matches(suffixes: DataFrame, kind: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """What each suffix has in common with its neighbours in one order of the whole array, and the
    suffixes that have a neighbour (those at partition borders perhaps twice).
    """
    found = stored(
        suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(True), _found_type(kind))
    )
    # The first and last run of each partition, whatever the input holds.
    edges = found.filter("__border").select(*_SUFFIX).distinct().coalesce(1).sortWithinPartitions(*order)
    again = edges.mapInArrow(_neighbours(False), _found_type(kind))
    matches = found.filter("not __border").union(again).select(*_FOUND[:7])
    return matches, found.select(*_SUFFIX)


# ---------------------------------------------------------------- stretches that no neighbour settles


def _stretches(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first hash, second hash, whether its words exist) of the stretch at each offset, WINDOW a row."""
    core = rows.column("__core").to_numpy().view(_U64)
    right, left = _words_of(rows.column("__right")), _words_of(rows.column("__left"))
    have_r, have_l = (np.where((c == 0).any(axis=1), (c == 0).argmax(axis=1), SIDE) for c in (right, left))
    out = []
    offset = np.arange(WINDOW)
    for factors in _STRETCH:
        by_l, by_r = (
            np.concatenate([np.zeros((len(core), 1), _U64), np.cumsum(c.astype(_U64) * f, axis=1)], axis=1)
            for c, f in ((left, factors[2 : 2 + SIDE]), (right, factors[2 + SIDE :]))
        )
        total = core[:, None] * factors[0] + offset.astype(_U64) * factors[1] + by_l[:, offset] + by_r[:, SIDE - offset]
        out.append(words.mix(total))
    there = (offset <= have_l[:, None]) & (SIDE - offset <= have_r[:, None])
    return out[0].view(np.int64), (out[1] >> _U64(32)).astype(np.uint32).view(np.int32), there


def _stretch_batch(rows: pa.RecordBatch, row: np.ndarray, offset: np.ndarray, one, two) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("__id").take(at), rows.column("__at").take(at), pa.array(offset.astype(np.int32)),
            pa.array(one[row, offset]), pa.array(two[row, offset]),
        ],
        ["__id", "__at", "__offset", "__one", "__two"],
    )


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches that would make a suffix's span longer and that no neighbour has settled."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            rows = batch.slice(lo, 4096)
            one, two, there = _stretches(rows)
            r, l, low, high = (rows.column(c).to_numpy()[:, None] for c in ("__r", "__l", "__low", "__high"))
            offset = np.arange(WINDOW)[None, :]
            wanted = there & (offset >= SIDE - r) & (offset <= l) & ((offset < low) | (offset > high))
            yield _stretch_batch(rows, *np.nonzero(wanted), one, two)


def _asked_rows(bits):
    """All stretches of suffixes that may be among the asked ones, one row per document and slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                rows = batch.slice(lo, 4096)
                one, two, there = _stretches(rows)
                wanted = there & _held(bits.value, one.ravel()).reshape(one.shape)
                yield _stretch_batch(rows, *np.nonzero(wanted), one, two)

    return run


def _maybe(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key may be among the wanted ones; surely those whose key is."""
    bits = stored(bitmap(wanted, keys), BITMAP_BITS // 64)
    return mark(rows, bits, keys, "__maybe").filter("__maybe").drop("__maybe")


def _settled(suffixes: DataFrame, unsure: DataFrame, kind: str) -> DataFrame:
    """(__id, __at, __low, __high, __other) of asked stretches that another document has."""
    # Bitmaps pass what may matter, so that few of the wide rows are shuffled.
    stretch = f"__id {kind}, __at int, __offset int, __one bigint, __two int"
    open_ones = stored(_maybe(suffixes, unsure, ["__id", "__at"]).join(unsure, ["__id", "__at"]))
    own = stored(open_ones.mapInArrow(_open_rows, stretch))
    asked = _maybe(suffixes, open_ones, ["__core"]).mapInArrow(_asked_rows(_bits(own, "__one")), stretch)
    key = ["__one", "__two"]
    # The two smallest ids of a stretch; the bound on ranks also holds before the shuffle.
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy("__id"))
    shared = stored(
        asked.select(*key, "__id").withColumn("__rank", rank).filter("__rank <= 2")
        .groupBy(*key).agg(F.min("__id").alias("__least"), F.max("__id").alias("__second"))
        .filter("__least <> __second")
    )
    return own.join(shared, key).select(
        "__id", "__at", F.col("__offset").alias("__low"), F.col("__offset").alias("__high"),
        F.when(F.col("__id") == F.col("__least"), F.col("__second")).otherwise(F.col("__least")).alias("__other"),
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, start_word, end_word, n_words, partner_id) for every repeated passage.

    The end is exclusive; partner_id is the smallest id among those by which the span was confirmed.
    """
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(
        F.col("__id").isNotNull()
    )
    kind = source.schema["__id"].dataType.simpleString()
    marked = source.mapInArrow(_mark_rows, f"__id {kind}, __at int, __core bigint")
    again = stored(
        marked.groupBy("__core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__core")
    )
    # Both sides shuffle, so AQE can split the rows of a frequent core.
    places = stored(
        marked.join(again, "__core", "left_semi")
        .groupBy("__id").agg(F.sort_array(F.collect_set("__at")).alias("__at"))  # bounded by the text
    )
    bits = stored(bitmap(places, ["__id"]), BITMAP_BITS // 64)
    texts = mark(source, bits, ["__id"], "__maybe").filter("__maybe").select("__id", "__text")
    suffixes = stored(
        texts.join(places, "__id").mapInArrow(
            _suffix_rows, f"__id {kind}, __at int, __core bigint, __right binary, __left binary"
        )
    )
    by_right, suffixes = _sorted_matches(suffixes, kind, ["__core", "__right", "__left", "__id", "__at"])
    by_left, _ = _sorted_matches(suffixes, kind, ["__core", "__left", "__right", "__id", "__at"])
    most = {c: F.max(c).alias(c) for c in ("__r", "__l", "__high")}
    judged, n_judged = counted(
        by_right.union(by_left).groupBy("__id", "__at")
        .agg(*most.values(), F.min("__low").alias("__low"), F.min("__other").alias("__other"))
        .filter(F.col("__r") + F.col("__l") >= SIDE)
    )
    spans = judged.filter("__high is not null").select("__id", "__at", "__low", "__high", "__other")
    unsure, n_unsure = counted(
        judged.select(
            "__id", "__at", "__r", "__l",
            F.coalesce("__low", F.lit(WINDOW)).alias("__low"), F.coalesce("__high", F.lit(-1)).alias("__high"),
        ).filter((F.lit(SIDE) - F.col("__r") < F.col("__low")) | (F.col("__l") > F.col("__high")))
    )
    if n_unsure:
        spans = spans.union(_settled(suffixes, unsure, kind))
    spans = spans.select(
        "__id", (F.col("__at") - F.col("__high")).alias("__begin"),
        (F.col("__at") - F.col("__low") + MIN_WORDS).alias("__end"), "__other",
    )
    inside = Window.partitionBy("__id").orderBy("__begin", "__end")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("__begin") > F.max("__end").over(before), F.lit(True))
    return (
        spans.groupBy("__id", "__begin", "__end").agg(F.min("__other").alias("__other"))
        .withColumn("__fresh", fresh.cast("int"))
        .withColumn("__span", F.sum("__fresh").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(F.col("__id").alias(id_col), "__span")
        .agg(
            F.min("__begin").alias("start_word"), F.max("__end").alias("end_word"),
            F.min("__other").alias("partner_id"),
        )
        .select(
            id_col, "start_word", "end_word",
            (F.col("end_word") - F.col("start_word")).alias("n_words"), "partner_id",
        )
    )
