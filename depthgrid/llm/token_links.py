"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

A text is encoded by a byte-level vocabulary (A, as space + text) and a piece vocabulary (B, which
adds the space itself). Byte offsets where tokens of both end cut them into groups; the two tokens
that end there are a link, so a group has one. Before any text is read, an array gives for each A id
the B id of the same bytes. Links that agree with it, which one-to-one groups of equal bytes do, are
counted in a vector as long as the A vocabulary; only the other links enter a shuffle as pairs.

Texts are cut at single spaces between two characters that are not white space. No token of A
crosses such a place (its splitter never joins white space to what stands before it), and none of B
(checked once: no piece has a space after another character), so the distinct new parts of a slice
are encoded together, with a space between them, and parts are remembered. Parts of a very long text are read
PIECE characters at a time.

Corpus counts come from one stored row per document with its distinct links. The best count of a B
id and the counts of A ids are vectors of vocabulary length. Of the other pairs the HEAVY most
frequent ones go to every task (a bounded table), so that no frequent pair becomes a hot key; the
rest are joined by pair.

Defined cases: a null or empty text, and one whose joined A or B bytes are not space + text, has
no tokens: zeros and an empty column of groups. Rows count each on their own, also where ids repeat or
are null; ties of the highest count are all best; an empty table gives an empty table; the id is
passed on, other columns are not read, so any name may occur. One part without any cut is encoded
whole by the libraries.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthgrid.llm import words
from depthgrid.llm.shared import counted, stored

#: Characters of a text that are read at once, and characters of texts that are counted together.
PIECE, SLICE = 1 << 20, 1 << 21
#: Parts after which a worker forgets all; those of one slice more may be remembered.
PARTS = 200_000
#: New parts that are encoded as one text.
TOGETHER = 1000
#: Pairs that go to every task: 12 bytes each.
HEAVY = 200_000
#: Counts of the A vocabulary that travel in one row.
STRIP = 1024

SPACE = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_CODE = 32  # bits of a B id in a pair's code


def byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 signs stand for
    themselves, the other bytes for 256, 257, ... in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the map from A ids to B ids of equal bytes."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_of_letter()
        named = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(named.values(), default=-1) + 1)
        for token, number in named.items():
            known = all(c in letters for c in token)
            self.a_bytes[number] = bytes(letters[c] for c in token) if known else token.encode()
        self.b_bytes, first = [], {}
        cuttable = True
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            if self.b.is_byte(number):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            self.b_bytes.append(piece.replace(SPACE, " ").encode())
            if not (self.b.is_control(number) or self.b.is_unknown(number)):
                first.setdefault(self.b_bytes[-1], number)
                cuttable &= SPACE not in piece.lstrip(SPACE)
        self.cuttable = cuttable
        self.same = np.array([first.get(b, -1) if b else -1 for b in self.a_bytes], np.int64)
        self.a_len, self.b_len = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.plain = [f"{a}|{b}" for a, b in enumerate(self.same.tolist())]
        self.forget()

    def forget(self) -> None:
        """Remembered parts: their places, groups as text, numbers, and link codes one after the other."""
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, whether the bytes differ
        self.starts = np.zeros(1, np.int64)
        self.codes = np.zeros(0, np.int64)
        self._fresh: list[tuple] = []
        self._parts: list[tuple] = []
        self._total = 0

    def cut(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuttable else [text]

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about PIECE characters that end at a cut."""
        begin = 0
        while self.cuttable and len(text) - begin > PIECE:
            found = _CUT.search(text, begin + PIECE)
            if found is None:
                break
            yield text[begin : found.start()]
            begin = found.end()
        yield text[begin:] if begin else text

    def _encode(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of both for a text, and whether the joined bytes of both are space + text."""
        whole = " " + text
        a = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = whole.encode()
        sound = b"".join([self.a_bytes[x] for x in a]) == raw == b"".join([self.b_bytes[x] for x in b])
        return np.array(a, np.int64), np.array(b, np.int64), sound

    def _align(self, texts: Sequence[str]) -> None:
        """Remember the parts ``texts``, encoded as one text of parts with a space between them."""
        a, b, sound = self._encode(" ".join(texts))
        if not sound:
            if len(texts) > 1:  # find the parts whose bytes differ
                middle = len(texts) // 2
                self._align(texts[:middle])
                self._align(texts[middle:])
            else:
                self._add(texts, [""], np.array([[0, 0, 0, 1]]), np.zeros(1, np.int64), np.zeros(0, np.int64))
            return
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        at = np.searchsorted(b_end, a_end)
        both = b_end[at] == a_end  # the last ends are equal, so no place is beyond the array
        last_a, last_b = np.flatnonzero(both), at[both]
        code = a[last_a] << _CODE | b[last_b]
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        names = [
            self.plain[x] if same else f"{x}|{y}"
            for x, y, same in zip(a[last_a].tolist(), b[last_b].tolist(), (self.same[a[last_a]] == b[last_b]).tolist())
        ]
        left, right = a.tolist(), b.tolist()
        for g in np.flatnonzero((n_a > 1) | (n_b > 1)).tolist():
            i, j = int(last_a[g]) + 1, int(last_b[g]) + 1
            names[g] = (
                ",".join(map(str, left[i - n_a[g] : i])) + "|" + ",".join(map(str, right[j - n_b[g] : j]))
            )
        size = np.array([len(t.encode()) + 1 for t in texts])
        upto = np.searchsorted(a_end[last_a], np.cumsum(size)) + 1  # groups up to each part's end
        starts = np.concatenate([[0], upto])
        ends = starts.tolist()
        numbers = np.column_stack(
            [
                np.diff(np.concatenate([[0], np.cumsum(n_a)])[starts]),
                np.diff(np.concatenate([[0], np.cumsum(n_b)])[starts]),
                np.diff(starts),
                np.zeros(len(texts), np.int64),
            ]
        )
        self._add(texts, [";".join(names[x:y]) for x, y in zip(ends, ends[1:])], numbers, upto, code)

    def _add(self, texts, groups, numbers, upto, codes) -> None:
        self.place.update(zip(texts, range(len(self.groups), len(self.groups) + len(texts))))
        self.groups += groups
        self._fresh.append((numbers, upto, codes))

    def _join(self) -> None:
        """What was added to the arrays since the last call, at once."""
        for numbers, upto, codes in self._fresh:
            self._total, upto = self._total + len(codes), upto + self._total
            self._parts.append((numbers, upto, codes))
        if self._fresh:
            numbers, starts, codes = zip(*self._parts)
            self.numbers = np.concatenate(numbers)
            self.starts = np.concatenate([np.zeros(1, np.int64), *starts])
            self.codes = np.concatenate(codes)
            self._parts = [(self.numbers, self.starts[1:], self.codes)]
            self._fresh = []

    def places(self, parts: list[str]) -> np.ndarray:
        """Places of the parts among the remembered ones; new ones are encoded together."""
        if len(self.place) > PARTS:
            self.forget()
        new = [p for p, known in zip(parts, map(self.place.get, parts)) if known is None]
        if new:
            # White space at an edge would run together with the space between two parts.
            fresh = list(dict.fromkeys(new))
            alone = {p for p in fresh if p[0].isspace() or p[-1].isspace() or SPACE in p}
            together = [p for p in fresh if p not in alone]
            for begin in range(0, len(together), TOGETHER):
                self._align(together[begin : begin + TOGETHER])
            for p in sorted(alone):
                self._align([p])
            self._join()
        return np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))

    def joined_right(self, text: str) -> bool:
        """Whether the tokens' joined bytes are space + text although those of a part are not."""
        cut = self.cut(text)
        got = b"".join(self.b_bytes[x] for ids in self.b.encode(cut, num_threads=1) for x in ids)
        return got == (" " + text).encode()


@lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


@dataclass
class _Text:
    """Sums of a text's pieces."""

    digest: object
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    sound: bool = True


def _texts(pair: Pair, texts: list[str | None]) -> tuple[list[tuple], list[np.ndarray], list[np.ndarray]]:
    """For each text its numbers and digest, its distinct link codes and how often each occurs."""
    sums = [_Text(hashlib.sha256()) for _ in texts]
    links: list[list[np.ndarray]] = [[] for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    chars = 0

    def settle_waiting() -> None:
        if not waiting:
            return
        places = pair.places([p for _, cut in waiting for p in cut])
        ends = np.cumsum([len(cut) for _, cut in waiting])
        begins = ends - [len(cut) for _, cut in waiting]
        totals = np.add.reduceat(pair.numbers[places], begins, axis=0).tolist()
        sizes = pair.starts[places + 1] - pair.starts[places]
        link_ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(link_ends[-1]) + np.repeat(pair.starts[places] - link_ends[:-1], sizes)
        codes = pair.codes[at]
        named, groups = places.tolist(), pair.groups
        for (t, _), first, end, (n_a, n_b, n_groups, differ) in zip(waiting, begins.tolist(), ends.tolist(), totals):
            text = sums[t]
            if text.n_groups:
                text.digest.update(b";")
            text.digest.update(";".join([groups[p] for p in named[first:end]]).encode())
            text.n_a += n_a
            text.n_b += n_b
            text.n_groups += n_groups
            text.sound &= not differ
            links[t].append(codes[link_ends[first] : link_ends[end]])

    for t, text in enumerate(texts):
        for piece in pair.pieces(text) if text else ():
            cut = pair.cut(piece)
            waiting.append((t, cut))
            chars += len(piece)
            if chars >= SLICE:
                settle_waiting()
                waiting, chars = [], 0
    settle_waiting()

    rows, codes, counts = [], [], []
    none = np.zeros(0, np.int64)
    for t, text in enumerate(texts):
        done = sums[t]
        if text and not done.sound and pair.joined_right(text):
            # Bytes that differ in one part and are made up for in another: the whole text at once.
            pair.forget()
            pair._align([text])
            pair._join()
            n_a, n_b, n_groups, differ = pair.numbers[0].tolist()
            done = _Text(hashlib.sha256(pair.groups[0].encode()), n_a, n_b, n_groups, not differ)
            links[t] = [pair.codes]
            pair.forget()
        if not text or not done.sound:
            rows.append((0, 0, 0, ""))
            codes.append(none)
            counts.append(none)
            continue
        rows.append((done.n_a, done.n_b, done.n_groups, done.digest.hexdigest()))
        found, often = np.unique(np.concatenate(links[t]), return_counts=True)
        codes.append(found)
        counts.append(often)
    return rows, codes, counts


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def document_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
    """One row per document: numbers, digest of its groups, links of the identity map (A id, times)
    and other links (pair code, times). Texts are read once.
    """
    kept = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for batch in batches:
            for part in words.slices(batch, "__text"):
                rows, codes, counts = _texts(pair, part.column("__text").to_pylist())
                plain = [pair.same[c >> _CODE] == (c & ((1 << _CODE) - 1)) for c in codes]
                n_a, n_b, n_groups, digest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__id"),
                        pa.array(n_a, pa.int64()),
                        pa.array(n_b, pa.int64()),
                        pa.array(n_groups, pa.int64()),
                        pa.array(digest),
                        _lists([c[p] >> _CODE for c, p in zip(codes, plain)], pa.int32()),
                        _lists([n[p] for n, p in zip(counts, plain)], pa.int32()),
                        _lists([c[~p] for c, p in zip(codes, plain)], pa.int64()),
                        _lists([n[~p] for n, p in zip(counts, plain)], pa.int32()),
                    ],
                    [*_DOCUMENT],
                )

    schema = kept.select("__id").schema
    for name, kind in _DOCUMENT.items():
        schema = schema.add(name, kind) if name != "__id" else schema
    return kept.mapInArrow(run, schema)


_DOCUMENT = {
    "__id": None, "n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "groups_sha256": T.StringType(),
    "__same": T.ArrayType(T.IntegerType()), "__same_times": T.ArrayType(T.IntegerType()),
    "__pairs": T.ArrayType(T.LongType()), "__pair_times": T.ArrayType(T.IntegerType()),
}


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy()


def _row_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.repeat(np.arange(batch.num_rows), np.diff(batch.column(name).offsets.to_numpy()))


def same_counts(documents: DataFrame, size: int) -> np.ndarray:
    """How often each A id is linked to its B id of equal bytes: one vector per task, cut in strips
    that are added up over the cluster.
    """
    strips = -(-size // STRIP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(strips * STRIP, np.int64)
        for batch in batches:
            np.add.at(total, _flat(batch, "__same"), _flat(batch, "__same_times"))
        lines = total.reshape(strips, STRIP)
        held = np.flatnonzero(lines.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(list(lines[held]), pa.list_(pa.int64()))], ["strip", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for strip, line in zip(batch.column("strip").to_pylist(), _flat(batch, "counts").reshape(-1, STRIP)):
                total[strip] = total[strip] + line if strip in total else line
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.int64()))],
            ["strip", "counts"],
        )

    schema = "strip int, counts array<long>"
    found = (
        documents.select("__same", "__same_times").mapInArrow(run, schema)
        .repartition(8, "strip").mapInArrow(add, schema).toArrow()  # as long as the vocabulary
    )
    out = np.zeros((strips, STRIP), np.int64)
    if found.num_rows:
        out[found.column("strip").to_numpy()] = np.stack(found.column("counts").to_pylist())
    return out.ravel()[:size]


def pair_counts(documents: DataFrame) -> DataFrame:
    """(code, n) of the links outside the identity map, added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, back = np.unique(_flat(batch, "__pairs"), return_inverse=True)
            n = np.bincount(back, _flat(batch, "__pair_times"), minlength=len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    return (
        documents.select("__pairs", "__pair_times").mapInArrow(run, "code long, n long")
        .groupBy("code").agg(F.sum("n").alias("n"))
    )


@dataclass(frozen=True)
class Counts:
    """Vectors of vocabulary length and the most frequent other pairs, ascending by code."""

    same: np.ndarray
    same_of: np.ndarray
    best: np.ndarray
    heavy: np.ndarray
    heavy_n: np.ndarray


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    documents = stored(
        document_links(docs, a_path, b_path, id_col, text_col).withColumn("__row", F.monotonically_increasing_id())
    )
    pair = _pair(a_path, b_path)
    same = same_counts(documents, len(pair.same))
    pairs, n_pairs = counted(pair_counts(documents))
    best = np.zeros(len(pair.b_len), np.int64)
    known = pair.same >= 0
    np.maximum.at(best, pair.same[known], same[known])
    highest = (
        pairs.groupBy(F.col("code").bitwiseAND((1 << _CODE) - 1).alias("b")).agg(F.max("n").alias("n"))
        .toArrow()  # at most the B vocabulary
    )
    np.maximum.at(best, highest.column("b").to_numpy(), highest.column("n").to_numpy())
    rest = None
    chosen = pairs
    if n_pairs > heavy:
        chosen = pairs.orderBy(F.col("n").desc(), "code").limit(heavy)
    table = chosen.toArrow()  # at most ``heavy`` rows
    codes, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast(Counts(same, pair.same, best, codes[order], n[order]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        low = (1 << _CODE) - 1
        for batch in batches:
            rows = batch.num_rows
            a, times, row = _flat(batch, "__same"), _flat(batch, "__same_times").astype(np.int64), _row_of(batch, "__same")
            count = known.same[a]
            n_best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(n_best, row, times * (count == known.best[known.same_of[a]]))
            np.add.at(total, row, times * count)
            code, times, row = _flat(batch, "__pairs"), _flat(batch, "__pair_times").astype(np.int64), _row_of(batch, "__pairs")
            at = np.minimum(np.searchsorted(known.heavy, code), max(len(known.heavy) - 1, 0))
            found = known.heavy[at] == code if len(known.heavy) else np.zeros(len(code), bool)
            count = known.heavy_n[at[found]] if found.any() else np.zeros(0, np.int64)
            np.add.at(n_best, row[found], times[found] * (count == known.best[code[found] & low]))
            np.add.at(total, row[found], times[found] * count)
            left = ~found
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[left], minlength=rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(n_best),
                    pa.array(total),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(code[left])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times[left])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(known.best[code[left] & low])),
                ],
                [*names, "n_best", "count_sum", "__codes", "__times", "__highest"],
            )

    names = ["__row", "__id", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = documents.select(*names).schema
    for name in ("n_best", "count_sum"):
        schema = schema.add(name, T.LongType())
    for name in ("__codes", "__times", "__highest"):
        schema = schema.add(name, T.ArrayType(T.LongType()))
    scored = documents.mapInArrow(score, schema)
    if n_pairs > heavy:
        scored = stored(scored)
        rest = (
            scored.select("__row", F.inline(F.arrays_zip("__codes", "__times", "__highest")))
            .join(pairs, F.col("__codes") == pairs["code"])
            .groupBy("__row")
            .agg(
                F.sum(F.col("__times") * (F.col("n") == F.col("__highest")).cast("long")).alias("__more_best"),
                F.sum(F.col("__times") * F.col("n")).alias("__more_sum"),
            )
        )
        scored = scored.join(rest, "__row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("__more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("__more_sum", F.lit(0)),
            }
        )
    return scored.select(
        F.col("__id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256",
    )
