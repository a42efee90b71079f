"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF on top.

The patterns give the base spans, which always stay. The network is trained here, in numpy, on
windows labelled with the spans of a bounded sample of texts (SAMPLE_TEXTS texts, of them
SAMPLE_WINDOWS windows; documented bounds), each text also with other letters and digits in its
spans. It then reads every place that can hold one of the
four kinds, all of which need a digit or an "@": these characters with CONTEXT characters around
form zones, zones are cut into windows that overlap by half, each window is decoded by Viterbi.
Overlapping windows are reconciled for the whole text at once: every character takes the tag of
the window whose middle is nearest, and spans are read off the joined tags, so a span may run over
a seam. A span is added if it passes its kind's own check and touches no base span; two card
numbers with a space between them, which no pattern separates, are found this way.

Defined cases: a null or empty text has no spans; offsets are code points with an exclusive end;
without a labelled span in the sample nothing is added; rows are read each on their own, so ties
and repeats need no rule; a very long text is searched whole, its windows overlapping; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthgrid.llm.shared import stored

# Kinds in their order and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behind only spares starts inside a run of digits, which cannot match where its
# beginning did not.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")
RUN = re.compile(r"[0-9]+|[A-Za-z]+")
BARE_PHONE = re.compile(r"\(?[0-9][\x20().0-9-]+[0-9]")

SAMPLE_TEXTS, SAMPLE_WINDOWS = 2_000, 4_096
WIDTH, CONTEXT, HIDDEN, STEPS, BATCH, RATE, SEED = 96, 24, 12, 600, 32, 0.02, 11
CHARS = 130  # ASCII, any other character, padding
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind

_SPOT = re.compile("[0-9@]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches that pass their check, sorted."""
    spans = []
    after, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > after and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at) if begin < at else None
        if found:
            spans.append((begin, 0, found.end()))
            after = found.end()
        at = text.find("@", max(at + 1, after))
    for kind, pattern, check in ((1, IP, _is_ip), (2, CARD, _is_card), (3, PHONE, _is_phone)):
        spans += [
            (m.start(), kind, m.end()) for m in pattern.finditer(text) if check(m.group())
        ]
    return sorted(spans)


def _holds(kind: int, text: str) -> bool:
    """The check that an added span has to pass."""
    if kind == 0:
        return base_spans(text)[:1] == [(0, 0, len(text))]
    if kind == 1:
        return bool(IP.fullmatch(text)) and _is_ip(text)
    if kind == 2:
        return bool(CARD.fullmatch(text)) and _is_card(text)
    plain = PHONE.fullmatch(text) or (BARE_PHONE.fullmatch(text) and not text.isdecimal())
    return bool(plain) and _is_phone(text)


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows over the zones of a text, rising."""
    starts, end = [], -1
    for spot in _SPOT.finditer(text):
        at = spot.start()
        if at < end:
            continue
        begin = max(at - CONTEXT, 0)
        if starts and begin < starts[-1] + WIDTH:
            begin = starts[-1] + WIDTH // 2
        starts.append(begin)
        end = begin + WIDTH - CONTEXT
    return starts


def training_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans to learn: the base spans, and every number of a card's length.

    Whether a number passes its checksum can't be seen from its shape, so that is left to the
    check of added spans; card numbers in a row are separate spans.
    """
    spans = [s for s in base_spans(text) if s[1] != 2]
    for found in CARD.finditer(text):
        if 12 <= len(_digits(found.group())) <= 19:
            spans.append((found.start(), 2, found.end()))
        else:
            at = found.start()
            spans += [(at + m.start(), 2, at + m.end()) for m in NUMBER.finditer(found.group())]
    return sorted(spans)


def vary(text: str, spans: list, draw: np.random.Generator) -> tuple[str, list]:
    """The text with other letters and digits in its spans, and the spans' new places."""
    out, moved, at, size = [], [], 0, 0

    def other(found: re.Match) -> str:
        run = found.group()
        if run[0] in "0123456789":
            if kind == 1:
                return str(draw.integers(256))
            return "".join(map(str, draw.integers(0, 10, len(run))))
        length = max(1, len(run) + int(draw.integers(-3, 4)))
        return "".join(chr(97 + c) for c in draw.integers(0, 26, length))

    for begin, kind, end in spans:
        if begin < at:
            continue
        body = RUN.sub(other, text[begin:end])
        out += [text[at:begin], body]
        size += begin - at
        moved.append((size, kind, size + len(body)))
        size, at = size + len(body), end
    return "".join(out) + text[at:], moved


def encode(text: str, start: int) -> np.ndarray:
    part = text[start : start + WIDTH]
    codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    out = np.full(WIDTH, CHARS - 1, np.int64)
    out[: len(codes)] = np.minimum(codes, 128)
    return out


def tag_window(spans: list[tuple[int, int, int]], start: int) -> np.ndarray:
    """Tags of a window; of overlapping spans the first in order marks the characters."""
    out = np.zeros(WIDTH, np.int64)
    for begin, kind, end in reversed(spans):
        a, b = max(begin - start, 0), min(end - start, WIDTH)
        if a < b:
            out[a:b] = 2 + 2 * kind
            if begin >= start:
                out[a] = 1 + 2 * kind
    return out


# ---------------------------------------------------------------- network


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _lstm(chars, table, back, order):
    """Hidden states (rows, WIDTH, HIDDEN) and what the gradient needs."""
    rows = len(chars)
    h, c = np.zeros((rows, HIDDEN)), np.zeros((rows, HIDDEN))
    out, kept = np.zeros((rows, WIDTH, HIDDEN)), []
    for t in order:
        gates = table[chars[:, t]] + h @ back
        ifo, g = _sigmoid(gates[:, : 3 * HIDDEN]), np.tanh(gates[:, 3 * HIDDEN :])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        before, previous = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[:, t] = h
        kept.append((i, f, o, g, before, previous, squashed))
    return out, kept


def _lstm_gradient(chars, back, order, kept, d_out):
    d_table, d_back = np.zeros((CHARS, 4 * HIDDEN)), np.zeros_like(back)
    d_h = d_c = np.zeros((len(chars), HIDDEN))
    for t, (i, f, o, g, before, previous, squashed) in zip(reversed(order), reversed(kept)):
        d_h = d_h + d_out[:, t]
        d_c = d_c + d_h * o * (1 - squashed**2)
        d_gates = np.concatenate(
            [d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g**2)],
            axis=1,
        )
        np.add.at(d_table, chars[:, t], d_gates)
        d_back += previous.T @ d_gates
        d_h, d_c = d_gates @ back.T, d_c * f
    return d_table, d_back


_FORTH, _BACK = list(range(WIDTH)), list(reversed(range(WIDTH)))


def new_parameters(seed: int = SEED) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    shapes = {
        "table_f": (CHARS, 4 * HIDDEN), "back_f": (HIDDEN, 4 * HIDDEN),
        "table_b": (CHARS, 4 * HIDDEN), "back_b": (HIDDEN, 4 * HIDDEN),
        "out": (2 * HIDDEN, TAGS), "bias": (TAGS,), "move": (TAGS, TAGS), "begin": (TAGS,),
    }
    return {name: draw.normal(0, 0.1, shape) for name, shape in shapes.items()}


def _emissions(p, chars):
    forth, kept_f = _lstm(chars, p["table_f"], p["back_f"], _FORTH)
    back, kept_b = _lstm(chars, p["table_b"], p["back_b"], _BACK)
    both = np.concatenate([forth, back], axis=2)
    return both @ p["out"] + p["bias"], both, kept_f, kept_b


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def loss_and_gradient(p, chars, tags):
    """Mean negative log likelihood of the tag sequences, and its gradient."""
    rows, place = len(chars), np.arange(len(chars))
    e, both, kept_f, kept_b = _emissions(p, chars)
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = p["begin"] + e[:, 0]
    for t in range(1, WIDTH):
        alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + p["move"], 1) + e[:, t]
    for t in range(WIDTH - 2, -1, -1):
        beta[:, t] = _log_sum(p["move"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    whole = _log_sum(alpha[:, -1], 1)
    share = np.exp(alpha + beta - whole[:, None, None])
    true = np.eye(TAGS)[tags]
    d_e = (share - true) / rows
    d_move = -np.einsum("nti,ntj->ij", true[:, :-1], true[:, 1:])
    for t in range(WIDTH - 1):
        pair = alpha[:, t, :, None] + p["move"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :]
        d_move += np.exp(pair - whole[:, None, None]).sum(axis=0)
    gold = p["begin"][tags[:, 0]] + e[place[:, None], np.arange(WIDTH), tags].sum(axis=1)
    gold += p["move"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
    d_both = d_e @ p["out"].T
    grad = {
        "out": np.einsum("nth,ntk->hk", both, d_e), "bias": d_e.sum(axis=(0, 1)),
        "move": d_move / rows, "begin": d_e[:, 0].sum(axis=0),
    }
    grad["table_f"], grad["back_f"] = _lstm_gradient(chars, p["back_f"], _FORTH, kept_f, d_both[:, :, :HIDDEN])
    grad["table_b"], grad["back_b"] = _lstm_gradient(chars, p["back_b"], _BACK, kept_b, d_both[:, :, HIDDEN:])
    return float((whole - gold).mean()), grad


def train(chars: np.ndarray, tags: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on shuffled batches of windows, STEPS of them at least, in whole passes."""
    draw, p, step = np.random.default_rng(seed), new_parameters(seed), 0
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    while step < STEPS:
        order = draw.permutation(len(chars))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            _, grad = loss_and_gradient(p, chars[chosen], tags[chosen])
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


def decode(p: dict[str, np.ndarray], chars: np.ndarray) -> np.ndarray:
    """Viterbi tags of each window."""
    e = _emissions(p, chars)[0]
    best, back = p["begin"] + e[:, 0], np.zeros(e.shape, np.int8)
    for t in range(1, WIDTH):
        paths = best[:, :, None] + p["move"]
        back[:, t] = paths.argmax(axis=1)
        best = paths.max(axis=1) + e[:, t]
    tags = np.zeros(chars.shape, np.int64)
    tags[:, -1] = best.argmax(axis=1)
    place = np.arange(len(chars))
    for t in range(WIDTH - 1, 0, -1):
        tags[:, t - 1] = back[place, t, tags[:, t]]
    return tags


# ---------------------------------------------------------------- whole texts


def reconcile(starts: list[int], tags: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of a text from all its windows' tags."""
    spans, open_span = [], None
    for k, start in enumerate(starts):
        last = starts[k + 1] if k + 1 < len(starts) else None
        # the border between two overlapping windows is half-way between their middles
        lo = start if not k or starts[k - 1] + WIDTH <= start else (start + starts[k - 1] + WIDTH) // 2
        hi = start + WIDTH if last is None or last >= start + WIDTH else (last + start + WIDTH) // 2
        if open_span and open_span[2] != lo:
            spans.append(tuple(open_span))
            open_span = None
        for at in range(lo, min(hi, size)):
            tag = tags[k, at - start]
            kind = (tag - 1) // 2
            if open_span and (tag == 0 or tag % 2 == 1 or kind != open_span[1]):
                spans.append(tuple(open_span))
                open_span = None
            if tag:
                if open_span:
                    open_span[2] = at + 1
                else:
                    open_span = [at, int(kind), at + 1]
    if open_span:
        spans.append(tuple(open_span))
    return spans


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


@dataclass(frozen=True)
class Finder:
    """Base spans, and the network's if there is one."""

    parameters: dict[str, np.ndarray] | None

    def find(self, texts: list[str]) -> tuple[list[list], list[list]]:
        """Base spans and added spans of each text."""
        base, added = [], [[] for _ in texts]
        waiting: list[tuple[int, list[int]]] = []
        held = 0
        for n, text in enumerate(texts):
            starts = window_starts(text)
            base.append(base_spans(text) if starts else [])
            if starts and self.parameters is not None:
                waiting.append((n, starts))
                held += len(starts)
                if held >= 512:
                    self._add(texts, base, added, waiting)
                    waiting, held = [], 0
        self._add(texts, base, added, waiting)
        return base, added

    def _add(self, texts, base, added, waiting):
        for n, starts in waiting:
            if len(starts) > 512:  # a long text: its windows in parts of bounded size
                parts = [starts[i : i + 512] for i in range(0, len(starts), 512)]
                tags = np.concatenate([self._tags(texts[n], part) for part in parts])
                self._keep(texts[n], base[n], added[n], starts, tags)
        short = [(n, s) for n, s in waiting if len(s) <= 512]
        if short:
            chars = np.stack([encode(texts[n], s) for n, starts in short for s in starts])
            tags, at = decode(self.parameters, chars), 0
            for n, starts in short:
                self._keep(texts[n], base[n], added[n], starts, tags[at : at + len(starts)])
                at += len(starts)

    def _tags(self, text, starts):
        return decode(self.parameters, np.stack([encode(text, s) for s in starts]))

    @staticmethod
    def _keep(text, base, added, starts, tags):
        begins = [a for a, _, _ in base]
        reach = list(accumulate((b for _, _, b in base), max))  # furthest end so far
        for begin, kind, end in reconcile(starts, tags, len(text)):
            body = text[begin:end]
            begin, end = begin + len(body) - len(body.lstrip()), end - len(body) + len(body.rstrip())
            before = bisect_left(begins, end)
            touches = before > 0 and reach[before - 1] > begin
            if begin < end and not touches and _holds(kind, text[begin:end]):
                added.append((begin, kind, end))


#: Windows that a task holds before it passes them on.
HELD_WINDOWS = 512


def _label_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    chars, tags = [], []

    def held() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(chars, kind), pa.array(tags, kind)], ["__chars", "__tags"])
        chars.clear()
        tags.clear()
        return done

    for batch in batches:
        for value in batch.column("__text"):
            text = value.as_py() or ""
            spans = training_spans(text)
            draw = np.random.default_rng(zlib.crc32(text.encode()))
            for version, own in ((text, spans), vary(text, spans, draw)):
                for start in window_starts(version):
                    chars.append(encode(version, start).tolist())
                    tags.append(tag_window(own, start).tolist())
                    if len(chars) == HELD_WINDOWS:
                        yield held()
    yield held()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Finder:
    """Train on the spans of at most SAMPLE_TEXTS texts and SAMPLE_WINDOWS windows."""
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).filter(
        F.col("__id").isNotNull() & F.col("__text").rlike("[0-9@]")
    )
    order = F.md5(F.concat(F.lit("pii:"), F.col("__id").cast("string")))
    ids = stored(texts.select("__id").distinct().orderBy(order, "__id").limit(SAMPLE_TEXTS))
    lists = "__chars array<bigint>, __tags array<bigint>"
    windows = texts.join(F.broadcast(ids), "__id").mapInArrow(_label_windows, lists)
    sample = (
        windows.orderBy(F.xxhash64("__chars"), "__chars", "__tags").limit(SAMPLE_WINDOWS).toArrow()
    )
    if not sample.num_rows:
        return Finder(None)
    chars = np.array(sample.column("__chars").to_pylist())
    tags = np.array(sample.column("__tags").to_pylist())
    return Finder(train(chars, tags) if tags.any() else None)


def _found(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                texts = [t or "" for t in part.column("__text").to_pylist()]
                base, added = shared.value.find(texts)
                counts = [[sum(k == kind for _, k, _ in s) for s in base] for kind in range(len(KINDS))]
                digest = [hashlib.sha256(_joined(s).encode()).hexdigest() for s in base]
                whole = [_joined([*s, *t]) for s, t in zip(base, added)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array(digest, pa.string()), pa.array(whole, pa.string()),
                     pa.array([len(t) for t in added], pa.int64())],
                    ["__id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    return run


def find_personal_data(
    docs: DataFrame, finder: Finder, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col``, counts of base spans by kind, base_sha256, spans, n_added."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(finder)  # some 100 kB, fixed by HIDDEN
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .mapInArrow(_found(shared), f"__id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")
        .withColumnRenamed("__id", id_col)
    )
