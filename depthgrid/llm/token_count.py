"""Token counts by a compiled finite-state transducer, without building the tokens.

The tokenizer file is a BPE with word ends over lower-cased text. Two machines are compiled
from it:

* a splitter, a regular expression that cuts normalised text into words;
* a transducer over a word's byte symbols. It uses that a byte-pair encoding is right exactly when
  every two neighbouring tokens are the encoding of their own concatenation, so the last token of
  each prefix determines everything before it. A state holds, for each place where a vocabulary
  token could still be open, the place's node in the vocabulary trie, the token that ends there and
  how many tokens have been emitted since. A transition carries the change in the count of emitted
  tokens; the word-end symbol closes the word. States are made when first reached, two words with
  the same future share them, and the table is emptied when it reaches a bound.

A text is cut into chunks. A chunk's map from entry state to (exit state, count) does not depend
on the entry state after the chunk's first white space, where every state falls back to the start;
so it is stored as (head, count, tail, broken): the text before the first and after the last white
space, and the count between. Maps compose associatively: count + count(tail + head) + count.
Composition runs as a parallel scan: the chunks of one task, then groups of FAN chunks per
document, then the groups, so one very long text is spread over tasks.

Defined cases: a null or empty text has 0 tokens; a special token's string in a text counts as one
token, as in the library; no truncation; rows that share an id are counted each on their own; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk, chunks composed by one task in the second step.
CHUNK, FAN = 1 << 16, 256
#: Bounds of a worker's tables: states, words of each generation, characters of a kept word.
STATES, WORDS, KEPT_WORD = 150_000, 300_000, 64

_SPACE = regex.compile("[ \t\n\r]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordMachine:
    """The transducer of one vocabulary: ``count(word)`` for a word of byte symbols."""

    def __init__(self, merges: list[tuple[str, str]], vocab: set[str], end: str):
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.end = end
        self.trie: list[dict] = [{}]
        self.token: list[str | None] = [None]
        for word in vocab:
            node = 0
            closed = word.endswith(end)
            for symbol in [*(word[: -len(end)] if closed else word), *([end] if closed else [])]:
                if symbol not in self.trie[node]:
                    self.trie.append({})
                    self.token.append(None)
                    self.trie[node][symbol] = len(self.trie) - 1
                node = self.trie[node][symbol]
            self.token[node] = word
        self.inner = {w for w in vocab if len(w) == 1}
        self.last = {w[0] for w in vocab if len(w) == 1 + len(end) and w.endswith(end)}
        self.valid: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((0, "", 0),)
        self.number = {start: 0}
        self.state = [start]
        self.step: list[dict] = [{}]

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _fits(self, left: str, right: str) -> bool:
        """Whether the two tokens are the encoding of their concatenation."""
        if not left:
            return True
        known = self.valid.get((left, right))
        if known is None:
            if len(self.valid) >= STATES:
                self.valid.clear()
            parts = self._symbols(left) + self._symbols(right)
            while len(parts) > 1:
                pairs = [self.rank.get(p, len(self.rank)) for p in zip(parts, parts[1:])]
                best = min(pairs)
                if best == len(self.rank):
                    break
                at = pairs.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.valid[left, right] = parts == [left, right]
        return known

    def _advance(self, state: tuple, symbol: str) -> tuple[tuple, int]:
        """The state after ``symbol`` and the tokens emitted on the way (may be negative)."""
        open_places, last, change = [], None, 0
        for node, before, since in state:
            following = self.trie[node].get(symbol)
            if following is None:
                continue
            token = self.token[following]
            if last is None and token is not None and self._fits(before, token):
                last, change = token, 1 - since
            open_places.append((following, before, since))
        if last is None:
            raise ValueError(f"no token ends with {symbol!r}")
        moved = tuple((n, b, s + change) for n, b, s in open_places if self.trie[n])
        return (*moved, (0, last, 0)), change

    def count(self, word: str) -> int:
        """Tokens of a word; a symbol that the vocabulary lacks is left out, as in the library."""
        symbols = [s for s in word[:-1] if s in self.inner]
        if word[-1] in self.last:
            symbols += [word[-1], self.end]
        total, at = 0, 0
        for symbol in symbols:
            known = self.step[at].get(symbol)
            if known is None:
                if symbol == self.end:
                    known = self.step[at][symbol] = (0, self._advance(self.state[at], symbol)[1])
                else:
                    after, change = self._advance(self.state[at], symbol)
                    number = self.number.get(after)
                    if number is None:
                        number = self.number[after] = len(self.state)
                        self.state.append(after)
                        self.step.append({})
                    known = self.step[at][symbol] = (number, change)
            at = known[0]
            total += known[1]
            if len(self.state) > STATES:
                now = self.state[at]
                self.reset()
                at = self.number.setdefault(now, len(self.state))
                if at:
                    self.state.append(now)
                    self.step.append({})
        return total


class TokenCounter:
    """Counts of whole fragments, from a tokenizers JSON file of the word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        kinds = [s["type"] for s in steps]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"]
            or level["type"] != "ByteLevel" or level["add_prefix_space"] or not split["invert"]
        ):
            raise ValueError("only the BPE with word ends over lower-cased text is compiled")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.machine = WordMachine(merges, set(model["vocab"]), model["end_of_word_suffix"])
        self.splitter = regex.compile(split["pattern"]["Regex"])
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.marks)))
        self.symbols = dict(enumerate(byte_symbols()))
        # Counts of words, in two generations: a word used since the last change stays known.
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _word(self, word: str) -> int:
        found = self.older.get(word)
        if found is None:
            if not (word.isascii() and word.isprintable()):
                found = self.machine.count(word.encode("utf-8").decode("latin-1").translate(self.symbols))
            else:
                found = self.machine.count(word)
        if len(word) <= KEPT_WORD:
            if len(self.known) >= WORDS:
                self.older = dict(self.known)
                self.known.clear()
            self.known[word] = found
        return found

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # one character at a time, so that no rule looks at its neighbours
            text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        else:
            text = text.lower()
        total, known = 0, self.known.get
        for word in self.splitter.findall(text):
            found = known(word)
            total += self._word(word) if found is None else found
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; white space may be cut anywhere, as no word or special token has any."""
        if not any(mark in text for mark in self.marks):
            return self._plain(text)
        total, begin = 0, 0
        for found in self.special.finditer(text):
            total += self._plain(text[begin : found.start()]) + 1
            begin = found.end()
        return total + self._plain(text[begin:])


def chunk_map(counter: TokenCounter, text: str) -> tuple[str, int, str, bool]:
    """(head, count, tail, broken) of a chunk; without white space all of it is the head."""
    first = _SPACE.search(text)
    if first is None:
        return text, 0, "", False
    last = max(text.rfind(c) for c in " \t\n\r")
    return text[: first.start()], counter.count(text[first.start() : last + 1]), text[last + 1 :], True


def compose(counter: TokenCounter, maps: list[tuple]) -> tuple[str, int, str, bool]:
    """The map of consecutive chunks: neighbours are joined level by level, as in a prefix scan."""
    while len(maps) > 1:
        joined = []
        for at in range(0, len(maps) - 1, 2):
            (h1, c1, t1, b1), (h2, c2, t2, b2) = maps[at], maps[at + 1]
            if b1 and b2:
                joined.append((h1, c1 + counter.count(t1 + h2) + c2, t2, True))
            elif b1:
                joined.append((h1, c1, t1 + h2, True))
            else:
                joined.append((h1 + h2, c2, t2, b2))
        maps = joined + maps[len(maps) & ~1 :]
    return maps[0]


_COUNTERS: dict[str, TokenCounter] = {}


def counter_of(path: str) -> TokenCounter:
    """One compiled counter per worker and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


_MAP_FIELDS = [("head", pa.string()), ("count", pa.int64()), ("tail", pa.string()), ("broken", pa.bool_())]
_ROW_FIELDS = [("__row", pa.int64()), ("__bytes", pa.int64()), ("__no", pa.int64())]


def _map_columns(maps: list[tuple]) -> list[pa.Array]:
    columns = zip(*maps) if maps else [[]] * len(_MAP_FIELDS)
    return [pa.array(c, kind) for c, (_, kind) in zip(columns, _MAP_FIELDS)]


def _whole_texts(path: str):
    """Count texts of one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            tokens = [counter.count(t.as_py() or "") for t in batch.column("__text")]
            columns = [batch.column("__id"), batch.column("__bytes"), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "__bytes", "__tokens"])

    return run


def _chunk_maps(path: str):
    names = ["__id", *(n for n, _ in _ROW_FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            maps = [chunk_map(counter, t.as_py()) for t in batch.column("__part")]
            columns = [*(batch.column(n) for n in names), *_map_columns(maps)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *(n for n, _ in _MAP_FIELDS)])

    return run


def _composed(path: str):
    """Compose one group's consecutive maps; the group's first number becomes the map's."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("__no")
        fields = [table.column(n).to_pylist() for n, _ in _MAP_FIELDS]
        whole = compose(counter_of(path), list(zip(*fields)))
        row = table.slice(0, 1).select(["__id", *(n for n, _ in _ROW_FIELDS)])
        for (name, kind), value in zip(_MAP_FIELDS, whole):
            row = row.append_column(pa.field(name, kind), pa.array([value], kind))
        return row

    return run


def _closed(path: str):
    """Count what a text's single map leaves open at both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            fields = [batch.column(n).to_pylist() for n, _ in _MAP_FIELDS]
            tokens = [counter.count(h) + c + counter.count(t) for h, c, t, _ in zip(*fields)]
            columns = [batch.column("__id"), batch.column("__bytes"), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "__bytes", "__tokens"])

    return run


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, n_tokens. ``path`` is the tokenizer's file.

    Texts of one chunk are counted where they are read. The chunks of longer ones are dealt out
    over all tasks, and only their maps meet again.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("__id"), text.alias("__text"),
        F.octet_length(text).cast("long").alias("__bytes"),
        F.floor((F.greatest(F.char_length(text), F.lit(1)) - 1) / chunk).alias("__last"),
    )
    counted = f"__id {kind}, __bytes bigint, __tokens bigint"
    short = rows.filter("__last = 0").select("__id", "__bytes", "__text")
    part = F.substring(F.col("__text"), (F.col("__no") * chunk + 1).cast("int"), F.lit(chunk))
    cut = (
        rows.filter("__last > 0")
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__last"))))
        .select("__id", "__row", "__bytes", "__no", part.alias("__part"))
        .repartition("__row", "__no")
    )
    mapped = f"__id {kind}, __row bigint, __bytes bigint, __no bigint, head string, count bigint, tail string, broken boolean"
    maps = cut.mapInArrow(_chunk_maps(path), mapped)
    for group in (["__row", F.floor(F.col("__no") / FAN)], ["__row"]):
        maps = maps.groupBy(*group).applyInArrow(_composed(path), mapped)
    return (
        short.mapInArrow(_whole_texts(path), counted)
        .union(maps.mapInArrow(_closed(path), counted))
        .select(F.col("__id").alias(id_col), F.col("__bytes").alias("n_bytes"), F.col("__tokens").alias("n_tokens"))
    )
