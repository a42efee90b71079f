import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from depthgrid.llm import token_count

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|endoftext|", "Don't we'LL I'd 's ''",
    "ΑΣ ΟΔΟΣ Σ", "İstanbul", "é café é ́x", "1234 12.5 ½ ²", "日本語テキスト 한국어", "a b​c",
    "😀😃 👨‍👩‍👧", "x" * 3000, "ab" * 2000, "\x00\x01 \x7f\x85 a", "hello,world!!! ???...", "ﬁ ǅ ẞ", "a b　c",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def true_count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def random_texts(n):
    draw = random.Random(3)
    letters = "abcdefghinorst' .,19é̈ßΣİ\n\t<|>"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(n)]


def test_counts_equal_the_library(library):
    counter = token_count.TokenCounter(PATH)
    for text in ODD + random_texts(1500):
        assert counter.count(text) == true_count(library, text), text


def test_maps_of_any_cut_compose_to_the_whole(library):
    counter = token_count.TokenCounter(PATH)
    for text in ODD + random_texts(300):
        for size in (1, 3, 11):
            parts = [text[i : i + size] for i in range(0, max(1, len(text)), size)]
            head, count, tail, _ = token_count.compose(
                counter, [token_count.chunk_map(counter, p) for p in parts]
            )
            assert counter.count(head) + count + counter.count(tail) == true_count(library, text)


def test_composition_is_associative():
    counter = token_count.TokenCounter(PATH)
    maps = [token_count.chunk_map(counter, t) for t in ("ab c", "de", "f\n", " gh i", "jk l")]
    left = maps[0]
    for m in maps[1:]:
        left = token_count.compose(counter, [left, m])
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = token_count.compose(counter, [m, right])
    assert left == right == token_count.compose(counter, maps)


def test_small_tables_do_not_change_counts(library, monkeypatch):
    monkeypatch.setattr(token_count, "STATES", 20)
    monkeypatch.setattr(token_count, "WORDS", 5)
    counter = token_count.TokenCounter(PATH)
    for text in random_texts(200) + ["abcdefghij" * 30]:
        assert counter.count(text) == true_count(library, text)
    assert len(counter.machine.state) < 100


def test_frame_with_long_texts_nulls_repeats_and_clashes(spark, library):
    draw = random.Random(1)
    long = " ".join("".join(draw.choice("aeinorst,.") for _ in range(draw.randint(1, 12))) for _ in range(4000))
    rows = [(1, long, 5), (2, None, 6), (3, "", 7), (4, "tie", 8), (4, "tie", 8), (None, "null id", 9),
            (5, "y" * 9000, 1), (6, long, 2)] + [(10 + k, t, 0) for k, t in enumerate(ODD) if "\x00" not in t]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_count.count_tokens(docs, PATH, chunk=500).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), true_count(library, t or "")) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_count.count_tokens(spark.createDataFrame([], docs.schema), PATH).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_count.TokenCounter(public_tokenizers.path("byte_bpe_50k.json"))
