"""Alignment of two tokenizers against the plain libraries."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from depthgrid.llm import token_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "x\ny z", "<|endoftext|>", "a<|endoftext|> b", "<s> </s>",
    "<0x41> <unk>", "a▁b c", "▁", "é café", "é", "日本語 テキスト", "😀😃 👨‍👩‍👧 x", "1234 12.5 ½ ²", "Don't we'LL I'd 's ''", "\x00 \x01\x7f",
    "a b　c d", "x" * 500, "ab " * 400, "hello,world!!! ???...", "\t\tindent  two", "tail   ", "   head", "a\x1c b\x85 c",
]


class Plain:
    """The contract, word for word, on whole texts."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        letters = token_links.byte_of_letter()
        self.a_bytes = lambda i: bytes(letters[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return None
        whole = (" " + text).encode()
        a = [(i, self.a_bytes(i)) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.b_bytes(i)) for i in self.b.encode(text)]
        if any(b"".join(x for _, x in side) != whole for side in (a, b)):
            return None
        return a, b

    def groups(self, text):
        found = self.tokens(text)
        if found is None:
            return None
        ends = []
        for side in found:
            at, here = 0, {}
            for i, raw in side:
                at += len(raw)
                here[at] = i
            ends.append(here)
        common = sorted(set(ends[0]) & set(ends[1]))
        cut = []
        for side in found:
            at, rows, row = 0, [], []
            for i, raw in side:
                at += len(raw)
                row.append(i)
                if at in ends[0] and at in ends[1]:
                    rows.append(row)
                    row = []
            cut.append(rows)
        links = [(ends[0][e], ends[1][e]) for e in common]
        return list(zip(*cut)), links, len(found[0]), len(found[1])


def plain(texts):
    tool = Plain()
    found = [tool.groups(t) for t in texts]
    counts = Counter(link for f in found if f for link in f[1])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, f in enumerate(found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links, n_a, n_b = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (i, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest())
        )
    return out


def run(spark, texts, parts=3, **options):
    table = spark.createDataFrame(
        [(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, code string"
    ).repartition(parts)
    return sorted(tuple(r) for r in token_links.align_tokens(table, A, B, **options).collect())


def random_texts(n, seed=5):
    draw = random.Random(seed)
    letters = "abcdefghinorst    .,19é̈ßΣ\n\t▁😀"
    plain_words = ["the", "and", "ing", "tion", "Hello", "world", "x1", "..", "é", "naïve"]
    out = []
    for _ in range(n):
        if draw.random() < 0.5:
            out.append("".join(draw.choice(letters) for _ in range(draw.randint(1, 60))))
        else:
            out.append(" ".join(draw.choice(plain_words) for _ in range(draw.randint(1, 30))))
    return out


@pytest.mark.parametrize("heavy", [token_links.HEAVY, 5, 0])
def test_equals_plain_libraries(spark, heavy):
    texts = ODD + random_texts(150)
    assert run(spark, texts, heavy=heavy) == plain(texts)


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r.text for r in rows]
    assert run(spark, texts, 5) == plain(texts)


def test_long_texts_in_pieces_and_small_memory(spark, monkeypatch):
    texts = [" ".join(random_texts(200, seed)) for seed in (1, 2)] + ["y" * 4000, "a b " * 3000]
    pair = token_links.Pair(A, B)
    monkeypatch.setattr(token_links, "PIECE", 37)
    monkeypatch.setattr(token_links, "SLICE", 200)
    monkeypatch.setattr(token_links, "PARTS", 11)
    tool = Plain()
    rows, codes, counts = token_links._texts(pair, texts + ODD)
    for text, row, own, often in zip(texts + ODD, rows, codes, counts):
        want = tool.groups(text)
        if want is None:
            assert row == (0, 0, 0, "") and not len(own)
            continue
        groups, links, n_a, n_b = want
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert row == (n_a, n_b, len(groups), hashlib.sha256(joined.encode()).hexdigest())
        assert Counter({(int(c) >> 32, int(c) & 0xFFFFFFFF): int(n) for c, n in zip(own, often)}) == Counter(links)


def test_identity_map_holds_equal_bytes():
    pair = token_links.Pair(A, B)
    known = [(a, b) for a, b in enumerate(pair.same.tolist()) if b >= 0]
    assert len(known) > 5000
    assert all(pair.a_bytes[a] == pair.b_bytes[b] for a, b in known)
    assert pair.cuttable


def test_empty_table_repeats_and_null_ids(spark):
    assert run(spark, []) == []
    table = spark.createDataFrame([(None, "the end"), (7, "the end"), (7, "the end")], "doc_id long, text string")
    got = token_links.align_tokens(table, A, B).collect()
    want = plain(["the end"] * 3)[0]
    assert len(got) == 3 and {tuple(r)[1:] for r in got} == {want[1:]}
