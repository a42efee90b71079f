import brute
import numpy as np
import pyarrow as pa

from depthgrid.llm import words


def sets_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    return [s for part in words.slices(batch, "t") for s in words.shingle_sets(part.column("t"))]


def test_shingle_sets_have_the_true_sizes_and_equalities():
    texts = [
        None, "", "  \t\n", "one", "One", "a b c d", "a b c d e", "A B C D E f", "a a a a a a a a",
        "é è ê ë ē x", "x " * 5000, "w\x0bv\x0cu\rt s r", "a\x85b c d e f g",
        "y" * (3 << 20), "y" * (3 << 20) + " z", "q" * ((1 << 20) - 1) + " r s t u v",
    ]
    found, true = sets_of(texts), [brute.shingles(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in true]
    for a, x in zip(found, true):
        for b, y in zip(found, true):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_words_do_not_depend_on_the_slice(monkeypatch):
    texts = ["alpha beta " * 40, "gamma", "", "delta epsilon zeta " * 30, "x" * 700]
    whole = sets_of(texts)
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    for a, b in zip(whole, sets_of(texts)):
        assert (a == b).all()


def test_offsets_of_a_sliced_column():
    column = pa.array(["skip me", "a b", None, "c"]).slice(1)
    starts, ends, hashes, bounds = words.word_hashes(column)
    assert bounds.tolist() == [0, 2, 2, 3]
    assert len(set(hashes.tolist())) == 3
