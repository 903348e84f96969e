import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starmart.llm import packing as P
from starmart.llm.tokens import tokenizer, vocabulary_path


def checked(lengths, pieces, window=P.WINDOW):
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in pieces:
        assert n > 0
        per_doc[doc].append((start, n))
        per_sequence[sequence].append((offset, n))
    for spans, want in [(per_doc, dict(enumerate(lengths)))]:
        for doc, total in want.items():
            at = 0
            for start, n in sorted(spans[doc]):
                assert start == at
                at += n
            assert at == total
    padding = 0
    for parts in per_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60))
def test_pack_keeps_every_token_once_without_padding(lengths):
    assert checked(lengths, P.pack(lengths)) == 0


def test_pack_mostly_uncut():
    lengths = np.random.default_rng(1).integers(1, 2048, 4000).tolist()
    pieces = P.pack(lengths)
    assert checked(lengths, pieces) == 0
    cut = {d for d, s, n, _, _ in pieces if n < lengths[d]}
    assert len(cut) < 0.35 * len(lengths)


def test_nnls_reaches_the_conditions_of_the_optimum():
    rng = np.random.default_rng(3)
    a, b = rng.random((20, 40)), rng.random(20) * 10
    x = P.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and abs(gradient[x > 0]).max() < 1e-6


def test_combinations_fill_the_window():
    assert P.combinations(6) == ((6,), (1, 5), (1, 1, 4), (1, 2, 3), (2, 4), (2, 2, 2), (3, 3))


TEXTS = ["", "a", "one two  three", "x\n y \nz", " lead", "trail ", "tab\tÄ é 漢字 🙂", "it's 3.5km <|endoftext|> no",
         "a\n\n b", "  nb   em", "w " * 3000, "z" * 30000, "   ", "don't  stop"]


def test_word_lookup_equals_the_library():
    library = Tokenizer.from_file(vocabulary_path())
    mine = tokenizer(vocabulary_path())
    for text in TEXTS:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == want, text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tab'sé1., 漢", max_size=40))
def test_word_lookup_equals_the_library_on_odd_spaces(text):
    library = Tokenizer.from_file(vocabulary_path())
    got = np.frombuffer(tokenizer(vocabulary_path()).encode(text), "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60))
def test_word_lookup_equals_the_library_on_latin_text(text):
    library = Tokenizer.from_file(vocabulary_path())
    got = np.frombuffer(tokenizer(vocabulary_path()).encode(text), "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def test_packed_documents_against_the_library(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "no id"), (1, "a"), (1, "a")]
    docs = spark.createDataFrame([(i, t, 1.0, 7) for i, t in rows], "doc_id long, text string, length double, offset int")
    out = P.pack_documents(docs.repartition(3)).collect()
    library = Tokenizer.from_file(vocabulary_path())
    for sequence in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted({(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out if r.doc_id == i})
        assert all(n == len(ids) for *_, n in own)
        for start, length, crc, _ in own:
            assert crc == zlib.crc32(ids[start:start + length].tobytes())
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in out) == total


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 6000])
def test_single_document(n):
    assert checked([n], P.pack([n])) == 0
