import hashlib
import random
import time

import numpy as np
import pytest

from kestrel.llm import sentences
from kestrel.llm.queries import PIECES, op12_sentence_pieces, tokenizer_path

TEXTS = ["", None, " ", "  a", "a▁b", "▁▁ ▁", "a\0b", "\n\t x\r\n", "é漢字😀 �", "<s>hi</s> <unk> <0x41>",
         "aＡ①", "word " * 20_000, "a" * 5_000, " " * 77, "-" * 301 + "=" * 100]
ALPHABETS = ["ab é'sTll19²\t\n .,!|日 \x1f▁😀", "abcdefghijklmnopqrstuvwxyz", "aeinrst", " a", "the and ing ",
             "0123456789abcdef-=*#/ ", "aA=-_*"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


@pytest.fixture(scope="module")
def coder():
    return sentences.Encoder(tokenizer_path(PIECES))


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_encoding_equals_the_library(coder, library, alphabet):
    rng = random.Random(len(alphabet))
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(n))) for n in (40, 40, 40, 900) for _ in range(150)]
    small = sentences.Encoder(tokenizer_path(PIECES), cached=4)
    for encode_all in (coder.encode_all, small.encode_all):
        for text, ids in zip(texts, encode_all(texts), strict=True):
            assert ids.tolist() == library.encode(text), text
            assert coder.decode(ids) == library.decode(ids.tolist())


def test_decoding_of_any_ids(coder, library):
    rng = random.Random(1)
    kinds = [lambda: rng.randrange(32_000), lambda: rng.randrange(3, 259), lambda: rng.randrange(3), lambda: 28705]
    for _ in range(4000):
        ids = [rng.choice(kinds)() for _ in range(rng.randrange(9))]
        assert coder.decode(np.array(ids, np.uint32)) == library.decode(ids), ids


def test_one_very_long_word(coder, library):
    rng = random.Random(2)
    for alphabet in ("acgt", "abcdefghijklmnopqrstuvwxyz", "a"):
        word = "".join(rng.choices(alphabet, k=300_000))
        start = time.perf_counter()
        ids = next(coder.encode_all([word]))
        assert time.perf_counter() - start < 30
        assert ids.tolist() == library.encode(word)


def test_op12_against_the_library(spark, docs_of, written, library):
    rows = [(i, t, "s") for i, t in zip([3, 1, 2, 2, 9, None, *range(20, 40)], TEXTS * 2)]
    got = op12_sentence_pieces(spark, written(documents=docs_of(rows)))
    want = []
    for i, text, _ in [*rows, (None, None, None)]:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert op12_sentence_pieces(spark, written(documents=docs_of([]))).count() == 0


def test_ids_and_text_of_the_operator(spark, library):
    docs = spark.createDataFrame([(1, "Two words", b"x", 5)], "doc_id long, text string, ids binary, decoded int")
    row = sentences.encoded(docs, tokenizer_path(PIECES)).first()
    assert row.decoded == "Two words"
    assert np.frombuffer(row.ids, "<u4").tolist() == library.encode("Two words", add_bos=True, add_eos=True)
