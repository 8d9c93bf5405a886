import hashlib
import random
from collections import Counter

import numpy as np

from kestrel.llm import alignment
from kestrel.llm.queries import PIECES, op13_token_alignment, tokenizer_path

TEXTS = ["", None, " ", "a", "  two  spaces", "with a ▁ in it", "a\0b", "\n\t x\r\n", "é漢字😀 naïve", "same text here",
         "same text here", "<|endoftext|> <s>", "unbelievable " * 3000, "The quick brown fox, 12345 jumps!"]


def brute(texts):
    """Per text: A ids, B ids, groups by walking both cuts, links; then counts of all."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_model = Tokenizer.from_file(tokenizer_path())
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    table = alignment.byte_level_bytes(tokenizer_path())

    def b_bytes(i):
        return bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()
    rows = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        if b"".join(table[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        while i < len(a):
            ga, gb = [a[i]], [b[j]]
            x, y, i, j = x + len(table[a[i]]), y + len(b_bytes(b[j])), i + 1, j + 1
            while x != y:
                if x < y:
                    ga.append(a[i])
                    x, i = x + len(table[a[i]]), i + 1
                else:
                    gb.append(b[j])
                    y, j = y + len(b_bytes(b[j])), j + 1
            groups.append((ga, gb))
        rows.append((a, b, groups))
    counts = Counter((ga[-1], gb[-1]) for _, _, groups in rows for ga, gb in groups)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for a, b, groups in rows:
        link = [(ga[-1], gb[-1]) for ga, gb in groups]
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(link), sum(counts[k] == most[k[1]] for k in link),
                    sum(counts[k] for k in link), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def test_op13_against_brute_force(spark, docs_of, written):
    rng = random.Random(4)
    made = ["".join(rng.choices("ab é'sTll19²\t .,!|日😀", k=rng.randrange(60))) for _ in range(400)]
    rows = [(i, t, "s") for i, t in zip([3, 1, 2, 2, 9, None, *range(20, 900)], TEXTS + made)]
    got = op13_token_alignment(spark, written(documents=docs_of(rows))).collect()
    want = brute([t for _, t, _ in rows] + [None])
    ids = [i for i, _, _ in rows] + [None]
    assert sorted(map(tuple, got), key=str) == sorted(((i, *w) for i, w in zip(ids, want)), key=str)
    assert op13_token_alignment(spark, written(documents=docs_of([]))).count() == 0


def test_ids_and_groups_of_the_operator(spark, docs_of):
    docs = docs_of([(i, t, "s") for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in alignment.aligned(docs, tokenizer_path(), tokenizer_path(PIECES)).collect()}
    of = lambda x: np.frombuffer(x, "<u4").tolist()
    for i, (n_a, n_b, n, *_, sha) in enumerate(brute(TEXTS)):
        a, b, in_a, in_b = map(of, (got[i].a_ids, got[i].b_ids, got[i].a_groups, got[i].b_groups))
        assert (len(a), len(b), len(in_a), len(in_b), sum(in_a), sum(in_b)) == (n_a, n_b, n, n, n_a, n_b)
        at = np.cumsum([0, *in_a]), np.cumsum([0, *in_b])
        text = ";".join(f"{','.join(map(str, a[s:e]))}|{','.join(map(str, b[t:f]))}" for s, e, t, f in zip(
            at[0], at[0][1:], at[1], at[1][1:]))
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == sha


def test_groups_of_random_cuts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 17, 400):
        for most in (2, 5, 40):
            a = np.diff([0, *np.unique(rng.integers(1, n + 1, max(1, n // most))), n + 1])
            b = np.diff([0, *np.unique(rng.integers(1, n + 1, max(1, n // 2))), n + 1])
            of_a, of_b = alignment.overlap_groups(a, b)
            both = np.intersect1d(np.cumsum(a), np.cumsum(b))
            assert (of_a == np.searchsorted(both, np.cumsum(a))).all()
            assert (of_b == np.searchsorted(both, np.cumsum(b))).all()


def test_one_chain_of_many_tokens():
    """Cuts that meet at the end only: a chain as long as the text."""
    a, b = np.full(100_000, 2), np.array([1, *[2] * 99_999, 1])
    of_a, of_b = alignment.overlap_groups(a, b)
    assert of_a.max() == of_b.max() == 0


def test_pairs_that_can_end_together():
    assert 300_000 < alignment.most_pairs(tokenizer_path(), tokenizer_path(PIECES)) < 1_000_000
