import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import warc, wavelet
from kestrel.llm.queries import op1_wavelet_tokens, tokenizer_path

TEXTS = ["The 1st  line,\n\nit's THE end", "", None, "日本 語 \x1c a\x85b", "x²¼ ''s I'LL <|endoftext|> z",
         "word " * 30000, "été\tça\r\n ", "word " * 3]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_encoder_equals_the_library(library):
    encode_all = wavelet.Encoder(tokenizer_path(), cached=8).encode_all
    rng = random.Random(3)
    letters = "ab é'sTll19²\t\n .,!|日 \x1f"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(3000)]
    for size in (1, 7, len(texts)):
        for at in range(0, len(texts), size):
            for text, ids in zip(texts[at:at + size], encode_all(texts[at:at + size])):
                assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_pieces_are_told_apart_by_their_bytes(library):
    """Thue-Morse words and their complements share every polynomial hash mod 2^64."""
    word = "a"
    swap = str.maketrans("ab", "ba")
    while len(word) < 4096:
        word += word.translate(swap)
        twins = [word, word.translate(swap), word[:-1] + "c", word[:-1]]
        for cached in (1, 1 << 10):
            got = wavelet.Encoder(tokenizer_path(), cached=cached).encode_all(twins + twins[::-1])
            assert [i.tolist() for i in got] == [
                library.encode(t, add_special_tokens=False).ids for t in twins + twins[::-1]]


def test_special_strings_as_plain_text():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    texts = ["a <|endoftext|> b", "<|endoftext|>", "é日<|endoftext|>"]
    got = wavelet.Encoder(tokenizer_path(), special=False).encode_all(texts)
    assert [i.tolist() for i in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_matrix_answers_from_its_file():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (300, 2), (70_000, 50_257), (300_000, 9), (5, 1 << 20)):
        ids = rng.integers(0, top, n)
        m = wavelet.WaveletMatrix(io.BytesIO(wavelet.pack(ids, [7, None], [n, 0])))
        assert (m.ids() == ids).all() and m.keys == [7, None] and m.lengths.tolist() == [n, 0]
        for i in rng.integers(0, n, min(n, 20)).tolist():
            c = int(ids[i])
            assert m.access(i) == c
            assert m.rank(c, i) == (ids[:i] == c).sum() and m.count(c) == (ids == c).sum()
            assert m.select(c, m.rank(c, i)) == i
        assert m.count(1 << 21) == 0
        if n:
            assert m.positions(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
        with pytest.raises(IndexError):
            m.access(n)


def test_op1_against_the_library(spark, docs_of, written, library):
    rows = [(i, t, "s") for i, t in zip((5, 1, 9, 3, 7, 2, 8, 2), TEXTS)]
    got = sorted(map(tuple, op1_wavelet_tokens(spark, written(documents=docs_of(rows))).collect()),
                 key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 2, 3, 5, 7, 8, 9]
    texts = {i: [] for i in (None, *range(10))}
    for i, t, _ in [*rows, (None, None, None)]:
        texts[i].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    at = 0
    for i, start, n, crc in got:
        assert start == at and (n, crc) in [(len(x), zlib.crc32(x)) for x in texts[i]]
        at += n
    assert op1_wavelet_tokens(spark, written(documents=docs_of([]))).count() == 0


def test_small_shards_hold_whole_documents(spark, docs_of, tmp_path):
    docs = docs_of([(i, "one two three four " * (i % 7), "s") for i in range(60)], extra=False)
    manifest = wavelet.write_shards(docs, tokenizer_path(), str(tmp_path), shard_tokens=50)
    assert manifest.count() > 10 and manifest.agg({"docs": "sum"}).first()[0] == 60
    rows = wavelet.read_shards(manifest).orderBy("start").collect()
    assert [r.doc_id for r in rows] == list(range(60))


# --- WARC -------------------------------------------------------------------

def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, path string")


def _expected(rows):
    first = {}
    for i, _, html, *_ in rows:
        key = (html or "").encode()
        if i is not None:
            first[key] = min(i, first.get(key, i))
    out = []
    for i, _, html, *_ in rows:
        key = (html or "").encode()
        again = len(key) >= 100 and key in first and first[key] != i
        out.append((i, len(key), hashlib.sha256(key).hexdigest(), "revisit" if again else "response",
                    first[key] if again else None))
    return Counter(out)


def test_archives_against_brute_force(spark):
    big = "".join(chr(random.Random(5).randrange(32, 0x2FF)) for _ in range(400_000))
    rows = [(4, "http://a/é?\n x", "y" * 100, "t", "p"), (2, None, "y" * 100, "t", "p"), (9, "u", "y" * 99, None, None),
            (8, "u", "y" * 99, None, None), (None, None, None, None, None), (None, "u", "y" * 100, "t", "p"),
            (5, "u", None, "t", "p"), (6, "u", "", "t", "p"), (7, "u", big, "t", "p"), (1, "u", big, "t", "p"),
            (7, "u", big, "t", "p"), (11, "u", "\x1f\u008b\x08 WARC/1.1" * 40, "t", "p"), (-3, "u", "z" * 500, "t", "p")]
    got = warc.archived_pages(_pages(spark, rows)).collect()
    assert Counter(map(tuple, got)) == _expected(rows)
    assert warc.archived_pages(_pages(spark, [])).count() == 0


def test_every_split_size_reads_every_record_once(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(rng.choices("abcdef \n", k=rng.randrange(3000))), "t", "p") for i in range(80)]
    manifest = warc.write_archives(warc.with_revisits(_pages(spark, rows)), str(tmp_path), file_bytes=20_000)
    assert manifest.count() > 3
    for size in (97, 1500, 1 << 20):
        read = warc.read_archives(manifest, split_bytes=size)
        assert sorted((r.page_id, bytes(r.payload).decode()) for r in read.collect()) == [(r[0], r[2]) for r in rows]


def test_false_magic_is_not_a_record(tmp_path):
    path = tmp_path / "x.warc.gz"
    record = warc._record(1, "u", b"pay", hashlib.sha256(b"pay").hexdigest(), 3, None)
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = other.compress(b"not a record") + other.flush()
    path.write_bytes(other + b"\x1f\x8b\x08" + record + b"junk\x1f\x8b" + record)
    assert len(list(warc._members(f"file:{path}", 0, path.stat().st_size))) == 2
    assert len(list(warc._members(f"file:{path}", len(other) + 4, path.stat().st_size))) == 1


def test_damage_is_never_silent(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * 50, "t", "p") for i in range(3)]
    manifest = warc.write_archives(warc.with_revisits(_pages(spark, rows).coalesce(1)), str(tmp_path))
    listed = manifest.collect()
    assert len(listed) == 1 and listed[0].records == 3
    path = listed[0].path.removeprefix("file:")
    whole = open(path, "rb").read()
    third = whole.rindex(b"\x1f\x8b\x08")

    def read(data, **options):
        open(path, "wb").write(data)
        files = spark.createDataFrame([(listed[0].path, len(data), 3)], "path string, file_bytes long, records long")
        return warc.read_archives(files, **options), files

    flipped = lambda at: whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1:]
    for data in (whole[:-5], whole[:third + 200], flipped(third + 200), flipped(len(whole) - 6)):
        records, _ = read(data)
        with pytest.raises(Exception, match="DamagedRecord"):
            records.collect()
        got = read(data, damaged="report")[0].collect()
        assert sorted(r.record_type for r in got) == ["damaged", "response", "response"]
        assert [r.offset for r in got if r.record_type == "damaged"] == [third]
    # a record whose first bytes are gone is found by its number
    for data in (flipped(third), flipped(third + 20), whole[:third + 30]):
        records, files = read(data)
        assert records.count() == 2
        with pytest.raises(warc.DamagedRecord, match="2 of 3"):
            warc.verified(records, files)
    records, files = read(whole)
    assert warc.verified(records, files).count() == 3


def test_records_of_other_writers(spark, tmp_path):
    def member(kind, block, *fields):
        raw = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", *fields,
                           f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        return packer.compress(raw) + packer.flush()

    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"
    data = (member("warcinfo", b"software: x\r\n") + member("request", b"GET / HTTP/1.1\r\n\r\n")
            + member("response", page, "WARC-Target-URI: http://a/", "WARC-Payload-Digest: sha1:ABCDEFGH")
            + member("response", b"20240101 dns", "Content-Type: text/dns") + member("metadata", b"")
            + member("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Target-URI: http://a/"))
    (tmp_path / "x.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file:{tmp_path}/x.warc.gz", len(data))], "path string, file_bytes long")
    got = [(r.record_type, r.url, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload))
           for r in warc.read_archives(files, split_bytes=100).orderBy("offset").collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == [("response", "http://a/", 9, sha(b"<p>hi</p>"), b"<p>hi</p>"),
                   ("response", None, 12, sha(b"20240101 dns"), b"20240101 dns"),
                   ("revisit", "http://a/", None, None, None)]
