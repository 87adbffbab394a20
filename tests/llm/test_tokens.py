"""Operators 1 and 10: exact ids of the tokenizer libraries, round trips, files."""

import hashlib
import random
import zlib

import numpy as np

from tidemark.llm import byte_bpe, token_files
from tidemark.llm.shared import scratch


def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.vocabulary_file())


def test_chunks_give_the_library_ids(odd):
    rnd = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "B", "'s", "é", "1", "!", " ", "\x1c", "\x85", "<|endoftext|>", " x", "　", "'"]
    texts = [t or "" for _, t in odd] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    enc = token_files.ChunkEncoder(token_files.vocabulary_file())
    got = enc.encode_many(texts)
    want = plain_tokenizer().encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, enc.dtype).tolist() for g in got] == [w.ids for w in want]


def test_special_strings(spark):
    """As the library has them by default, or as text on request."""
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|> b  <|endoftext|>", " <|endoftext|>", "<|endoftext|> <|endoftext|>\n<|endoftext|>", "<|endo ftext|>", ""]
    for as_text in (False, True):
        plain = plain_tokenizer()
        plain.encode_special_tokens = as_text
        enc = token_files.ChunkEncoder(token_files.vocabulary_file(), as_text)
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(g, enc.dtype).tolist() for g in enc.encode_many(texts)] == want
        assert (50256 in want[0]) != as_text
    got = token_files.token_file_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(plain_tokenizer().encode(t, add_special_tokens=False).ids) + 1 for t in texts]


def test_memory_starts_anew(monkeypatch, odd):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    enc = token_files.ChunkEncoder(token_files.vocabulary_file())
    plain = plain_tokenizer()
    for _, t in odd:
        assert np.frombuffer(enc.encode_many([t or ""])[0], enc.dtype).tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_token_files(docs, odd):
    t = plain_tokenizer()
    got = token_files.token_file_digests(docs).collect()
    got.sort(key=lambda r: (r.start, r.n_tokens))
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd), key=lambda i: (i is not None, i or 0))
    start, want = 0, {}
    for i, text in odd:
        ids = np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r.start == start
        start += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))


def test_files_are_written_again_alike(spark, docs):
    folder = scratch(spark, "tokens")
    first = token_files.write_tokens(docs, folder).collect()
    assert token_files.write_tokens(docs, folder).collect() == first
    assert first[-1].base_tokens == sum(r.n_tokens for r in first[:-1])


def test_no_documents(none):
    assert token_files.token_file_digests(none).count() == 0
    assert byte_bpe.round_trip(none).count() == 0


def test_pieces_encode_as_the_whole():
    rnd = random.Random(4)
    codec = byte_bpe.codec(byte_bpe.rank_file())
    for _ in range(2000):
        text = "".join(rnd.choice([" ", "  ", "\n", "a", "'s", "é", "12", "!", " ", "　"]) for _ in range(rnd.randint(0, 40)))
        ids = [i for p in byte_bpe.pieces(text, 5) for i in codec._enc.encode_ordinary(p)]
        assert ids == codec._enc.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_long_white_space(monkeypatch, spark):
    """Short runs taken apart give the library's ids; runs that end the library's matcher are coded and restored."""
    codec, rnd = byte_bpe.codec(byte_bpe.rank_file()), random.Random(6)
    with monkeypatch.context() as m:
        m.setattr(byte_bpe, "WHOLE_CHARS", 4)
        m.setattr(byte_bpe, "_RUN", byte_bpe.re.compile(byte_bpe._RUN.pattern.replace(str(byte_bpe.LONG_RUN), "2")))
        for _ in range(3000):
            text = "".join(rnd.choice([" ", "\n", "\t", "\x85", "\u3000", "\x1c", "a", "'s", "7", "!?"]) * rnd.choice([1, 1, 2, 5]) for _ in range(rnd.randint(0, 12)))
            assert codec.encode(text) == codec._enc.encode_ordinary(text)
    long = [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", "x " + " \n" * 1_000_000 + " word\n" + "\t" * 1_500_000]
    got = byte_bpe.round_trip(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert all(r.restored for r in got)
    assert got[0].n_tokens == 2_000_000 and got[1].n_tokens == 2_000_002


def test_round_trip(docs, odd):
    codec = byte_bpe.codec(byte_bpe.rank_file())
    want = sorted((str(i), n, a, b, True) for i, t in odd for ids in [codec._enc.encode_ordinary(t or "")] for n, a, b in
                  [(len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())])
    assert sorted((str(r[0]), *r[1:]) for r in byte_bpe.round_trip(docs).collect()) == want


def test_encode_and_decode_keep_columns(docs):
    out = byte_bpe.decode(byte_bpe.encode(docs, ids="ids"), "ids")
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in out.collect())


def test_raw_bytes_need_not_be_text():
    codec = byte_bpe.codec(byte_bpe.rank_file())
    ids = codec.encode("漢\U0001f600")
    assert b"".join(codec.decode([i]) for i in ids).decode() == "漢\U0001f600"
