import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, queries, token_counts

SIGNS = "aAbBzZ 0129  \n\t\r'sdm.,!@#-_()éèçÀ×÷ßñĀſ\xa0\x1c\x85'¡²¼ǅ٣中́İΣ😀"


@pytest.fixture(scope="module")
def corpus(spark, sf_small):
    r = random.Random(6)
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows += [(10_000 + i, "".join(r.choice(SIGNS) for _ in range(r.randint(0, 80)))) for i in range(300)]
    rows += [(20_000, None), (20_001, ""), (20_002, "x <|endoftext|> y<|endoftext|>"), (20_003, "<|startoftext|>A <|endoftext|>"),
             (20_004, " " * 3000), (20_005, "a" * 3000 + " b"), (20_006, "word " * 5000), (None, "It's a b"), (20_006, "word " * 5000)]
    return rows


@pytest.fixture(scope="module")
def docs(frame, corpus):
    return frame([(*row, 1) for row in corpus], "doc_id bigint, text string, n_tokens int")


def ids_of(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("length", "want"), [(1, [(0, 1)]), (2048, [(0, 2048)]), (5000, [(0, 2048), (2048, 2048), (4096, 512), (4608, 256), (4864, 128), (4992, 8)])])
def test_pieces(length, want):
    assert packing.pieces_of(length) == want


def test_pieces_restore_every_document(docs, corpus):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.pack_documents(docs, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_doc = {}
    for r in rows:
        part = np.array(r.ids, dtype="<u4")
        assert r.length == len(part) <= 2048 and r.length & (r.length - 1) == 0 and r.offset == 0
        assert r.sequence_id >> packing.BUCKET_SHIFT == r.length.bit_length() - 1
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in corpus:
        want = exact.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[doc_id], key=lambda r: r.start)
        copies = sum(d == doc_id for d, _ in corpus)
        assert {r.doc_tokens for r in own} == {len(want)}
        assert [i for r in own[::copies] for i in r.ids] == want
    assert {r["length"]: r["tokens"] for r in packing.buckets(queries.pack_documents(docs)).collect()} == {
        n: sum(r.length for r in rows if r.length == n) for n in {r.length for r in rows}}


def test_counts_equal_the_library(docs, corpus):
    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    want = []
    for doc_id, text in corpus:
        n = len(exact.encode(text or "", add_special_tokens=False).ids)
        want.append((str(doc_id), len((text or "").encode()), n, n > 2048))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    path = public_tokenizers.path("word_bpe_49k.json")
    lengths = token_counts.Lengths(path, {"the": 1})
    for text in ("the quick brown fox jumped", "over the lazy dog", "the " + "x" * 100):
        assert lengths.counts([text]) == [len(ids_of("word_bpe_49k.json", text))]
    assert "x" * 100 not in lengths.known and "the" in lengths.known


def test_empty_table(frame):
    none = frame([], "doc_id bigint, text string")
    assert queries.pack_documents(none).count() == 0
    assert token_counts.count_tokens(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
