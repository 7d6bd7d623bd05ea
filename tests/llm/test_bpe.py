import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tabmine.llm.bpe import PrefixCoder, PrefixTable, encode_documents, load_ranks, token_digests

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    tokens = load_ranks(PATH)
    ranks = {t: i for i, t in enumerate(tokens)}
    return PrefixCoder(tokens), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(seed, n):
    rng = random.Random(seed)
    pool = ["th", "ing", "er", "é", "ß", "a", "aa", "b", "1", "22", " ", "  ", "!", "中", "😀", "ción", "_", "́", "zq", "=="]
    return ["".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(n)]


def test_single_strings_match(vocabulary):
    coder, tk = vocabulary
    pieces = strings(1, 3000) + ["a" * 200, "=" * 300, " " * 90, "ab" * 60, "\n" * 70]
    got = coder.encode_many([p.encode() for p in pieces])
    for p, ids in zip(pieces, got, strict=True):
        assert ids == tk._core_bpe.encode_single_piece(p.encode()), p


def test_appends_and_edits_match_a_fresh_table(vocabulary):
    coder, _ = vocabulary
    rng = random.Random(4)
    table = PrefixTable(coder, "".join(strings(2, 30)).encode())
    for _ in range(60):
        if rng.random() < 0.3:
            table.append("".join(strings(rng.random(), 1)).encode())
        else:
            a = rng.randrange(len(table.data))
            b = min(len(table.data), a + rng.randrange(6))
            table.replace(a, b, "".join(strings(rng.random(), 1))[:8].encode())
        fresh = PrefixTable(coder, table.data)
        assert table.last == fresh.last and table.ids() == fresh.ids()
        assert coder.decode(np.array(table.ids(), dtype="<u4").tobytes()) == table.data


def test_edits_stay_local(vocabulary):
    coder, _ = vocabulary
    table = PrefixTable(coder, " ".join(strings(8, 2000)).encode())
    assert table.replace(100, 103, b"xyz") < 1000


def reference(tk, text):
    ids = tk.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(tk.decode_bytes(ids)).hexdigest())


def test_whole_table(spark, vocabulary):
    _, tk = vocabulary
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = token_digests(docs, PATH, P.PATTERN).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == reference(tk, texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges(spark, vocabulary):
    _, tk = vocabulary
    rows = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "<|endoftext|> it's"), (4, "z" * 300_000), (5, "中文 😀\u0000x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS ids", "2 AS _id")
    got = sorted((tuple(r) for r in token_digests(df, PATH, P.PATTERN).collect()), key=str)
    assert got == sorted([(i, *reference(tk, t)) for i, t in rows], key=str)
    for r in encode_documents(df, PATH, P.PATTERN).collect():
        assert (r.doc_id, r.ids) in [(i, tk.encode_ordinary(t or "")) for i, t in rows]
        assert bytes(r.decoded) in [(t or "").encode() for i, t in rows if i == r.doc_id]
    assert encode_documents(df.limit(0), PATH, P.PATTERN).collect() == []
