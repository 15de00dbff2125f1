import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from pricetide.llm.bpe import RANKS, decode_documents, encode_documents, load_ranks
from pricetide.llm.chunks import chunks_of

ODD = ["", None, " ", "a  b   c\n \n d\t\te ", "it's we'll DON'T'S", "é\xa0b \xa0 c", "\x1c a \x1d\x1d b \x85 x",
       "日本語 テスト 😀😀 😀", "<|endoftext|> a", "aaaaaaaaaaaaaaaa " * 20, "zq" * 6000, "1234 56a7 !!??  !!", " lead", "trail "]


def tokenizer():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=load_ranks(public_tokenizers.path(RANKS)))


def texts():
    rng = random.Random(6)
    return ODD + ["".join(rng.choice(" \n\t ab'sé1!\xa0 \x1c😀Q") for _ in range(rng.randint(1, 80))) for _ in range(400)]


def test_equals_the_library_and_decodes(spark):
    enc, rows = tokenizer(), list(enumerate(texts()))
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    got = encode_documents(df, with_ids=True)
    found = got.collect()
    assert len(found) == len(rows) + 5
    for r in found:
        text = rows[r.doc_id][1] or ""
        ids = enc.encode_ordinary(text)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert {r.doc_id: r.text for r in decode_documents(got).collect()} == {i: t or "" for i, t in rows}


def test_chunks_join_and_cut_where_pieces_start():
    import regex
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in texts():
        parts = chunks_of(text or "")
        assert "".join(parts) == (text or "")
        assert [p for c in parts for p in pattern.findall(c)] == pattern.findall(text or "")


def test_empty_table_and_null_id(spark):
    assert encode_documents(spark.createDataFrame([], "doc_id int, text string")).count() == 0
    r = encode_documents(spark.createDataFrame([(None, "hello", 1)], "doc_id int, text string, n_tokens int")).first()
    assert r.doc_id is None and r.n_tokens == 1


def test_rank_file_is_read_whole():
    with open(public_tokenizers.path(RANKS), "rb") as f:
        first = f.readline().split()
    assert load_ranks(public_tokenizers.path(RANKS))[base64.b64decode(first[0])] == int(first[1])
