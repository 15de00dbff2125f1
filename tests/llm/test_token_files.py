import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricetide.llm.token_files import TokenFile, read_token_files, write_token_files
from tests.llm.test_bpe import texts


def test_round_trip_against_the_library(spark, tmp_path):
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts())] + [(2000, "long words of text " * 3000), (2000, "again"),
                                                                 (None, "no id")]
    rows += [(3000 + i, t) for i, t in enumerate(["a <|endoftext|>b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n y",
                                                  "<|endoftext |> <|endoftext"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit(1))
    index = write_token_files(df, str(tmp_path), length=64, rows=4)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {(d, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    assert 50256 in ids[3000, "a <|endoftext|>b"] and 50256 not in ids[3003, "<|endoftext |> <|endoftext"]
    got = sorted(read_token_files(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([d for d, _ in rows], key=lambda d: -1 if d is None else d)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    want = sorted((-1 if d is None else d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), x in ids.items())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


def test_sequences_are_views_of_equal_length(spark, tmp_path):
    df = spark.createDataFrame([(i, "some words " * 40) for i in range(30)], "doc_id long, text string")
    index = write_token_files(df, str(tmp_path), length=16, rows=4).collect()
    per = {}
    for r in index:
        per[r.file] = per.get(r.file, 0) + r.n_tokens
    for name, n in per.items():
        file = TokenFile(name)
        count = -(-n // 16)
        ids, mask = file.sequence(count - 1)
        assert len(ids) == len(mask) == 16 and sum(mask.to_pylist()) == n - 16 * (count - 1)
        assert not ids.flags.owndata and file.source.size() >= file.first + file.step
        joined = np.concatenate([file.sequence(i)[0] for i in reversed(range(count))][::-1])[:n]
        assert (joined == file.tokens(0, n)).all()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert read_token_files(write_token_files(df, str(tmp_path))).count() == 0
