import random

import pytest

from pricetide.llm.source_divergence import (NO_TERM, DivergenceRules, divergence_sql, merged_stripes, op12, source_divergence,
                                             stripes)
from tests.harness import compare, duck

SCHEMA = "doc_id long, text string, lang string, source string, term string, counts string"


def documents(rng):
    rows, vocabulary = [], [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "straße", "Zz"]
    for i in range(200):
        lang = rng.choice(["en", "de", None, ""])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", None, ""])
        text = " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=rng.randint(0, 60)))
        rows.append((i, text.upper() if rng.random() < 0.2 else text, lang, source))
    rows += [(None, None, None, None), (1, "", "en", "only here"), (2, "x" * 50_000 + " " + "wa " * 20_000, "en", "a"),
             (3, "few words", "xx", "s"), (4, None, "xx", "t")] + [rows[0]] * 3
    return [(*r, "term", "clash") for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("divergence"))
    spark.createDataFrame(documents(random.Random(3)), SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def sql_rows(folder):
    con = duck("")
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    return con


def test_equals_sql(spark, folder):
    con = sql_rows(folder)
    assert compare(op12(spark, folder), con, divergence_sql()) is None
    got = con.execute(divergence_sql()).fetchall()
    assert {r[0] for r in got} == {"", "en", "de", "xx"} and ("xx", "s", "pair", "t", 0, 1) in got


@pytest.mark.parametrize("rules", [DivergenceRules(spill_entries=1, slice_bytes=200, block_cells=40),
                                   DivergenceRules(min_docs=1, top=3, block_cells=1)])
def test_spills_and_blocks_change_nothing(spark, folder, rules):
    found = source_divergence(spark.read.parquet(f"{folder}/documents.parquet").repartition(7), rules=rules)
    assert compare(found, sql_rows(folder), divergence_sql(rules)) is None


def test_stripes_of_a_term_are_merged(spark):
    df = spark.createDataFrame([("a a b", "en", "s"), ("a", "en", "t"), ("a", "de", "s")], "text string, lang string, source string")
    rules = DivergenceRules(min_docs=2, spill_entries=1, slice_bytes=1)
    assert stripes(df.coalesce(1), rules=rules).where("term = 'a'").count() == 3
    got = {(r.lang, r.term): (r.docs, dict(zip(r.sources, r.counts))) for r in merged_stripes(
        stripes(df, rules=rules), rules).collect()}
    assert got == {("en", "a"): (2, {"s": 2, "t": 1}), ("en", NO_TERM): (0, {"s": 1, "t": 1}), ("de", NO_TERM): (0, {"s": 1})}


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
