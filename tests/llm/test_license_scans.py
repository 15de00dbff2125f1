import random

from pricetide.llm.license_scans import TEMPLATES, LicenseRules, license_scans, license_sql, op11, word_frequencies, words_in
from tests.harness import compare, duck

SCHEMA = "doc_id long, text string, links string, n_words string"


def documents(rng):
    common = "the of and to is under license a copy work software version terms".split()
    rows = [(1, None), (2, ""), (3, "   \n"), (4, "Released under the MIT License."), (4, "Released under the MIT License."),
            (None, "licensed under CC BY-NC 4.0"), (5, "CC-BY\nmit\tLICENSE apache license gnu general public"),
            (6, "É mit license" * 3), (7, " ".join(["mit", "license"] * 20_000))]
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts += rng.choices(common, k=rng.randint(0, 30))
            words = rng.choice(TEMPLATES)[1].split()
            if rng.random() < 0.5:  # some words lost, others put between
                words = [w for w in words if rng.random() > 0.05]
                words.insert(rng.randrange(len(words) + 1), "xyz")
            if rng.random() < 0.2:
                rng.shuffle(words)
            parts += words
        rows.append((100 + i, rng.choice([" ", "\n", " - "]).join(parts)))
    return [(*r, "x", "y") for r in rows]


def test_equals_sql_that_counts_every_block(spark, tmp_path):
    spark.createDataFrame(documents(random.Random(5)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duck("")
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(op11(spark, str(tmp_path)), con, license_sql()) is None


def test_links_name_their_blocks(spark):
    filler = ["word"] * 100
    text = " ".join(filler + TEMPLATES[6][1].split() + filler)
    row = license_scans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == "gpl,gpl-notice" and row.first_word == 106 and row.score == 1.0
    best = max(row.links, key=lambda x: x.shared)
    assert (best.shared, best.size) == (12, 12) and best.block_start <= 100 and best.block_end >= 112


def test_templates_are_a_parameter(spark):
    rules = LicenseRules(containment=0.5, templates=(("own", "alpha beta gamma delta"), ("none", "  ")), phrases=())
    df = spark.createDataFrame([(1, "beta x delta"), (2, "beta x x x x x x x x x delta"), (3, "beta")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scans(df, rules=rules).collect()}
    assert got == {1: ("own", 0.5), 2: ("", 0.0), 3: ("", 0.0)}


def test_empty_table_and_frequencies(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert license_scans(empty).count() == 0
    df = spark.createDataFrame([(1, "MIT mit license", "", ""), (2, None, "", "")], SCHEMA)
    assert word_frequencies(df, [b"license", b"mit", b"zzz"]) == {b"license": 1, b"mit": 2, b"zzz": 0}
    assert words_in("A-bé 9".encode()) == [b"a", "bé".encode(), b"9"]
