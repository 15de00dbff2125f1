import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pricetide.llm.quality_rules import CLASSES, COMMON, QualityRules, language_references, quality_rules, stage

SCHEMA = "doc_id long, text string, lang string"


def prose(rng, lang, n):
    return " ".join(rng.choice(COMMON[lang]) if rng.random() < 0.5 else "".join(rng.choice("abcdeinorst") for _ in range(
        rng.randint(3, 9))) for _ in range(n))


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    places = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(places))


def documents(rng):
    rows = [(i, prose(rng, lang, 200), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 15)]
    rows += [(100, "### $$$ 12 34 || " * 60, "en"), (101, "qqq www zzz " * 50, "en"),
             (102, " ".join(f"xy{i}zz" for i in range(150)), "en"), (103, None, "en"), (104, "", None), (105, "a b c", "en"),
             (106, prose(rng, "en", 120), "xx"), (107, prose(rng, "fr", 300), "en"), (108, "x" * 100000, "en"),
             (109, "a b c d a b c\n a b c\n\n \na b c\na b c", "en"), (110, "é ü\x0bß\x1cq r " * 30, "de"),
             (111, prose(rng, "de", 20000), "de"), (None, prose(rng, "es", 60), "es")]
    return rows + rows[:2]


def test_base_counts_against_brute_force(spark):
    rows = documents(random.Random(3))
    got = quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = Counter((i, *brute_base(t)) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_divergence_and_guards(spark):
    rows = documents(random.Random(4))
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].kept for i in range(60))
    assert got[102].word_distance > QualityRules().max_word_distance and not got[102].kept
    assert not got[107].kept, "French prose that calls itself English"
    assert got[106].kept and got[106].word_distance is None, "an unknown language has no common words"
    assert got[105].class_distance is None and got[109].word_distance is None


def test_distance_is_jensen_shannon(spark):
    rows = [(1, "Aa 1.", "en"), (2, "the of and", "de")]
    rules = QualityRules(min_words=0, min_chars_judged=0)
    df = spark.createDataFrame(rows, SCHEMA)
    refs = {r.lang: r.classes for r in language_references(df, rules=rules).collect()}
    assert set(refs) == {"en", "de", "*"} and refs["en"] == [1, 1, 1, 0, 0, 0, 1, 1] and len(refs["en"]) == len(CLASSES) + 4
    a, b = [x / 5 for x in refs["en"]], [x / 15 for x in refs["*"]]
    m = [(x + y) / 2 for x, y in zip(a, b)]
    want = math.sqrt(sum(x * math.log2(x / z) for v in (a, b) for x, z in zip(v, m) if x) / 2)
    got = quality_rules(spark.createDataFrame([(1, "Aa 1.", None)], SCHEMA), language_references(df, rules=rules),
                        rules=rules).first()
    assert got.class_distance == round(want, 6)


def test_stage_keeps_columns_and_empty_tables(spark):
    rows = [r + (7, "mine") for r in documents(random.Random(5))]
    df = spark.createDataFrame(rows, SCHEMA + ", n_words int, _words string")
    out = stage(spark, df, "")
    assert out.columns == df.columns
    assert {(r.n_words, r._words) for r in out.collect()} == {(7, "mine")}
    assert quality_rules(df.limit(0)).count() == 0


def test_words_count_whatever_separates_them(spark):
    """A text is judged alike when its blanks become line ends or tabs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    references = language_references(docs).cache()
    want = {(r.doc_id, r.kept, r.word_distance, r.class_distance) for r in quality_rules(docs, references).collect()}
    assert sum(kept for _, kept, *_ in want) > 50
    for gap in ("\n", "\t"):
        other = docs.withColumn("text", F.translate("text", " ", gap))
        assert {(r.doc_id, r.kept, r.word_distance, r.class_distance)
                for r in quality_rules(other, references).collect()} == want


def test_each_text_is_split_once_a_pass(spark, tmp_path):
    """One split for the references; one into words and one into lines for the rules; white space takes no pass."""
    spark.createDataFrame(documents(random.Random(6)), SCHEMA).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))

    def uses(df, kind):
        return df._jdf.queryExecution().optimizedPlan().toJSON().count(f".expressions.{kind}\"")

    references = language_references(docs)
    assert uses(references, "StringSplit") == 1
    assert uses(quality_rules(docs), "StringSplit") == 3
    assert uses(quality_rules(docs), "StringTranslate") == 0


def test_references_against_brute_force(spark):
    rows = documents(random.Random(7)) + [(200, "\t\x0bA the\r\n\x0c of\x1c\U0001F600  zu, THE-of l'un \n" * 25, "en"),
                                          (201, " \t la casa", "es")]
    rows = [r for r in rows if r[2] in COMMON and (r[2] != "es" or r[0] == 201)]
    got = {r.lang: r for r in language_references(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {}
    for _, text, lang in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if n < QualityRules().min_words:
            continue
        marks = [len(re.findall(f"[{c}]", text)) for c in CLASSES.values()] + [sum(ord(c) > 127 for c in text)]
        blank, small = len(re.findall(r"[\x20\x09-\x0D]", text)), len(re.findall("[a-z]", text))
        classes = marks + [len(text) - sum(marks) - blank - small, blank, small]
        tokens = Counter(re.findall(r"[^\W\d_]+", text.lower()))
        hits = [tokens[w] for w in COMMON[lang]]
        for code in (lang, "*"):
            want.setdefault(code, [Counter(), Counter()])[0].update(dict(enumerate(classes)))
        want[lang][1].update(dict(enumerate(hits + [max(0, n - sum(hits))])))
    assert set(got) == set(want) == {"en", "de", "fr", "*"}, "no Spanish text is long enough"
    for code, (classes, common) in want.items():
        assert got[code].classes == [classes[i] for i in range(len(CLASSES) + 4)]
        assert got[code].common == (None if code == "*" else [common[i] for i in range(len(COMMON[code]) + 1)])
    assert language_references(spark.createDataFrame([(1, "a b c", "en")], SCHEMA)).count() == 0
