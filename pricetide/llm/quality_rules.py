"""Quality rules: does a text look like its language?

Two histograms of a text, its character classes and its common words, are compared by Jensen-Shannon distance with
references of the language, which are counted over all texts of that language.  Short texts are guarded: a histogram
is judged only from a least number of characters or words on.

Only DataFrame functions are used.  One pass adds up the references (one row per known language and one for all), a
second judges every row; nothing is shuffled but those sums.

Defined results: a null or blank text has no words and fails.  A row whose language is null or unknown is compared
with the reference of all texts, and by character classes only.  Rows are never merged: repeated rows are judged
alike.  Other columns pass through, but for columns with the names of results, which are replaced.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import GAP, free_prefix, read_table, words_of

# Common function words of the four languages.
COMMON = {
    "en": "the of and to in is that for was on".split(),
    "de": "der die und in den von zu das mit sich".split(),
    "fr": "de la le et les des en un du une".split(),
    "es": "de la que el en y los del se las".split(),
}
# Classes of characters; the rest are white space, a-z, and what is left.
CLASSES = {"upper": "A-Z", "digit": "0-9", "mark": r".,;:!?'\"()-", "sign": r"#*$%&|<>@=+/\\^~_{}\[\]`"}
SYMBOLS = "#*$%&|<>"
ANY = "*"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
           "word_distance", "kept")


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars_judged: int = 200
    min_words_judged: int = 100
    max_class_distance: float = 0.30
    max_word_distance: float = 0.33


def _long(x) -> Column:
    return x.cast("long")


def _sum(x: Column) -> Column:
    return F.aggregate(x, _long(F.lit(0)), lambda s, v: s + v)


def _histograms(docs: DataFrame, text: str, lang: str, p: str) -> DataFrame:
    """Add, as columns with the prefix: lang, size (characters), rare (the text without a-z and white space), words, n (their
    number), chars (characters in them), and the histograms ``classes`` and ``common`` as arrays of long."""
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn(p + "lang", F.when(F.col(lang).isin(*COMMON), F.col(lang)).otherwise(F.lit(ANY))) \
        .withColumn(p + "rare", F.regexp_replace(whole, r"[a-z\x20\x09-\x0D]+", "")) \
        .withColumn(p + "size", _long(F.length(whole))).withColumn(p + "words", words_of(F.col(text))) \
        .withColumn(p + "n", F.size(p + "words")).withColumn(p + "chars", _long(F.length(F.array_join(p + "words", ""))))
    rare = F.col(p + "rare")
    marked = [_long(F.length(F.regexp_replace(rare, f"[^{c}]+", ""))) for c in CLASSES.values()]
    # In UTF-8 a character beyond ASCII has more bytes than one.
    wide = _long(F.length(F.regexp_replace(rare, r"[\x00-\x7F]+", "")))
    df = df.withColumn(p + "marked", F.array(*marked, wide))
    # What is in no word is white space.
    df = df.withColumn(p + "classes", F.concat(p + "marked", F.array(
        F.length(rare) - _sum(F.col(p + "marked")), F.col(p + "size") - F.col(p + "chars"),
        F.col(p + "chars") - F.length(rare))))
    found, counts = F.lit(None).cast("string"), F.lit(None).cast("array<bigint>")
    for code, words in COMMON.items():
        here = F.col(p + "lang") == code
        # The first two only pass over most places sooner.
        pattern = f"(?=[{''.join(sorted({w[0] for w in words}))}])(?<![a-z])" \
            + r"(?<!\p{L})(" + "|".join(words) + r")(?!\p{L})"
        found = F.when(here, F.array_join(F.regexp_extract_all(F.lower(whole), F.lit(pattern), F.lit(1)), "  ")).otherwise(found)
        size = F.length(p + "found")
        counts = F.when(here, F.array(*[_long((size - F.length(F.replace(
            F.col(p + "found"), F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)) for w in words])).otherwise(counts)
    df = df.withColumn(p + "found", F.concat(F.lit(" "), found, F.lit(" "))) \
        .withColumn(p + "hits", counts)
    return df.withColumn(p + "common", F.concat(p + "hits", F.array(F.greatest(
        _long(F.lit(0)), F.col(p + "n") - _sum(F.col(p + "hits"))))))


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang",
                        rules: QualityRules = QualityRules()) -> DataFrame:
    """(lang, classes, common): histograms added up over all texts with ``min_words`` words; five rows at most."""
    p = free_prefix(docs)
    # Short texts add nulls; a filter would be moved below and split every text once more.
    df = _histograms(docs.select(text, lang), text, lang, p).withColumns({p + h: F.when(
        F.col(p + "n") >= rules.min_words, F.col(p + h)) for h in ("classes", "common")})
    n, k = len(CLASSES) + 4, len(COMMON["en"]) + 1
    sums = [F.sum(F.get(p + "classes", F.lit(i))).alias(f"c{i}") for i in range(n)]
    sums += [F.sum(F.get(p + "common", F.lit(i))).alias(f"w{i}") for i in range(k)]
    per = df.groupBy(F.col(p + "lang").alias("lang")).agg(*sums).where(F.col("c0").isNotNull())
    classes, common = F.array(*[f"c{i}" for i in range(n)]), F.array(*[f"w{i}" for i in range(k)])
    # Five rows: each language, and the sum of all; read once.
    both = per.select(F.explode(F.array("lang", F.lit(ANY))).alias("lang"), F.struct(classes.alias("c"), common.alias(
        "w"), (F.col("lang") != ANY).alias("known")).alias("h"))
    total = both.groupBy("lang").agg(*[F.sum(F.get("h.c", F.lit(i))).alias(f"c{i}") for i in range(n)],
                                     *[F.sum(F.get("h.w", F.lit(i))).alias(f"w{i}") for i in range(k)])
    return total.select("lang", classes.alias("classes"),
                        F.when(F.col("lang") != ANY, common).alias("common"))


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two histograms as arrays; null if one is empty or missing."""
    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def half(x, m):
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))

    def term(x, y):
        m = (x + y) / 2
        return half(x, m) + half(y, m)

    ta, tb = total(a), total(b)
    pairs = F.zip_with(F.transform(a, lambda v: v / ta), F.transform(b, lambda v: v / tb), term)
    summed = F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)
    return F.when((ta > 0) & (tb > 0), F.sqrt(F.greatest(F.lit(0.0), summed / (2 * math.log(2)))))


def quality_rules(docs: DataFrame, references: DataFrame | None = None, text: str = "text", lang: str = "lang",
                  rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, the two distances and
    ``kept``.

    ``references`` come from ``language_references``; by default from the same documents.
    """
    references = language_references(docs, text, lang, rules) if references is None else references
    p = free_prefix(docs, references)
    whole = F.coalesce(F.col(text), F.lit(""))
    df = _histograms(docs, text, lang, p)
    words = F.col(p + "words")
    # Windows as hashes of three words; most texts repeat none, which their distinct number shows.
    df = df.withColumn(p + "windows", F.slice(
        F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))))
    windows = F.col(p + "windows")
    df = df.withColumn(p + "sorted", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ordered = F.col(p + "sorted")

    def same(x, i):
        return F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))

    df = df.withColumn(p + "again", F.sort_array(F.transform(
        F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])))
    again = F.col(p + "again")
    covered = _sum(F.transform(again, lambda x, i: _long(F.least(F.lit(3), F.coalesce(
        F.get(again, i + 1) - x, F.lit(3))))))
    df = df.withColumn(p + "lines", F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    result = {
        "n_words": F.col(p + "n"), "word_chars": F.col(p + "chars"),
        "n_symbols": F.length(F.regexp_replace(p + "rare", r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(p + "lines") - F.size(F.array_distinct(p + "lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0))}
    names = {k: p + "r_" + k for k in result}
    df = df.withColumns({names[k]: _long(v) for k, v in result.items()})
    df = df.withColumn(p + "failed", (F.col(names["n_words"]) < rules.min_words) | (
        100 * F.col(names["n_repeat_words"]) > rules.max_repeat_percent * F.col(names["n_words"])))
    refs = references.select(F.col("lang").alias(p + "ref"), F.col("classes").alias(p + "ref_classes"),
                             F.col("common").alias(p + "ref_common"))
    # Five reference rows at most: the list of languages is fixed.
    df = df.join(F.broadcast(refs), F.col(p + "lang") == F.col(p + "ref"), "left")
    df = df.withColumn(p + "class_distance", F.when(
        F.col(p + "size") >= rules.min_chars_judged, js_distance(F.col(p + "classes"), F.col(p + "ref_classes"))))
    df = df.withColumn(p + "word_distance", F.when(
        F.col(names["n_words"]) >= rules.min_words_judged, js_distance(F.col(p + "common"), F.col(p + "ref_common"))))
    fine = (F.coalesce(F.col(p + "class_distance"), F.lit(0.0)) <= rules.max_class_distance) & (
        F.coalesce(F.col(p + "word_distance"), F.lit(0.0)) <= rules.max_word_distance)
    outcome = {**{k: F.col(v) for k, v in names.items()}, "base_failed": F.col(p + "failed"),
               "class_distance": F.round(p + "class_distance", 6), "word_distance": F.round(p + "word_distance", 6),
               "kept": ~F.col(p + "failed") & fine}
    return df.select(*[F.col(c) for c in docs.columns if c.lower() not in outcome],
                     *[v.alias(k) for k, v in outcome.items()])


def op1(spark, folder: str) -> DataFrame:
    return quality_rules(read_table(spark, folder, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the rules keep."""
    p = free_prefix(docs)
    own = {c: f"{p}own_{c}" for c in docs.columns if c.lower() in RESULTS}
    # A filter is not moved below a row number; moved down, it would hold all rules written out many times over.
    judged = quality_rules(docs.withColumnsRenamed(own)).withColumn(p + "row", F.monotonically_increasing_id()) \
        .where(F.col("kept") & (F.col(p + "row") >= 0))
    return judged.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality_sql(rules: QualityRules = QualityRules()) -> str:
    """DuckDB SQL for ``op1``; the CTE ``judged`` has one row per document."""
    known = ", ".join(f"'{c}'" for c in COMMON)
    marked = [f"length(regexp_replace(rare, '[^{c.replace(chr(39), chr(39) * 2)}]+', '', 'g'))" for c in CLASSES.values()]
    marked.append(r"length(regexp_replace(rare, '[\x00-\x7F]+', '', 'g'))")
    hits = " ".join(f"when '{code}' then [" + ", ".join(
        f"len(list_filter(tokens, lambda x: x = '{w}'))" for w in words) + "]" for code, words in COMMON.items())
    n, k = len(CLASSES) + 4, len(COMMON["en"]) + 1
    sums = ", ".join([f"sum(classes[{i + 1}]) c{i}" for i in range(n)] + [f"sum(common[{i + 1}]) w{i}" for i in range(k)])
    cl, co = "[" + ", ".join(f"c{i}" for i in range(n)) + "]", "[" + ", ".join(f"w{i}" for i in range(k)) + "]"

    def distance(a, b):
        x, y = f"({a}[i] / list_sum({a}))", f"({b}[i]::double / list_sum({b}))"
        half = "case when {0} > 0 then {0} * ln({0} / (({1} + {2}) / 2)) else 0.0 end"
        total = (f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {half.format(x, x, y)} + "
                 f"{half.format(y, x, y)}))")
        return f"case when list_sum({a}) > 0 and list_sum({b}) > 0 then sqrt(greatest(0.0, {total} / (2 * ln(2)))) end"

    return rf"""
with base as (select row_number() over () rid, doc_id, coalesce(text, '') t,
        case when lang in ({known}) then lang else '{ANY}' end lang from documents),
parts as (select *, regexp_replace(t, '[a-z\x20\x09-\x0D]+', '', 'g') rare,
        length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) blank,
        regexp_split_to_array(lower(t), '[^\p{{L}}]+') tokens,
        list_filter(regexp_split_to_array(t, '[ 	-
]+'), lambda x: x <> '') words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) lines from base),
m as (select *, [{', '.join(marked)}] marked, case lang {hits} end hits from parts),
h as (select *, list_concat(marked, [length(rare) - list_sum(marked), blank, length(t) - length(rare) - blank]) classes,
        list_append(hits, greatest(0, len(words) - list_sum(hits))) common from m),
per as (select lang, {sums} from h where len(words) >= {rules.min_words} group by lang),
refs as (select lang, {cl} rc, {co} rw from per where lang <> '{ANY}'
    union all select '{ANY}', {"[" + ", ".join(f"sum(c{i})" for i in range(n)) + "]"}, null from per having count(*) > 0),
win as (select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] w
        from (select rid, words, unnest(range(1, len(words) - 1)) i from h)),
dup as (select rid, i from (select *, count(*) over (partition by rid, w) c from win) where c > 1),
rep as (select rid, count(distinct p)::bigint n from (select rid, unnest([i, i + 1, i + 2]) p from dup) group by rid),
f as (select h.*, len(words) n_words, length(array_to_string(words, '')) word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) n_symbols, len(lines) - len(list_distinct(lines)) n_dup_lines,
        coalesce(rep.n, 0) n_repeat_words from h left join rep using (rid)),
g as (select f.*, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words base_failed,
        case when length(t) >= {rules.min_chars_judged} then {distance('classes', 'rc')} end cd,
        case when n_words >= {rules.min_words_judged} then {distance('common', 'rw')} end wd
        from f left join refs using (lang)),
judged as (select rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        round(cd, 6) class_distance, round(wd, 6) word_distance,
        not base_failed and coalesce(cd, 0) <= {rules.max_class_distance}
        and coalesce(wd, 0) <= {rules.max_word_distance} kept from g)
select * exclude (rid) from judged"""
