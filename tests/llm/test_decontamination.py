import random

from pricetide.llm.decontamination import LeakRules, Templates, benchmark_leaks, stage, without_leaks

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
QUESTION = ("A train leaves Berlin Central at 9 and travels 240 km to Hamburg at a speed of 80 km per hour, so how long "
            "does it take before the train from Berlin Central arrives?")
OTHER = ("A train leaves Madrid at 7 and travels 450 miles to Sevilla at a speed of 90 miles per hour, so how long "
         "does it take before the train from Madrid arrives?")
MIXED = ("A train leaves Madrid at 7 and travels 450 miles to Sevilla at a speed of 90 km per hour, so how long "
         "does it take before the train from Oslo arrives?")


def filler(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def found(spark, docs, items):
    return {(r.doc_id, r.item_id): r for r in benchmark_leaks(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}


def test_copies_and_changed_parameters(spark):
    rng = random.Random(3)
    docs = [(1, f"{filler(rng, 40)}. {QUESTION} {filler(rng, 60)}"), (2, f"{filler(rng, 9)}. {OTHER}"),
            (3, f"{filler(rng, 9)}. {MIXED}"), (4, filler(rng, 300)), (5, QUESTION[:45]), (6, QUESTION.upper())]
    got = found(spark, docs, [(1, QUESTION), (2, "too short an item"), (3, None)])
    assert set(got) - {(6, 1)} == {(1, 1), (2, 1)}
    assert not got[1, 1].changed and got[2, 1].changed and got[1, 1].n_covered == got[1, 1].n_item_tokens


def test_plain_passages_against_brute_force(spark):
    rng, rules = random.Random(4), LeakRules()
    items = [(i, filler(rng, rng.randint(10, 40))) for i in range(12)]
    docs = []
    for d in range(60):
        words = filler(rng, rng.randint(0, 80)).split()
        item = items[rng.randrange(12)][1].split()
        a = rng.randrange(len(item))
        part = item[a:a + rng.randint(1, 30)]
        if rng.random() < 0.3 and part:
            part[rng.randrange(len(part))] = "new"
        at = rng.randint(0, len(words))
        docs.append((d, " ".join(words[:at] + part + words[at:])))
    want = set()
    for d, t in docs:
        for i, x in items:
            words, item = t.split(), x.split()
            for shift in range(-len(item), len(words)):
                same = [0 <= k + shift < len(words) and words[k + shift] == w for k, w in enumerate(item)]
                under = {j for k in range(len(item) - rules.window + 1) if all(same[k:k + rules.window])
                         for j in range(k, k + rules.window)}
                if under and len(under) >= min(rules.min_tokens, len(item)):
                    want.add((d, i))
    assert set(found(spark, docs, items)) == want and 5 < len(want) < 60


def test_templates_have_types():
    texts = ["We met Anna Maria Lopez near Lake Como with 3 kg of flour. Then 12 other people came, and 5 minutes passed."]
    own, place, h, counts, slots = Templates(LeakRules(few_literals=0)).windows(texts)
    assert counts[0] == 19 and len(own) == 12
    assert slots(range(len(own)))[0] == ["Anna", "Lake", "3", "kg"]


def test_odd_rows_and_stage(spark, tmp_path):
    rows = [(1, None, 1), (2, "", 2), (None, QUESTION, 3), (3, QUESTION, 4), (3, QUESTION, 4), (4, "clean words", 5)]
    df = spark.createDataFrame(rows, DOCS + ", item_id int")
    items = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (None, QUESTION), (2, "")], ITEMS)
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    leaks = benchmark_leaks(df, items)
    assert [(r.doc_id, r.item_id, r.n_places) for r in leaks.collect()] == [(3, 1, 1)]
    out = stage(spark, df, str(tmp_path))
    assert out.columns == df.columns and {r.item_id for r in out.collect()} == {1, 2, 3, 5}
    assert without_leaks(df.limit(0), leaks).count() == 0 and benchmark_leaks(df, items.limit(0)).count() == 0


def test_short_and_dense_items_in_any_context(spark):
    rng = random.Random(6)
    items = [(1, "Which of these rivers flows through the old town?"), (2, "Name the largest moon."),
             (3, "Anna Maria walked home and then she slept all day"), (4, "In 1914 , 1918 , 1939 and 1945 at 3 4 5 6 7 8"),
             (5, QUESTION), (6, "A boat leaves at 9 and arrives here by 12 today")]
    docs = [(10 * i, f"{filler(rng, 9)} {t} {filler(rng, 9)}") for i, t in items]
    docs += [(10 * i + 1, f"{filler(rng, 9)}. {t} {filler(rng, 9)}") for i, t in items]
    docs += [(10 * i + 2, f"{filler(rng, 9)} Bob {t.upper()}") for i, t in items]
    docs += [(10 * i + 3, f"{filler(rng, 9)} 12 {t}") for i, t in items]
    docs += [(34, f"{filler(rng, 9)} Paul walked home and then she slept all day"),  # a name for a name
             (44, f"{filler(rng, 9)} In 1914 , 1918 , 1939 and 1945 at 3 4 5 6 7 9"),  # one word is another
             (24, f"{filler(rng, 9)} name the largest {filler(rng, 5)}"),
             (64, f"{filler(rng, 9)} A boat leaves at 7 and arrives here by 11 today")]
    got = found(spark, docs, items)
    assert set(got) == {(10 * i + k, i) for i, _ in items for k in range(4)} | {(34, 3), (64, 6)}
    assert got[64, 6].changed and not got[10, 1].changed and {r.n_places for r in got.values()} == {1}


def test_changed_parameters_of_dense_questions(spark):
    rng = random.Random(12)
    shapes = ["A train travels {} km in {} hours and {} minutes, then {} km in {} hour. What is its speed?",
              "{} boxes hold {} kg of rice and {} kg of beans each; {} boxes are sold for {} dollars. How much is left?",
              "Mix {} ml of water, {} g of salt and {} g of sugar for {} minutes at {} degrees and weigh the result.",
              "If {} workers dig {} m in {} days, how many workers dig {} m in {} days at the same pace?"]
    items, docs = [], []
    for i in range(80):
        words = filler(rng, 3)  # tells the items apart
        text = f"{words} {rng.choice(shapes)}"
        items.append((i, text.format(*rng.sample(range(2, 900), 5))))
        docs.append((i, f"{filler(rng, 30)}. {text.format(*rng.sample(range(1000, 9000), 5))} {filler(rng, 30)}"))
    numbers = " ".join(f"{rng.randint(1, 99)} kg and {rng.randint(1, 99)} km in" for _ in range(20))
    docs += [(1000, numbers), (1001, filler(rng, 100) + " yes " + filler(rng, 9)), (1002, "yes")]
    items += [(500, "10 kg and 20 km in 30 kg and 40 km in 50 kg and 60 km in"), (501, "yes"), (502, "Yes it is")]
    got = found(spark, docs, items)
    own = {d for d, i in got if d == i}
    assert len(own) >= 0.9 * 80 and all(got[d, d].changed for d in own)
    assert not {d for d, _ in got} & {1000, 1001, 1002}
