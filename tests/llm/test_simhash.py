import random

import xxhash

from pricetide.llm.simhash import fingerprint, keep_one, linked_fingerprints, near_duplicates, stage

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, f"{f:016x}", least.get(root(i))) for i, (d, f) in enumerate(zip([r[0] for r in rows], fps))),
                  key=str)


def documents(rng):
    def words(n):
        return [rng.choice("alpha beta gamma delta Epsilon zeta eta theta iota kappa Éta".split()) + str(rng.randint(0, 40))
                for _ in range(n)]
    rows = [(i, " ".join(words(rng.randint(1, 90)))) for i in range(40)]
    for base in (0, 3, 7):  # near copies: a few words of a long text are changed
        long = words(300)
        for k in range(25):
            other = list(long)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(300)] = "changed"
            rows.append((1000 * (base + 1) + k, " ".join(other)))
    rows += [(90, None), (91, ""), (92, " \t\n"), (93, "one"), (94, "ONE"), (95, "one two"), (None, "lonely words here"),
             (None, rows[0][1]), (5, rows[5][1]), (96, "x" * 50000), (97, " ".join(words(30000)))]
    return rows


def test_against_brute_force(spark):
    rows = documents(random.Random(2))
    assert all(fingerprint((t or "").encode(), 3) == brute_fingerprint(t) for _, t in rows)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows)


def test_every_link_is_found(spark):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                values.add(v ^ 1 << b)
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    values = list(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    for segments in (1, 2, 4) if len(values) < 200 else (2, 4):
        assert {(r.a, r.b) for r in linked_fingerprints(df, 3, segments).collect()} == want


def test_stage_keeps_one_of_each_group(spark):
    rows = [(3, "a b c d e", 1), (2, "A b c d e", 2), (2, "A b c d e", 2), (7, "other words entirely in here", 3),
            (None, "nobody knows this one", 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", component_id int")
    out = stage(spark, df, "")
    assert out.columns == df.columns
    assert sorted(out.collect(), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_a_row_is_judged_by_its_own_text(spark):
    copied, unique = "one two three four five six seven", "quite another text that stands alone here"
    rows = [(3, copied, "a"), (7, copied, "b"), (7, unique, "c"), (None, "first text without an id", "d"),
            (None, "second thing that has no number", "e"), (None, copied, "f"), (9, "same id " + unique, "g"),
            (9, "and text " + copied, "h"), (11, unique.upper(), "i"), (11, None, "j"), (None, "", "k")]
    df = spark.createDataFrame(rows, SCHEMA + ", _digest string")
    got = [r for r in stage(spark, df, "").collect()]
    assert {r._digest for r in got} == set("acdeghj") and len(got) == 7
    again = spark.createDataFrame([(1, "x y z", "b"), (1, "x y z", "a"), (1, "x y z", "b")], SCHEMA + ", source string")
    assert stage(spark, again, "").count() == 1


def test_the_exploded_balls_are_not_broadcast(spark):
    """Spark sizes them like the few fingerprints they come from; at 0.6 GB they did not fit the driver."""
    df = spark.createDataFrame([(i,) for i in range(100)], "fingerprint long")
    found = linked_fingerprints(df, 3, 2)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
