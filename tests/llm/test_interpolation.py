import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pricetide.llm.interpolation import (END, START, ScoringRules, _pack, _pack_sorted, _unpack, _unpack_sorted,
                                         bucket_of, learn_weights, score_documents)

SCHEMA = "doc_id long, text string"


def documents(rng):
    nouns = [f"w{i}" for i in range(30)]
    rows = []
    for d in range(120):
        words, at = [], rng.randrange(30)
        for _ in range(rng.randint(0, 60)):
            at = (at * 7 + 1) % 30 if rng.random() < 0.8 else rng.randrange(30)
            words.append(nouns[at].upper() if rng.random() < 0.1 else nouns[at])
        if rng.random() < 0.2:
            words.append(f"rare{d}")
        rows.append((d, " ".join(words)))
    return rows + [(500, None), (501, " \n"), (None, "w1 w2"), (7, rows[7][1]), (502, "x" * 40000)]


def brute(rows, rules):
    """The whole model in plain Python."""
    def fold(d):
        return None if d is None else zlib.crc32(str(d).encode()) % rules.folds
    texts = [(d, fold(d), [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]) for d, t in rows]

    def counts(use):
        one, two, context = Counter(), Counter(), Counter()
        for _, f, words in texts:
            if use(f):
                one.update(words)
                two.update(zip([" "] + words, words))
                context.update([" "] + words[:-1])
        return one, two, context
    one, two, context = counts(lambda f: f not in (rules.held_out, rules.fold))
    n, v = sum(one.values()), len(one)
    weights = {b: [1 / 3] * 3 if b else [0, 0.5, 0.5] for b in range(65)}
    tokens = [(a, b) for _, f, words in texts if f == rules.fold for a, b in zip([" "] + words, words)]

    def parts(a, b, one, two, context, n, v, w):
        c = context[a]
        return [w[0] * (two[a, b] / c if c else 0), w[1] * one[b] / max(n, 1), w[2] / (v + 1)], c
    before = -math.inf
    for _ in range(rules.rounds):
        sums, sizes, total = {}, Counter(), 0.0
        for a, b in tokens:
            bucket = int(bucket_of(np.array([context[a]]))[0])
            p, _ = parts(a, b, one, two, context, n, v, weights[bucket])
            sums[bucket] = [s + x / sum(p) for s, x in zip(sums.get(bucket, [0, 0, 0]), p)]
            sizes[bucket] += 1
            total += math.log(sum(p))
        for b, s in sums.items():
            weights[b] = [x / sizes[b] for x in s]
        if total / len(tokens) - before < rules.tolerance:
            break
        before = total / len(tokens)
    one, two, context = counts(lambda f: f != rules.held_out)
    n, v = sum(one.values()), len(one)
    out = []
    for d, f, words in texts:
        score = 0.0
        for a, b in zip([" "] + words, words):
            w = [max(x, m) for x, m in zip(weights[int(bucket_of(np.array([context[a]]))[0])], (0, 1e-6, 1e-6))]
            p, _ = parts(a, b, one, two, context, n, v, [x / sum(w) for x in w])
            score += math.log10(sum(p))
        out.append((d, f == rules.held_out, len(words), sum(one[w] > 0 for w in words), n,
                    sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words), score))
    return out


@pytest.mark.parametrize("batch_bytes", [16_000_000, 3000])
def test_against_plain_python(spark, batch_bytes):
    rows = documents(random.Random(1))
    rules = ScoringRules(batch_bytes=batch_bytes, part_bytes=20000, rounds=4)
    df = spark.createDataFrame([r + ("x",) for r in rows], SCHEMA + ", role string").repartition(3)
    got = sorted([tuple(r) for r in score_documents(df, rules=rules).collect()], key=str)
    want = sorted(brute(rows, rules), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-6)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held), "the mixture beats single words on held-out texts"


def test_empty_table_and_no_fold(spark):
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    r = score_documents(spark.createDataFrame([(None, "a b a")], SCHEMA)).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (False, 4, 4, 4) and r.score < 0


def test_weights_of_a_known_mixture(spark):
    rows = [(3, 4, 4, 100, 50), (3, 0, 4, 100, 50)]
    w = learn_weights(spark.createDataFrame(rows, "bucket int, c2 long, context long, c1 long, n long"), 1000, 9,
                      ScoringRules(rounds=25, tolerance=0.0))
    assert w.sum(axis=1) == pytest.approx(1) and 0.4 < w[3][0] < 0.5


def test_numbers_survive_packing():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        a = np.sort(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        assert (_unpack_sorted(_pack_sorted(a), n) == a).all()
        c = rng.integers(0, 9, n).astype(np.uint32)
        assert (_unpack(_pack(c), n, np.uint32) == c).all()
    assert START != END and list(bucket_of(np.array([0, 1, 2, 3, 4]))) == [0, 1, 2, 2, 3]
