import random
from collections import Counter

import numpy as np
import xxhash

from pricetide.llm.paragraph_dedup import (_M, ParagraphRules, _block_links, _mix, band_values, cut_texts, edit_distance,
                                           repeated_paragraphs, stage, tune_bands, without_repeats)

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def changed(rng, line, n):
    words = line.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = "other"
    return " ".join(words)


def documents(rng):
    rows = [(i, "\n".join(prose(rng, rng.randint(5, 80)) for _ in range(rng.randint(1, 5)))) for i in range(30)]
    shared = prose(rng, 60)
    rows += [(100 + i, f"{prose(rng, 35)}\n{shared.upper() if i % 2 else shared}\n{prose(rng, 10)}") for i in range(20)]
    base = prose(rng, 120)  # a chain of near copies, each close to the one before
    for i in range(25):
        rows.append((200 + i, f"{base}\n{prose(rng, 40)}"))
        base = changed(rng, base, 2)
    rows += [(300, None), (301, ""), (302, "short line\nshort line"), (None, shared), (None, shared), (303, rows[0][1]),
             (304, f"{shared}\n{shared}"), rows[3], (305, " ".join(["same"] * 5000)), (306, " ".join(["same"] * 5000))]
    return rows


def cuts(text):
    """(place, words) of a text's paragraphs, told word by word."""
    rules, words = ParagraphRules(), (text or "").lower().encode().split()
    h = [xxhash.xxh3_64_intdigest(w) for w in words] + [0]
    pair = [int(_mix(np.array([h[i]], np.uint64) * _M + np.uint64(h[i + 1]))[0]) for i in range(len(words))]
    starts = [i for i in range(len(words)) if not i or all(
        pair[i] < pair[j] if j < i else pair[i] <= pair[j]
        for j in range(max(0, i - rules.reach), min(len(words), i + rules.reach + 1)) if j != i)]
    return [(a, words[a:b]) for a, b in zip(starts, [*starts[1:], len(words)]) if b - a >= rules.min_words]


def brute(rows, rules):
    """(least, all of its class) of every repeated place; links are those of paragraphs that share a band."""
    items = {(d, place): b" ".join(words) for d, t in rows if d is not None for place, words in cuts(t)}
    keys = sorted(items)
    bands = {}
    for k in keys:
        pieces = cut_texts([items[k]], ParagraphRules(reach=0))
        bands[k] = set(band_values(pieces, rules)[0].tolist())
    label = {k: k for k in keys}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bands[a] & bands[b] and root(a) != root(b):
                x, y = items[a].split(), items[b].split()
                if shingle_share(x, y, rules.shingle) >= rules.similarity or \
                        edit_distance(x, y) <= (1 - rules.similarity) * max(len(x), len(y)) + 1e-9:
                    label[max(root(a), root(b))] = min(root(a), root(b))
    groups = {}
    for k in keys:
        groups.setdefault(root(k), []).append(k)
    return {k: r for r, g in groups.items() if len(g) > 1 for k in g}


def shingle_share(x, y, n):
    x, y = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for w in (x, y))
    return len(x & y) / len(x | y)


def test_cuts_and_bands_against_all_pairs(spark):
    rows, rules = documents(random.Random(8)), ParagraphRules()
    texts = [None if t is None else t.encode() for _, t in rows]
    pieces = cut_texts(texts, rules)
    assert [(i, p, w) for i, (_, t) in enumerate(rows) for p, w in cuts(t)] == [
        (i, p, pieces.words[i][p:p + n]) for i, p, n in zip(pieces.text.tolist(), pieces.place.tolist(), pieces.n.tolist())]
    got = repeated_paragraphs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.place): (r.kept_id, r.kept_place) for r in got} == brute(rows, rules)
    assert all(r.kept == ((r.doc_id, r.place) == (r.kept_id, r.kept_place)) for r in got)


def test_passages_of_fifty_words_are_found_wherever_they_stand(spark):
    rng, rows, planted = random.Random(21), [], set()
    for i in range(150):
        passage = prose(rng, rng.randint(51, 90)).split()
        for j in range(2):  # inside a line, over short lines, at the start or the end
            before, after = prose(rng, rng.choice([0, 3, 90])), prose(rng, rng.choice([0, 3, 90]))
            lines = " ".join(passage) if rng.random() < 0.5 else "\n".join(
                " ".join(passage[k:k + 8]) for k in range(0, len(passage), 8))
            rows.append((2 * i + j, f"{before} {lines.upper() if rng.random() < 0.3 else lines} {after}"))
            planted.add(2 * i + j)
    rows += [(1000 + i, prose(rng, 300)) for i in range(150)]
    got = {r.doc_id for r in repeated_paragraphs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got <= planted and len(got) >= 0.97 * len(planted)


def test_texts_lose_all_but_the_first(spark):
    rng = random.Random(1)
    shared = prose(rng, 90)
    rows = [(1, f"intro É\n{shared}\nend", "a"), (2, f"{prose(rng, 60)} {shared}", "b"), (4, None, "d"), (None, shared, "e"),
            (5, f"\t{shared.upper()}\n\n{shared}", "f"), (6, prose(rng, 40), "g")]
    df = spark.createDataFrame(rows, SCHEMA + ", place string")
    out = stage(spark, df, "")
    assert out.columns == df.columns
    got = {r.place: r.text for r in out.collect()}
    assert all(got[k] == t for _, t, k in rows if k in "adeg")
    left = {k: len(got[k].split()) for k in "bf"}
    assert left["b"] < 60 + 40 and left["f"] < 2 * 40 and got["b"].startswith(rows[1][1][:200])
    assert all(w in rows[1][1].split() for w in got["b"].split())
    empty = df.limit(0)
    assert without_repeats(empty, repeated_paragraphs(empty)).count() == 0


def test_bands_reach_the_recall():
    for similarity, recall, most in ((0.8, 0.999, 32), (0.8, 0.9999, 80), (0.6, 0.99, 64)):
        bands, rows = tune_bands(similarity, recall, most)
        assert bands * rows <= most and 1 - (1 - similarity ** rows) ** bands >= recall


def test_edit_distance():
    rng = random.Random(2)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 80))] for _ in range(2))
        assert edit_distance(a, b) == slow(a, b)


def test_edit_links_of_a_large_group(spark):
    rng, rules = random.Random(11), ParagraphRules(reach=0)  # no places to cut: a text is one paragraph
    base = [f"w{i}" for i in range(100)]
    lines = [base]
    for c in range(1500):  # each is near the first line only, by edit distance but not by shingles
        line = list(base)
        for i in rng.sample(range(100), 15):
            line[i] = f"x{c}n{i}"
        lines.append(line)
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], SCHEMA)
    pieces = cut_texts([" ".join(x).encode() for x in lines], rules)
    assert pieces.n.tolist() == [100] * len(lines)
    label, by_band = list(range(len(lines))), {}
    for i, values in enumerate(band_values(pieces, rules).tolist()):
        for b in values:
            by_band.setdefault(b, []).append(i)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in sorted({(i, j) for m in by_band.values() for j in m for i in m if i < j}):
        x, y = root(i), root(j)
        if x != y and len({*lines[i]} & {*lines[j]}) >= 80 and edit_distance(lines[i], lines[j]) <= 20:
            label[max(x, y)] = min(x, y)
    want = {i: root(i) for i in range(len(lines))}
    sizes = Counter(want.values())
    got = {r.doc_id: r.kept_id for r in repeated_paragraphs(df, rules=rules).collect()}
    assert got == {i: r for i, r in want.items() if sizes[r] > 1} and len(got) >= 150


def test_blocks_compare_both_sides_only():
    rules = ParagraphRules()
    line = b"a b c d e f g h i j"
    near = line.replace(b"j", b"k")
    group = [(b"1", 1, True, line), (b"2", 2, True, near), (b"3", 3, False, line.replace(b"i", b"z"))]
    assert set(_block_links(group, rules)) == {(b"1", b"3"), (b"2", b"3")}
    assert set(_block_links(group[:2], rules)) == {(b"1", b"2")}
