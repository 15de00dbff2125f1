import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pricetide.llm.prefix_trie import RESULT, TrieRules, op13, prefix_trie, rebuilt_paths, trie_sql, turn_paths
from tests.harness import compare, duck

SCHEMA = "conv_id long, turn long, role string, text string, turns string, key string"


def rows_of(rng):
    rows = []
    openings = [[("user", "hello"), ("assistant", "hi")], [("user", "hello"), ("assistant", "ho")], [("user", None)], []]
    for c in [*range(-7, 90), 1000]:
        path = list(rng.choice(openings)) + [(rng.choice(["user", None, ""]), rng.choice(["a", "b", "", "é" * 3, None]))
                                             for _ in range(rng.randint(0, 3))]
        if c % 3 == 0:
            path = list(openings[0])  # a third are copies
        rows += [(c, t if t or c % 2 else None, *p) for t, p in enumerate(path)]
    long = [("user", str(i % 7)) for i in range(150)]
    for c, n in ((200, 150), (205, 150), (210, 149), (215, 64), (220, 32), (225, 33)):
        rows += [(c, t, *p) for t, p in enumerate(long[:n])]
    rows += [(None, 1, "user", "lost"), (300, 2, "user", "x"), (300, 2, "user", "x"), (300, None, "user", "first")]
    alone = next(c for c in range(2001, 3000, 5) if zlib.crc32(str(c).encode()) % 9)  # its first turns are another's: none
    rows.append((alone, 0, "user", "gone"))
    rng.shuffle(rows)
    return [(*r, "x", "y") for r in rows]


def brute(paths: dict) -> set:
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out, leaves, saved = set(), {}, {}
    for p in sorted(members, key=len, reverse=True):
        m = members[p]
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(m) - 1) * (p[-1][1] if p else 0) + sum(saved[k] for k in kids[p])
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("shard_turns", [200_000, 40, 3])
def test_against_all_prefixes(spark, shard_turns):
    df = spark.createDataFrame(rows_of(random.Random(2)), SCHEMA)
    paths = turn_paths(df)
    own = {r.conv_id: [(x.digest, x.size) for x in r.turns] for r in paths.collect()}
    got = prefix_trie(paths, df.count(), TrieRules(shard_turns)).collect()
    assert {tuple(r[c] for c in RESULT) for r in got} == brute(own) and len(got) == len(brute(own))
    again = {}
    for c, path in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(c - 5 * int(c / 5))
        again[c] = own.get(base, [])[:h] + path[h:]
    got = prefix_trie(rebuilt_paths(paths), df.count(), TrieRules(shard_turns)).collect()
    assert {tuple(r[c] for c in RESULT) for r in got} == brute(again) and any(not p for p in again.values())


def test_copies_over_many_shards(spark):
    df = spark.range(3000).selectExpr("id conv_id", "explode(array(0, 1, 2)) turn", "'user' role",
                                      "case when id % 1000 = 7 and turn = 2 then 'other' else 'same' end text")
    paths = turn_paths(df)
    own = {r.conv_id: [(x.digest, x.size) for x in r.turns] for r in paths.collect()}
    got = prefix_trie(paths, 9000, TrieRules(300)).collect()
    assert {tuple(r[c] for c in RESULT) for r in got} == brute(own) and len(got) == 5


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(rows_of(random.Random(4)), SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duck("")
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare(op13(spark, str(tmp_path)), con, trie_sql()) is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(turn_paths(empty), 0).count() == 0
