"""Substring dedup: repeated paragraphs found by MinHash banding.

A text's words, lower-cased (A-Z), are cut into paragraphs at places that depend on the words around them alone: before a
word whose hash with the next one is the least among ``reach`` words on either side.  So a passage that stands in two
texts is cut alike in both, wherever lines end and whatever stands around it, and of 50 words or more it holds a whole
paragraph (13 words on average).  Each paragraph gets MinHash values over its five-word shingles, cut into bands that
are tuned for the wanted recall; paragraphs that share a band are joined, checked by exact Jaccard similarity or by
edit distance (at most a fifth of the words changed), and clustered by connected components.  The first paragraph of
a cluster (least document id, then place) stays, all other occurrences go.

One exchange finds the bands that hold more than one occurrence; a task sends a paragraph that it meets again and again
only twice.  Equal paragraphs have equal bands, and are told from others by a 128-bit key.  Words are shuffled only
for paragraphs in bands of different ones.

Pairs within a band are not all listed: every paragraph is first checked against the least and the greatest of its
band.  Colliding paragraphs that are still in different components meet again only if they share one of their rarest
shingles, as all pairs of the wanted Jaccard similarity must.  Bands that still hold several components are then
compared whole, block against block: the words that two paragraphs share bound their edit distance, and what the bound
lets through is measured.  So no link between paragraphs of a band is lost; only bands of many paragraphs that are not
alike cost the square of their size, in products of matrices.

Defined results: null, blank and short texts (under ``min_words`` words) have no paragraphs and pass as they are.
Documents with a null id are neither compared nor changed.  Rows that share an id count as one document: equal
paragraphs at one place of such rows stay or go together.  Ties in length or similarity do not matter, order is by id
and place alone.  A text without any such place, as one word over and over, is one paragraph.  An empty table gives an
empty result.  Other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.chunks import slices
from pricetide.llm.common import bitmap_of, free_prefix, in_bitmap, read_table, staged
from pricetide.llm.components import connected_components

SLOTS = 1 << 18
BLOCK_ROWS = 800
COLUMNS = 4096
SLICE_BYTES = 2_000_000
SEEN = 1 << 18
_M = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class ParagraphRules:
    reach: int = 6
    min_words: int = 7
    shingle: int = 5
    similarity: float = 0.8
    recall: float = 0.95
    max_hashes: int = 6


def tune_bands(similarity: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows in a band for which bands that reach the recall need ``max_hashes`` at most."""
    for rows in range(max_hashes, 0, -1):
        miss = 1 - similarity ** rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no bands reach this recall with so few hashes")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M
    return h ^ (h >> np.uint64(29))


class _Hashes(dict):
    """64-bit hashes of words; starts anew when it has grown."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


@dataclass
class _Pieces:
    """The paragraphs of a few texts: of each its text's number, first word, length, and key (two rows of numbers)."""
    words: list[list[bytes]]
    hashes: np.ndarray
    first: np.ndarray  # in the words of all texts
    text: np.ndarray
    place: np.ndarray
    n: np.ndarray
    key: np.ndarray

    def short(self) -> np.ndarray:
        return self.key[0].view(np.int64)

    def keys(self) -> list[bytes]:
        raw = np.ascontiguousarray(self.key.T.astype(">u8")).tobytes()
        return [raw[i:i + 16] for i in range(0, len(raw), 16)]

    def line(self, i: int) -> bytes:
        return b" ".join(self.words[self.text[i]][self.place[i]:self.place[i] + self.n[i]])


def cut_texts(texts: list[bytes | None], rules: ParagraphRules) -> _Pieces:
    """The paragraphs of UTF-8 texts."""
    if len(_HASHES) > 200_000:
        _HASHES.clear()
    words = [(t or b"").lower().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    h = np.fromiter((v for w in words for v in map(_HASHES.__getitem__, w)), np.uint64, total)
    doc = np.repeat(np.arange(len(words)), counts)
    starts = np.cumsum(counts) - counts
    # Pairs of neighbouring words, with room between texts that no pair can be less than.
    r, top = rules.reach, np.uint64(0xFFFFFFFFFFFFFFFF)
    pair = np.full(total + r * (len(words) + 1), top)
    at = np.arange(total) + r * (doc + 1)
    following = np.append(h[1:], np.uint64(0))
    if total:
        following[(starts + counts - 1)[counts > 0]] = 0
    pair[at] = _mix(h * _M + following)
    least = np.full(total, r > 0)  # without reach a text is one paragraph
    own = pair[at]
    for k in range(1, r + 1):
        least &= (own < pair[at - k]) & (own <= pair[at + k])
    least[starts[counts > 0]] = True
    first = np.flatnonzero(least)
    n = np.diff(np.append(first, total))
    keep = n >= rules.min_words
    # Keys of 128 bits from the words and their places.
    if total:
        inside = (np.arange(total) - np.repeat(first, n)).astype(np.uint64)
        lanes = [_mix(np.add.reduceat(_mix(h * np.uint64(odd) + inside * np.uint64(step)), first) + n.astype(np.uint64))
                 for odd, step in ((0xBF58476D1CE4E5B9, 0x94D049BB133111EB), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))]
    else:
        lanes = [np.empty(0, np.uint64)] * 2
    first, n = first[keep], n[keep]
    return _Pieces(words, h, first, doc[first], first - starts[doc[first]], n, np.array([x[keep] for x in lanes]))


def band_values(pieces: _Pieces, rules: ParagraphRules) -> np.ndarray:
    """One row per paragraph, one column per band."""
    bands, rows = tune_bands(rules.similarity, rules.recall, rules.max_hashes)
    out = np.empty((len(pieces.n), bands), np.uint64)
    if not len(out):
        return out
    rolled, size = pieces.hashes.copy(), rules.shingle
    for k in range(1, size):  # a polynomial over a word and the next ones
        rolled[:-k] = rolled[:-k] * _M + pieces.hashes[k:]
    shingles = np.maximum(pieces.n - size + 1, 1)  # what crosses a paragraph's end is left out
    at = np.repeat(pieces.first - (np.cumsum(shingles) - shingles), shingles) + np.arange(int(shingles.sum()))
    rolled, starts = _mix(rolled[at]), np.cumsum(shingles) - shingles
    rng = np.random.default_rng(7)
    odd = rng.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, np.uint64)
    for b in range(bands):
        value = np.full(len(out), np.uint64(b + 1))
        for i in range(b * rows, (b + 1) * rows):
            value = _mix(value * _M + np.minimum.reduceat(rolled * odd[i] + add[i], starts))
        out[:, b] = value
    return out


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))


def _slices(batches, column: int) -> Iterator[tuple]:
    """(batch, first row, texts) of a few texts at a time."""
    for batch in batches:
        texts = [t.as_py() for t in batch.column(column).cast(pa.binary())]
        for a, b in slices([len(t or b"") for t in texts], SLICE_BYTES):
            yield batch, a, texts[a:b]


def shared_bands(docs: DataFrame, id_col: str, text: str, rules: ParagraphRules) -> DataFrame:
    """(band, short, mixed): paragraphs of every band that more than one occurrence has; ``short`` is the first half
    of the key, ``mixed`` tells that the band has different ones."""
    def run(batches):
        seen: dict[int, int] = {}  # how often this task has sent what it met more than once
        for _, _, texts in _slices(batches, 1):
            pieces = cut_texts(texts, rules)
            values = band_values(pieces, rules).view(np.int64)
            short, at, n = np.unique(pieces.short(), return_index=True, return_counts=True)
            send = np.array([seen.get(s, 0) < 2 for s in short.tolist()], bool)
            short, at, n = short[send], at[send], n[send]
            for s in short[n > 1].tolist():
                seen[s] = 2
            for s in short[n == 1].tolist():
                seen[s] = seen.get(s, 0) + 1
            if len(seen) > SEEN:  # keep what came again
                seen = {s: k for s, k in seen.items() if k > 1}
                seen = seen if len(seen) < SEEN // 2 else {}
            bands = values.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[at].ravel()), pa.array(np.repeat(short, bands)),
                 pa.array(np.repeat(np.minimum(n, 2), bands).astype(np.int32))], names=["band", "short", "n"])

    rows = _texts(docs, id_col, text).mapInArrow(run, "band bigint, short bigint, n int")
    of_band = Window.partitionBy("band")
    return rows.select("*", F.min("short").over(of_band).alias("lo"), F.max("short").over(of_band).alias("hi"),
                       F.sum("n").over(of_band).alias("all")).where("all > 1").select(
        "band", "short", F.expr("lo != hi").alias("mixed")).distinct()


def occurrences(docs: DataFrame, groups: DataFrame, id_col: str, text: str, rules: ParagraphRules) -> DataFrame:
    """(id, place, n_words, key, short, words) of the paragraphs in ``groups``; words where the band is mixed, once
    per few texts.

    The bitmaps keep most others from being shuffled; when they fill up, more of them are, and the join still decides.
    """
    every, mixed = bitmap_of(groups, "short"), bitmap_of(groups.where("mixed"), "short")
    source = _texts(docs, id_col, text)
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch, a, texts in _slices(batches, 1):
            pieces = cut_texts(texts, rules)
            hits = np.flatnonzero(in_bitmap(every, pieces.short()))
            with_words = in_bitmap(mixed, pieces.short())
            keys, told = pieces.keys(), set()
            words: list[bytes | None] = []
            for i in hits.tolist():
                new = bool(with_words[i]) and keys[i] not in told
                words.append(pieces.line(i) if new else None)
                if new:
                    told.add(keys[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(pieces.text[hits] + a)), pa.array(pieces.place[hits], pa.int32()),
                 pa.array(pieces.n[hits], pa.int32()), pa.array([keys[i] for i in hits.tolist()], pa.binary()),
                 pa.array(pieces.short()[hits]), pa.array(words, pa.binary())],
                names=["id", "place", "n_words", "key", "short", "words"])

    found = source.mapInArrow(run, f"id {id_type}, place int, n_words int, key binary, short bigint, words binary")
    return found.join(groups.select("short").distinct(), "short", "left_semi")


def jaccard(a: bytes, b: bytes, shingle: int) -> float:
    def shingles(line):
        words = line.split()
        return {tuple(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def edit_distance(a: list, b: list) -> int:
    """Levenshtein distance of two lists of words, a column at a time as bits of one number."""
    if not a:
        return len(b)
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    whole = (1 << len(a)) - 1
    last, up, down, score = 1 << len(a) - 1, whole, 0, len(a)
    for w in b:
        same = at.get(w, 0)
        x = same | down
        y = ((same & up) + up ^ up) | same
        grow, shrink = down | ~(y | up), up & y
        score += 1 if grow & last else -1 if shrink & last else 0
        grow, shrink = grow << 1 | 1, shrink << 1
        up, down = (shrink | ~(x | grow)) & whole, grow & x & whole
    return score


def similar(a: bytes, b: bytes, rules: ParagraphRules) -> bool:
    """Exact Jaccard similarity of the shingles, or else the share of words that the edit distance leaves."""
    if jaccard(a, b, rules.shingle) >= rules.similarity:
        return True
    x, y = a.split(), b.split()
    most = (1 - rules.similarity) * max(len(x), len(y)) + 1e-9
    return abs(len(x) - len(y)) <= most and edit_distance(x, y) <= most


def _verified(pairs: DataFrame, texts: DataFrame, rules: ParagraphRules) -> DataFrame:
    """The pairs (a, b) that are similar."""
    def run(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(
                pa.array([similar(x, y, rules) for x, y in zip(a, b)], pa.bool_()))

    x = texts.select(F.col("key").alias("a"), F.col("words").alias("words_a"))
    y = texts.select(F.col("key").alias("b"), F.col("words").alias("words_b"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "words_a", "words_b").mapInArrow(
        run, "a binary, b binary")


def _shingles(words: bytes, shingle: int) -> np.ndarray:
    parts = words.split()
    return np.unique(np.array([xxhash.xxh3_64_intdigest(b" ".join(parts[i:i + shingle]))
                               for i in range(max(1, len(parts) - shingle + 1))], np.uint64))


def _rarity(texts: DataFrame, shingle: int) -> np.ndarray:
    """How often shingles come, in ``SLOTS`` slots: a table of fixed size, whatever the data."""
    def run(batches):
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for words in batch.column(0).to_pylist():
                counts[(_shingles(words, shingle) % np.uint64(SLOTS)).astype(np.int64)] += 1
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["slot", "n"])

    out = np.zeros(SLOTS, np.int64)
    for slot, n in texts.select("words").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(
            F.sum("n")).collect():
        out[slot] = n
    return out


def _unconnected(texts: DataFrame, part: DataFrame, rules: ParagraphRules) -> DataFrame:
    """(a, b): the colliding paragraphs of different components that may still be similar.

    In any common order of all shingles, two sets of the wanted similarity share one of their first shingles: of n,
    all but the wanted share and one more.  Rare ones come first, so copies with different changes hardly meet, and
    shingles that only one component has are left out.
    """
    order = _rarity(texts, rules.shingle)

    def run(batches):
        for batch in batches:
            sizes, firsts = [], []
            for words in batch.column(1).to_pylist():
                h = _shingles(words, rules.shingle)
                h = h[np.lexsort((h, order[(h % np.uint64(SLOTS)).astype(np.int64)]))]
                sizes.append(len(h))
                firsts.append(h[:len(h) - math.ceil(rules.similarity * len(h) - 1e-9) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["key", "n", "firsts"])

    rows = texts.select("key", "words").mapInArrow(run, "key binary, n int, firsts array<bigint>").join(
        part.select(F.col("node").alias("key"), "component"), "key", "left").select(
        "key", "n", F.coalesce("component", "key").alias("component"), F.posexplode("firsts").alias("place", "first"))
    rows = staged(rows, "first-shingles")
    mixed = rows.groupBy("first").agg(F.min("component").alias("x"), F.max("component").alias("y")).where(
        "x != y").select("first")
    rows = staged(rows.join(mixed, "first"), "mixed-shingles")
    other = rows.select("first", *[F.col(c).alias(c + "2") for c in ("key", "n", "component", "place")])
    # At the first shingle that two sets share, what is left of both must still hold all that they have to share.
    needed = rules.similarity / (1 + rules.similarity) * (F.col("n") + F.col("n2")) - 1e-9
    near = ((F.col("key") < F.col("key2")) & (F.col("component") != F.col("component2")) &
            (F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) >= needed))
    return rows.join(other, "first").where(near).select(F.col("key").alias("a"), F.col("key2").alias("b")).distinct()


def _shared_words(lines: list[list[bytes]]) -> np.ndarray:
    """How many words each two lines share, a repeated word as often as both have it."""
    at: dict = {}
    rows, cols = [], []
    for i, words in enumerate(lines):
        times: dict = {}
        for w in words:
            n = times[w] = times.get(w, 0) + 1
            rows.append(i)
            cols.append(at.setdefault((w, n), len(at)))
    rows, cols = np.array(rows), np.array(cols)
    often = np.bincount(cols) > 1
    rows, cols = rows[often[cols]], (np.cumsum(often) - 1)[cols[often[cols]]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    out = np.zeros((len(lines), len(lines)), np.float32)
    for start in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(cols, (start, start + COLUMNS))
        part = np.zeros((len(lines), COLUMNS), np.float32)
        part[rows[a:b], cols[a:b] - start] = 1
        out += part @ part.T
    return out


def _block_links(group: list[tuple], rules: ParagraphRules):
    """(key, key) of links by edit distance among (key, component, side, words); only pairs of both sides are compared
    if there are two.  What is linked already, here or before, is not measured again."""
    lines = [g[3].split() for g in group]
    n = np.array([len(x) for x in lines], np.float32)
    longest = np.maximum.outer(n, n)
    most = np.float32(1 - rules.similarity) * longest + np.float32(1e-4)
    near = np.triu(longest - _shared_words(lines) <= most, 1)
    sides = np.array([g[2] for g in group])
    if sides.min() != sides.max():
        near &= sides[:, None] != sides[None, :]
    label = {g[1]: g[1] for g in group}

    def root(c):
        while label[c] != c:
            label[c] = c = label[label[c]]
        return c

    for i, j in np.argwhere(near).tolist():
        x, y = root(group[i][1]), root(group[j][1])
        if x != y and edit_distance(lines[i], lines[j]) <= most[i, j]:
            label[x] = y
            yield group[i][0], group[j][0]


def _edited(members: DataFrame, texts: DataFrame, part: DataFrame, rules: ParagraphRules) -> DataFrame:
    """(a, b): links by edit distance between all colliding paragraphs of different components.

    A band is dealt into blocks of about ``BLOCK_ROWS``, and every two blocks meet in a group of their own, so that no
    task holds a whole band.
    """
    labelled = staged(members.join(part.select(F.col("node").alias("key"), "component"), "key", "left").select(
        "band", "key", F.coalesce("component", "key").alias("component")), "labelled-paragraphs")
    mixed = labelled.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where(
        "x != y").select("band")
    rows = staged(labelled.join(mixed, "band").join(texts, "key"), "mixed-bands")
    blocks = rows.groupBy("band").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    dealt = rows.join(staged(blocks, "blocks-of-bands"), "band").withColumn("block", block).select(
        "band", "key", "component", "words", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias(
            "other")).select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key",
                             "component", (F.col("block") <= F.col("other")).alias("side"), "words")
    met = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches):
        group, of_group, found = [], None, []
        for batch in batches:
            for band, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, i, j) != of_group:
                    found += _block_links(group, rules) if group else ()
                    group, of_group = [], (band, i, j)
                group.append(rest)
            yield _pairs(found)
            found = []
        yield _pairs(list(_block_links(group, rules)) if group else [])

    return met.mapInArrow(run, "a binary, b binary").distinct()


def _pairs(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                        rules: ParagraphRules = ParagraphRules()) -> DataFrame:
    """(class_id, id, place, n_words, kept, kept_id, kept_place): every occurrence of a paragraph that has others.

    ``place`` is the number of its first word in the text, from 0; ``kept`` marks the occurrence that stays,
    ``kept_id`` and ``kept_place`` name it.
    """
    groups = staged(shared_bands(docs, id_col, text, rules), "shared-bands")
    found = staged(occurrences(docs, groups, id_col, text, rules), "occurrences")
    distinct = staged(found.groupBy("key").agg(
        F.min(F.struct("id", "place")).alias("first"), F.max(F.struct("id", "place")).alias("last"),
        F.first("short").alias("short"), F.first("words", ignorenulls=True).alias("words")), "distinct-paragraphs")
    texts = distinct.where("words is not null").select("key", "words")
    members = staged(groups.where("mixed").select("band", "short").join(
        distinct.where("words is not null").select("key", "short"), "short").select("band", "key"), "colliding-paragraphs")
    ends = members.groupBy("band").agg(F.min("key").alias("x"), F.max("key").alias("y"))
    stars = members.join(staged(ends, "ends-of-bands"), "band").select(
        F.explode(F.array("x", "y")).alias("end"), "key").where("end != key")
    pair = (F.least("end", "key").alias("a"), F.greatest("end", "key").alias("b"))
    links = staged(_verified(stars.select(*pair).distinct(), texts, rules), "paragraph-links")
    part = connected_components(links)
    rest = _unconnected(texts, part, rules)
    more = staged(_verified(rest, texts, rules), "paragraph-links")
    if not more.isEmpty():
        part = connected_components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    edited = staged(_edited(members, texts, part, rules), "paragraph-links")
    if not edited.isEmpty():
        part = connected_components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).union(edited))
    clustered = distinct.select("key", "first", "last").join(part.select(F.col("node").alias("key"), "component"), "key",
                                                           "left")
    alone = clustered.where("component is null and first != last").select("key", "first")
    grouped = staged(clustered.where("component is not null"), "clustered-paragraphs")
    of_class = grouped.groupBy("component").agg(F.min("first").alias("of_class"))
    label = alone.union(grouped.join(of_class, "component").select("key", F.col("of_class").alias("first")))
    kept = (F.col("id") == F.col("first.id")) & (F.col("place") == F.col("first.place"))
    return found.select("id", "place", "n_words", "key").join(staged(label, "paragraph-classes"), "key").select(
        F.concat_ws(":", "first.id", "first.place").alias("class_id"), F.col("id").alias(id_col), "place", "n_words",
        kept.alias("kept"), F.col("first.id").alias("kept_id"), F.col("first.place").alias("kept_place"), "key")


def without_repeats(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text",
                    rules: ParagraphRules = ParagraphRules()) -> DataFrame:
    """``docs`` with the paragraphs that go cut out of their texts; ``found`` is from ``repeated_paragraphs``."""
    p = free_prefix(docs)
    gone = found.where("not kept").select(F.col(id_col).alias(p + "id"), "place", "key").distinct().groupBy(
        p + "id").agg(F.collect_list(F.struct("place", "key")).alias(p + "gone"))
    joined = docs.join(gone, F.col(id_col) == F.col(p + "id"), "left")

    @F.pandas_udf("string")
    def cut(texts, gones):
        return pd.Series([_cut(t, g, rules) for t, g in zip(texts, gones)])

    changed = F.when(F.col(p + "gone").isNotNull(), F.lit(True))
    columns = [F.when(changed, cut(F.col(text), F.col(p + "gone"))).otherwise(F.col(text)).alias(c) if c == text
               else F.col(c) for c in docs.columns]
    return joined.select(*columns)


def _cut(text, gone, rules):
    """The text without the paragraphs that go; white space before the first word of each goes with it."""
    if text is None or gone is None:
        return text
    raw, where = text.encode(), {(g["place"], bytes(g["key"])) for g in gone}
    pieces = cut_texts([raw], rules)
    spans = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for place, n, key in zip(pieces.place.tolist(), pieces.n.tolist(), pieces.keys()):
        if (place, key) in where:
            out.append(raw[at:spans[place - 1][1] if place else 0])
            at = spans[place + n - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def op5(spark, folder: str) -> DataFrame:
    return repeated_paragraphs(read_table(spark, folder, "documents")).drop("key")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The documents without the repeated paragraphs."""
    return without_repeats(docs, repeated_paragraphs(docs))
