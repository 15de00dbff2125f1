"""Benchmark decontamination by template canonicalisation.

Words are lower-cased (A-Z and beyond) without outer punctuation; numbers, units after a number, and names
(capitalised words within a sentence, runs of them as one) become typed placeholders.  Windows of ``window`` template
tokens are hashed; those of the documents are joined to those of the benchmark on the hash.  Matched windows of a
document and an item lie on diagonals (same shift between the two); a diagonal counts if its windows cover enough
tokens and if its slots agree: each value of the item always stands for one value in the document.  So a copied
question is found again when its numbers, names or units were changed consistently.  Changed slots count only on a
diagonal with a window of ``min_literals`` literals, so that bare lists of quantities or names are not taken for one
another; windows with under ``few_literals`` are hashed with the values of their slots.  The first word of an item takes its type from what stands before it, so items
are hashed once for each type it may have.  Copies of a whole item are also looked for word by word, without types, so
that neither case nor context hides them.

A bitmap of fixed size over the benchmark's hashes keeps most windows of the documents from being shuffled.

Defined results: null and blank texts, on either side, match nothing.  Items with fewer tokens than a window have one
window of their length; those of under ``min_item_tokens`` (an answer like "yes") are not looked for, as any text may
hold them.  Documents with a null id are neither matched nor removed; items with a null id are left out.
Rows that share an id count as one document, repeated items as one item.  Ties do not matter: every item that a
document contains gives a row.  Empty tables give an empty result.  Other columns are not read, or pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import bitmap_of, free_prefix, in_bitmap, read_table, staged

NUMBER, UNIT, NAME, WORD = 1, 2, 3, 0
# Units of measure and money that may follow a number.
UNITS = frozenset((
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce ounces ml cl l "
    "liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent % $ € £ usd eur gbp dollar dollars cent cents euro euros mph km/h m/s "
    "hz khz mhz ghz w kw mw v a j kj cal kcal k c f °c °f").split())
_OUTER = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*#&|"
SLICE_ROWS = 1000
_M = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LeakRules:
    window: int = 8
    min_literals: int = 5
    few_literals: int = 2
    min_tokens: int = 13
    min_item_tokens: int = 4


FLAG_BITS = 5


class _Facts(dict):
    """A number for each word as written: the hash of the bare word, and flags in the lowest bits.

    Flags: 1 number, 2 unit, 4 capitalised, 8 ends a sentence, 16 nothing but punctuation.  At most ``most`` words are
    kept; others are looked at again.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        if word.isalpha():
            bare, tail = word, ""
        else:
            bare = word.strip(_OUTER)
            tail = word[len(word.rstrip(_OUTER)):]
        flags = 8 if tail and ("." in tail or "!" in tail or "?" in tail or ":" in tail) else 0
        if bare:
            low = bare.lower()
            digest = xxhash.xxh3_64_intdigest(low) >> FLAG_BITS << FLAG_BITS
            first = bare[0]
            if low in UNITS:
                flags |= 2
            if first.isalpha():
                flags |= 4 * first.isupper()
            elif first.isdigit() or bare.lstrip("+-$€£")[:1].isdigit():
                flags |= 1
        else:
            digest, flags = 0, flags | 16
        if len(self) < self.most:
            self[word] = digest | flags
        return digest | flags


class Templates:
    """Template windows of many texts at once."""

    def __init__(self, rules: LeakRules, most: int = 500_000):
        self.rules, self.facts = rules, _Facts(most)

    def windows(self, texts: list[str]):
        """(text, place, hash, tokens of the text, slots) arrays and lists of all template windows of full length.

        ``slots`` is a function from the chosen windows to lists of slot values.
        """
        return self.typed(self.parsed(texts), len(texts), (self.rules.window,))[:5]

    def parsed(self, texts: list[str]):
        """(words, places of the words that count, their texts, flags and hashes, which start a sentence)."""
        split = [t.split() for t in texts]
        words = [w for s in split for w in s]
        facts = np.fromiter(map(self.facts.__getitem__, words), np.uint64, len(words))
        hashes, flags = facts >> np.uint64(FLAG_BITS), (facts & np.uint64((1 << FLAG_BITS) - 1)).astype(np.uint8)
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        ended = np.cumsum((flags & 8) > 0)  # sentences that have ended, this word included
        keep = np.flatnonzero(flags & 16 == 0)
        own, flag, token = owner[keep], flags[keep], hashes[keep]
        first = _firsts(own)
        # A word starts a sentence if one ended at the word before it or at punctuation that stands alone between.
        opens = first.copy()
        opens[1:] |= ended[keep[1:] - 1] > ended[keep[:-1]] - ((flag[:-1] & 8) > 0)
        return words, keep, own, flag, token, opens

    def typed(self, parsed, n_texts: int, lengths, lead: int = WORD):
        """The windows of ``windows``, of the given lengths, and these lengths.  ``lead`` is the type of a text's first
        word; if not WORD, only texts whose first word can have it have windows."""
        words, keep, own, flag, token, opens = parsed
        first = _firsts(own)
        number = (flag & 1) > 0
        kind = np.where(number, NUMBER, np.where(((flag & 4) > 0) & ~opens, NAME, WORD)).astype(np.int8)
        after_number = np.zeros(len(keep), bool)
        after_number[1:] = number[:-1]
        kind[~number & ((flag & 2) > 0) & after_number & ~first] = UNIT
        able = np.ones(n_texts, bool)
        if lead != WORD:
            can = first & ~number & ((flag & (4 if lead == NAME else 2)) > 0)
            kind[can] = lead
            able = np.bincount(own[can], minlength=n_texts) > 0
        named = kind == NAME
        run = np.zeros(len(keep), bool)
        run[1:] = named[1:] & named[:-1] & ~first[1:]
        if run.any():  # the rest of a run of names goes; the slot's value is the run's first name
            stay = np.flatnonzero(~run)
            own, kind, token, keep = own[stay], kind[stay], token[stay], keep[stay]
        literal = kind == WORD
        seen = np.concatenate([[0], np.cumsum(literal)])
        hashed = zip(_rolled(np.where(literal, token, kind.astype(np.uint64)), own, lengths, 0),
                     _rolled(token, own, lengths, 1))
        at, h, length = _joined([(i, np.where(seen[i + w] - seen[i] >= self.rules.few_literals, typed, exact), w)
                                 for (i, typed, w), (_, exact, _) in hashed], able[own])
        rich = seen[at + length] - seen[at] >= self.rules.min_literals
        counts = np.bincount(own, minlength=n_texts)
        starts = np.concatenate([[0], np.cumsum(counts)])

        def slots(chosen):
            return [[words[keep[j]].strip(_OUTER) for j in range(i, i + w) if kind[j] != WORD]
                    for i, w in zip(at[chosen].tolist(), length[chosen].tolist())]

        return own[at], at - starts[own[at]], h, counts, slots, length, rich

    def whole(self, parsed, n_texts: int, lengths):
        """Windows of words without types, in the same form; they have no slots."""
        _, _, own, _, token, _ = parsed
        at, h, length = _joined(list(_rolled(token, own, lengths, 2)), np.ones(len(own), bool))
        counts = np.bincount(own, minlength=n_texts)
        starts = np.concatenate([[0], np.cumsum(counts)])
        return (own[at], at - starts[own[at]], h, counts, lambda chosen: [[] for _ in chosen], length,
                np.ones(len(at), bool))


def _firsts(own: np.ndarray) -> np.ndarray:
    first = np.ones(len(own), bool)
    first[1:] = own[1:] != own[:-1]
    return first


def _rolled(token: np.ndarray, own: np.ndarray, lengths, code: int):
    """(places, hashes, length) of the windows of each length that lie in one text."""
    h = token.copy()
    for w in range(1, max(lengths, default=0) + 1):
        if w > len(token):
            return
        if w > 1:
            h = h[:-1] * _M + token[w - 1:]
            h ^= h >> np.uint64(29)
        if w in lengths:
            at = np.flatnonzero(own[:len(h)] == own[w - 1:])
            x = (h[at] + np.uint64(4 * w + code)) * _M
            yield at, x ^ (x >> np.uint64(31)), w


def _joined(parts: list, able: np.ndarray):
    """(places, hashes, lengths) of the parts together, for the places that are able."""
    at = np.concatenate([np.zeros(0, np.int64)] + [p[0] for p in parts])
    h = np.concatenate([np.zeros(0, np.uint64)] + [p[1] for p in parts]).view(np.int64)
    length = np.repeat(np.array([p[2] for p in parts], np.int64), [len(p[0]) for p in parts])
    fine = able[at] if len(at) else np.zeros(0, bool)
    return at[fine], h[fine], length[fine]


WHOLE = 4  # the form of windows without types; those below are the type of an item's first word


def _windows(table: DataFrame, id_col: str, text: str, rules: LeakRules, bitmap=None, lengths=None) -> DataFrame:
    """(id, form, place, hash, n_tokens, rich, slots) of the windows of items, each as long as ``window`` or the whole item;
    or, with a bitmap, of those windows of documents, of the given lengths, whose hash the bitmap has."""
    source = table.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    lengths = range(1, rules.window + 1) if lengths is None else lengths
    forms = (WORD, NAME, UNIT, WHOLE) if bitmap is None else (WORD, WHOLE)

    def run(batches):
        templates = Templates(rules)
        for all_rows in batches:
            for at in range(0, all_rows.num_rows, SLICE_ROWS):
                batch = all_rows.slice(at, SLICE_ROWS)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                parsed = templates.parsed(texts)
                for form in forms:
                    own, place, h, counts, slots, length, rich = templates.whole(parsed, len(texts), lengths) \
                        if form == WHOLE else templates.typed(parsed, len(texts), lengths, form)
                    hit = np.flatnonzero((length == np.minimum(rules.window, counts[own])) &
                                         (counts[own] >= rules.min_item_tokens) if bitmap is None else in_bitmap(bitmap, h))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(own[hit])), pa.array(np.full(len(hit), form), pa.int32()),
                         pa.array(place[hit], pa.int64()), pa.array(h[hit], pa.int64()),
                         pa.array(counts[own[hit]], pa.int64()), pa.array(rich[hit]),
                         pa.array(slots(hit), pa.list_(pa.string()))],
                        names=["id", "form", "place", "hash", "n_tokens", "rich", "slots"])

    return source.mapInArrow(
        run, f"id {id_type}, form int, place bigint, hash bigint, n_tokens bigint, rich boolean, "
             "slots array<string>")


def _covered(places, window):
    """Tokens under windows that start at the given places (a sorted array)."""
    return F.aggregate(F.transform(places, lambda x, i: F.least(
        window, F.coalesce(F.get(places, i + 1) - x, window))),
        F.lit(0).cast("long"), lambda s, v: s + v)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", rules: LeakRules = LeakRules()) -> DataFrame:
    """(id, item_id, n_covered, n_item_tokens, n_places, changed) of every document and item it contains.

    ``n_covered`` is the most template tokens that one place covers, ``changed`` says that slots have other values.
    """
    items = staged(_windows(benchmark, item_id, item_text, rules).distinct(), "benchmark-windows")
    bitmap = bitmap_of(items, "hash")
    full = F.lit(rules.window).cast("long")
    # As many lengths as a window has tokens, at most.
    lengths = [r[0] for r in items.select(F.least(full, "n_tokens")).distinct().collect()]
    found = _windows(docs, id_col, text, rules, bitmap, lengths)
    parts = items.select(F.col("id").alias(item_id), F.col("form").alias("of_form"), F.col("place").alias("at"), "hash",
                         F.col("n_tokens").alias("n_item_tokens"), F.col("rich").alias("item_rich"), F.col("slots").alias(
                             "item_slots"))
    # All types of a first word end at the same token, so a place is named by its end.
    matched = found.join(parts, "hash").where((F.col("form") == WHOLE) == (F.col("of_form") == WHOLE)).select(
        "id", item_id, "of_form", "n_item_tokens",
        (F.col("place") - F.col("at") + F.col("n_item_tokens")).alias("end"), "at", "item_rich",
        F.arrays_zip(F.col("item_slots").alias("of_item"), F.col("slots").alias("of_doc")).alias("pairs"))
    # A diagonal has at most one window for each place of the item.
    diagonal = matched.groupBy("id", item_id, "of_form", "n_item_tokens", "end").agg(
        F.sort_array(F.collect_set("at")).alias("places"), F.max("item_rich").alias("rich"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    whole = F.col("of_form") == WHOLE
    judged = diagonal.select(
        "id", item_id, "of_form", "n_item_tokens", "end", "rich",
        _covered(F.col("places"), F.least(full, "n_item_tokens")).alias("covered"),
        (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["of_item"])))).alias("agreed"),
        F.exists("pairs", lambda x: x["of_item"] != x["of_doc"]).alias("changed"))
    enough = F.when(whole, F.col("n_item_tokens")).otherwise(
        F.least(F.lit(rules.min_tokens).cast("long"), F.col("n_item_tokens")))
    # Words are only counted where no template covers enough.
    best = F.max(F.struct(~whole, "covered", "n_item_tokens"))
    return judged.where(F.col("agreed") & (F.col("covered") >= enough) & (F.col("rich") | ~F.col("changed"))).groupBy(
        F.col("id").alias(id_col), item_id).agg(
        best["covered"].alias("n_covered"), best["n_item_tokens"].alias("n_item_tokens"),
        F.greatest(F.size(F.collect_set(F.when(~whole, F.col("end")))),
                   F.size(F.collect_set(F.when(whole, F.col("end"))))).cast("long").alias("n_places"),
        F.coalesce(F.max(F.when(~whole, F.col("changed"))), F.lit(False)).alias("changed"))


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    p = free_prefix(docs)
    gone = leaks.select(F.col(id_col).alias(p + "id")).distinct()
    return docs.join(gone, F.col(id_col) == F.col(p + "id"), "left_anti")


def op8(spark, folder: str) -> DataFrame:
    return benchmark_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    leaks = staged(benchmark_leaks(docs, read_table(spark, folder, "benchmark")), "leaks")
    return without_leaks(docs, leaks)
