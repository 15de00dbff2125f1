"""License scans: exact set-similarity join of text blocks with license templates.

A template is a set of words.  Its block class is the least power of two that holds its words; blocks of class ``w``
are the words ``k*w`` to ``k*w + 2*w`` of a text, so that every run of ``w`` words lies whole in a block.  A link is a
block that holds at least ``containment`` of a template's words.

The words of all templates are ordered by how often the documents have them, the rarest first; words of no template
cannot add to an overlap and are left out.  If a template of ``n`` words needs ``a`` of them, then a block that has
``a`` holds, in that order, one of the template's first ``n - a + 1`` words among its own first ones (prefix filter);
it has at least ``a`` words itself (length filter), and what is left behind the first common word on either side must
suffice (positional filter).  Pairs that pass are counted exactly, so no link is missed and none is made up.

Phrases are looked for as consecutive words besides.  What tasks are given has the size of the templates and phrases,
which are parameters, never that of the documents: frequencies are kept for template words only.

Defined results: a null or empty text has no words, no label and score 0.  ``score`` is 1 where a phrase stands, else
the greatest containment of a link, else 0.  Rows are never merged; repeated rows and null ids are scanned alike.
Ties do not matter: labels are sorted, and equal frequencies are ordered by the word.  A template that is given twice
has its links twice.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pricetide.llm.common import read_table

# Phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Sentences of public licenses and of common notices.
TEMPLATES = (
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the"
                      " License at http www apache org licenses LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
            " that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                   " General Public License as published by the Free Software Foundation"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
                 " associated documentation files, to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("no-warranty", "the software is provided as is, without warranty of any kind, express or implied, including but"
                    " not limited to the warranties of merchantability, fitness for a particular purpose and"
                    " noninfringement"),
)
#: Bytes of words stay, capital letters become small ones, all else is a gap.
_TABLE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))
FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
          "score double, links array<struct<label: string, block_start: bigint, block_end: bigint, shared: int, size: int>>")


@dataclass(frozen=True)
class LicenseRules:
    containment: float = 0.9
    templates: tuple = field(default=TEMPLATES)
    phrases: tuple = field(default=PHRASES)


def words_in(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


@dataclass
class _Template:
    label: str
    words: list[bytes]  # distinct
    width: int
    needed: int
    ranks: np.ndarray | None = None


def _templates(rules: LicenseRules) -> list[_Template]:
    out = []
    for label, text in rules.templates:
        found = words_in(text.encode())
        if found:
            distinct = sorted(set(found))
            out.append(_Template(label, distinct, 1 << max(0, len(found) - 1).bit_length(),
                                 max(1, math.ceil(rules.containment * len(distinct) - 1e-9))))
    return out


def word_frequencies(docs: DataFrame, words: list[bytes], text: str = "text") -> dict[bytes, int]:
    """How often the documents have each of the given words: as many numbers as words are given."""
    def run(batches):
        at = {w: i for i, w in enumerate(words)}
        counts = np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()):
                found = words_in(t.as_py())
                counts += np.bincount(np.fromiter(map(at.get, found, [len(words)] * len(found)), np.int64, len(found)),
                                      minlength=len(words) + 1)
        hit = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(counts[hit])], names=["word", "n"])

    out = dict.fromkeys(words, 0)
    for i, n in docs.select(text).mapInArrow(run, "word bigint, n bigint").groupBy("word").sum("n").collect():
        out[words[i]] = n
    return out


class _Scanner:
    """The templates and phrases as arrays of ranks; a rank is a word's place in the order of frequencies."""

    def __init__(self, templates: list[_Template], order: list[bytes], phrases):
        self.rank = {w: i + 1 for i, w in enumerate(order)}  # 0 is a word of no template
        self.phrases = [(label, p) for label, text in phrases if (p := words_in(text.encode()))]
        for _, p in self.phrases:
            for w in p:
                self.rank.setdefault(w, len(self.rank) + 1)
        self.phrases = [(label, [self.rank[w] for w in p]) for label, p in self.phrases]
        self.by_width: dict[int, list] = {}
        starts = np.zeros(len(self.rank) + 1, bool)  # words that a prefix or a phrase holds
        for t in templates:
            t.ranks = np.sort(np.array([self.rank[w] for w in t.words]))
            prefix = t.ranks[:len(t.ranks) - t.needed + 1]
            starts[prefix] = True
            self.by_width.setdefault(t.width, []).append(t)
        self.index = {}
        for width, group in self.by_width.items():
            index: dict[int, list] = {}  # word of a prefix -> (template, the word's place in it)
            for n, t in enumerate(group):
                for i, r in enumerate(t.ranks[:len(t.ranks) - t.needed + 1].tolist()):
                    index.setdefault(r, []).append((n, i))
            known = np.zeros(len(self.rank) + 1, bool)
            for t in group:
                known[t.ranks] = True
            self.index[width] = index, known
        for _, p in self.phrases:
            starts[p[0]] = True
        self.starts = starts

    def ranks(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.rank.get, found, [0] * len(found)), np.int32, len(found))

    def places(self, ranks: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """(label, starts) of each phrase."""
        out = []
        for label, p in self.phrases:
            n = len(ranks) - len(p) + 1
            at = np.flatnonzero(ranks[:n] == p[0]) if n > 0 else np.empty(0, np.int64)
            for k, r in enumerate(p[1:], 1):
                at = at[ranks[at + k] == r]
            out.append((label, at))
        return out

    def links(self, ranks: np.ndarray) -> list[tuple[str, int, int, int, int]]:
        """(label, block start, block end, shared words, template size) of every link."""
        out = []
        for width, (index, known) in self.index.items():
            group = self.by_width[width]
            at = np.flatnonzero(known[ranks])
            hits = np.flatnonzero(np.isin(ranks[at], list(index)))
            if not len(hits):
                continue
            near = np.unique(at[hits] // width)
            blocks = np.unique(np.concatenate([near, near - 1]))
            for b in blocks[blocks >= 0].tolist():
                own = np.unique(ranks[at[np.searchsorted(at, b * width):np.searchsorted(at, (b + 2) * width)]])
                done = set()
                for j, r in enumerate(own.tolist()):
                    for n, i in index.get(r, ()):
                        t = group[n]
                        if n in done or len(own) < t.needed or j > len(own) - t.needed:
                            continue  # met before, too short, or not in this block's prefix for the template
                        done.add(n)
                        if 1 + min(len(t.ranks) - i - 1, len(own) - j - 1) < t.needed:
                            continue
                        shared = len(np.intersect1d(own, t.ranks, assume_unique=True))
                        if shared >= t.needed:
                            out.append((t.label, b * width, min((b + 2) * width, len(ranks)), shared, len(t.ranks)))
        return out

    def scan(self, text: bytes | None) -> tuple:
        ranks = self.ranks(words_in(text))
        if not self.starts[ranks].any():
            return len(ranks), 0, None, None, "", "", 0.0, []
        places = [(label, at) for label, at in self.places(ranks) if len(at)]
        links = self.links(ranks)
        starts = np.concatenate([at for _, at in places]) if places else np.empty(0, np.int64)
        base = {label for label, _ in places}
        score = 1.0 if places else max((shared / size for *_, shared, size in links), default=0.0)
        return (len(ranks), len(starts), int(starts.min()) if len(starts) else None,
                int(starts.max()) if len(starts) else None, ",".join(sorted(base)),
                ",".join(sorted(base | {x[0] for x in links})), score,
                [dict(zip(("label", "block_start", "block_end", "shared", "size"), x)) for x in sorted(links)])


def license_scans(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  rules: LicenseRules = LicenseRules()) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, links) of every row."""
    templates = _templates(rules)
    vocabulary = sorted({w for t in templates for w in t.words})
    n = word_frequencies(docs, vocabulary, text)
    order = sorted(vocabulary, key=lambda w: (n[w], w))
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "links"]
    link = pa.struct([("label", pa.string()), ("block_start", pa.int64()), ("block_end", pa.int64()),
                      ("shared", pa.int32()), ("size", pa.int32())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(link)]

    def run(batches):
        scanner = _Scanner(templates, order, rules.phrases)
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), kind) for c, kind in zip(columns, kinds)]], names=names)

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {id_type}, {FIELDS}")


def op11(spark, folder: str) -> DataFrame:
    return license_scans(read_table(spark, folder, "documents")).drop("links")


def license_sql(rules: LicenseRules = LicenseRules()) -> str:
    """DuckDB SQL for ``op11``, without order or filters: every template word of every block is counted."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    tpl = ", ".join(f"({n}, {quoted(t.label)}, {len(t.words)}, {t.width}, {t.needed}, {quoted(w.decode())})"
                    for n, t in enumerate(_templates(rules)) for w in t.words)
    phrases = ", ".join(f"({quoted(label)}, [{', '.join(quoted(w.decode()) for w in words_in(p.encode()))}])"
                        for label, p in rules.phrases)
    return rf"""
with tpl(n, label, size, width, needed, word) as (values {tpl}),
phrases(label, words) as (values {phrases}),
docs as (select row_number() over () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') words from documents),
toks as (select rid, unnest(words) word, unnest(range(len(words))) pos from docs),
bits as (select rid, n, label, size, needed, word, unnest([pos // width, pos // width - 1]) block
    from toks join tpl using (word)),
links as (select rid, label, count(distinct word) / max(size) score from bits where block >= 0
    group by rid, n, label, block having count(distinct word) >= max(needed)),
base as (select rid, label, pos from docs join toks using (rid) join phrases on toks.word = phrases.words[1]
    and docs.words[pos + 1:pos + len(phrases.words)] = phrases.words),
b as (select rid, count(*) n_base, min(pos) first_word, max(pos) last_word,
    string_agg(distinct label, ',' order by label) base_labels from base group by rid),
l as (select rid, string_agg(distinct label, ',' order by label) labels from
    (select rid, label from base union select rid, label from links) group by rid),
s as (select rid, max(score) score from links group by rid)
select doc_id, len(words)::bigint n_words, coalesce(n_base, 0) n_base, first_word, last_word,
    coalesce(base_labels, '') base_labels, coalesce(labels, '') labels,
    case when n_base > 0 then 1.0::double else coalesce(score, 0.0::double) end score
from docs left join b using (rid) left join l using (rid) left join s using (rid)"""
