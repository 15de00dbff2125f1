"""Source divergence audit: how far the sources of a language are apart, from merged stripes of counts.

A task folds whole documents into stripes: term -> (number of documents, occurrences per source), for each language.
When a fold holds ``spill_entries`` entries, its stripes go to the shuffle and it starts anew (Spark sorts and spills them
there); so a frequent term or a hot source sends one stripe per fold, whatever its rows.  Stripes of one (language,
term) are merged as sorted runs.  Terms in fewer than ``min_docs`` documents of the language go; the others, with all
counts of their sources, are the kept stripes, from which all divergences are computed directly, a bounded block of
terms at a time: for every two sources the summed differences of their smoothed shares, and for every source the terms
that it has more often than the language.

Shares are whole numbers, ``1 + floor(scale * (count + add) / (N + add * V))``; all arithmetic is on whole numbers.
Blocks hold ``block_cells`` (terms times sources) at most, and one term where there are more sources than that.  The
result has a row for every two sources of a language, so its size, and that of the sums sent by a block, is the
square of the number of sources.

Defined results: null text, language and source count as empty ones.  Repeated rows count as often as they come.  A
language without kept terms has differences of 0.  Equal values are ranked by the UTF-8 order of the item.  Other
columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.chunks import slices
from pricetide.llm.common import partitions, read_table, staged

#: Bytes of terms stay, A-Z become small ones, all else is a gap.
_TABLE = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
STRIPE = "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
_NAMES = ["lang", "term", "docs", "sources", "counts"]
NO_TERM = ""  # the stripe of this term has all sources of the language, with their counts of rows


@dataclass(frozen=True)
class DivergenceRules:
    min_docs: int = 30
    add: int = 5
    scale: int = 1_000_000_000
    top: int = 50
    spill_entries: int = 1_000_000
    slice_bytes: int = 4_000_000
    block_cells: int = 2_000_000


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class _Fold:
    """The stripes of one task since its last spill."""

    def __init__(self):
        self.terms, self.groups, self.langs = _Numbers(), _Numbers(), _Numbers()
        empty = np.empty(0, np.int64)
        self.tf, self.df = (empty, empty), (empty, empty)  # keys: term << 24 | group, term << 24 | language
        self.rows = _Numbers()

    def add(self, texts: list[bytes], langs: list[str], sources: list[str]) -> None:
        found = [t.translate(_TABLE).split() for t in texts]
        sizes = np.array([len(f) for f in found])
        number = self.terms.__getitem__
        terms = np.fromiter((n for f in found for n in map(number, f)), np.int64, int(sizes.sum()))
        group = np.array([self.groups[lang, s] for lang, s in zip(langs, sources)], np.int64)
        lang = np.array([self.langs[x] for x in langs], np.int64)
        for g in group.tolist():
            self.rows[g] = self.rows.get(g, 0) + 1
        doc = np.repeat(np.arange(len(texts)), sizes)
        per_doc, n = np.unique(doc << 32 | terms, return_counts=True)
        term, doc = per_doc & 0xFFFFFFFF, per_doc >> 32
        self.tf = self._merged(self.tf, term << 24 | group[doc], n.astype(np.int64))
        self.df = self._merged(self.df, term << 24 | lang[doc], np.ones(len(term), np.int64))

    @staticmethod
    def _merged(held, keys, counts):
        keys, counts = _summed(keys, counts)
        return _summed(np.concatenate([held[0], keys]), np.concatenate([held[1], counts]))

    def entries(self) -> int:
        return max(len(self.tf[0]), len(self.groups) * 16)

    def stripes(self):
        """Record batches of all stripes."""
        terms, groups, langs = list(self.terms), list(self.groups), list(self.langs)
        lang_of = np.array([self.langs[lang] for lang, _ in groups], np.int64)
        keys, counts = self.tf
        term, group = keys >> 24, keys & 0xFFFFFF
        stripe = term << 24 | lang_of[group] if len(keys) else keys
        order = np.argsort(stripe, kind="stable")
        stripe, group, counts = stripe[order], group[order], counts[order]
        starts = np.searchsorted(stripe, self.df[0])  # both have the same (term, language) pairs
        names = pa.array([s for _, s in groups], pa.string())
        for a in range(0, len(starts), 50_000):
            own, df = self.df[0][a:a + 50_000], self.df[1][a:a + 50_000]
            lo, hi = starts[a], starts[a + 50_000] if a + 50_000 < len(starts) else len(stripe)
            offsets = pa.array(np.append(starts[a:a + 50_000], hi) - lo, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[i] for i in (own & 0xFFFFFF).tolist()], pa.string()),
                pa.array([terms[i] for i in (own >> 24).tolist()], pa.binary()).cast(pa.string()), pa.array(df),
                pa.ListArray.from_arrays(offsets, names.take(pa.array(group[lo:hi]))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[lo:hi]))], names=_NAMES)
        for i, lang in enumerate(langs):
            own = [g for g in self.rows if lang_of[g] == i]
            yield _batch([(lang, NO_TERM, 0, [groups[g][1] for g in own], [self.rows[g] for g in own])])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_KINDS)],
                                      names=_NAMES)


def stripes(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
            rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """The stripes of all folds, not yet merged."""
    def run(batches):
        fold = _Fold()
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(0).cast(pa.binary())]
            langs, sources = ([x or "" for x in batch.column(i).to_pylist()] for i in (1, 2))
            for a, b in slices([len(t) for t in texts], rules.slice_bytes):
                fold.add(texts[a:b], langs[a:b], sources[a:b])
                if fold.entries() >= rules.spill_entries:
                    yield from fold.stripes()
                    fold = _Fold()
        yield from fold.stripes()

    return docs.select(text, lang, source).mapInArrow(run, STRIPE)


def merged_stripes(found: DataFrame, rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """One stripe per (language, term) in at least ``min_docs`` documents, and that of ``NO_TERM``."""
    def run(batches):
        held = None  # (lang, term), documents, source -> count
        out, size = [], 0

        def closed():
            (lang, term), docs, counts = held
            return [(lang, term, docs, list(counts), list(counts.values()))] \
                if docs >= rules.min_docs or term == NO_TERM else []

        for batch in batches:
            for lang, term, docs, sources, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held[0] != (lang, term):
                    if held is not None:
                        done = closed()
                        out += done
                        size += sum(len(r[3]) for r in done)
                    held = [(lang, term), 0, {}]
                held[1] += docs
                mine = held[2]
                for s, n in zip(sources, counts):
                    mine[s] = mine.get(s, 0) + n
                if size > 200_000:
                    yield _batch(out)
                    out, size = [], 0
        if held is not None:
            out += closed()
        yield _batch(out)

    return found.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, STRIPE)


def _differences(sources: list[str], totals: list[int], count: int, term_rows, rules: DivergenceRules):
    """(pair sums, top terms per source) of one block: ``totals`` are N of each source, ``count`` is V."""
    at = {s: i for i, s in enumerate(sources)}
    wide = np.array([n + rules.add * count for n in totals], object)
    whole = sum(totals) + rules.add * count
    sums = np.zeros((len(sources), len(sources)), np.int64)
    best: list[list] = [[] for _ in sources]
    # Blocks of at most so many cells are dense; a share of a count of 0 is the same for all terms.
    none = np.array([1 + rules.scale * rules.add // w if w else 0 for w in wide], np.int64)
    step = max(1, rules.block_cells // max(1, len(sources)))
    term_rows = iter(term_rows)
    while rows := list(islice(term_rows, step)):
        p = np.tile(none, (len(rows), 1))
        q = np.empty(len(rows), np.int64)
        had = np.zeros(p.shape, bool)
        for i, (_, names, counts) in enumerate(rows):
            total = 0
            for s, n in zip(names, counts):
                j = at[s]
                p[i, j] = 1 + rules.scale * (n + rules.add) // wide[j]
                had[i, j] = n > 0
                total += n
            q[i] = 1 + rules.scale * (total + rules.add) // whole
        for j in range(len(sources)):
            sums[j, j + 1:] += np.abs(p[:, j + 1:] - p[:, j:j + 1]).sum(axis=0)
            f = np.where(had[:, j], p[:, j] - q, 0)
            hits = np.flatnonzero(f > 0)
            if len(hits) > rules.top:
                least = np.partition(f[hits], len(hits) - rules.top)[len(hits) - rules.top]
                hits = hits[f[hits] >= least]  # with all ties of the last one
            best[j] = sorted(best[j] + [(-int(f[i]), rows[i][0]) for i in hits.tolist()])[:rules.top]
    return sums, best


def _audit_rows(lang, sources, sums, best):
    for i, s in enumerate(sources):
        for j in range(i + 1, len(sources)):
            yield lang, s, "pair", sources[j], int(sums[i, j])
        for f, term in best[i]:
            yield lang, s, "term", term.decode(), -f


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                      rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms a source has more often."""
    spark = docs.sparkSession
    kept = staged(merged_stripes(stripes(docs, text, lang, source, rules), rules), "stripes")
    each = kept.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", F.col("x.sources").alias("source"),
        F.when(F.col("term") != NO_TERM, F.col("x.counts")).otherwise(F.lit(0)).alias("n"))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    size = kept.groupBy("lang").agg(F.sum((F.col("term") != NO_TERM).cast("long")).alias("terms"))
    groups = totals.join(size, "lang").withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
    # As many blocks as their bounded size asks for; a language has one at least.
    cells = F.ceil(F.col("terms") * F.col("sources") / rules.block_cells)
    groups = staged(groups.withColumn("blocks", F.greatest(cells, F.lit(1)).cast("long")), "source-totals")
    per_block = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    number = groups.select("lang", "blocks").distinct()
    terms = kept.where(F.col("term") != NO_TERM).join(number, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "term", "sources", "counts")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = sorted(zip(left.column("source").to_pylist(), left.column("n").to_pylist()), key=lambda x: x[0].encode())
        names = [s for s, _ in order]
        count, language = left.column("terms")[0].as_py(), left.column("lang")[0].as_py()

        def term_rows():
            for batch in right.to_batches(max_chunksize=2_000):
                yield from zip(batch.column("term").cast(pa.binary()).to_pylist(), batch.column("sources").to_pylist(),
                               batch.column("counts").to_pylist())

        sums, best = _differences(names, [n for _, n in order], count, term_rows(), rules)
        rows = list(_audit_rows(language, names, sums, best))
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                    names=["lang", "source", "part", "item", "value"])

    found = per_block.select("lang", "block", "source", "n", "terms").groupBy("lang", "block").cogroup(
        terms.groupBy("lang", "block")).applyInArrow(
        run, "lang string, source string, part string, item string, value bigint")
    found = staged(found, "divergences")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part",
                                          F.col("source").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = both.unionByName(found.where("part = 'term'")).withColumn("rank", rank)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= rules.top))


def op12(spark, folder: str) -> DataFrame:
    return source_divergence(read_table(spark, folder, "documents"))


def divergence_sql(rules: DivergenceRules = DivergenceRules()) -> str:
    """DuckDB SQL for ``op12``."""
    share = f"(1 + ({rules.scale}::hugeint * ({{0}} + {rules.add})) // ({{1}} + {rules.add} * v))::bigint"
    return rf"""
with docs as (select row_number() over () rid, coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') terms from documents),
tok as (select rid, lang, source, unnest(terms) term from docs),
kept as (select lang, term from tok group by lang, term having count(distinct rid) >= {rules.min_docs}),
grp as (select distinct lang, source from docs),
tf as (select lang, source, term, count(*) c from tok join kept using (lang, term) group by all),
tot as (select g.lang, g.source, coalesce((select sum(c) from tf where tf.lang = g.lang and tf.source = g.source), 0) n,
    (select count(*) from kept k where k.lang = g.lang) v from grp g),
lng as (select lang, sum(n) n, any_value(v) v from tot group by lang),
p as (select t.lang, t.source, k.term, coalesce(c, 0) c, {share.format('coalesce(c, 0)', 'n')} p
    from tot t join kept k using (lang) left join tf on tf.lang = t.lang and tf.source = t.source and tf.term = k.term),
q as (select l.lang, k.term, {share.format('(select sum(c) from tf where tf.lang = k.lang and tf.term = k.term)', 'n')} q
    from lng l join kept k using (lang)),
dist as (select a.lang, a.source, b.source item, sum(abs(a.p - b.p)) f from p a join p b
    on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' part, b.source item, coalesce(f, 0)::bigint as value
    from grp a join grp b on a.lang = b.lang and a.source <> b.source
    left join dist d on d.lang = a.lang and d.source = a.source and d.item = b.source),
term as (select lang, source, 'term' part, term item, (p - q)::bigint as value from p join q using (lang, term)
    where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from (select * from pair union all select * from term))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {rules.top}"""
