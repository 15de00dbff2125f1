"""Chat formatting by quotation linking.

Lines that start with ``>`` are quotes; the number of ``>`` is their level.  A passage is a run of lines of one level.
Passages are normalised (lower case, single blanks) and hashed as a whole, by paragraph and by line, and joined to the
same hashes of the texts that messages of the conversation wrote themselves.  The original of a passage is the first
message that has it, if that came before.  A message replies to the original of its lowest quoted level, of its
longest match there.  Following replies up leads to the first message of a thread; messages without a found original
start one.  Read by conversation, thread and turn, every message comes after what it quotes, and each body is free of
quotes and of the line that introduces them.

Only DataFrame functions are used.  No conversation, thread or passage is gathered in one task: originals are minima
that combine before the shuffle, replies are followed by doubling, and the result is sorted by ranges.

Defined results: a null text keeps a null body; a text without quotes keeps its body unchanged; a text of quotes alone
has an empty body.  Rows with a null conversation or turn are never linked and start a thread of their own.  Rows that
share conversation and turn are never merged; they are linked alike, by the quotes of all of them.  Passages of fewer
than ``min_words`` words link nothing.  Other columns pass through, but for columns with the names of results, which
are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import free_prefix, partitions, read_table, staged

MARK = r"^((?:[ \t]{0,3}>)+)"
# How mail and chat programs introduce a quote.
INTRODUCTION = r"(?i)\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"
MIN_WORDS = 3


def _normal(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))


def _units(x: Column, min_words: int) -> Column:
    """The distinct normalised forms of a text: all of it, its paragraphs, its lines."""
    whole = F.concat(F.array(x), F.split(x, r"\n[ \t]*\n"), F.split(x, r"\n"))
    return F.filter(F.array_distinct(F.transform(whole, _normal)), lambda u: (u != "") & (
        F.size(F.split(u, " ")) >= min_words))


def _parsed(messages: DataFrame, text: str, p: str) -> DataFrame:
    """Add runs (array of level, text) and body."""
    df = messages.withColumn(p + "lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    df = df.withColumn(p + "levels", F.transform(p + "lines", lambda x: F.length(F.regexp_replace(
        F.regexp_extract(x, MARK, 1), "[^>]", ""))))
    lines, levels = F.col(p + "lines"), F.col(p + "levels")
    # The line that introduces a quote belongs to it: it is emptied and never matched.
    df = df.withColumn(p + "quoted", F.exists(levels, lambda x: x > 0)) \
        .withColumn(p + "bare", F.transform(lines, lambda x, i: F.when(
            (F.get(levels, i + 1) > F.get(levels, i)) & x.rlike(INTRODUCTION), F.lit("")).otherwise(
            F.when(F.get(levels, i) > 0, F.trim(F.regexp_replace(x, MARK + " ?", ""))).otherwise(x)))) \
        .withColumn(p + "starts", F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (
            F.get(levels, i) != F.get(levels, i - 1))))
    bare, starts = F.col(p + "bare"), F.col(p + "starts")
    df = df.withColumn(p + "runs", F.transform(starts, lambda s, j: F.struct(
        F.get(levels, s).alias("level"), F.array_join(F.slice(
            bare, s + 1, F.coalesce(F.get(starts, j + 1), F.size(lines)) - s), "\n").alias("text"))))
    own = F.array_join(F.transform(F.filter(p + "runs", lambda r: r["level"] == 0), lambda r: r["text"]), "\n")
    return df.withColumn(p + "body", F.when(
        F.col(p + "quoted"), F.regexp_replace(own, r"^(?:[ \t]*\n)+|\s+$", "")).otherwise(F.col(text)))


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``messages`` without quotes: body, n_quotes, max_level, n_linked, reply_to, thread_turn and depth.

    The rows are ordered by conversation, thread_turn and turn, over the partitions and within them.
    """
    p = free_prefix(messages)
    df = _parsed(messages, text, p)
    known = df.where(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(
        F.col(conv).alias("c"), F.col(turn).alias("t"), F.col(p + "body").alias("body"),
        F.filter(p + "runs", lambda r: r["level"] > 0).alias("quotes"))
    quotes = known.select("c", "t", F.posexplode("quotes").alias("run", "quote")).select(
        "c", "t", "run", F.col("quote.level").alias("level"), F.explode(_units(F.col("quote.text"), min_words)).alias("u"))
    quotes = staged(quotes.select("c", "t", "run", "level", F.length("u").alias("n"), F.xxhash64("u").alias("h")), "quotes")
    own = known.select("c", "t", F.explode(_units(F.coalesce("body", F.lit("")), min_words)).alias("u")) \
        .select("c", "t", F.length("u").alias("n"), F.xxhash64("u").alias("h"))
    # Only what some quote asks for is looked up; the first message that wrote it is the original.
    asked = quotes.select("c", "h", "n").distinct()
    originals = staged(own.join(asked, ["c", "h", "n"], "left_semi").groupBy("c", "h", "n").agg(
        F.min("t").alias("first")), "originals")
    found = quotes.join(originals, ["c", "h", "n"]).where("first < t")
    links = staged(found.groupBy("c", "t").agg(
        F.max(F.struct(-F.col("level"), "n", "first"))["first"].alias("reply_to"),
        F.count_distinct("run").alias("n_linked")), "quote-links")
    threads = _threads(links)
    found = links.join(threads, ["c", "t"]).select(*[F.col(c).alias(p + c) for c in (
        "c", "t", "reply_to", "n_linked", "root", "depth")])
    quoted = F.filter(p + "runs", lambda r: r["level"] > 0)
    result = {
        "body": F.col(p + "body"), "n_quotes": F.size(quoted), "max_level": F.array_max(p + "levels"),
        "n_linked": F.coalesce(F.col(p + "n_linked"), F.lit(0).cast("long")), "reply_to": F.col(p + "reply_to"),
        "thread_turn": F.coalesce(F.col(p + "root"), F.col(turn)),
        "depth": F.coalesce(F.col(p + "depth"), F.lit(0))}
    joined = df.join(found, (F.col(conv) == F.col(p + "c")) & (F.col(turn) == F.col(p + "t")), "left")
    kept = [c for c in messages.columns if c.lower() not in result and c != text]
    out = joined.select(*kept, *[v.alias(k) for k, v in result.items()])
    spark = messages.sparkSession
    return out.repartitionByRange(partitions(spark), conv, "thread_turn", turn).sortWithinPartitions(
        conv, "thread_turn", turn)


def _threads(links: DataFrame) -> DataFrame:
    """(c, t, root, depth) of every reply: the ways up double in length with each round."""
    at = staged(links.select("c", "t", F.col("reply_to").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = at.select("c", F.col("t").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        longer = at.join(up, ["c", "root"], "left")
        if longer.where("higher is not null").isEmpty():
            return at
        at = staged(longer.select("c", "t", F.coalesce("higher", "root").alias("root"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")


def op3(spark, folder: str) -> DataFrame:
    return link_quotes(read_table(spark, folder, "conversations"))


def quote_sql(min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for ``op3``."""
    normal = r"trim(regexp_replace(lower(u), '\s+', ' ', 'g'))"

    def units(x):
        return (f"list_filter(list_distinct(list_transform(list_concat([{x}], regexp_split_to_array({x}, '\\n[ \\t]*\\n'), "
                f"string_split({x}, chr(10))), lambda u: {normal})), "
                f"lambda u: u <> '' and len(string_split(u, ' ')) >= {min_words})")

    return rf"""
with recursive msg as (select row_number() over () rid, conv_id, turn, role, text from conversations),
split as (select rid, string_split(coalesce(text, ''), chr(10)) ls from msg),
lines as (select rid, unnest(ls) line, generate_subscripts(ls, 1) i from split),
levels as (select *, length(regexp_replace(regexp_extract(line, '{MARK}', 1), '[^>]', '', 'g')) as lv from lines),
around as (select *, lead(lv) over w as nx, lag(lv) over w as pv from levels window w as (partition by rid order by i)),
bare as (select rid, i, lv, case when nx > lv and regexp_matches(line, '{INTRODUCTION}') then ''
    when lv > 0 then trim(regexp_replace(line, '{MARK} ?', '')) else line end as line,
    sum(case when pv is null or pv <> lv then 1 else 0 end) over (partition by rid order by i) as run from around),
runs as (select rid, run, lv, string_agg(line, chr(10) order by i) as txt from bare group by rid, run, lv),
own as (select rid, max(lv) as max_level, count(*) filter (lv > 0) as n_quotes,
    string_agg(txt, chr(10) order by run) filter (lv = 0) as txt from runs group by rid),
bodies as (select msg.*, max_level, n_quotes, case when max_level > 0 then
    regexp_replace(coalesce(own.txt, ''), '^(?:[ \t]*\n)+|\s+$', '', 'g') else text end as body from msg join own using (rid)),
known as (select * from bodies where conv_id is not null and turn is not null),
quotes as (select conv_id c, turn t, run, lv, unnest({units('txt')}) u from known join runs using (rid) where lv > 0),
wrote as (select conv_id c, turn t, unnest({units("coalesce(body, '')")}) u from known),
originals as (select c, u, min(t) as first from wrote group by c, u),
found as (select q.*, first from quotes q join originals o on q.c = o.c and q.u = o.u where first < t),
links as (select c, t, count(distinct run) as n_linked,
    arg_max(first, row(-lv, length(u), first)) as reply_to from found group by c, t),
up(c, t, root, depth) as (select c, t, reply_to, 1 from links
    union all select up.c, up.t, l.reply_to, depth + 1 from up join links l on up.c = l.c and up.root = l.t),
ends as (select c, t, arg_max(root, depth) as root, max(depth) as depth from up group by c, t)
select conv_id, turn, role, body, cast(n_quotes as int) as n_quotes, cast(max_level as int) as max_level,
    coalesce(n_linked, 0) as n_linked, reply_to, coalesce(root, turn) as thread_turn, coalesce(depth, 0) as depth
from bodies left join links on conv_id = links.c and turn = links.t left join ends on conv_id = ends.c and turn = ends.t"""
