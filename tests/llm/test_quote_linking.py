import duckdb

from pricetide.llm.quote_linking import link_quotes, quote_sql

SCHEMA = "conv_id long, turn long, role string, text string"
FIRST = "Where do the cranes land?\nI saw two of them near the lake.\n\nThey left at noon."


def rows_of(spark, rows, schema=SCHEMA):
    return link_quotes(spark.createDataFrame(rows, schema)).collect()


def by_sql(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    return sorted(con.execute(quote_sql()).fetchall(), key=str)


def test_nested_quotes_are_linked_and_taken_out(spark):
    rows = [
        (1, 0, "user", FIRST),
        (1, 1, "assistant", "Anna wrote:\n> where do  the CRANES land?\n\nMostly on the eastern shore."),
        (1, 2, "user", "Something new entirely, about herons."),
        (1, 3, "user", "> Mostly on the\n> eastern shore.\n>> I saw two of them near the lake.\nThanks a lot!"),
        (1, 4, "assistant", ">> They left at noon.\nThat one was earlier."),
        (1, 5, "user", "> never said by anybody here\nHm."),
        (1, 6, "user", "> Thanks a lot!\n> ok\n"),
        (2, 0, "user", "> Mostly on the eastern shore.\nother conversation"),
    ]
    got = rows_of(spark, rows)
    assert sorted(map(tuple, got), key=str) == by_sql(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert {k: v.reply_to for k, v in by.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 0, (1, 5): None, (1, 6): 3, (2, 0): None}
    assert {k: (v.thread_turn, v.depth) for k, v in by.items()} == {
        (1, 0): (0, 0), (1, 1): (0, 1), (1, 2): (2, 0), (1, 3): (0, 2), (1, 4): (0, 1), (1, 5): (5, 0),
        (1, 6): (0, 3), (2, 0): (0, 0)}
    assert by[1, 1].body == "Mostly on the eastern shore." and by[1, 3].body == "Thanks a lot!" and by[1, 6].body == ""
    assert by[1, 0].body == FIRST
    assert (by[1, 3].n_quotes, by[1, 3].max_level, by[1, 3].n_linked) == (2, 2, 2)
    assert [(r.conv_id, r.turn) for r in got] == [
        (1, 0), (1, 1), (1, 3), (1, 4), (1, 6), (1, 2), (1, 5), (2, 0)]


def test_long_chain(spark):
    rows = [(7, 0, "a", "message number zero here")] + [
        (7, i, "b", f"> message number {'zero' if i == 1 else i - 1} here\nmessage number {i} here") for i in range(1, 40)]
    got = rows_of(spark, rows)
    assert sorted(map(tuple, got), key=str) == by_sql(rows)
    got = {r.turn: r for r in got}
    assert all(got[i].thread_turn == 0 and got[i].depth == i and (got[i].reply_to == i - 1 or i == 0) for i in range(40))


def test_odd_rows(spark):
    rows = [(None, 1, "u", "> a b c\nx"), (1, None, "u", "a b c"), (1, 2, None, None), (1, 3, "u", ""),
            (1, 4, "u", "same words twice"), (1, 4, "u", "same words twice"), (1, 5, "u", "> same words twice"),
            (1, 5, "u", "> same words twice")]
    assert sorted(map(tuple, rows_of(spark, rows)), key=str) == by_sql(rows)
    got = link_quotes(spark.createDataFrame([r + (1, "t") for r in rows], SCHEMA + ", body int, _x string"))
    assert got.columns == ["conv_id", "turn", "role", "_x", "body", "n_quotes", "max_level", "n_linked", "reply_to",
                           "thread_turn", "depth"]
    got = got.collect()
    assert len(got) == len(rows)
    assert sorted(str(r.body) for r in got) == sorted(["x", "a b c", "None", "", "same words twice",
                                                       "same words twice", "", ""])
    assert [r.reply_to for r in got if r.turn == 5] == [4, 4]
    assert rows_of(spark, [], SCHEMA) == []
