from tollgate.llm import quotes


def test_links_and_order(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are you?"),
        (1, 1, "assistant", "> how  ARE you?\nFine.\nAnd you?"),
        (1, 2, "user", "New topic"),
        (1, 3, "assistant", ">> How are you?\n> Fine.\n> And you?\n\nGood, > really"),
        (1, 4, "user", "> New topic\nYes"),
        (1, 5, "user", "> nowhere said\nHm"),
        (1, 6, "user", "> Good, > really\n> Yes\n> Good, > really\nBoth"),
        (2, 0, "user", "> Hello there\nself"),
        (2, None, "user", None),
        (3, 0, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, path string")
    out = {(r.conv_id, r.turn): r for r in quotes.format_chats(df).collect()}
    assert len(out) == len(rows)
    assert [out[1, i].parent_turn for i in range(7)] == [None, 0, None, 1, 2, None, 3]
    assert out[1, 3].quoted_turns == "0,1" and out[1, 3].content == "\nGood, > really" and out[1, 3].n_quoted == 3
    order = sorted((r.path, r.turn) for (c, t), r in out.items() if c == 1)
    assert [t for _, t in order] == [0, 1, 3, 6, 2, 4, 5]
    assert out[2, 0].parent_turn is None and out[2, None].content == "" and out[3, 0].content == ""
    levels = {(r.turn, r.line): (r.level, r.passage) for r in quotes.parsed(df.where("conv_id = 1")).collect()}
    assert levels[3, 0] == (2, 1) and levels[3, 1] == levels[3, 2] == (1, 2) and levels[3, 3] == (0, 3)
    assert quotes.format_chats(df.limit(0)).count() == 0


def test_sql_agrees(spark, tmp_path):
    import duckdb
    import random

    rnd = random.Random(1)
    said = ["One line", "Two  lines here", "three", "?!", "é a", ""]
    rows = [(c, t, "user", "\n".join(rnd.choice(["", "", "> ", ">> ", ">"]) + rnd.choice(said) for _ in range(rnd.randrange(5)))) for c in range(30) for t in range(rnd.randrange(9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/c/*.parquet')")
    want = con.execute(f"select conv_id, turn, role, content, n_quoted, parent_turn, quoted_turns, path from ({quotes.ORACLE})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in quotes.format_chats(df).collect())


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, 0, "u", "Hi you"), (1, 0, "u", "Hi you"), (1, 1, "u", "> Hi you")], "conv_id long, turn long, role string, text string")
    assert sorted((r.turn, r.parent_turn or 0) for r in quotes.format_chats(df).collect()) == [(0, 0), (0, 0), (1, 0)]


def test_a_passage_is_found_however_it_is_wrapped(spark):
    rows = [
        (1, 0, "The first point is that ships\nsail by night and by day.\n\nThanks"),
        (1, 1, "Another paragraph of the same thread.\n\nThanks"),
        (1, 2, "> The first point is\n> that ships sail by\n> NIGHT and by day.\n>\n> Thanks\nAgreed."),
        (1, 3, "> sail by night and by day.\nA part of it."),
        (2**40, 10**13, "One"),
        (2**40, 10**13 + 1, "> One\nTwo"),
        (2**40, 10**13 + 2, " ".join(["word"] * 200_000)),
        (2**40, 10**13 + 3, "\n".join("> " + " ".join(["word"] * 50) for _ in range(4000)) + "\nYes"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").selectExpr("*", "'u' as role")
    out = {(r.conv_id, r.turn): r for r in quotes.format_chats(df).collect()}
    # 14 words of the first message beside one word, "Thanks", whose latest message is the second
    assert out[1, 2].parent_turn == 0 and out[1, 2].quoted_turns == "0,1"
    assert out[1, 3].parent_turn == 0
    assert [out[2**40, 10**13 + i].parent_turn for i in range(4)] == [None, 10**13, None, 10**13 + 2]
    assert out[2**40, 10**13 + 1].path.endswith("/" + str(10**13 + 1).zfill(20))
