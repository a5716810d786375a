from tallybrook.llm import quoting

SCHEMA = "conv_id long, turn long, role string, text string, body string, c string, t string"


def run(spark, rows):
    df = spark.createDataFrame([(c, t, "user", x, "x", "y", "z") for c, t, x in rows], SCHEMA)
    out = quoting.linked(df)
    assert out.columns == [*df.columns, "n_quotes", "n_linked", "parent_turn", "thread_turn"]
    rows = out.collect()
    assert len(rows) == df.count()
    return rows


def test_quotes_lead_to_what_they_answer(spark):
    first = "The first message says a lot.\nIt has two lines."
    second = "Another opinion that stands by itself."
    reply = "> The first message says a lot.\n> It has two lines.\nI agree with all of it."
    nested = (
        "On Monday someone wrote:\n> > the FIRST message, says a lot. It has\n>> two lines\n"
        "> I agree with all of it.\n\nSo do I, as it happens."
    )
    partly = "> It has two lines.\nOnly the second one."
    rows = run(spark, [(1, 0, first), (1, 1, second), (1, 2, reply), (1, 3, nested), (1, 4, partly), (2, 9, reply)])
    got = {(r["conv_id"], r["turn"]): r for r in rows}
    assert got[1, 2]["text"] == "I agree with all of it."
    assert got[1, 3]["text"] == "So do I, as it happens."
    assert [got[1, t]["parent_turn"] for t in range(5)] == [None, None, 0, 2, 0]
    assert [got[1, t]["thread_turn"] for t in range(5)] == [0, 1, 0, 0, 0]
    assert [got[1, t]["n_quotes"] for t in range(5)] == [0, 0, 1, 2, 1]
    assert got[2, 9]["parent_turn"] is None and got[2, 9]["n_linked"] == 0
    order = [(r["conv_id"], r["turn"]) for r in rows]
    assert order == [(1, 0), (1, 2), (1, 3), (1, 4), (1, 1), (2, 9)]


def test_a_quote_leads_to_the_first_who_wrote_it(spark):
    said = "Something that is said again and again."
    rows = run(spark, [(1, t, said) for t in range(5)] + [(1, 5, f"> {said}\nIndeed.")])
    assert {r["turn"]: r["parent_turn"] for r in rows}[5] == 0


def test_later_messages_are_not_answered(spark):
    rows = run(spark, [(1, 0, "> Words that come only later on."), (1, 1, "Words that come only later on.")])
    assert all(r["parent_turn"] is None for r in rows)


def test_short_passages_link_too(spark):
    said = ["Is it ready?", "Thanks.", "好的"]
    rows = run(spark, [(1, t, x) for t, x in enumerate(said)] + [(1, 5 + t, f"> {x}\nYes.") for t, x in enumerate(said)])
    assert {r["turn"]: r["parent_turn"] for r in rows if r["turn"] >= 5} == {5: 0, 6: 1, 7: 2}


def test_single_lines_of_passages_link_if_long_enough(spark):
    quote = "> Words of somebody else here.\n> Thanks.\nWell."
    rows = run(spark, [(1, 0, "Thanks."), (1, 1, "Words of somebody else here."), (1, 2, quote)])
    last = next(r for r in rows if r["turn"] == 2)
    assert last["parent_turn"] == 1 and last["n_linked"] == 1


def test_awkward_rows(spark):
    long = "\n".join(f"> line number {i} of a long quote" for i in range(3000)) + "\nEnd."
    rows = run(
        spark,
        [(1, 0, None), (1, 1, ""), (1, 2, long), (1, 2, long), (None, 3, "> quoted words of someone\nx"),
         (1, None, "> quoted words of someone\ny"), (None, None, None), (3, 0, ">"), (3, 1, "> > >\n>")],
    )
    assert sorted(r["text"] for r in rows) == ["", "", "", "", "", "End.", "End.", "x", "y"]
    assert all(r["parent_turn"] is None for r in rows)


def test_no_rows(spark):
    assert quoting.linked(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_conversation_with_very_many_copies(spark):
    said = "The line that everybody quotes here."
    rows = [(1, 0, said)] + [(1, t, f"> {said}\nReply number {t} to it.") for t in range(1, 400)]
    got = run(spark, rows)
    assert sum(r["parent_turn"] == 0 for r in got) == 399
    assert {r["thread_turn"] for r in got} == {0}


def test_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, 0, "u", "a long enough line", "", "", "")], SCHEMA)
    assert "Python" not in quoting.linked(df)._jdf.queryExecution().executedPlan().toString()
