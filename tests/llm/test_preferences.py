import pytest

from checks.compare import connect, difference, oracle_rows, spark_rows
from repopulse.llm import preferences
from repopulse.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "pair_id long, turn long, role string, text string, prompt string"


def frame(spark, *rows):
    return spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA)


def formatted(spark, chosen, rejected):
    rows = preferences.format_preferences(frame(spark, *chosen), frame(spark, *rejected)).collect()
    return {row.pair_id: row for row in rows}


def said(turns):
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)


def test_prefix_completions_and_spans(spark):
    shared = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi \U0001f600")]
    chosen = [*shared, (1, 2, "assistant", "Hello"), (1, 3, "user", "And?"), (1, 4, "assistant", "Bye")]
    row = formatted(spark, chosen, [*shared, (1, 2, "assistant", "")])[1]
    assert row.prompt == said([("system", "Be kind."), ("user", "Hi \U0001f600")])
    assert row.chosen == said([("assistant", "Hello"), ("user", "And?"), ("assistant", "Bye")])
    assert row.rejected == said([("assistant", "")])
    assert [row.chosen[s.start : s.stop] for s in row.chosen_spans] == ["Hello<|end|>\n", "Bye<|end|>\n"]
    assert [row.rejected[s.start : s.stop] for s in row.rejected_spans] == ["<|end|>\n"]
    assert (row.n_prompt_turns, row.n_chosen_turns, row.n_rejected_turns) == (2, 3, 1)


def test_one_side_equal_sides_and_nothing_shared(spark):
    turn = lambda pair, text: (pair, 0, "user", text)
    found = formatted(spark, [turn(1, "a"), turn(2, "b"), turn(3, "c")], [turn(2, "b"), turn(3, "d"), turn(4, "e")])
    assert (found[1].prompt, found[1].chosen, found[1].rejected) == ("", said([("user", "a")]), "")
    assert (found[2].prompt, found[2].chosen, found[2].rejected) == (said([("user", "b")]), "", "")
    assert (found[3].n_prompt_turns, found[3].rejected) == (0, said([("user", "d")]))
    assert (found[4].chosen, found[4].n_rejected_turns) == ("", 1)
    assert found[1].chosen_spans == [] and found[2].chosen_spans == []


def test_a_longer_conversation_shares_all_of_a_shorter_one(spark):
    first = (1, 0, "user", "a")
    row = formatted(spark, [first], [first, (1, 1, "assistant", "b")])[1]
    assert (row.n_prompt_turns, row.n_chosen_turns, row.n_rejected_turns) == (1, 0, 1)


def test_nulls_ties_and_repeated_rows(spark):
    chosen = [(1, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "a"), (1, 5, "user", "a"), (None, 0, "user", "x")]
    found = formatted(spark, chosen, [(None, 0, "user", "y")])
    assert list(found) == [1]
    assert found[1].chosen == said([("", ""), ("user", "a"), ("user", "a"), ("user", "b")])


def test_long_texts_and_empty_tables(spark):
    long = "word " * 200_000
    row = formatted(spark, [(1, 0, "user", long), (1, 1, "assistant", long)], [(1, 0, "user", long)])[1]
    assert row.prompt == said([("user", long)]) and row.chosen_spans[0].stop == len(row.chosen)
    empty = frame(spark, (1, 0, "user", "a")).where("false")
    assert preferences.format_preferences(empty, empty).count() == 0


def test_no_python_runs_and_one_shuffle_gathers_both(spark):
    chosen = frame(spark, (1, 0, "user", "a"))
    plan = preferences.format_preferences(chosen, chosen)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    plan = QUERIES["op5_preference_formatting"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_the_query_against_sql(spark, folder):
    ours = spark_rows(QUERIES["op5_preference_formatting"](spark, folder))
    sql = oracle_rows(connect(folder), ORACLE["op5_preference_formatting"])
    assert len(ours) and difference(ours, sql) is None
