import pytest
from pyspark.sql import functions as F

from frostline.llm.line_templates import without_templates

SCHEMA = "doc_id long, text string, tokens string, n_lines string"


def texts(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = without_templates(df)
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_recurring_lines_stay_in_the_first_document(spark):
    rows = [(1, "my own first line here\nShare this page with friends"), (2, "Share this page with friends\nsomething else entirely new"), (3, "Share this page with friends")]
    assert texts(spark, rows) == [(1, rows[0][1]), (2, "something else entirely new"), (3, "")]


def test_variable_fields_are_generalised(spark):
    names = ["anna", "bert", "cleo", "dora"]
    rows = [(i, f"Posted by the author {n} on monday morning\nunlike line number {'abcd'[i]} {n * 3} {n * 2} kind") for i, n in enumerate(names)]
    out = dict(texts(spark, rows))
    assert out[0] == rows[0][1]
    assert all("Posted" not in out[i] and "unlike" in out[i] for i in (1, 2, 3))


def test_numbers_are_fields(spark):
    rows = [(i, f"Page {i} of {i + 70} here\n{i} {i} {i}") for i in range(3)]
    out = dict(texts(spark, rows))
    assert out[0] == rows[0][1] and out[1] == "1 1 1" and out[2] == "2 2 2"


def test_alike_but_different_prose_stays(spark):
    rows = [(1, "it was a dark night and the rain fell hard"), (2, "it was a quiet day but no bird sang there")]
    assert texts(spark, rows) == rows


def test_hot_line_long_text_nulls_and_repeats(spark):
    hot = "This very line stands in every text"
    rows = [(i, f"{hot}\nown words of number {'x' * (i + 1)} y") for i in range(200)]
    rows += [(500, "\n".join(f"w{'a' * (k % 50)} q{'b' * (k // 50)} z" for k in range(3000)) + f"\n{hot}"), (501, None), (502, ""), (None, f"{hot}\nanonymous words are kept"), (7, rows[7][1])]
    out = texts(spark, rows)
    assert len(out) == len(rows)
    by_id = {}
    for i, t in out:
        by_id.setdefault(i, []).append(t)
    kept = [i for i, ts in by_id.items() if any(hot in (t or "") for t in ts)]
    assert len(kept) == 1
    assert by_id[501] == [None] and by_id[502] == [""]
    assert len(by_id[500][0].split("\n")) == 3000
    assert len(by_id[7]) == 2 and by_id[7][0] == by_id[7][1]


def test_one_document_may_repeat_itself(spark):
    text = "again and again and again\nagain and again and again"
    assert texts(spark, [(1, text), (1, text)]) == [(1, text), (1, text)]


def test_empty_table(spark):
    assert texts(spark, []) == []


def test_short_and_digit_lines_go_where_they_recur_as_they_are(spark):
    rows = [(1, "Les.\nAnd ornd.\n無断転載を禁じます。\n12 34 56\n\nkept 7"), (2, "Les.\nAnd  ornd.\n\n無断転載を禁じます。\n12 34 56\nkept 8\n12 34 57\nown")]
    assert texts(spark, rows) == [(1, rows[0][1]), (2, "\nkept 8\n12 34 57\nown")]


def test_counts_of_lines(spark):
    df = spark.createDataFrame([(i, "Les.\nthis line stands twice\n\nonly in " + "ab"[i - 1], "x", "y") for i in (1, 2)], SCHEMA)
    out = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in without_templates(df, counts=True).collect()}
    assert out == {1: ("Les.\nthis line stands twice\n\nonly in a", 4, 0), 2: ("\nonly in b", 4, 2)}


def test_a_line_of_a_million_characters(spark):
    long = "word " * 100_000 + "end" * 200_000
    assert texts(spark, [(1, long), (2, f"{long}\nown"), (3, "x" * 1_000_000)]) == [(1, long), (2, "own"), (3, "x" * 1_000_000)]


@pytest.mark.parametrize("n", [10, 100_000])
def test_fields_with_repeating_values_are_generalised(spark, n):
    def one_of(values, salt):
        return F.concat(F.lit(chr(97 + salt)), F.translate(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(values)).cast("string"), "0123456789", "klmnopqrst"))

    line = F.format_string("Posted by the author %s %s on this fine %s morning", one_of(50, 1), one_of(200, 2), one_of(7, 3))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(line, F.lit("\nunlike "), F.translate("id", "0123456789", "klmnopqrst")).alias("text"))
    out = without_templates(docs, counts=True)
    assert out.filter(F.contains("text", F.lit("Posted"))).select("doc_id").collect() == [(0,)]
    assert out.filter(~F.contains("text", F.lit("unlike"))).count() == 0
