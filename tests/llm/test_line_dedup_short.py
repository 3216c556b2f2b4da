from helpers import docs
from postline.llm.line_dedup import dedup_lines


def test_lines_without_spaces_are_compared_by_characters(spark):
    chinese, japanese, thai = "今天的天气非常好我们一起去公园", "これは日本語の長い行です。", "นี่คือบรรทัดภาษาไทยที่ยาว"
    rows = [(1, f"{chinese}\n{japanese}\n𠀀𠀁𠀂𠀃𠀄𠀅𠀆𠀇"), (2, f"{chinese}\n{thai}\n短い"), (3, f"  {chinese.replace('好', '坏')}\n短い"),
            (4, f"{thai[:-1]}\n{chinese[:5]} {chinese[5:]}"), (5, f"{japanese[1:]}\nplain words here"), (6, "𠀀𠀁𠀂𠀃𠀄𠀅𠀆𠀈\nplain words here")]
    got = {r.doc_id: r.lines_gone for r in dedup_lines(docs(spark, rows), exact_words=8, count_col="lines_gone").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1}


def test_short_equal_lines_go_unless_left_alone(spark):
    rows = [(1, "Yes.\n\nIt is so."), (2, "Yes.\n\nit is so.\nIt  is so."), (3, "It is\nYes."), (3, "It is\nYes."),
            (4, "one two three four five six seven eight"), (5, "one two three four five six seven")]
    out = dedup_lines(docs(spark, rows), count_col="lines_gone").collect()
    assert sorted((r.doc_id, r.text) for r in out) == [
        (1, "Yes.\n\nIt is so."), (2, "\nit is so."), (3, "It is"), (3, "It is"), (4, rows[4][1]), (5, rows[5][1])]
    assert sum(r.lines_gone for r in dedup_lines(docs(spark, rows), exact_words=8, count_col="lines_gone").collect()) == 0
