"""Table operators: rows, Markdown, CSV, fixes, placement."""


from lectern.operators import tables as TB


def _rows(spark, rows):
    cells = [("d", 0, r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)]
    return TB.table_rows(spark.createDataFrame(cells, "doc_id string, table_no int, row_no int, col_no int, text string"))


def test_markdown_and_csv(spark):
    t = _rows(spark, [["h1", "h\n1) x"], ["a,b", ' q"uote '], [""]])
    md, csv = t.select(TB.markdown("rows"), TB.csv_text("rows")).first()
    assert md == '| h1 | h\n1) x |\n| --- | --- |\n| a,b | q"uote |\n|  |\n'
    assert csv == 'h1,"h\n1) x"\n"a,b","q""uote"\n""\n'


def test_fixes_in_order(spark):
    t = spark.createDataFrame([(3, "П ольшча С амай")], "table_no int, csv string")
    fx = spark.createDataFrame([(3, 2, "Польшча", "X"), (3, 1, "П ольшча", "Польшча")],
                               "table_no int, seq int, `from` string, `to` string")
    assert TB.apply_fixes(spark, t, fx, ["table_no"]).first().csv == "X С амай"


def test_placement_fixture(spark):
    qs = spark.createDataFrame(
        [("d", 0, 1, "А", "A1", "x H1 a T1 y"), ("d", 0, 2, "А", "A2", "H1 q T1 H1 q T1"),
         ("d", 0, 3, "А", "A3", "H2 zz T2"), ("d", 0, 4, "А", "A4", "H5 T5 u H5 T5"),
         ("e", 0, 1, "А", "E1", "ab H c")],
        "doc_id string, section_order int, pos bigint, section string, question_id string, text string")
    tabs = spark.createDataFrame(
        [("d", 1, [["H1", "x"], ["y", "T1"]]), ("d", 2, [["H1"], ["T1"]]), ("d", 3, [["H2"], ["T2"]]),
         ("d", 4, [["no"], ["T"]]), ("d", 5, [["H5"], ["T5"]]), ("e", 1, [["H"], [""]])],
        "doc_id string, table_no int, rows array<array<string>>")
    placed, unplaced = TB.place_tables(qs, tabs)
    got = {r.question_id: r.text for r in placed.collect()}
    m1 = "| H1 | x |\n| --- | --- |\n| y | T1 |\n"
    m2 = "| H1 |\n| --- |\n| T1 |\n"
    # the second table has the same anchors; the first table's Markdown holds
    # them too, so it lands in A1 again, inside the first table
    assert got["A1"] == "x | " + m2 + " |\n y" and m1.startswith("| H1")
    assert got["A2"] == "H1 q T1 H1 q T1"
    assert got["A3"] == "| H2 |\n| --- |\n| T2 |\n"
    assert got["A4"] == "| H5 |\n| --- |\n| T5 |\n u | H5 |\n| --- |\n| T5 |\n"
    assert got["E1"] == "ab | H |\n| --- |\n|  |\n c"
    assert [(r.doc_id, r.table_no) for r in unplaced.collect()] == [("d", 4)]
