"""Rules the build, the sinks and the scoring must keep: repeats, reports, missing parts."""

import pytest

from lectern import schemas
from lectern.build import ExamInputs, build_records
from lectern.functions import text as T
from lectern.operators import records as R
from lectern.operators import scoring as SC
from lectern.operators import tables as TB
from lectern.sources import readers, sinks
from support import one_col

DOCS = "doc_id string, subject string, year string, language string, kind string"
BLOCKS = "doc_id string, page_no int, block_no int, x0 double, y0 double, x1 double, y1 double, text string"


def small_exam(spark, docs):
    tests = [d for d in docs if d[4] == "test"]
    pages = spark.createDataFrame([(d, 1, "Часть А\nА1. question") for d in {t[0] for t in tests}], "doc_id string, page_no int, text string")
    blocks = spark.createDataFrame([(c[0], 1, 0, 141.0, 10.0, 0.0, 0.0, "А1. x\nОтвет: 3") for c in docs if c[4] == "consult"], BLOCKS)
    return build_records(spark, ExamInputs(spark.createDataFrame(docs, DOCS), pages, blocks), "c", materialize=False)


def test_repeated_exam_repeats_records_exactly(spark):
    docs = [("t", "phy", "2023", "rus", "test"), ("c", "phy", "2023", None, "consult")]
    for times in (1, 2, 3):
        assert [r.id for r in small_exam(spark, docs * times).records.collect()] == ["03-phy-2023-rus-A1"] * times


def test_unknown_subject_and_language_are_reported(spark):
    res = small_exam(spark, [("t", "xyz", "2023", "rus", "test"), ("c", "xyz", "2023", None, "consult"),
                             ("e", "phy", "2024", "eng", "test"), ("d", "phy", "2024", None, "consult")])
    assert res.records.count() == 0
    assert sorted((r.doc_id, r.problem) for r in res.problems.collect()) == [
        ("e", "Language 'eng' is not a valid language."), ("t", "Subject 'xyz' is not a valid subject code.")]
    with pytest.raises(ValueError, match="is not a valid"):
        R.raise_on_rejects(res.problems)


def test_missing_completions_score_zero_and_are_listed(spark):
    recs = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, target string, points int")
    comp = spark.createDataFrame([("a", "m", "ANSWER: x")], "id string, model string, completion string")
    got = {(r.id, r.model): r.value for r in SC.score(recs, comp, models=["m", "n"]).collect()}
    assert got == {("a", "m"): 1, ("b", "m"): 0, ("a", "n"): 0, ("b", "n"): 0}
    assert sorted(map(tuple, SC.missing_completions(recs, comp, ["m", "n"]).collect())) == [("a", "n"), ("b", "m"), ("b", "n")]
    assert SC.score(recs, comp).count() == 1


def test_punctuation_can_be_ignored(spark):
    recs = spark.createDataFrame([("a", "4", 1)], "id string, target string, points int")
    comp = spark.createDataFrame([("a", "m", "ANSWER: 4.")], "id string, model string, completion string")
    assert [SC.score(recs, comp, ignore_punctuation=p).first().value for p in (False, True)] == [0, 1]


def test_option_numbers_of_any_length_and_script(spark):
    text = "s 1) a; 100000000000000000002) b; 20000000000000000000) c; 0002) d; ٣) e;"
    (got,) = one_col(spark, [text], T.reorder_options)
    assert got.split("\n") == ["s", "1) a;", "0002) d;", "٣) e;", "20000000000000000000) c;", "100000000000000000002) b;"]


def test_separators_are_white_space(spark):
    assert one_col(spark, ["a\x1c\x1cb", "\x1da \x1f", "x\x1e"], T.clean_text) == ["a\x1cb", "a", "x"]


def test_csv_round_trip_and_fix_across_cells(spark):
    rows = [["a", "b,c"], ['say "x"', "line\nbreak"], ["", ""], [""]]
    df = spark.createDataFrame([(1, rows)], "table_no int, rows array<array<string>>")
    assert df.select(TB.csv_rows(TB.csv_text("rows")).alias("r")).first().r == rows
    t = spark.createDataFrame([(1, [["a", "b"], ["c", "d"]]), (2, [["a", "b"]])], "table_no int, rows array<array<string>>")
    fixes = spark.createDataFrame([(1, 1, "a,b", "a,X"), (1, 2, "X\nc", "Y\nZ,c")], "table_no int, seq int, `from` string, `to` string")
    assert {r.table_no: r.rows for r in TB.fix_tables(spark, t, fixes, ["table_no"]).collect()} == {
        1: [["a", "Y"], ["Z", "c", "d"]], 2: [["a", "b"]]}


def test_saving_an_exam_keeps_the_others(spark, tmp_path):
    cols = "doc_id string, subject string, year string, filename string, format string, content binary, size int"
    save = lambda *rows: (sinks.save_images(spark.createDataFrame(rows, cols), f"{tmp_path}/b"),
                          sinks.save_image_info(spark.createDataFrame(rows, cols), f"{tmp_path}/i"))
    save(("d1", "geo", "2023", "f", "png", b"1", 1), ("d1", "geo", "2023", "g", "png", b"1", 1))
    save(("d2", "geo", "2024", "f", "png", b"2", 1))
    save(("d1", "geo", "2023", "f", "png", b"33", 2))
    assert sorted((r.doc_id, r.filename, bytes(r.content)) for r in spark.read.parquet(f"{tmp_path}/b").collect()) == [
        ("d1", "f", b"33"), ("d2", "f", b"2")]
    assert sorted((r.doc_id, r.size) for r in spark.read.json(f"{tmp_path}/i").collect()) == [("d1", 2), ("d2", 1)]


@pytest.mark.parametrize("reader,schema", [("read_page_text", "PAGE_TEXT"), ("read_blocks", "BLOCKS"), ("read_images", "IMAGES"),
                                           ("read_table_cells", "TABLE_CELLS"), ("read_completions", "COMPLETIONS")])
def test_readers_apply_their_schema(spark, tmp_path, reader, schema):
    s = getattr(schemas, schema)
    value = {"string": "x", "int": 1, "double": 1.5, "binary": bytearray(b"z"), "bigint": 1}
    df = spark.createDataFrame([tuple(value[f.dataType.simpleString()] for f in s)], s)
    fmt = "json" if reader == "read_completions" else "parquet"
    df.write.format(fmt).save(f"{tmp_path}/t")
    back = getattr(readers, reader)(spark, f"{tmp_path}/t")
    assert [f.name for f in back.schema] == [f.name for f in s] and back.collect() == df.collect()
