"""CSV / JSON reading rules, safe rewrite of the file that was read."""
import json
import os

import pandas as pd
import pytest
from pyspark.sql import types as T

from tessera.session import local_path, scratch_dir
from tessera.sources import staging
from tessera.sources import text_tables as tt

CSV = ('"ID товара",name,when,n\n'
       '1,"two\nlines",2024-01-02,NA\n'
       '2,"say ""hi""",2024-01-03,\n'
       '3,"",2024-01-04,7\n')


def _write(spark, text):
    d = local_path(scratch_dir(spark, "csvin"))
    os.makedirs(d)
    with open(os.path.join(d, "data.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return d


def test_csv_edge_cases_match_pandas(spark):
    d = _write(spark, CSV)
    df = tt.read_csv(spark, d)
    pdf = pd.read_csv(os.path.join(d, "data.csv"))
    assert df.columns == list(pdf.columns)
    assert dict(df.dtypes) == {"ID товара": "bigint", "name": "string", "when": "string",
                               "n": "bigint"}
    rows = sorted(df.collect(), key=lambda r: r[0])
    assert [r["name"] for r in rows] == ["two\nlines", 'say "hi"', None]
    assert [r["n"] for r in rows] == [None, None, 7]
    assert [r["name"] if isinstance(r["name"], str) else None for _, r in pdf.iterrows()] == \
        ["two\nlines", 'say "hi"', None]


def test_rewrite_in_place_is_safe(spark):
    d = _write(spark, CSV)
    df = tt.read_csv(spark, d)
    tt.write_csv(df, d)                       # the path the frame reads from
    back = tt.read_csv(spark, d, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        sorted(map(tuple, tt.read_csv(spark, d, schema=df.schema).collect()), key=lambda r: r[0])
    assert back.count() == 3
    assert sorted(r[0] for r in back.collect()) == [1, 2, 3]


def test_json_columns_layout_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, 1e-05), (3, "c", 12345678.9)],
                               "k bigint, s string, x double")
    d = scratch_dir(spark, "jc")
    tt.write_json(df.repartition(2), d, orient="columns", double_precision=15)
    back = tt.read_json(spark, d, orient="columns", schema=df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    # a single pandas-written file reads the same way
    single = local_path(scratch_dir(spark, "jcp"))
    os.makedirs(single)
    df.toPandas().to_json(os.path.join(single, "data.json"))
    inferred = tt.read_json(spark, single)
    assert dict(inferred.dtypes) == {"k": "bigint", "s": "string", "x": "double"}
    assert sorted(map(tuple, inferred.select("k", "s", "x").collect())) == \
        sorted(map(tuple, df.collect()))


def test_json_lines_and_records(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, s string")
    d = scratch_dir(spark, "jl")
    tt.write_json(df, d)
    assert tt.read_json(spark, d, orient="lines", schema=df.schema).collect() == df.collect()
    rec = local_path(scratch_dir(spark, "jr"))
    os.makedirs(rec)
    with open(os.path.join(rec, "r.json"), "w") as f:
        f.write('[{"k": 1, "s": "a"}, {"k": 2, "s": "b"}]')
    assert tt.read_json(spark, rec, orient="records").count() == 2


def test_infer_types_all_null_column(spark):
    df = spark.createDataFrame([(None,), ("",)], T.StructType([T.StructField("c", T.StringType())]))
    assert tt.infer_types(tt.na_to_null(df))["c"].dataType == T.StringType()


def _shared_strings_workbook(path):
    """A minimal workbook as spreadsheet programs write it: shared strings,
    a named sheet that is not the first, a missing cell, a boolean."""
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("xl/workbook.xml",
                   f'<workbook {ns} xmlns:r="{rel}"><sheets>'
                   '<sheet name="Other" sheetId="1" r:id="rId1"/>'
                   '<sheet name="Sheet1" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Type="x" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst {ns}><si><t>name</t></si><si><t>qty</t></si><si><t>ok</t></si>'
                   '<si><r><t>Ali</t></r><r><t>ce</t></r></si><si><t>Bob</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml",
                   f'<worksheet {ns}><sheetData>'
                   '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
                   '<c r="C1" t="s"><v>2</v></c></row>'
                   '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2"><v>3</v></c>'
                   '<c r="C2" t="b"><v>1</v></c></row>'
                   '<row r="3"><c r="A3" t="s"><v>4</v></c><c r="C3" t="b"><v>0</v></c></row>'
                   '</sheetData></worksheet>')


def test_xlsx_reads_shared_strings_and_named_sheet(spark):
    from tessera.sources import workbooks
    d = local_path(scratch_dir(spark, "wb"))
    os.makedirs(d)
    _shared_strings_workbook(os.path.join(d, "book.xlsx"))
    df = workbooks.read_xlsx(spark, d, sheet_name="Sheet1")
    assert dict(df.dtypes) == {"name": "string", "qty": "bigint", "ok": "boolean"}
    assert sorted(map(tuple, df.collect())) == [("Alice", 3, True), ("Bob", None, False)]


def test_xlsx_cells_without_references_and_phonetic_runs(spark):
    import zipfile

    from tessera.sources import workbooks
    d = local_path(scratch_dir(spark, "wbr"))
    os.makedirs(d)
    path = os.path.join(d, "book.xlsx")
    _shared_strings_workbook(path)
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    for place in ("A1", "B1", "C1", "A2", "B2", "C2", "A3"):      # C3 stays: its row has a gap
        parts["xl/worksheets/sheet2.xml"] = parts["xl/worksheets/sheet2.xml"].replace(f' r="{place}"', "")
    for row in "12":
        parts["xl/worksheets/sheet2.xml"] = parts["xl/worksheets/sheet2.xml"].replace(f'<row r="{row}">', "<row>")
    parts["xl/sharedStrings.xml"] = parts["xl/sharedStrings.xml"].replace(
        "<si><t>Bob</t></si>", '<si><t>B_x000D_ob</t><rPh sb="0" eb="1"><t>bee</t></rPh></si>')
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    got = sorted(map(tuple, workbooks.read_xlsx(spark, d, sheet_name="Sheet1").collect()))
    assert got == [("Alice", 3, True), ("B\rob", None, False)]


def test_xlsx_write_splits_large_partitions(spark):
    from tessera.sources import workbooks
    df = spark.range(0, 25).selectExpr("id", "cast(id as string) as s", "id % 2 = 0 as even")
    d = scratch_dir(spark, "wbw")
    workbooks.write_xlsx(df.coalesce(1), d, rows_per_book=10)
    files = [f for f in os.listdir(local_path(d)) if f.endswith(".xlsx")]
    assert len(files) == 3
    back = workbooks.read_xlsx(spark, d, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_xlsx_dates_decimals_nulls_and_big_numbers(spark):
    from datetime import date, datetime
    from decimal import Decimal

    from tessera.sources import workbooks
    rows = [(1, date(2024, 2, 29), datetime(2024, 2, 29, 23, 59, 59, 999999), Decimal("12.30"), 9007199254740993),
            (2, date(1900, 3, 1), datetime(1970, 1, 1, 0, 0, 0, 1), Decimal("-0.01"), None),
            (3, None, datetime(2038, 1, 19, 3, 14, 7), None, -1),
            (4, date(1899, 5, 6), datetime(1850, 1, 2, 3, 4, 5), Decimal("0.00"), 0)]
    df = spark.createDataFrame(rows, "id long, d date, t timestamp, m decimal(10,2), n long")
    d = scratch_dir(spark, "wbd")
    workbooks.write_xlsx(df, d)
    assert sorted(map(tuple, workbooks.read_xlsx(spark, d, schema=df.schema).collect())) == rows
    workbooks.write_xlsx(df.filter("id < 4"), d)
    back = workbooks.read_xlsx(spark, d)
    assert dict(back.dtypes) == {"id": "bigint", "d": "timestamp", "t": "timestamp", "m": "double", "n": "bigint"}
    assert back.filter("id = 1").first()["d"] == datetime(2024, 2, 29)


def test_xlsx_empty_table_keeps_its_header(spark):
    from tessera.sources import workbooks
    df = spark.createDataFrame([], "a long, b string")
    d = scratch_dir(spark, "wbe")
    workbooks.write_xlsx(df, d)
    back = workbooks.read_xlsx(spark, d)
    assert back.columns == ["a", "b"] and back.count() == 0
    assert [f for f in os.listdir(local_path(d)) if f.endswith(".xlsx")]


def test_xlsx_rows_are_zipped_and_read_one_at_a_time():
    import tracemalloc

    from tessera.sources import workbooks
    n = 40_000
    tracemalloc.start()
    book = workbooks.workbook_bytes(["id", "s", "t"], ((i, f"name {i}", "x" * 80) for i in range(n)))
    written = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    rows = sum(1 for _ in workbooks.sheet_rows(book))
    read = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n + 1
    assert written < 3 * len(book) + 2_000_000 and read < len(book) + 2_000_000


def test_xlsx_books_end_at_their_size_and_lose_no_row(spark, monkeypatch):
    from tessera.sources import workbooks
    monkeypatch.setattr(workbooks, "SHEET_BYTES", 1_000)
    book = workbooks.Workbook(["id"])
    for i in range(100):
        assert not book.full()
        book.add((i,))
        if book.full():
            break
    assert [r[1] for r in workbooks.sheet_rows(book.content())] == [["id"], *[[str(k)] for k in range(i + 1)]]
    df = spark.range(0, 1000, 1, 2).selectExpr("id", "cast(id as string) as s")
    d = scratch_dir(spark, "wbz")
    workbooks.write_xlsx(df, d)
    assert sorted(map(tuple, workbooks.read_xlsx(spark, d, schema=df.schema).collect())) == [
        (i, str(i)) for i in range(1000)]


def test_xlsx_cells_right_of_the_header_are_kept(spark):
    from tessera.sources import workbooks
    d = local_path(scratch_dir(spark, "wbx"))
    os.makedirs(d)
    book = workbooks.workbook_bytes(["a", None], [(1, "more"), (2, None)])
    assert book.endswith(b"\n")
    with open(os.path.join(d, "b.xlsx"), "wb") as f:
        f.write(book)
    back = workbooks.read_xlsx(spark, d)
    assert back.columns == ["a", "Unnamed: 1"]
    assert sorted(map(tuple, back.collect())) == [(1, "more"), (2, None)]


def test_scratch_folders_go_when_the_application_ends(spark):
    d = scratch_dir(spark, "gone")
    spark.range(3).write.parquet(d)
    parent = os.path.dirname(d)
    assert os.path.isdir(local_path(parent))
    fs, p = staging._fs(spark, parent)
    assert fs.cancelDeleteOnExit(p)
    fs.deleteOnExit(p)


def test_png_folder_and_gray(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tessera.sources import images
    px = [10, 20, 60, 0, 30, 30, 30, 255]       # 1 x 2 pixels, RGBA
    df = spark.createDataFrame([("img-1", px)], "name string, px array<int>")
    d = scratch_dir(spark, "img")
    images.write_pngs(df, d, "name", "px", width=2, channels=4)
    img = images.read_images(spark, d)
    r = img.select("image.height", "image.width", "image.nChannels",
                   images.gray("image").alias("g")).first()
    assert (r["height"], r["width"], r["nChannels"]) == (1, 2, 4)
    assert r["g"] == [np.mean([10, 20, 60, 0]), np.mean([30, 30, 30, 255])]
    assert img.select(F.col("image.origin")).first()[0].endswith("img-1.png")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_text = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc"), whitelist_characters='\n",;'),
                min_size=1, max_size=12).filter(lambda t: t.strip() == t and t not in tt.NA_VALUES)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), _text,
                          st.floats(min_value=-1e300, max_value=1e300, width=64)),
                min_size=1, max_size=20))
def test_csv_and_json_roundtrip_property(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, s string, x double")
    for kind in ("csv", "json", "jsoncols"):
        d = scratch_dir(spark, kind)
        if kind == "csv":
            tt.write_csv(df, d)
            back = tt.read_csv(spark, d, schema=df.schema)
        elif kind == "json":
            tt.write_json(df, d)
            back = tt.read_json(spark, d, orient="lines", schema=df.schema)
        else:
            tt.write_json(df, d, orient="columns", double_precision=15)
            back = tt.read_json(spark, d, orient="columns", schema=df.schema)
        got = sorted(map(tuple, back.collect()), key=repr)
        exp = sorted(map(tuple, df.collect()), key=repr)
        if kind == "jsoncols":   # pandas writes 15 significant digits
            assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in exp]
            assert all(abs(g[2] - e[2]) <= 1e-14 * max(1.0, abs(e[2])) for g, e in zip(got, exp))
        else:
            assert got == exp


def test_json_columns_of_two_files_keep_all_rows(spark, tmp_path):
    import pandas as pd
    for i in range(2):
        pd.DataFrame({"a": [i, 2, 3], "s": ["None", "NA", ""]}).to_json(tmp_path / f"{i}.json")
    rows = tt.read_json(spark, str(tmp_path)).collect()
    assert len(rows) == 6 and sorted(r["s"] for r in rows) == ["", "", "NA", "NA", "None", "None"]


def test_csv_keeps_codes_and_spaces(spark, tmp_path):
    frame = spark.createDataFrame([("1d", "  a ", 1), ("2f", "b", 2)], "code string, s string, n int")
    path = tt.write_csv(frame, str(tmp_path / "out"))
    rows = sorted(map(tuple, tt.read_csv(spark, path).collect()))
    assert rows == [("1d", "  a ", 1), ("2f", "b", 2)]


def test_json_keeps_nullable_integers_and_null_columns(spark, tmp_path):
    frame = spark.createDataFrame([(9007199254740993, None, "x"), (None, None, "y")], "n long, e string, s string")
    path = tt.write_json(frame, str(tmp_path / "c"), orient="columns")
    back = tt.read_json(spark, path, schema=frame.schema).collect()
    assert {r["s"]: r["n"] for r in back} == {"x": 9007199254740993, "y": None}
    path = tt.write_json(frame, str(tmp_path / "l"))
    assert "e" in spark.read.json(path).columns


def test_json_columns_are_zipped_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "columns")
    os.makedirs(path)
    aligned = {"b": {"0": 1, "1": None, "2": 3}, "a x": {"0": "p", "1": "q", "2": None}}
    ragged = {"b": {"0": 7, "10": 9}, "a x": {"2": "r", "0": "s"}}
    for name, table in (("1.json", aligned), ("2.json", ragged), ("3.json", {"b": {"5": 11}}), ("4.json", {})):
        with open(os.path.join(path, name), "w") as f:
            json.dump(table, f)
    df = tt.read_json(spark, path)
    assert df.columns == ["b", "a x"] and dict(df.dtypes)["b"] == "bigint"
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted([(1, "p"), (None, "q"), (3, None), (7, "s"), (None, "r"), (9, None), (11, None)], key=str)


def test_ragged_json_columns_come_in_key_order(spark, tmp_path):
    path = str(tmp_path / "one")
    os.makedirs(path)
    with open(os.path.join(path, "x.json"), "w") as f:
        json.dump({"u": {"10": 1, "2": 2}, "v": {"1": 3, "10": 4}}, f)
    assert [tuple(r) for r in tt.read_json(spark, path).collect()] == [(None, 3), (2, None), (1, 4)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_breaks_across_split_borders(spark, tmp_path, end):
    import random
    r = random.Random(4)
    parts = ['say ""hi""', "a, b", "line\nbreak", "two" + end + "lines", "\n\n", "plain", "é\nü" * 40, "x" * 300, 'q""\n""q']
    for name, rows in (("one.csv", 400), ("two.csv", 3)):
        with open(tmp_path / name, "w", newline="") as f:
            f.write(f'id,"text{end}of row",n{end}')
            for i in range(rows):
                f.write(f'{i},"{"".join(r.choice(parts) for _ in range(r.randrange(4)))}",{r.choice(["", "NA", "7"])}{end}')
    pdf = pd.concat([pd.read_csv(tmp_path / n) for n in ("one.csv", "two.csv")])
    name = pdf.columns[1]
    want = sorted(((int(i), None if pd.isna(t) else t, None if pd.isna(n) else 7)
                   for i, t, n in zip(pdf["id"], pdf[name], pdf["n"])), key=str)
    if end == "\n":  # the reader of whole files says the same
        assert sorted((tuple(x) for x in tt.read_csv(spark, str(tmp_path)).collect()), key=str) == want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("997b", "311b", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = tt.read_csv(spark, str(tmp_path), multiline="split")
            assert got.dtypes == [("id", "bigint"), (name, "string"), ("n", "bigint")]
            assert sorted((tuple(x) for x in got.collect()), key=str) == want
            if size == "997b":
                assert got.rdd.getNumPartitions() > 20  # many tasks a file
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
