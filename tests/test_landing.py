import json

import pytest

from prodmart.operators.keyed import first_wins
from prodmart.schema import COLUMNS, ORDER_COLUMNS, conform
from prodmart.sources.landing import NA_VALUES, header_catalogue, page_fields, read_extract_csv, read_pages, union_batches
from prodmart.sources.tables import write_csv


def landing(tmp_path, pages):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    for name, body in pages.items():
        text = body if isinstance(body, str) else json.dumps(body, indent=1, ensure_ascii=False)
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


PRODUCT = {
    "code": "00123", "product_name": "Crème", "brands_tags": ["nestlé waters", "l'eau"], "countries_tags": [],
    "nutriments": {"fat_100g": 1.50, "energy-kcal_100g": "250"}, "nutrient_levels": {"fat": "low"},
    "completeness": 1.25, "created_t": 1600000000, "ingredients_n": "3", "unknown_field": {"x": 1}, "lang": None,
}


@pytest.fixture
def pages(tmp_path):
    return landing(
        tmp_path,
        {
            "page_1.json": {"products": [PRODUCT, {"code": "2", "product_name": "b"}], "count": 2},
            "page_2.json": {"count": 0},
            "page_3.json": "<html>502 Bad Gateway</html>",
            "page_10.json": {"products": [{"code": "3", "product_name": "", "lang": "NA"}]},
            "page_11.json": {"products": []},
        },
    )


def test_read_pages(spark, pages):
    rows, quarantine = read_pages(spark, pages)
    assert rows.columns == [*ORDER_COLUMNS, *COLUMNS]
    got = {r["code"]: r for r in rows.collect()}
    assert {c: (r["page_no"], r["pos"]) for c, r in got.items()} == {"00123": (1, 0), "2": (1, 1), "3": (10, 0)}
    first = got["00123"]
    assert json.loads(first["brands_tags"]) == ["nestlé waters", "l'eau"]
    assert first["countries_tags"] == "[]"
    assert (first["completeness"], first["created_t"], first["ingredients_n"]) == (1.25, 1600000000, 3.0)
    assert first["lang"] is None and got["3"]["product_name"] is None
    assert got["3"]["lang"] == "NA"
    renamed = read_pages(spark, pages, na_values=NA_VALUES)[0]
    assert renamed.where("code = '3'").first()["lang"] is None
    bad = quarantine.collect()
    assert len(bad) == 1 and "502" in bad[0]["body"] and bad[0]["file_path"].endswith("page_3.json")


def test_pages_are_read_once(spark, tmp_path):
    """Numbers and objects that become text are copied from memory, with all their digits and blanks."""
    record = '{"code": %d, "nova_group": 1.50e0, "completeness": 0.10, "nutriments": {"fat_100g": 1.50, "b": [1 ,2]}, "url": 7.0}'
    for number in range(4):
        records = ",\n".join(record % i for i in range(500))
        (tmp_path / f"page_{number}.json").write_text('{"products":\n[' + records + "]}\n")

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    rows = read_pages(spark, str(tmp_path))[0].collect()
    assert bytes_read() - before < 3 * sum(f.stat().st_size for f in tmp_path.iterdir())
    assert len(rows) == 2000
    assert {(r["nova_group"], r["nutriments"], r["url"]) for r in rows} == {(1.5, '{"fat_100g": 1.50, "b": [1 ,2]}', "7.0")}


def test_page_fields_and_strict(spark, pages):
    fields = {r["field"]: r["n_records"] for r in page_fields(spark, pages).collect()}
    assert fields["code"] == 3 and fields["product_name"] == 3 and fields["unknown_field"] == 1
    with pytest.raises(ValueError, match="generic_name"):
        read_pages(spark, pages, strict=True)


def test_csv_keeps_codes_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "extract.csv")
    body = (
        'code,product_name,extra,nova_group,created_t,brands_tags\n'
        '00123,"say ""hi""\nthere",x,4.0,1600000000.0,"[\'a\', \'b\']"\n'
        'nan,NA,y,,bad,[]\n'
    )
    (tmp_path / "extract.csv").write_text(body)
    df = read_extract_csv(spark, path)
    assert df.columns == ORDER_COLUMNS + COLUMNS
    first, second = df.select("code", "product_name", "nova_group", "created_t", "brands_tags", "url").collect()
    assert tuple(first) == ("00123", 'say "hi"\nthere', 4.0, 1600000000, "['a', 'b']", None)
    assert tuple(second) == ("nan", "NA", None, None, "[]", None)
    cleaned = read_extract_csv(spark, path, na_values=["nan", "NA"]).collect()[1]
    assert cleaned["code"] is None and cleaned["product_name"] is None
    with pytest.raises(ValueError, match="generic_name"):
        read_extract_csv(spark, path, strict=True)


def test_csv_round_trip(spark, tmp_path):
    rows = [("01", 'a "b", c', "['x', \"l'eau\"]", 1.5, 5), ("02", "  line\nbreak ", None, None, None)]
    df = conform(
        spark.createDataFrame(rows, "code string, product_name string, brands_tags string, nova_group double, created_t long"),
        COLUMNS,
    )
    write_csv(df, str(tmp_path / "out"))
    back = read_extract_csv(spark, str(tmp_path / "out")).select(*COLUMNS)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_csv_files_hold_few_rows(spark, tmp_path):
    """One task's rows go to several files, which are read in the order they were written."""
    df = spark.range(0, 250, 1, 1).selectExpr("CAST(id % 50 AS STRING) AS code", "CONCAT('line\n', id) AS product_name")
    write_csv(conform(df, COLUMNS), str(tmp_path / "out"), rows_per_file=20)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 13
    rows = read_extract_csv(spark, str(tmp_path / "out"))
    assert rows.count() == 250
    won = first_wins(rows, ["code"], ORDER_COLUMNS).select("code", "product_name").collect()
    assert len(won) == 50 and all(r["product_name"] == f"line\n{r['code']}" for r in won)


def test_conform_strict(spark):
    df = spark.createDataFrame([("1",)], "code string")
    assert conform(df, ["code", "nova_group"]).dtypes == [("code", "string"), ("nova_group", "double")]
    with pytest.raises(ValueError, match="nova_group"):
        conform(df, ["code", "nova_group"], strict=True)


def test_union_batches(spark):
    a = spark.createDataFrame([("1", "x")], "code string, lang string")
    b = spark.createDataFrame([("2", 3.0)], "code string, nova_group double")
    assert sorted(map(tuple, union_batches(a, b).collect())) == [("1", "x", None), ("2", None, 3.0)]


def test_reading_order_of_pages_in_several_folders(spark, tmp_path):
    names = ["d2/page_1.json", "d1/page_10.json", "d1/page_2.json", "d10/page_1.json", "d1/page_1_of_10.json", "d1/rest.json"]
    for name in names:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        body = {"products": [{"code": c, "product_name": name} for c in (name, "same", "same")]}
        (tmp_path / name).write_text(json.dumps(body))
    rows = read_pages(spark, f"{tmp_path}/*")[0]
    read = [r["product_name"] for r in rows.orderBy(*ORDER_COLUMNS).where("code != 'same'").collect()]
    assert read == ["d1/page_1_of_10.json", "d1/page_2.json", "d1/page_10.json", "d1/rest.json", "d2/page_1.json", "d10/page_1.json"]
    assert rows.groupBy(*ORDER_COLUMNS).count().where("count > 1").isEmpty()
    numbers = {r["code"]: r["page_no"] for r in rows.collect()}
    assert (numbers["d1/page_1_of_10.json"], numbers["d1/page_10.json"], numbers["d1/rest.json"]) == (1, 10, None)
    won = first_wins(rows, ["code"], ORDER_COLUMNS).where("code = 'same'").first()
    assert (won["product_name"], won["pos"]) == ("d1/page_1_of_10.json", 1)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_rows_of_the_first_file_win(spark, tmp_path, conf, multi_line):
    conf("spark.sql.files.maxPartitionBytes", "20000")  # several splits per file, the larger file scheduled first
    for name, n in (("extract_2.csv", 5000), ("extract_10.csv", 20_000)):
        lines = [f"{i % 5000},{name} {i}" for i in range(n)]
        (tmp_path / name).write_text("code,product_name\n" + "\n".join(lines) + "\n")
    rows = read_extract_csv(spark, str(tmp_path), multi_line=multi_line)
    won = first_wins(rows, ["code"], ORDER_COLUMNS).select("code", "product_name").collect()
    assert len(won) == 5000 and all(r["product_name"] == f"extract_2.csv {r['code']}" for r in won)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_files_with_different_headers(spark, tmp_path, multi_line):
    """Order and number of columns differ by file, as do quoting, repeated names, a byte order mark and odd file names."""
    files = {
        "a 1.csv": "code,product_name,lang\n1,one,en\n2,two,fr\n",
        "b[2].csv": "lang,extra,product_name,more,code\nde,x,three,y,3\n",
        "c{3}.csv": '\ufeff"code","na""me","product_name"\n4,x,"four, 4"\n',
        "d*.csv": "product_name,code,code,brands\nfive,5,other,b\n",
        "e.csv": "other,columns\nx,y\n",
        "f.csv": "",
        "g.csv": "code,product_name",
        "h.csv": "code,product_name,lang\n6,six\n7,seven,it,beyond\n",
    }
    for name, body in files.items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    found = header_catalogue(spark, str(tmp_path))
    assert sorted(len(f) for f in found.values()) == [1, 1, 1, 1, 1, 1, 2] and ("code", 'na"me', "product_name") in found
    rows = read_extract_csv(spark, str(tmp_path), multi_line=multi_line)
    assert rows.columns == ORDER_COLUMNS + COLUMNS
    got = sorted((r["code"] or "", r["product_name"], r["lang"], r["brands"]) for r in rows.collect())
    assert got == [
        ("", None, None, None), ("1", "one", "en", None), ("2", "two", "fr", None), ("3", "three", "de", None),
        ("4", "four, 4", None, None), ("5", "five", None, "b"), ("6", "six", None, None), ("7", "seven", "it", None),
    ]
    with pytest.raises(ValueError, match="input lacks columns"):
        read_extract_csv(spark, str(tmp_path), strict=True)


def test_csv_headers_of_any_length(spark, tmp_path):
    """A header longer than the first look, with a line break in a quoted name."""
    names = [f"column_{i}" for i in range(20_000)] + ["two\nlines", "code"]
    body = ",".join(f'"{n}"' for n in names) + "\n" + ",".join("x" for _ in names[:-1]) + ",42\n"
    (tmp_path / "wide.csv").write_text(body)
    assert list(header_catalogue(spark, str(tmp_path))) == [tuple(names)]
    (tmp_path / "wide.csv").unlink()
    (tmp_path / "empty.csv").write_text("")
    assert read_extract_csv(spark, str(tmp_path)).count() == 0


def test_csv_columns_named_by_folders(spark, tmp_path):
    for lang in ("en", "fr"):
        (tmp_path / f"lang={lang}").mkdir()
        (tmp_path / f"lang={lang}" / "x.csv").write_text(f"code,product_name\n{lang}1,n\n")
    got = sorted((r["code"], r["lang"]) for r in read_extract_csv(spark, str(tmp_path)).collect())
    assert got == [("en1", "en"), ("fr1", "fr")]
