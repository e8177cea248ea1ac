"""Sources, ingest, preparation, sampling."""

import csv
import io
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cataloom import schemas
from cataloom.functions import csvtext, jsontext
from cataloom.functions.text import has_text, shrink_sample_csv
from cataloom.operators import ingest, prepare, sampling
from cataloom.sources import landed, qrels, stages
from cataloom.sources.csv_heads import CHUNK, SPECIAL, CsvHeads, head


def values(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column, **data):
    """The value of an expression over one row of strings."""
    names = ", ".join(f"{k} string" for k in data)
    return spark.createDataFrame([tuple(data.values())], names).select(column).first()[0]


def test_pages_stop_at_the_first_empty_one_and_keep_their_order(spark, tmp_path):
    pages = {0: ["a", "b"], 2: ["c"], 3: [], 4: ["never"]}
    for offset, found in pages.items():
        text = json.dumps({"offset": offset, "results": [{"resource": {"id": x}} for x in found]})
        (tmp_path / f"{offset}.json").write_text(text)
    ids = ingest.safe_get(F.col("entry_json"), "$.resource.id")
    entries = landed.read_catalog_pages(spark, str(tmp_path))
    assert [r[0] for r in entries.orderBy("offset", "pos").select(ids).collect()] == ["a", "b", "c"]
    limited = landed.read_catalog_pages(spark, str(tmp_path), 2)
    assert [r[0] for r in limited.select(ids).collect()] == ["a", "b"]


def test_landed_csv_counts_the_header_apart_and_drops_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n  h1,h2 \n\n1,"x, y"\r\n \n2,b\n3,c\n')
    (tmp_path / "b.csv").write_text("only,header\n")
    (tmp_path / "c.csv").write_text(" \n\n")
    found = {
        r["file_path"][-5:]: r["sample_csv"]
        for r in landed.sample_landed_csv(spark, str(tmp_path), max_rows=2).collect()
    }
    assert found == {"a.csv": 'h1,h2\n1,"x, y"\n2,b', "b.csv": "only,header"}


def test_qrels_take_the_second_segment_of_the_path(spark, tmp_path):
    (tmp_path / "q.csv").write_text("topic,rel,doc,x\nt1,1.5,a/b/c,0\nt1,2,a/b/d,0\nt2,0,plain,0\n")
    rows = qrels.read_qrels(spark, str(tmp_path / "q.csv"))
    assert values(rows.orderBy("position").drop("position")) == [
        ("b", "t1", 1.5), ("b", "t1", 2.0), ("", "t2", 0.0)
    ]
    nested = {(r.topic, r.document): r for r in qrels.nested_qrels(rows).collect()}
    assert (nested["t1", "b"].first_score, nested["t1", "b"].last_score) == (1.5, 2.0)


def test_score_lists_keep_the_order_of_lines(spark, tmp_path):
    want = {}
    for part in range(3):
        lines = ["topic,rel,doc,x"]
        for i in range(40):
            topic, document, score = ("", "hot", "") if i == 7 else ("t%d" % (i % 2), "hot" if i % 5 else "cold", str(part * 100 - i))
            lines.append(f"{topic},{score},a/{document}/c,0")
            want.setdefault((topic or None, document), []).append(float(score) if score else None)
        (tmp_path / f"{part}.csv").write_text("\n".join(lines) + "\n")
    rows = qrels.read_qrels(spark, str(tmp_path))
    got = {}
    for r in qrels.score_lists(rows, 4).orderBy("block_no").collect():
        one = got.setdefault((r.topic, r.document), [])
        assert len(one) == r.block_no * 4 and len(r.scores) <= 4
        one += r.scores
    assert got == want
    assert qrels.score_lists(rows.filter("false")).count() == 0
    with pytest.raises(ValueError):
        qrels.score_lists(rows, 0)


def test_resume_does_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "progress")
    todo = spark.range(10).withColumn("id", F.col("id").cast("string"))
    seen = []

    def work(df):
        seen.append(df.count())
        return df.withColumn("done", F.lit(True))

    stages.resume_progress(todo.filter("id < 4"), path, "id", work, "1")
    result = stages.resume_progress(todo, path, "id", work, "2")
    assert seen == [4, 6]
    assert result.count() == 10


def test_records_json_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "dataset_id string, description string")
    stages.write_records_json(df, str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert json.loads(text) == {"dataset_id": "a", "description": None}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="title"):
        prepare.require_columns(spark.range(1).withColumnRenamed("id", "dataset_id"))


SAMPLES = [("a", None, None, "x,y\n1,2"), ("b", "t", "s", None), ("c", "t", "s", "  "), ("d", "t", "s", "\n")]


def test_prepare_trims_spaces_only(spark):
    df = spark.createDataFrame(SAMPLES, "dataset_id string, title string, source string, sample_csv string")
    rows = {r.dataset_id: r for r in prepare.prepare_records(df).collect()}
    # A newline is not a space: it passes here and fails when the sample is shortened.
    assert set(rows) == {"a", "d"}
    assert (rows["a"].title, rows["a"].source) == ("", "")
    assert one(spark, shrink_sample_csv(F.col("x")), x="\n") is None
    assert one(spark, has_text(F.col("x")), x="\n") is True


@pytest.mark.parametrize(
    "text, chars, lines, expected",
    [
        ("  h\n1\n2\n3  ", 100, 2, "h\n1\n2"),
        ("h\r\n1\r2  3", 100, 8, "h\n1\n2\n 3"),
        ("header\n12345", 8, 8, "header\n1"),
        ("head  \nx", 6, 0, "head"),
        ("　\n", 5, 5, None),
    ],
)
def test_shrink(spark, text, chars, lines, expected):
    assert one(spark, shrink_sample_csv(F.col("x"), chars, lines), x=text) == expected


def test_socrata_entries(spark):
    full = {
        "resource": {"id": "x", "name": "N", "createdAt": "2020"},
        "classification": {"tags": ["a", 'b "q"', "é"]},
        "metadata": {"domain": "d", "downloads": 7, "page_views": {"page_views_total": 12}},
    }
    entries = [json.dumps(full), json.dumps({"classification": {"tags": "one"}}), "{}"]
    df = spark.createDataFrame([(e,) for e in entries], "entry_json string")
    a, b, c = ingest.normalize_socrata_catalog(df).collect()
    assert (a.dataset_id, a.page_views_total, a.download_count, a.domain) == ("x", 12, 7, "d")
    assert a.tags_json == json.dumps(["a", 'b "q"', "é"], ensure_ascii=False)
    assert (b.tags_json, c.tags_json, c.dataset_id) == ("one", None, None)
    assert a.source == b.source == "nyc_open_data"


def test_portal_entries(spark):
    summaries = [
        {"id": "1", "name": "N", "category": "C", "tags": ["t", "C", None, "t"], "rowsUpdatedAt": 5},
        {"id": "2", "tags": []},
        {"name": "no id"},
    ]
    details = [
        {"id": "1", "columns": [{"name": "a", "dataTypeName": "text"}, {"name": "", "dataTypeName": "n"}, {"name": "b"}], "license": {"name": "L"}},
        {"id": "2", "license": "text"},
    ]
    make = lambda rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "entry_json string")
    rows = {r.dataset_id: r for r in ingest.normalize_portal_view(make(summaries), make(details)).collect()}
    assert set(rows) == {"1", "2"}
    first = rows["1"]
    assert json.loads(first.keywords_json) == ["C", "t"]
    assert json.loads(first.column_names_json) == ["a", "b"]
    assert json.loads(first.column_types_raw_json) == ["text", "n", "unknown"]
    assert (first.license, rows["2"].license) == ("L", None)
    assert first.last_updated == "5"
    raw = json.loads(first.raw_metadata_json)
    assert raw == {"summary_entry": summaries[0], "detail_entry": details[0]}
    assert rows["2"].column_names_json == "[]"
    assert [f.name for f in schemas.PORTAL_METADATA] == list(first.asDict())


@pytest.mark.parametrize(
    "links, expected",
    [
        ([{"accessURL": "u", "mediaType": "text/CSV"}], "u"),
        ([{"accessURL": "", "downloadURL": "d", "format": "CSV"}], "d"),
        ([{"mediaType": "csv"}, "x", {"downloadURL": "http://a/B.CSV"}], "http://a/B.CSV"),
        ([{"accessURL": "u.json"}], None),
        (None, None),
    ],
)
def test_dcat_entries(spark, links, expected):
    entry = {"identifier": "", "keyword": [], "dcat": {"identifier": "n", "title": "T", "keyword": ["k"], "distribution": links}}
    df = spark.createDataFrame([(json.dumps(entry),)], "entry_json string")
    row = ingest.normalize_dcat_entry(df).first()
    assert (row.dataset_id, row.title, row.keywords_json) == ("n", "T", '["k"]')
    assert row.download_url == expected


def test_sample_status(spark):
    meta = spark.createDataFrame(
        [("a", "u1"), ("b", " "), ("c", None), ("d", "u2"), ("e", "u3"), ("f", "u4")],
        "dataset_id string, download_url string",
    ).selectExpr("dataset_id", "'s' source", "'t' title", "null original_description", "download_url", "null landing_page_url")
    found = spark.createDataFrame(
        [("u1", "x", None), ("u2", "\n", None), ("u4", None, "HTTP 403")],
        "download_url string, sample_csv string, error_message string",
    )
    rows = {r.dataset_id: (r.sample_fetch_status, r.error_message) for r in ingest.tag_sample_status(meta, found).collect()}
    assert rows == {
        "a": ("success", None),
        "b": ("error", "missing_download_url"),
        "c": ("error", "missing_download_url"),
        "d": ("error", "empty_or_unreadable_sample"),
        "e": ("error", "empty_or_unreadable_sample"),
        "f": ("error", "HTTP 403"),
    }


def test_comparable_pairs(spark):
    rows = [("o" * 51, "g", "success"), ("short", "g", "success"), ("\t", "g", "success"), ("o", None, "success"), ("o", "g", "error")]
    df = spark.createDataFrame(rows, "original_description string, generated_description string, generation_status string")
    assert prepare.comparable_pairs(df).count() == 2
    assert prepare.comparable_pairs(df, 50).count() == 1


def test_csv_cells_with_quotes_and_line_ends(spark):
    text = 'a,b\n"x, 1","say ""hi"""\n"two\nlines",\nNA,last'
    df = spark.createDataFrame([("d", text)], "dataset_id string, sample_csv string")
    cells = values(sampling.explode_sample_cells(df).orderBy("row_no", "col_no").select("col_name", "value"))
    assert cells == [("a", "x, 1"), ("b", 'say "hi"'), ("a", "two\nlines"), ("b", None), ("a", None), ("b", "last")]
    again = df.select(csvtext.render(csvtext.rows(F.col("sample_csv")))).first()[0]
    assert again == text


def test_open_quote_is_an_error_row(spark):
    df = spark.createDataFrame([("d", 'a,b\n"1,2')], "dataset_id string, sample_csv string")
    row = sampling.with_table(df).first()
    assert row.columns is None
    assert row.csv_error.startswith("csv_parse_failed")


def test_sample_size_is_the_smaller_of_n_and_rows(spark):
    df = spark.range(100).withColumn("g", (F.col("id") > 96).cast("string"))
    counts = {r.g: r.n for r in sampling.get_sample(df, 5, ["id"], by="g").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert counts == {"false": 5, "true": 3}
    once = sorted(values(sampling.get_sample(df, 7, ["id"])))
    assert once == sorted(values(sampling.get_sample(df.repartition(9), 7, ["id"])))


def test_list_text_is_json(spark):
    texts = ["plain", 'q"uote', "back\\slash", "né", "tab\t"]
    df = spark.createDataFrame([(texts,)], "x array<string>")
    out = df.select(jsontext.list_text(F.col("x"))).first()[0]
    assert json.loads(out) == texts
    assert out.startswith('["plain", "q')


def test_resume_loses_nothing_when_a_batch_id_comes_again(spark, tmp_path):
    path = str(tmp_path / "progress")
    todo = spark.range(10).withColumn("id", F.col("id").cast("string"))

    def work(df):
        return df.withColumn("done", F.lit(True))

    assert stages.resume_progress(todo.filter("id < 4"), path, "id", work, "1").count() == 4
    (tmp_path / "progress" / "batch=broken").mkdir()  # what a run leaves that broke before its commit
    (tmp_path / "progress" / "batch=broken" / "_temporary").mkdir()
    for _ in range(2):
        assert stages.resume_progress(todo, path, "id", work, "1").count() == 10


def test_csv_quotes_open_at_the_start_of_a_field_only(spark):
    import csv
    import io
    import random

    pick = random.Random(1)
    texts = ['1,"open, cell', '5" pipe', '5" pipe,7" tube', 'a,"b ""c"" d"e,f\n"x\ny",z', '"a""', '""']
    texts += ["".join(pick.choice(['"', '""', ",", "\n", "a", " b", "\r\n"]) for _ in range(pick.randrange(1, 15))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r["i"]: (r["rows"], r["ok"]) for r in df.select("i", csvtext.rows(F.col("text")).alias("rows"), csvtext.is_parsable(F.col("text")).alias("ok")).collect()}
    for i, text in enumerate(texts):
        want = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        assert got[i][0] == want, text
        # A line end added at the end is taken into a cell only if that cell is open.
        more = [r for r in csv.reader(io.StringIO(text + "\n.", newline="")) if r]
        assert got[i][1] == (more == [*want, ["."]]), text
    assert [got[i][1] for i in range(6)] == [False, True, True, True, False, True]


def test_landed_csv_keeps_cells_with_line_ends_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2\n1,"first\nsecond\nthird"\n2,b\n3,c\n')
    found = landed.sample_landed_csv(spark, str(tmp_path), max_rows=2).first()["sample_csv"]
    assert found == 'h1,h2\n1,"first\nsecond\nthird"\n2,b'
    rows = "".join(f'"m{i}\nn{i}",{i}\n' for i in range(9))
    (tmp_path / "a.csv").write_text("x,y\n" + rows)
    found = landed.sample_landed_csv(spark, str(tmp_path), max_rows=3).first()["sample_csv"]
    assert found == 'x,y\n"m0\nn0",0\n"m1\nn1",1\n"m2\nn2",2'


def test_csv_heads_read_a_bounded_part(spark, tmp_path):
    (tmp_path / "part=1").mkdir()
    long_row = "v" * 100
    (tmp_path / "part=1" / "long.csv").write_text("h\n" + f"{long_row}\n" * 200_000)
    (tmp_path / "open.csv").write_text('h\n1\n"never closed\n' + "2\n" * 100_000)
    (tmp_path / "latin.csv").write_bytes(b"\xef\xbb\xbfh,k\r\nb\xe9,\"q\"\"\"\r")
    (tmp_path / "_SUCCESS").write_text("h\n")
    spark.dataSource.register(CsvHeads)
    reader = spark.read.format("csv_heads").option("max_rows", 3).option("max_bytes", 50_000).option("files_per_task", 1)
    rows = {r["file_path"].rsplit("/", 1)[1]: r for r in reader.load(str(tmp_path)).collect()}
    assert set(rows) == {"long.csv", "open.csv", "latin.csv"}
    assert rows["long.csv"]["sample_csv"] == "\n".join(["h", *[long_row] * 3])
    assert rows["long.csv"]["bytes_read"] <= 2 * CHUNK and rows["long.csv"]["complete"]
    assert rows["open.csv"]["sample_csv"] == "h\n1"
    assert not rows["open.csv"]["complete"] and rows["open.csv"]["bytes_read"] == 50_000
    assert rows["latin.csv"]["sample_csv"] == 'h,k\nb\ufffd,"q"""'
    with pytest.raises(Exception, match="nowhere"):
        reader.load(str(tmp_path / "nowhere")).collect()


@given(
    rows=st.lists(st.lists(st.text('a, "\n\ré\U0001f600', max_size=6), min_size=2, max_size=3), min_size=1, max_size=6),
    chunk=st.integers(1, 9),
    ends=st.sampled_from(["\n", "\r\n", "\r"]),
    cut=st.integers(0, 6),
)
@settings(max_examples=300, deadline=None)
def test_heads_agree_with_a_csv_reader(rows, chunk, ends, cut):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=ends, quoting=csv.QUOTE_ALL).writerows(rows)
    data = out.getvalue().encode()
    sample, n, size, whole = head(io.BytesIO(data), cut, chunk=chunk)
    assert n == min(len(rows), cut + 1) and whole and size <= len(data)
    # Outer white space of a record goes when its first or last field needs no quotes.
    want = [[f if SPECIAL.search(f) else f.lstrip() if i == 0 else f.rstrip() if i == len(r) - 1 else f for i, f in enumerate(r)] for r in rows[: cut + 1]]
    assert list(csv.reader(io.StringIO(sample, newline=""))) == want


def test_a_shared_address_does_not_multiply_rows(spark):
    meta = spark.createDataFrame(
        [("a", "u"), ("b", "u")], "dataset_id string, download_url string"
    ).selectExpr("dataset_id", "'s' source", "'t' title", "null original_description", "download_url", "null landing_page_url")
    by_url = spark.createDataFrame([("u", None, "HTTP 500"), ("u", "x", None)], "download_url string, sample_csv string, error_message string")
    rows = ingest.tag_sample_status(meta, by_url).collect()
    assert sorted((r.dataset_id, r.sample_csv, r.sample_fetch_status) for r in rows) == [("a", "x", "success"), ("b", "x", "success")]
    own = spark.createDataFrame([("s", "a", "x"), ("s", "b", "y"), ("s", "b", "y")], "source string, dataset_id string, sample_csv string")
    assert sorted(r.sample_csv for r in ingest.tag_sample_status(meta, own).collect()) == ["x", "y"]


def test_a_union_without_rows_is_an_error(spark):
    empty = spark.createDataFrame([], "a string")
    assert ingest.union_sources(empty, empty).count() == 0
    with pytest.raises(ValueError):
        ingest.union_sources(empty, empty, required=True)
    assert ingest.union_sources(empty, spark.createDataFrame([("x",)], "a string"), required=True).count() == 1
