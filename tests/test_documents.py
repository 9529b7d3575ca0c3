"""Embedded documents: sections, fields, files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.functions import files as fx
from pagecat.functions.numbers import ratio_text_expr, round_one_digit_expr
from pagecat.functions.values import date_published_expr
from pagecat.operators import embedded, enrich, files, sections
from pagecat.plans import flow
from pagecat.schemas import BASE_RECORD, NEW_FIELDS

URL = "https://example.com/datasets/x"


def page(dataset=None, filesets=None, raw=None):
    props = {"dataset": dataset or {}, "filesetMap": filesets or {}}
    text = raw if raw is not None else json.dumps({"props": {"pageProps": props}}, ensure_ascii=False)
    return f"<html><body><h1>X</h1>{rules.DOCUMENT_OPEN}{text}{rules.DOCUMENT_CLOSE}</body></html>"


def pages_of(spark, *sources):
    return spark.createDataFrame([(f"{URL}{i}", s) for i, s in enumerate(sources)], "url string, html string")


def records_of(spark, n):
    rows = [(f"name {i}", f"{URL}{i}", "", "Human", "", "", "") for i in range(n)]
    return spark.createDataFrame(rows, BASE_RECORD)


def enriched(spark, dataset):
    return enrich.enrich(records_of(spark, 1), pages_of(spark, page(dataset))).first()


def test_absent_malformed_and_repeated_documents(spark):
    twice = page({"donorCount": 1}) + page({"donorCount": 2})
    docs = embedded.embedded_json(
        pages_of(spark, "<p>none</p>", page(raw='{"props": '), page({"donorCount": 3}), twice, page(raw=""), rules.DOCUMENT_OPEN + "{}")
    )
    got = docs.orderBy("url").select("doc.props.pageProps.dataset.donorCount", F.col("doc").isNull()).collect()
    assert [tuple(r) for r in got] == [(None, True), (None, False), ("3", False), ("1", False), (None, True), (None, True)]


def test_sections_and_traps(spark):
    body = "\n".join(
        [
            "intro",
            "**Biomaterials** same line",
            "",
            "  tissue \t",
            "**biomaterials**",  # headers are case-sensitive; this one closes
            "- Camera: closed",
            "  **Imaging**",
            "- Light: N/A",
            "- Illumination: LED: blue",
            "Camera detector:",
            "Camera: first",
            "- Camera: second",
            "no pair",
            "**Imaging** again",
            "Exposure: 5",
            "- - Stain: H&E",
        ]
    )
    row = enriched(spark, {"body": body})
    assert row.biomaterials == "tissue"
    assert row.numerical_aperture == "LED: blue"  # 'na' inside illumination comes first
    assert row.scopeled_light_source == ""
    assert row.camera == "first"
    assert (row.exposure, row.image_type) == ("5", "H&E")
    lines = sections.body_sections(spark.createDataFrame([(1, body)], "id int, body string"))
    assert [(r.pos, r.section) for r in lines.orderBy("pos").collect()][:3] == [
        (2, "biomaterials"),
        (3, "biomaterials"),
        (7, "imaging"),
    ]


def test_imaging_line_may_fill_a_text_field_first(spark):
    body = "**Imaging**\nBiomaterial: from imaging\n**Biomaterials**\nfrom section"
    assert enriched(spark, {"body": body}).biomaterials == "from imaging"


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-03-01T23:30:00-05:00", "2024-03-01"),
        ("2024-03-01T00:10:00Z", "2024-03-01"),
        ("2024-03-01", "2024-03-01"),
        ("20240301", "2024-03-01"),
        ("2024-03-01 10:00:00.123", "2024-03-01"),
        ("2024-02-30", "2024-02-30"),
        ("2024-03-01T25:00:00", "2024-03-01T25:00:00"),
        ("soon", "soon"),
        ("March 2024", "March 2024"),
        ("", ""),
        (None, ""),
    ],
)
def test_dates_keep_their_own_day(one, value, expected):
    assert one(date_published_expr(F.col("x")), "x string", value) == expected


def test_lists_and_donors(spark):
    row = enriched(
        spark,
        {"anatomicalEntities": ["a", None, "b"], "diseaseStates": [], "donorCount": 0, "biomaterialTypes": ["x"]},
    )
    assert (row.anatomical_entity, row.disease_state, row.donor_count, row.biomaterial_type) == ("a, b", "", "", "x")
    assert enriched(spark, {"donorCount": 12}).donor_count == "12"
    assert enriched(spark, {"donorCount": "4"}).donor_count == "4"


def test_records_without_page_are_kept(spark):
    got = enrich.enrich(records_of(spark, 2), pages_of(spark, page({"donorCount": 2}))).orderBy("dataset_url").collect()
    assert [(r.outcome, r.donor_count) for r in got] == [("ok", "2"), ("failed", "")]
    assert {got[1][f] for f in NEW_FIELDS} == {""}


def test_copies_of_a_page_give_one_record(spark):
    copies = pages_of(spark, page({"donorCount": 2}), "<p>broken</p>").withColumn("url", F.lit(f"{URL}0"))
    got = enrich.enrich(records_of(spark, 1), copies).collect()
    assert [(r.donor_count, r.outcome) for r in got] == [("2", "ok")]
    assert flow.catalogue(records_of(spark, 1), copies).count() == 1


def item(url, size=0, title="t"):
    return {"url": url, "bytes": size, "title": title, "md5sum": "m"}


def test_file_entry(spark):
    sets = {"Files": {"inputs": [item("https://cf.example.com/a/tissue_image.btf?x=1", 8020000000, "Microscope image")], "outputs": []}}
    row = files.attach_files(records_of(spark, 1), files.page_files(pages_of(spark, page(None, sets)))).first()
    assert row["files"][0].asDict() == {
        "file_title": "Microscope image",
        "file_type": "BTF",
        "filename": "tissue_image.btf",
        "size": "8.02 GB",
        "size_bytes": 8020000000,
        "md5sum": "m",
        "url": "https://cf.example.com/a/tissue_image.btf?x=1",
    }
    assert (row.files_found_count, row.file_extraction_status) == (1, "partial")


def test_many_experiments_in_order_and_statuses(spark):
    sets = {
        "Experiment 2, post": {"outputs": [item("u/b.h5")], "inputs": [item("u/a")]},
        "Experiment 1": {"inputs": [item(""), {"bytes": 1}], "outputs": [item("u/c.csv", None, None)]},
    }
    single = {"Other": {"inputs": [item("u/no")]}, "Files": {"inputs": None, "outputs": [item("u/yes.gz")]}}
    pages = pages_of(spark, page(None, sets), page(None, single), "<p>none</p>")
    got = files.attach_files(records_of(spark, 4), files.page_files(pages)).orderBy("dataset_url").collect()
    assert [[f.filename for f in r["files"]] for r in got] == [["a", "b.h5", "c.csv"], ["yes.gz"], [], []]
    assert [r.file_extraction_status for r in got] == ["success", "partial", "failed", "failed"]
    assert (got[0]["files"][0].file_type, got[0]["files"][2].size, got[0]["files"][2].file_title) == ("A", "0 B", "")
    wide = files.files_wide(files.attach_files(records_of(spark, 4), files.page_files(pages)))
    assert [c for c in wide.columns if c.endswith("_filename")] == ["file_1_filename", "file_2_filename", "file_3_filename"]


def test_sizes_like_python(spark):
    def expected(b):
        for step, unit in ((1000**3, "GB"), (1000**2, "MB"), (1000, "KB")):
            if b >= step:
                return f"{b / step:.2f} {unit}"
        return f"{b} B"

    rng = random.Random(7)
    sizes = [*range(0, 30000, 5), *(rng.randrange(10**6) * 10**rng.randrange(6) + 5 * 10**rng.randrange(7) for _ in range(8000))]
    got = spark.createDataFrame([(b,) for b in sizes], "b bigint").select("b", fx.human_size_expr(F.col("b"))).collect()
    assert [r[1] for r in got] == [expected(r[0]) for r in got]


def test_ratios_and_rates_like_python(spark):
    micros = [*range(0, 400000, 2500), 10**12 + 5000]
    got = spark.createDataFrame([(m,) for m in micros], "m bigint").select("m", ratio_text_expr(F.col("m"), 10**6))
    assert all(r[1] == f"{r[0] / 10**6:.2f}" for r in got.collect())
    pairs = [(k, n) for n in (8, 19, 40, 80, 400, 2000) for k in range(n + 1)]
    rate = F.col("k").cast("double") / F.col("n").cast("double") * 100
    got = spark.createDataFrame(pairs, "k bigint, n bigint").select("k", "n", round_one_digit_expr(rate)).collect()
    assert all(r[2] == round(r[0] / r[1] * 100, 1) for r in got)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2.3 GB", ("2.3 GB", 2469606195)),
        ("1,500 MB", ("1.5 GB", 1572864000)),
        ("1.5tb", ("1536.0 GB", 1649267441664)),
        (" 12 B and more", ("12 B", 12)),
        ("1.25 KB", ("1.2 KB", 1280)),
        ("", ("", 0)),
        ("1.2.3 MB", ("1.2.3 MB", 0)),
        ("many, many", ("many many", 0)),
    ],
)
def test_parse_size(one, text, expected):
    assert tuple(one(fx.parse_size_expr(F.col("x")), "x string", text)) == expected


@pytest.mark.parametrize(
    "title, name, expected",
    [
        ("As given", "x.btf", "As given"),
        ("", "X.BTF", "Microscope Image (BTF)"),
        ("", "square_002um.tar.gz", "Binned Output (2μm)"),
        ("", "square.tar.gz", "Binned Output (GZ)"),
        ("", "square_8um.gz", "Compressed Archive (GZ)"),
        ("", "a.h5", "Feature Matrix (H5)"),
        (None, "a.cloupe", "Loupe File"),
        ("", "a.csv", "Other"),
    ],
)
def test_classify(one, title, name, expected):
    kind = fx.classify_file_expr(F.col("t"), F.col("n"))
    assert one(kind, "t string, n string", title, name) == expected
