"""Pages, records and logs derived in Spark from the star-schema tables.

They give the operators realistic input whose right answer can be computed from the base tables
without parsing any HTML. The work grows with the tables: one page row per 50 parts, one detail page
per order, one stage event per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecat import rules
from pagecat.schemas import BASE_FIELDS

SITE = "https://catalog.example.com"
SEED = f"{SITE}/datasets?hitsPerPage=50"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _concat(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else _text(p) for p in parts))


def _pick(index: Column, values: list[str]) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), index.cast("int"))


# ---- FX1: listing pages ----------------------------------------------------------------------


def _listing_rows(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    page = F.expr("cast((p_partkey div 50) % 40 as int)")
    shifted = F.when(page.between(20, 22), k - 50 * (page - 19)).otherwise(k)
    item = F.when(shifted % 4 == 3, shifted - 1).otherwise(shifted)
    name = F.when(k % 97 == 0, "").otherwise(_concat(F.col("p_name"), "  \n ", k))
    # Links as pages write them: padded, with a character reference, or plain.
    href = (
        F.when(k % 8 == 1, _concat(" /datasets/part-", item, "\n"))
        .when(k % 8 == 2, _concat("&#47;datasets&#x2F;part-", item))
        .otherwise(_concat("/datasets/part-", item))
    )
    link = _concat('<a href="', href, '">', name, "</a>")
    decoy = F.when(k % 6 == 0, '<a href="/datasets?q=all">all</a> ').otherwise("")
    brand, species = F.col("p_brand"), _pick(k % 3, ["Human", "Mouse", "Rat"])
    spatial = _concat("Spatial ", F.col("p_type"))
    cells = _pick(k % 2, ["Cells", "N/A"])
    kept = _pick(k % 2, ["FFPE", "Fresh Frozen"])

    def row(*cells_of: Column) -> Column:
        tds = [p for c in cells_of for p in ("<td>", c, "</td>")]
        return _concat("<tr>", *tds, "</tr>")

    first = _concat(decoy, link)
    html = (
        F.when(k % 10 <= 5, row(first, F.lit(""), spatial, species, brand, cells, kept))
        .when(k % 10 == 6, row(first, brand, species, kept, spatial))
        .when(
            k % 10 == 7,
            row(first, spatial, brand, cells, _concat("Gene Expression ", F.col("p_type")), F.col("p_name")),
        )
        .when(k % 10 == 8, row(first, spatial, species))
        .otherwise(row(first))
    )
    return part.select(
        F.expr("cast(p_partkey div 2000 as string)").alias("run"),
        page.alias("page_num"),
        F.struct((k % 50).alias("pos"), html.alias("row"), link.alias("link")).alias("entry"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue listing: 50 rows to a page, 40 pages to a run, with repeats and odd rows."""
    page = _listing_rows(table(spark, sf_dir, "part")).groupBy("run", "page_num").agg(
        F.sort_array(F.collect_list("entry")).alias("entries")  # 50 by construction
    )
    rows = F.array_join(F.transform("entries", lambda e: e["row"]), "\n")
    links = F.array_join(F.transform("entries", lambda e: e["link"]), "<br>")
    decoy = F.when(
        F.col("page_num") == 5,
        '<tbody><tr><td><a href="/datasets/decoy">decoy</a></td><td>x</td></tr></tbody>',
    ).otherwise("")
    # Page 7 has tables inside its table, one of them with a dataset link; page 9 a table without a body tag.
    inner = F.when(
        F.col("page_num") == 7,
        '<tr><td><table><tbody><tr><td><a href="/datasets/inner">inner</a></td><td>x</td></tr></tbody></table></td></tr>',
    ).otherwise("")
    body = (
        F.when(F.col("page_num") == 13, _concat("<p>", links, "</p>"))
        .when(F.col("page_num") == 9, _concat("<table>", rows, "</table>"))
        .otherwise(
            _concat("<table><thead><tr><th>Name</th></tr></thead><tbody>", rows, inner, "</tbody>", decoy, "</table>")
        )
    )
    return page.select(
        "run",
        "page_num",
        F.when(F.col("page_num") == 0, SEED)
        .otherwise(_concat(SEED, "&page=", F.col("page_num")))
        .alias("url"),
        _concat(
            "<!DOCTYPE html><html><head><title>Listing</title></head><body><nav>",
            '<a href="/datasets?page=2">Next</a> <a href="/about">About</a></nav>',
            body,
            "</body></html>",
        ).alias("html"),
    )


# ---- FX2: detail pages and their records -----------------------------------------------------


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One base record per order."""
    key = F.col("o_orderkey")
    values = {
        "dataset_name": _concat("Order ", key),
        "dataset_url": _concat(f"{SITE}/datasets/o-", key),
        "product": _concat("Spatial ", F.col("o_orderpriority")),
        "species": _pick(F.col("o_custkey") % 3, ["Human", "Mouse", "Rat"]),
        "sample_type": F.when(F.col("o_custkey") % 7 == 0, "").otherwise(F.col("o_orderstatus")),
        "cells_or_nuclei": F.lit("N/A"),
        "preservation": _pick(F.col("o_custkey") % 2, ["FFPE", "Fresh Frozen"]),
    }
    return table(spark, sf_dir, "orders").select(*(values[f].alias(f) for f in BASE_FIELDS))


def _item(line: dict[str, Column]) -> Column:
    part, number = line["l_partkey"], line["l_linenumber"]
    ext = _pick(part % 5, ["btf", "tar.gz", "h5", "cloupe", "csv"])
    name = (
        F.when((part % 5 == 1) & (part % 2 == 0), _concat("square_00", number, "um.tar.gz"))
        .when((part % 5 == 1) & (part % 3 == 0), "square_all.tar.gz")
        .otherwise(_concat("f_", number, ".", ext))
    )
    url = _concat("https://files.example.com/", part, "/", name, "?sig=1")
    cents = F.round(line["l_extendedprice"] * 100).cast("bigint")
    return F.struct(
        _pick(number % 3, ["Microscope image", "Binned outputs", ""]).alias("title"),
        F.when(part % 41 == 0, "").otherwise(url).alias("url"),
        (cents * F.pow(F.lit(10), number % 4).cast("bigint")).alias("bytes"),
        F.md5(_text(part)).alias("md5sum"),
    )


def _fileset_map() -> Column:
    """Sets by return flag; of every third order one with all files too. The lines bring their item along."""
    lines = F.col("lines")

    def items(status: str, flag: Column | None) -> Column:
        def wanted(line: Column) -> Column:
            side = line["l_linestatus"] == "O" if status == "O" else line["l_linestatus"] != "O"
            return side if flag is None else side & (line["l_returnflag"] == flag)

        return F.transform(F.filter(lines, wanted), lambda line: line["item"])

    def filed(flag: Column | None) -> Column:
        return F.struct(items("O", flag).alias("inputs"), items("F", flag).alias("outputs"))

    flags = F.array_sort(F.array_distinct(F.transform(lines, lambda line: line["l_returnflag"])))
    sets = F.transform(
        flags, lambda flag: F.struct(_concat("Exp ", flag).alias("key"), filed(flag).alias("value"))
    )
    everything = F.array(F.struct(F.lit("Files").alias("key"), filed(None).alias("value")))
    return F.map_from_entries(
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(sets, everything)).otherwise(sets)
    )


def _body() -> Column:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return F.concat_ws(
        "\n",
        _concat("Order ", key, " overview"),
        F.lit("**Biomaterials**"),
        F.lit(""),
        _concat("  Tissue ", F.col("o_orderpriority"), " "),
        F.lit("second line"),
        F.lit("**Other** x"),
        F.lit("- Camera: no"),
        F.lit("**Sample preparation**"),
        F.when(key % 4 == 0, "").otherwise(_concat("Prep ", F.col("o_orderstatus"))),
        F.lit("**Imaging** trailing"),
        _concat("- Microscope: ", F.col("o_orderpriority"), ": A"),
        F.lit("Illumination: LED"),
        F.lit("- Camera: N/A"),
        _concat("- Exposure: ", cust % 100),
        F.when(key % 2 == 0, _concat("- Camera: C", cust % 10)).otherwise("no pair here"),
        _concat("Organ: ", F.col("o_orderpriority")),
        F.lit("Tissue type: second"),
        _concat("- Number of donors: ", cust % 4),
        F.lit("Condition: N/A"),
        _concat("Release date: ", F.date_format("o_orderdate", "yyyy-MM-dd")),
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order with an embedded document; some without page, script or valid JSON.

    A page holds the lines of its order, so an order is as large as its page.
    """
    line_fields = [
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
    ]
    # Lines are small and pages large: keep every shuffle partition, so that pages are built and read
    # by all tasks. Sorted lines are grouped and joined in one pass; an item is worked out once, in its
    # line's own row, after the shuffle.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    item = _item({name: F.col(name) for name in line_fields})
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", *line_fields)
        .repartition(partitions, "l_orderkey")
        .sortWithinPartitions("l_orderkey")
        .select("l_orderkey", F.struct(*line_fields, item.alias("item")).alias("line"))
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 37 <> 0")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "lines", F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType))
    )
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    published = _concat(F.date_format("o_orderdate", "yyyy-MM-dd"), "T23:30:00-05:00")
    none = F.array().cast("array<string>")
    dataset = F.struct(
        _body().alias("body"),
        F.when(cust % 2 == 0, F.array("o_orderpriority"))
        .otherwise(F.array(F.col("o_orderpriority"), F.lit("Second")))
        .alias("anatomicalEntities"),
        F.when(status == "O", F.array(F.lit("FFPE")))
        .when(status == "F", F.array(F.lit("Fresh Frozen"), F.lit("FFPE")))
        .otherwise(none)
        .alias("preservationMethods"),
        F.when(status == "P", F.array(F.lit("Healthy"))).otherwise(none).alias("diseaseStates"),
        F.array(_concat("Type ", status)).alias("biomaterialTypes"),
        (cust % 5).alias("donorCount"),
        F.when(key % 50 == 0, "unknown").otherwise(published).alias("publishedAt"),
    )
    document = F.struct(
        F.struct(
            F.struct(dataset.alias("dataset"), _fileset_map().alias("filesetMap")).alias("pageProps")
        ).alias("props")
    )
    text = F.to_json(document)
    script = _concat(
        rules.DOCUMENT_OPEN,
        F.when(key % 31 == 0, F.expr("'{\"props\": {\"pageProps\": '")).otherwise(text),
        rules.DOCUMENT_CLOSE,
    )
    return joined.select(
        _concat(f"{SITE}/datasets/o-", key).alias("url"),
        _concat(
            "<html><head><title>Detail</title></head><body><h1>Order ",
            key,
            '</h1><div id="root">text</div>',
            F.when(key % 29 == 0, "").otherwise(script),
            "</body></html>",
        ).alias("html"),
    )


# ---- FX3: stage events -----------------------------------------------------------------------


def stage_events(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """One stage result per event; a run is a user, or a user's day."""
    k = F.col("event_id")
    run = _text(F.col("user_id"))
    if by_day:
        run = _concat(F.col("user_id"), "-", F.date_format("ts", "yyyyMMdd"))
    names = {
        "signup": "scraper",
        "view": "validator",
        "click": "metadata_enricher",
        "purchase": "file_extractor",
    }
    name = F.lit("scraper")
    for event, stage in names.items():
        name = F.when(F.col("event_type") == event, stage).otherwise(name)
    skipped = k % 7 == 0
    code = F.when(F.col("event_type") == "error", 2).otherwise((k % 2).cast("int"))
    status = F.when(code == 0, "success").when(code == 1, "failed").otherwise("error")
    micros = F.round(F.col("value") * 1000).cast("bigint") * 1000 + 5000
    return table(spark, sf_dir, "events").select(
        "event_id",
        run.alias("run"),
        name.alias("name"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + micros).alias("end_time"),
        F.when(~skipped, code).alias("exit_code"),
        F.when(skipped, "user_skipped").otherwise(status).alias("status"),
    )


# ---- FX4: two copies of a catalogue ----------------------------------------------------------


def _copy_values() -> dict[str, Column]:
    k = F.col("p_partkey")
    return {
        "dataset_name": _concat(F.col("p_name"), " ", k),
        "dataset_url": _concat(f"{SITE}/datasets/part-", k),
        "product": _concat("Spatial ", F.col("p_type")),
        "species": _pick(k % 3, ["Human", "Mouse", "Rat"]),
        "sample_type": F.col("p_brand"),
        "cells_or_nuclei": _pick(k % 2, ["Cells", "N/A"]),
        "preservation": F.when(k % 103 == 0, "").otherwise(_pick(k % 2, ["FFPE", "Fresh Frozen"])),
    }


def copy_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _copy_values()
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_idx"), *(values[f].alias(f) for f in BASE_FIELDS)
    )


def copy_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy A with some values changed; a null where A is blank is no change."""
    k = F.col("p_partkey")
    values = _copy_values()
    changed = {
        "species": F.when(k % 101 == 0, F.lower(values["species"])),
        "product": F.when(k % 107 == 0, ""),
        "dataset_url": F.when(k % 109 == 0, _concat(f"{SITE}/datasets/moved-", k)),
    }
    for field, value in changed.items():
        values[field] = F.coalesce(value, values[field])
    values["preservation"] = F.when(k % 103 != 0, values["preservation"])
    return table(spark, sf_dir, "part").select(
        k.alias("row_idx"), *(values[f].alias(f) for f in BASE_FIELDS)
    )


def copy_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy B without its last row."""
    last = table(spark, sf_dir, "part").agg(F.max("p_partkey").alias("last"))
    return copy_b(spark, sf_dir).crossJoin(last).where("row_idx <> last").drop("last")


# ---- FX5: records and the pages they came from -----------------------------------------------

_TISSUE_NAMES = [t.title() for t in rules.TISSUES]


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy A's records in three runs, with tissues for sample types."""
    k = F.col("p_partkey")
    values = _copy_values()
    values["sample_type"] = F.when(k % 61 == 0, "").otherwise(_pick(k % 10, _TISSUE_NAMES))
    values["preservation"] = F.when(k % 47 == 0, "fresh-frozen").otherwise(
        _pick(k % 4, ["FFPE", "Fresh Frozen", "FFPE", "Fixed Frozen"])
    )
    return table(spark, sf_dir, "part").select(
        _text(k % 3).alias("run"), k.alias("row_idx"), *(values[f].alias(f) for f in BASE_FIELDS)
    )


def record_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every record, some missing, some telling something else."""
    k = F.col("p_partkey")
    name = _concat(F.col("p_name"), " ", k)
    heading = F.when(k % 71 == 0, "Other").when(k % 43 == 0, F.upper(name)).otherwise(name)
    species = F.when(k % 41 == 0, _pick(k % 3, ["Mouse", "Human", "Human"])).otherwise(
        _pick(k % 3, ["Human", "Mouse", "Rat"])
    )
    kept = F.when(k % 47 == 0, "fresh frozen").otherwise(
        _pick(k % 4, ["FFPE", "Fresh Frozen", "FFPE", "Fixed Frozen"])
    )
    tissue = F.when(k % 53 == 0, _pick((k + 1) % 10, rules.TISSUES)).otherwise(_pick(k % 10, rules.TISSUES))
    species_line = F.when(k % 59 == 0, "").otherwise(_concat("<p>Species: <b>", species, "</b></p>"))
    return table(spark, sf_dir, "part").where("p_partkey % 37 <> 0").select(
        _concat(f"{SITE}/datasets/part-", k).alias("url"),
        _concat(
            "<html><head><title>human mouse pancreas</title><style>p{x:human}</style></head><body>",
            "<!-- human --><script>var s='human mouse ffpe pancreas</p>';</script><h1> ",
            heading,
            "\n</h1>",
            species_line,
            "<ul><li>Preservation: ",
            F.replace(kept, F.lit(" "), F.lit("&nbsp;\n")),
            "<li>Tissue: ",
            tissue,
            "</ul></body></html>",
        ).alias("html"),
    )


# ---- FX6: the pages behind the listing -------------------------------------------------------


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail page of every part of the listing, some missing, some telling something else.

    Some have an older copy beside them, without a document and under another heading.
    """
    k = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").where("p_partkey % 37 <> 0")
    name = _concat(F.col("p_name"), " ", k)
    heading = F.when(k % 71 == 0, "Other").when(k % 43 == 0, F.upper(name)).otherwise(name)
    species = F.when(k % 41 == 0, _pick(k % 3, ["Mouse", "Human", "Human"])).otherwise(
        _pick(k % 3, ["Human", "Mouse", "Rat"])
    )
    species_line = F.when(k % 59 == 0, "").otherwise(_concat("<p>Species: ", species, "</p>"))
    tissue_line = F.when(k % 13 == 0, _concat("<p>Tissue: ", _pick(k % 10, rules.TISSUES), "</p>")).otherwise("")

    def file(i: Column) -> Column:
        name = _concat("f_", i, ".csv")
        url = _concat("https://files.example.com/", k, "/", name)
        return F.struct(
            F.lit("Table").alias("title"), url.alias("url"), (k * 1000 + i).alias("bytes"), F.md5(_text(k)).alias("md5sum")
        )

    listed = F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= k % 3)
    filed = F.struct(F.transform(listed, file).alias("outputs"))
    dataset = F.struct(
        _concat("**Imaging**\n- Microscope: M", k % 9).alias("body"),
        _concat("2024-01-", F.lpad(_text(k % 28 + 1), 2, "0"), "T10:00:00-05:00").alias("publishedAt"),
    )
    content = F.struct(dataset.alias("dataset"), F.create_map(F.lit("Files"), filed).alias("filesetMap"))
    document = F.to_json(F.struct(F.struct(content.alias("pageProps")).alias("props")))
    script = F.when(k % 29 == 0, "").otherwise(_concat(rules.DOCUMENT_OPEN, document, rules.DOCUMENT_CLOSE))
    url = _concat(f"{SITE}/datasets/part-", k).alias("url")
    kept = _pick(k % 2, ["FFPE", "Fresh&nbsp;Frozen"])
    told = _concat("</h1>", species_line, "<p>Preservation: ", kept, "</p>", tissue_line, script, "</body></html>")
    older = parts.where("p_partkey % 17 = 0").select(url, F.lit("<html><body><h1>Not ready</h1></body></html>").alias("html"))
    return parts.select(url, _concat("<html><body><h1>", heading, told).alias("html")).unionByName(older)
