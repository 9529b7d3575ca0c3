"""File lists of the embedded document: flat, nested, wide, counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecat.functions.files import file_name_expr, file_type_expr, human_size_expr
from pagecat.operators.embedded import embedded_json
from pagecat.operators.joins import best_lookup, grouped_lookup_join, rank_expr
from pagecat.schemas import FILE, embedded_doc

# Fixed value: the one set that, where present, is the whole list.
ALL_FILES = "Files"

FILE_NAMES = FILE.fieldNames()
WIDE_FIELDS = ["file_type", "filename", "size", "md5sum", "url"]


def _used_sets(filesets: Column) -> Column:
    only = F.filter(F.map_entries(filesets), lambda e: e["key"] == ALL_FILES)
    return F.when(F.map_contains_key(filesets, ALL_FILES), only).otherwise(F.map_entries(filesets))


def filesets(nodes: DataFrame) -> DataFrame:
    """File sets in document order; where a set holds all files, only that one."""
    kept = [c for c in nodes.columns if c not in ("dataset", "filesets", "has_doc")]
    return nodes.select(
        *kept, F.posexplode(_used_sets(F.col("filesets"))).alias("set_pos", "s")
    ).select(
        *kept,
        "set_pos",
        F.col("s.key").alias("set_name"),
        F.col("s.value.inputs").alias("inputs"),
        F.col("s.value.outputs").alias("outputs"),
    )


def _entries(inputs: Column, outputs: Column) -> Column:
    """Inputs then outputs of one set, those without a url dropped."""

    def side(items: Column, kind: str) -> Column:
        named = F.transform(
            F.filter(items, lambda item: F.coalesce(item["url"], F.lit("")) != ""),
            lambda item: F.struct(
                F.lit(kind).alias("kind"),
                item.alias("item"),
                file_name_expr(item["url"]).alias("name"),
                F.coalesce(item["bytes"], F.lit(0).cast("bigint")).alias("bytes"),
            ),
        )
        return F.coalesce(F.transform(named, _file), F.array().cast(_ENTRIES))

    return F.concat(side(inputs, "input"), side(outputs, "output"))


def _file(entry: Column) -> Column:
    item = entry["item"]
    return F.struct(
        entry["kind"].alias("kind"),
        F.coalesce(item["title"], F.lit("")).alias("file_title"),
        file_type_expr(entry["name"]).alias("file_type"),
        entry["name"].alias("filename"),
        human_size_expr(entry["bytes"]).alias("size"),
        entry["bytes"].alias("size_bytes"),
        F.coalesce(item["md5sum"], F.lit("")).alias("md5sum"),
        item["url"].alias("url"),
    )


_ENTRIES = f"array<struct<kind:string,{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in FILE)}>>"


def explode_files(sets: DataFrame) -> DataFrame:
    """One row per file of every set, in order, with its kind (input or output)."""
    kept = [c for c in sets.columns if c not in ("inputs", "outputs")]
    entries = _entries(F.col("inputs"), F.col("outputs"))
    return sets.select(*kept, F.posexplode(entries).alias("file_pos", "f")).select(
        *kept, "file_pos", "f.*"
    )


def files_expr(fileset_map: Column) -> Column:
    """All files of a fileset map as one ordered array, with their kinds."""
    return F.flatten(
        F.transform(
            _used_sets(fileset_map), lambda s: _entries(s["value"]["inputs"], s["value"]["outputs"])
        )
    )


def page_files(pages: DataFrame) -> DataFrame:
    """(dataset_url, files) of every page, nested in order without leaving the page's row."""
    read = pages.select(F.col("url").alias("dataset_url"), "html")
    docs = embedded_json(read, embedded_doc(dataset=False))
    return docs.select("dataset_url", files_expr(F.col("doc.props.pageProps.filesetMap")).alias("files"))


def nest_files(flat: DataFrame, by: Sequence[str] = ("dataset_url",)) -> DataFrame:
    """Rows of ``explode_files`` back to one ordered array per page.

    Copies of a page repeat its places; each place is reduced to one file first, so an array never
    holds more than one page's list.
    """
    places = flat.groupBy(*by, "set_pos", "file_pos").agg(
        F.max(F.struct("kind", *FILE_NAMES)).alias("file")
    )
    in_order = F.array_sort(F.collect_list(F.struct("set_pos", "file_pos", "file")))
    return places.groupBy(*by).agg(F.transform(in_order, lambda e: e["file"]).alias("files"))


def attach_files(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records with their nested files, the count, and a status by it.

    ``files`` holds one array per page (``page_files``), or flat rows, which are nested first. Of
    several copies of a page the longest list is taken.
    """
    bare = records.drop("files")
    if "files" in files.columns:
        rank = rank_expr(F.coalesce(F.size("files"), F.lit(0)), F.col("files"))
        joined = best_lookup(bare, files.select("dataset_url", "files"), "dataset_url", rank)
    else:  # nested rows have one list per page already: nothing to choose, and nothing to write first
        joined = grouped_lookup_join(bare, files, "dataset_url", nest_files)
    return joined.select(*[c for c in records.columns if c != "files"], *file_columns())


def file_columns() -> list[Column]:
    """Files without their kind, their count, and the status by it, after a left join."""
    plain = F.transform("files", lambda f: f.dropFields("kind"))
    count = F.coalesce(F.size("files"), F.lit(0))
    found = F.when(count > 0, count).otherwise(0)
    status = F.when(found >= 2, "success").when(found == 1, "partial").otherwise("failed")
    return [
        F.coalesce(plain, F.array().cast(f"array<{FILE.simpleString()}>")).alias("files"),
        found.alias("files_found_count"),
        status.alias("file_extraction_status"),
    ]


def file_stats(files: DataFrame, filed: DataFrame) -> DataFrame:
    """Totals over all records (by status) and all files (by kind and title), one row."""

    def titled(kind: str, word: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.lower("file_title").contains(word))

    by_file = files.agg(
        titled("input", "microscope").alias("microscope_images_found"),
        titled("output", "binned").alias("binned_outputs_found"),
    )
    status = F.col("file_extraction_status")
    by_record = filed.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if(status == "success").alias("successful"),
        F.count_if(status == "partial").alias("partial"),
        F.count_if(status == "failed").alias("failed"),
        F.coalesce(F.sum("files_found_count"), F.lit(0)).cast("bigint").alias("total_files_extracted"),
    )
    return by_record.crossJoin(by_file)  # one row each


def widest(filed: DataFrame) -> int:
    """Length of the longest file list: the number of file column groups."""
    return filed.agg(F.coalesce(F.max(F.size("files")), F.lit(0)).alias("n")).first()["n"]


def files_wide(filed: DataFrame, n: int | None = None) -> DataFrame:
    """One row per record with columns file_1_type … file_n_url; no shuffle."""
    count = widest(filed) if n is None else n
    kept = [c for c in filed.columns if c != "files"]
    columns = [
        F.get("files", F.lit(i))[field].alias(f"file_{i + 1}_{field.removeprefix('file_')}")
        for i in range(count)
        for field in WIDE_FIELDS
    ]
    return filed.select(*kept, *columns)
