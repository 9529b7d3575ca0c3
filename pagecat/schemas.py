"""Record shapes. All fields are strings unless typed; a missing value is ''."""

from pyspark.sql import types as T


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Field names of records, files and reports.
BASE_FIELDS = [
    "dataset_name",
    "dataset_url",
    "product",
    "species",
    "sample_type",
    "cells_or_nuclei",
    "preservation",
]

IMAGING_FIELDS = [
    "biomaterials",
    "sample_preparation",
    "image_type",
    "microscope",
    "objective_magnification",
    "numerical_aperture",
    "scopeled_light_source",
    "camera",
    "exposure",
]

SAMPLE_FIELDS = [
    "anatomical_entity",
    "preservation_method",
    "disease_state",
    "biomaterial_type",
    "donor_count",
    "date_published",
]

NEW_FIELDS = IMAGING_FIELDS + SAMPLE_FIELDS
ENRICHED_FIELDS = BASE_FIELDS + NEW_FIELDS

PAGES = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        *strings("url", "html"),
    ]
)

BASE_RECORD = T.StructType(strings(*BASE_FIELDS))
ENRICHED_RECORD = T.StructType(strings(*ENRICHED_FIELDS))
# Records of a crawl, stored per run, with their place in the listing.
CRAWLED = T.StructType(
    [
        *strings("run"),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        *strings(*BASE_FIELDS),
    ]
)

FILE = T.StructType(
    [
        *strings("file_title", "file_type", "filename", "size"),
        T.StructField("size_bytes", T.LongType()),
        *strings("md5sum", "url"),
    ]
)

FILED_RECORD = T.StructType(
    [
        *ENRICHED_RECORD.fields,
        T.StructField("files", T.ArrayType(FILE)),
        T.StructField("files_found_count", T.IntegerType()),
        T.StructField("file_extraction_status", T.StringType()),
    ]
)

_SOURCE_FILE = T.StructType(
    [
        *strings("title", "url"),
        T.StructField("bytes", T.LongType()),
        *strings("md5sum"),
    ]
)

FILESET_MAP = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("inputs", T.ArrayType(_SOURCE_FILE)),
            T.StructField("outputs", T.ArrayType(_SOURCE_FILE)),
        ]
    ),
)

# Only what the operators read; donorCount is read as text so that numbers and text both work.
DATASET_NODE = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("anatomicalEntities", T.ArrayType(T.StringType())),
        T.StructField("preservationMethods", T.ArrayType(T.StringType())),
        T.StructField("diseaseStates", T.ArrayType(T.StringType())),
        T.StructField("biomaterialTypes", T.ArrayType(T.StringType())),
        *strings("donorCount", "publishedAt"),
    ]
)


def embedded_doc(dataset: bool = True, filesets: bool = True) -> T.StructType:
    """Schema of the embedded document, cut down to the branches a caller reads."""
    page_props = []
    if dataset:
        page_props.append(T.StructField("dataset", DATASET_NODE))
    if filesets:
        page_props.append(T.StructField("filesetMap", FILESET_MAP))
    return T.StructType(
        [T.StructField("props", T.StructType([T.StructField("pageProps", T.StructType(page_props))]))]
    )


EMBEDDED_DOC = embedded_doc()

DIFFERENCE = T.StructType(strings("field", "severity", "scraped_value", "actual_value", "message"))

URL_RESULT = T.StructType(
    [*strings("dataset_url", "dataset_name", "status"), T.StructField("differences", T.ArrayType(DIFFERENCE))]
)

VALIDATION_REPORT = T.StructType(
    [
        *strings("run", "validation_timestamp"),
        T.StructField("total_datasets", T.LongType()),
        T.StructField(
            "file_consistency",
            T.StructType(
                [
                    T.StructField("passed", T.BooleanType()),
                    T.StructField("json_count", T.LongType()),
                    T.StructField("excel_count", T.LongType()),
                    T.StructField("mismatch_count", T.LongType()),
                ]
            ),
        ),
        T.StructField(
            "url_validation",
            T.StructType(
                [
                    T.StructField(name, T.LongType())
                    for name in ("verified", "mismatched", "warnings", "failed_urls")
                ]
            ),
        ),
        T.StructField("exit_code", T.IntegerType()),
    ]
)
