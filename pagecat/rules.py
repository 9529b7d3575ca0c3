"""Keyword rules and other fixed values, as data. Operators take them as parameters."""

# ---- Fixed values: these must stay as they are for results to match -------------------------

# Marks of the links that lead to a dataset, and of those that lead back to the listing.
DATASET_LINK = "/datasets/"
LISTING_LINK = "/datasets?"

# Embedded JSON document of a page.
DOCUMENT_OPEN = '<script id="__NEXT_DATA__" type="application/json">'
DOCUMENT_CLOSE = "</script>"

# Pages with nothing new, in a row, after which a crawl stops.
EMPTY_PAGES_TO_STOP = 3

# Cells of a seven-column listing row, by position (0 is the name).
CELL_POSITIONS = {
    "product": 2,
    "species": 3,
    "sample_type": 4,
    "cells_or_nuclei": 5,
    "preservation": 6,
}

# Cells of a five- or six-column row: (field, how to match, words), first rule wins.
CELL_RULES = [
    ("product", "contains", ["spatial", "expression"]),
    ("species", "equals", ["human", "mouse", "rat"]),
    ("preservation", "contains", ["ffpe", "fresh frozen", "fixed frozen"]),
    ("cells_or_nuclei", "equals", ["cells", "nuclei", "n/a"]),
]

# Section headers of a page body: (prefix, section); None closes the open section.
SECTION_HEADERS = [
    ("**Biomaterials**", "biomaterials"),
    ("**Sample preparation**", "sample_preparation"),
    ("**Imaging**", "imaging"),
    ("**", None),
]

# Keys of the imaging section: (field, words), first field with a word inside the key wins.
IMAGING_RULES = [
    ("biomaterials", ["biomaterial", "biomaterials", "bio materials"]),
    ("sample_preparation", ["sample preparation", "sample prep", "preparation"]),
    ("image_type", ["image type", "imaging type", "staining", "stain"]),
    ("microscope", ["microscope", "imaging system"]),
    ("objective_magnification", ["magnification", "objective magnification", "objective mag"]),
    ("numerical_aperture", ["numerical aperture", "na", "n.a."]),
    ("scopeled_light_source", ["light source", "scopeled", "led source", "illumination"]),
    ("camera", ["camera", "detector"]),
    ("exposure", ["exposure", "exposure time", "exposure settings"]),
]

SAMPLE_RULES = [
    ("anatomical_entity", ["anatomical entity", "anatomical location", "tissue", "organ"]),
    ("preservation_method", ["preservation", "preservation method", "fixation"]),
    ("disease_state", ["disease", "disease state", "condition", "pathology"]),
    ("biomaterial_type", ["biomaterial type", "material type", "sample type"]),
    ("donor_count", ["donor", "donor count", "donors", "number of donors"]),
    ("date_published", ["date published", "published", "publication date", "release date"]),
]

# Labels found in free text: (label, words); the first line with a hit decides.
IMAGE_TYPE_RULES = [
    ("H&E", ["h&e", "hematoxylin"]),
    ("IF", ["if", "immunofluorescence"]),
    ("IHC", ["ihc", "immunohistochemistry"]),
]
DISEASE_RULES = [
    ("Healthy", ["healthy", "normal"]),
    ("Cancer", ["cancer", "tumor", "carcinoma"]),
]
PRESERVATION_TEXT_RULES = [
    ("FFPE", ["ffpe", "formalin"]),
    ("Fresh Frozen", ["fresh frozen", "frozen"]),
]

# Labels found anywhere in a page's text: first rule wins.
SPECIES_RULES = [("Human", ["human"]), ("Mouse", ["mouse"])]
PRESERVATION_RULES = [
    ("FFPE", ["ffpe"]),
    ("Fresh Frozen", ["fresh frozen"]),
    ("Fixed Frozen", ["fixed frozen"]),
]
TISSUES = [
    "pancreas",
    "breast",
    "lung",
    "kidney",
    "liver",
    "brain",
    "colon",
    "lymph node",
    "prostate",
    "skin",
]
TISSUE_RULES = [(tissue.title(), [tissue]) for tissue in TISSUES]

# Fields compared with the page: (field, method).
COMPARISONS = [
    ("species", "exact"),
    ("preservation", "normalized"),
    ("sample_type", "substring"),
    ("dataset_name", "case_insensitive"),
]

STATUS_LABELS = {
    "verified": "✓ VERIFIED",
    "mismatched": "✗ MISMATCHED",
    "warning": "⚠ WARNING",
    "failed": "✗ FAILED",
}

# Stages of a run, in order.
STAGES = ["scraper", "validator", "metadata-enricher", "file-extractor"]

# Exit code -> status, by who asks; anything else is the last entry.
STAGE_STATUS = {
    "stage": ({0: "success", 1: "failed"}, "error"),
    "scraper": ({0: "success"}, "failed"),
    "validator": ({0: "success", 1: "warnings"}, "failed"),
    "enricher": ({0: "success", 1: "partial"}, "failed"),
}
