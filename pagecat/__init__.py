"""Turn tables of crawled web pages into a checked, enriched catalogue of datasets."""
