"""The website and link/document sources: validated file lists and their tables."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from setlake.functions.predicates import PROJECTS
from setlake.operators.sets import website_members, wikidata_members
from setlake.schemas import DOCUMENT_COLUMNS, LINK_COLUMNS, WEBSITE_COLUMNS
from setlake.sources.files import file_inventory, parquet_files, read_union, validate_columns


@dataclass(frozen=True, slots=True)
class WebsiteSource:
    root: Path
    files: list[Path]

    @classmethod
    def validate(cls, root: Path, spark: SparkSession | None = None) -> WebsiteSource:
        """With a session the footers of many files are read by tasks."""
        files = parquet_files(root / "polygons", "website polygons")
        validate_columns(files, WEBSITE_COLUMNS, "website polygons", spark)
        return cls(root, files)

    def inventory(self) -> list[dict]:
        return file_inventory(self.root, self.files, label="website")

    def members(self, spark: SparkSession) -> DataFrame:
        return website_members(read_union(spark, self.files, WEBSITE_COLUMNS))


@dataclass(frozen=True, slots=True)
class WikidataSource:
    root: Path
    links: list[Path]
    documents: list[Path]

    @classmethod
    def validate(cls, root: Path, spark: SparkSession | None = None) -> WikidataSource:
        """Links and the documents of each supported project; folders of other projects are not read."""
        links = parquet_files(root / "polygon_document_links", "link")
        validate_columns(links, LINK_COLUMNS, "link", spark)
        documents = []
        for project in PROJECTS:
            found = parquet_files(root / project / "documents", f"{project} document")
            validate_columns(found, DOCUMENT_COLUMNS, f"{project} document", spark)
            documents += found
        return cls(root, links, documents)

    def inventory(self) -> list[dict]:
        return file_inventory(self.root, [*self.links, *self.documents], label="wikidata")

    def members(self, spark: SparkSession) -> DataFrame:
        return wikidata_members(read_union(spark, self.links, LINK_COLUMNS), read_union(spark, self.documents, DOCUMENT_COLUMNS, ()))
