"""The eight row layouts in which a document's tables are exported as CSV."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import export_rows


class Layout(NamedTuple):
    """Exported names in their order, where a name's values come from if not from a column of that name, and the order of rows."""

    columns: list[str]
    source: dict[str, str]
    order: list[str]


# Names and order of the exported columns.
LAYOUTS = {
    "chapter_index": Layout(["chapter_number", "title", "page_number"], {"chapter_number": "section_number", "page_number": "page_start"}, ["page_start", "section_order"]),
    "sections": Layout(["section_order", "section_number", "title", "page_start", "page_end", "confidence", "detection_method"], {}, ["section_order"]),
    "stories": Layout(["story_order", "section_id", "title", "page_start", "page_end", "confidence", "segmentation_method", "text"], {}, ["story_order"]),
    "scenes": Layout(["scene_id", "story_id", "scene_order", "title", "page_start", "page_end", "confidence", "segmentation_method", "text"], {}, ["story_id", "scene_order"]),
    "entities": Layout(["entity_id", "entity_type", "canonical_name", "profile_text", "confidence", "discovery_method"], {}, ["entity_type", "canonical_name"]),
    "entity_mentions": Layout(["mention_id", "entity_id", "scene_id", "story_id", "page_start", "page_end", "mention_text", "context", "confidence"], {}, ["page_start", "scene_id", "mention_id"]),
    "entity_aliases": Layout(["alias_id", "entity_id", "alias", "resolution_method", "confidence"], {}, ["entity_id", "alias"]),
    "events": Layout(["event_id", "scene_id", "event_order", "title", "page_start", "page_end", "confidence", "discovery_method", "text"], {}, ["scene_id", "event_order"]),
}

#: A number of a section that is exported as nothing.
NO_NUMBER = ("0",)


def layout_rows(df: DataFrame, layout: str, *, key: str = "document_id") -> DataFrame:
    """key and the layout's columns as text: numbers with a fraction to 3 places, nulls and sections numbered 0 as empty text.

    A column of the layout that df does not have is exported empty; df's other columns are left out.
    """
    spec = LAYOUTS[layout]
    named = df.select(F.col(key).alias("__key"), *[F.col(at).alias(c) if (at := spec.source.get(c, c)) in df.columns else F.lit(None).cast("string").alias(c) for c in spec.columns])
    shown = export_rows(named, ["__key", *spec.columns]).withColumnRenamed("__key", key)
    for c in ("chapter_number", "section_number"):
        if c in spec.columns:
            shown = shown.withColumn(c, F.when(F.col(c).isin(*NO_NUMBER), "").otherwise(F.col(c)))
    return shown


def export_layout(df: DataFrame, layout: str, path: str, *, key: str = "document_id", folders: bool = False) -> None:
    """The layout's rows as CSV with a header, in the layout's order within each document.

    Rows are divided by ranges of (document, order), so a document of any size is spread over
    several files, whose names follow that order. With folders each document gets a folder
    `key=...` of its own, as a reader of single documents wants it; without, key is the first column.
    """
    spec = LAYOUTS[layout]
    missing = [c for c in spec.order if c not in df.columns]
    if missing:
        raise ValueError(f"{layout} is ordered by {missing}, which the rows do not have")
    ordered = df.repartitionByRange(key, *spec.order).sortWithinPartitions(key, *spec.order)
    writer = layout_rows(ordered, layout, key=key).write.mode("overwrite")
    if folders:
        writer = writer.partitionBy(key)
    writer.csv(path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_layout(spark: SparkSession, layout: str, path: str, *, key: str = "document_id") -> DataFrame:
    """An exported layout as text columns, line breaks within texts included."""
    columns = LAYOUTS[layout].columns
    raw = spark.read.csv(path, header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, enforceSchema=False, inferSchema=False)
    return raw.select(key, *[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def export_all(tables: dict[str, DataFrame], path: str, *, key: str = "document_id", folders: bool = False) -> list[str]:
    """Each of the given tables in the folder of its layout's name; returns the folders."""
    for name, df in tables.items():
        export_layout(df, name, f"{path}/{name}", key=key, folders=folders)
    return [f"{path}/{name}" for name in tables]
