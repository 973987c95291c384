"""Reading, writing and exporting the engine's tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "document_id string, page_number int, page_type string, source string, text string, raw_text string, ocr_used boolean, quality_score double, method string"
FRAGMENTS = "document_id string, page_number int, frag_idx int, text string, x double, y double, font_size double, confidence double, width double, height double, label string"


def load_pages(spark: SparkSession, path: str, *, form: str = "parquet", schema: str = PAGES) -> DataFrame:
    """Page records with an explicit schema; the scan prunes columns and pushes filters down."""
    return spark.read.schema(schema).format(form).load(path)


def load_fragments(raw: DataFrame, *, drop: tuple[str, ...] = ("page_header", "page_footer"), pages: tuple[int, int] | None = None) -> DataFrame:
    """Positioned fragments without headers, footers and blanks; boxes (x1, y1, x2, y2) become place and size, null where a box is bad."""
    df = raw.filter((F.btrim("text") != "") & ~F.coalesce(F.col("label").isin(list(drop)), F.lit(False)))
    if pages:
        df = df.filter(F.col("page_number").between(*pages))
    if {"x1", "y1", "x2", "y2"} <= set(raw.columns):
        good = (F.col("x2") >= F.col("x1")) & (F.col("y2") >= F.col("y1"))
        df = df.withColumns({"x": F.when(good, F.col("x1")), "y": F.when(good, F.col("y1")), "width": F.when(good, F.col("x2") - F.col("x1")), "height": F.when(good, F.col("y2") - F.col("y1"))}).drop("x1", "y1", "x2", "y2")
    return df


def replace_document(store: DataFrame, incoming: DataFrame, key: str = "path") -> DataFrame:
    """store with all rows of incoming's keys replaced: running it again changes nothing."""
    return store.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def document_header(pages: DataFrame) -> DataFrame:
    """document_id, document_type (text, scanned, mixed, unknown), page_count, scanned_page_count."""
    kinds = F.array_sort(F.collect_set("source"))
    return pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("page_count"), F.count_if(F.col("source") == "ocr").alias("scanned_page_count"), kinds.alias("kinds")).select(
        "document_id",
        F.when(F.size("kinds") == 0, "unknown").when(F.col("kinds") == F.array(F.lit("pdf_text")), "text").when(F.col("kinds") == F.array(F.lit("ocr")), "scanned").otherwise("mixed").alias("document_type"),
        "page_count", "scanned_page_count",
    )


#: Logical plans that do more than read; functions that call into the virtual machine.
_WRITES = ("logical.Command", "logical.ParsedStatement", "logical.InsertIntoStatement")
_CALLS = re.compile(r"\b'?(?:try_)?(?:reflect|java_method)\(", re.I)


def _nodes(gateway, plan) -> Iterator:
    """A parsed plan, its common table expressions and all below them."""
    yield plan
    for part in (plan.children(), plan.innerChildren()):
        for i in range(part.size()):
            if is_instance_of(gateway, part.apply(i), "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"):
                yield from _nodes(gateway, part.apply(i))


def is_read_only(spark: SparkSession, text: str) -> bool:
    """Whether text is one statement whose parsed plan only reads: no command and no insert at any depth, in common table expressions too."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:
        if "ParseException" in type(e).__name__ or "ParseException" in str(e):
            return False
        raise
    gateway = spark.sparkContext._gateway
    writes = any(is_instance_of(gateway, n, f"org.apache.spark.sql.catalyst.plans.{c}") for n in _nodes(gateway, plan) for c in _WRITES)
    return not writes and not _CALLS.search(plan.toString())


def read_only_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a query over the given views. What may run is decided on the parsed plan, not on the text's words.

    The views are seen by this query alone: names that were views before are so again after it.
    """
    if not is_read_only(spark, text):
        raise ValueError("only one statement that reads is allowed")
    before = {name: spark.table(name) for name in views or {} if spark.catalog.tableExists(name)}
    try:
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql(text)
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def store_pages(pages: DataFrame, table: str, path: str, *, buckets: int = 64, key: str = "document_id", order: str = "page_number") -> DataFrame:
    """pages as a table in path, bucketed by document and sorted by page inside each bucket.

    A scan of one document then reads one bucket of `buckets`, and a page range skips row groups
    by their least and largest page.
    """
    pages.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, order).saveAsTable(table)
    return pages.sparkSession.table(table)


def scan(df: DataFrame, where: dict[str, object] | None = None, *, pages: tuple[int, int] | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Point and range scans in a fixed order; equality and page-range filters reach the Parquet scan."""
    for column, value in (where or {}).items():
        df = df.filter(F.col(column) == value)
    if pages:
        df = df.filter(F.col("page_number").between(*pages))
    return df.orderBy(*order) if order else df


def export_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as exported: numbers with a fraction rounded to 3 places, nulls as empty text.

    What is rounded is the binary value itself, to the nearest number of 3 places and, halfway between two,
    to the even one: 8.0925, which is stored a little below that, gives 8.092 and 0.0625 gives 0.062.
    """
    kinds = dict(df.dtypes)

    def shown(c: str) -> Column:
        if kinds[c] not in ("double", "float"):
            return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        value = F.col(c).cast("double")
        odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
        near = F.when(~odd, F.call_function("format_number", value, F.lit("0.###"))).cast("double")
        # the number format takes 0.0005, which is stored a little above that, for halfway between two
        near = F.when((F.abs(value) >= 0.0005) & (F.abs(value) < 0.001), F.signum(value) * 0.001).otherwise(near)
        return F.coalesce(F.when(odd, value).otherwise(near).cast("string"), F.lit("")).alias(c)

    return df.select([shown(c) for c in columns])


def export_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    export_rows(df, columns).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def nested_documents(documents: DataFrame, children: dict[str, tuple[DataFrame, list[str]]], key: str = "document_id") -> DataFrame:
    """One row per document with an ordered array of structs for each child table (name: rows, order)."""
    out = documents
    for name, (rows, order) in children.items():
        fields = order + [c for c in rows.columns if c not in (*order, key)]
        nested = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        out = out.join(nested, key, "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
    return out


def export_document_json(documents: DataFrame, children: dict[str, tuple[DataFrame, list[str]]], path: str) -> None:
    nested_documents(documents, children).write.mode("overwrite").json(path)


def export_packages(packages: DataFrame, path: str) -> None:
    """One JSON record per scene package."""
    packages.write.mode("overwrite").json(path)


def export_texts(prompts: DataFrame, path: str) -> None:
    """prompts (kind, text): one folder of text files for each kind."""
    prompts.select("kind", F.col("text").alias("value")).write.mode("overwrite").partitionBy("kind").text(path)


def export_summary(packages: DataFrame) -> DataFrame:
    """One row: scenes, passed, failed, and how often each error occurs (packages: scene_id, errors)."""
    errors = packages.select(F.explode("errors").alias("error")).groupBy("error").count()
    histogram = errors.agg(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("n"), "error"))).alias("h")).select(F.transform("h", lambda e: F.struct(e["error"].alias("error"), (-e["n"]).alias("count"))).alias("errors"))
    return packages.agg(F.count(F.lit(1)).alias("scenes"), F.count_if(F.size("errors") == 0).alias("passed"), F.count_if(F.size("errors") > 0).alias("failed")).crossJoin(F.broadcast(histogram))


#: UTF-8 read as Windows-1252, and what was meant.
MOJIBAKE = [("â€™", "'"), ("â€˜", "'"), ("â€œ", '"'), ("â€\u009d", '"'), ("â€“", "-"), ("â€”", "-"), ("Ã©", "é"), ("Ã¨", "è"), ("Â", "")]


def clean_index(index: DataFrame) -> DataFrame:
    """Titles repaired and trimmed, page numbers as whole numbers; rows without either left out."""
    title = F.col("title")
    for wrong, right in MOJIBAKE:
        title = F.replace(title, F.lit(wrong), F.lit(right))
    return index.withColumns({"title": F.btrim(F.regexp_replace(title, r"\s+", " ")), "page_number": F.expr("try_cast(page_number AS int)")}).filter("title <> '' AND page_number IS NOT NULL")
