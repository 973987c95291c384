"""Sections' page ranges, stories, scenes, chunks and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import range_join
from ..functions.text import squeezed, trimmed_items


def section_ranges(sections: DataFrame, pages: DataFrame) -> DataFrame:
    """sections (document_id, page_number, confidence, ...) with section_order, page_start and page_end.

    A section ends before the next one starts, at its own start at the earliest; the last
    ends with the document. Sections beyond the last page are dropped before numbering.
    """
    ends = pages.groupBy("document_id").agg(F.max("page_number").alias("last_page"))
    w = Window.partitionBy("document_id").orderBy("page_number", F.desc("confidence"), "title")
    held = sections.join(ends, "document_id").filter("page_number <= last_page")
    return (
        held.withColumn("section_order", F.row_number().over(w))
        .withColumn("page_end", F.greatest(F.col("page_number"), F.coalesce(F.lead("page_number").over(w) - 1, F.col("last_page"))))
        .withColumnRenamed("page_number", "page_start").drop("last_page")
    )


def page_sections(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """Each page with every section that holds it; a page where two sections start can be in both."""
    spans = sections.select("document_id", "section_order", "page_start", "page_end")
    return range_join(pages, spans, ["document_id"], "page_number", "page_start", "page_end")


def unassigned_pages(pages: DataFrame, sections: DataFrame) -> DataFrame:
    return range_join(pages, sections.select("document_id", "page_start", "page_end"), ["document_id"], "page_number", "page_start", "page_end", how="left_anti")


def stories(pages: DataFrame, sections: DataFrame, para_sep: str = "\n\n") -> DataFrame:
    """One story per section: its non-blank pages in order, joined; empty ones dropped, the rest renumbered."""
    joined = page_sections(pages.select("document_id", "page_number", "text").filter(F.btrim("text") != ""), sections)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda p: p["text"]), para_sep)
    told = joined.groupBy("document_id", "section_order").agg(text.alias("text"))
    # numbers are given to the sections that have text, without it: ordering texts would move them once more
    order = F.row_number().over(Window.partitionBy("document_id").orderBy("section_order"))
    heads = joined.select("document_id", "section_order").distinct().join(sections.select("document_id", "section_order", "title", "page_start", "page_end"), ["document_id", "section_order"])
    titled = told.join(heads.withColumn("story_order", order), ["document_id", "section_order"])
    return titled.select("document_id", "story_order", "section_order", F.concat(F.col("section_order").cast("string"), F.lit(". "), "title").alias("title"), "page_start", "page_end", "text")


def scenes(stories: DataFrame, *, target: int = 3500, minimum: int = 900, para_sep: str = "\n\n", split_on: str = r"\n\s*\n+") -> DataFrame:
    """Stories cut into scenes: paragraphs gather until a scene has `minimum` characters and the next would pass `target`.

    A short tail joins the scene before it. The separator counts before a scene is closed,
    so every scene after the first starts as much longer, as in the original rule.
    """
    gap = len(para_sep)
    paragraphs = F.filter(trimmed_items(F.split(F.btrim("text"), split_on)), lambda p: p != "")
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("groups"), none.alias("now"), F.lit(0).alias("size"))

    def add(s, p):
        extra = F.length(p) + F.when(F.size(s["now"]) > 0, gap).otherwise(0)
        close = (F.size(s["now"]) > 0) & (s["size"] >= minimum) & (s["size"] + extra > target)
        return F.struct(
            F.when(close, F.concat(s["groups"], F.array(F.array_join(s["now"], para_sep)))).otherwise(s["groups"]).alias("groups"),
            F.when(close, F.array(p)).otherwise(F.concat(s["now"], F.array(p))).alias("now"),
            F.when(close, extra).otherwise(s["size"] + extra).alias("size"),
        )

    def finish(s):
        tail, last = F.array_join(s["now"], para_sep), F.size(s["groups"])
        short = (last > 0) & (s["size"] < minimum)
        merged = F.concat(F.slice(s["groups"], 1, F.greatest(last - 1, F.lit(0))), F.array(F.concat_ws(para_sep, F.try_element_at(s["groups"], F.greatest(last, F.lit(1))), tail)))
        return F.when(F.size(s["now"]) == 0, s["groups"]).when(short, merged).otherwise(F.concat(s["groups"], F.array(tail)))

    cut = stories.withColumn("__p", paragraphs).filter(F.size("__p") > 0)
    whole = F.array(F.btrim("text"))
    groups = F.when(F.size("__p") <= 1, whole).otherwise(F.aggregate("__p", start, add, finish))
    method = F.when(F.size("__p") <= 1, "story_default").otherwise("paragraph_group")
    return (
        cut.withColumn("strategy", method)
        .select("document_id", "story_order", "title", "page_start", "page_end", "strategy", F.posexplode(groups).alias("__i", "text"))
        .withColumn("scene_order", F.col("__i") + 1).drop("__i")
    )


def page_shapes(pages: DataFrame) -> DataFrame:
    """pages with `size`, the text's length, `paragraphs`, the lengths of its trimmed lines that are not empty, and `blank`, instead of the text."""
    lines = F.filter(trimmed_items(F.split("text", "\n")), lambda p: p != "")
    return pages.withColumns({"size": F.length("text"), "paragraphs": F.transform(lines, lambda p: F.length(p)), "blank": F.coalesce(F.btrim("text") == "", F.lit(True))}).drop("text")


def story_shapes(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """stories() of pages joined by line breaks, with the lengths of their paragraphs (lines) instead of their texts."""
    joined = page_sections(pages.filter(~F.col("blank")).select("document_id", "page_number", "paragraphs"), sections)
    lengths = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "paragraphs"))), lambda p: p["paragraphs"]))
    told = joined.groupBy("document_id", "section_order").agg(lengths.alias("paragraphs")).join(sections.select("document_id", "section_order", "page_start", "page_end"), ["document_id", "section_order"])
    return told.withColumn("story_order", F.row_number().over(Window.partitionBy("document_id").orderBy("section_order")))


def scene_shapes(stories: DataFrame, *, target: int = 3500, minimum: int = 900, gap: int = 1) -> DataFrame:
    """scenes() of story_shapes: the same rule on lengths. `size` is null for a story that is one scene, whose pages are the story's."""
    start = F.struct(F.array().cast("array<int>").alias("groups"), F.lit(-1).alias("now"), F.lit(0).alias("size"))

    def add(s, n):
        some = s["now"] >= 0
        extra = n + F.when(some, gap).otherwise(0)
        close = some & (s["size"] >= minimum) & (s["size"] + extra > target)
        return F.struct(
            F.when(close, F.concat(s["groups"], F.array(s["now"]))).otherwise(s["groups"]).alias("groups"),
            F.when(close | ~some, n).otherwise(s["now"] + gap + n).alias("now"),
            F.when(close, extra).otherwise(s["size"] + extra).alias("size"),
        )

    def finish(s):
        last = F.size(s["groups"])
        merged = F.concat(F.slice(s["groups"], 1, F.greatest(last - 1, F.lit(0))), F.array(F.try_element_at(s["groups"], F.greatest(last, F.lit(1))) + gap + s["now"]))
        return F.when((last > 0) & (s["size"] < minimum), merged).otherwise(F.concat(s["groups"], F.array(s["now"])))

    one = F.size("paragraphs") <= 1
    cut = stories.filter(F.size("paragraphs") > 0).withColumn("strategy", F.when(one, "story_default").otherwise("paragraph_group"))
    groups = F.when(one, F.array(F.lit(None).cast("int"))).otherwise(F.aggregate("paragraphs", start, add, finish))
    cut = cut.select("document_id", "story_order", "page_start", "page_end", "strategy", F.posexplode(groups).alias("__i", "size"))
    return cut.withColumn("scene_order", F.col("__i") + 1).drop("__i")


STRETCH = 16_384


def scene_pages(scenes: DataFrame, stories: DataFrame, pages: DataFrame, para_sep: str = "\n\n") -> DataFrame:
    """Scenes with the pages that their text touches, from running offsets of pages and scenes in the story.

    Texts or shapes (page_shapes, story_shapes, scene_shapes): lengths are all that is looked at.
    Pages and scenes meet by stretches of STRETCH characters, so a long section is no single group.
    """
    gap = len(para_sep)
    size = lambda df: F.col("size") if "size" in df.columns else F.length("text")
    told = pages.filter(~F.col("blank")) if "blank" in pages.columns else pages.filter(F.btrim("text") != "")
    text = page_sections(told.select("document_id", "page_number", size(pages).alias("size")), stories)
    w = Window.partitionBy("document_id", "section_order").orderBy("page_number")
    at = text.withColumn("until", F.sum(F.col("size") + gap).over(w) - gap).withColumn("since", F.col("until") - F.col("size"))
    s = Window.partitionBy("document_id", "story_order").orderBy("scene_order")
    sizes = scenes.select("document_id", "story_order", "scene_order", size(scenes).alias("size"))
    placed = sizes.withColumn("stop", F.sum(F.col("size") + gap).over(s) - gap).withColumn("start", F.col("stop") - F.col("size"))
    keyed = placed.join(stories.select("document_id", "story_order", "section_order"), ["document_id", "story_order"])
    stretches = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / STRETCH), F.floor(F.greatest(F.col(a), F.col(b) - 1) / STRETCH))).alias("__stretch")
    left = keyed.select("document_id", "section_order", "story_order", "scene_order", "start", "stop", stretches("start", "stop"))
    right = at.select("document_id", "section_order", "page_number", "since", "until", stretches("since", "until"))
    met = left.join(right, ["document_id", "section_order", "__stretch"]).filter("until > start AND since < stop")
    found = met.groupBy("document_id", "story_order", "scene_order").agg(F.min("page_number").alias("__a"), F.max("page_number").alias("__b"))
    own = F.col("strategy") == "story_default"
    return scenes.join(found, ["document_id", "story_order", "scene_order"], "left").withColumns({
        "page_start": F.when(own, F.col("page_start")).otherwise(F.coalesce("__a", "page_start")),
        "page_end": F.when(own, F.col("page_end")).otherwise(F.coalesce("__b", "page_end")),
    }).drop("__a", "__b")


def chunk_texts(texts: DataFrame, text: str = "text", *, size: int = 2000, overlap: int = 200) -> DataFrame:
    """texts with chunk_index, chunk_text, char_count and token_count: windows of `size` characters that overlap, up to the end."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and overlap below it")
    step, flat = size - overlap, squeezed(F.col(text))
    last = F.floor(F.greatest(F.length("__flat") - overlap - 1, F.lit(0)) / step).cast("int")
    cut = texts.withColumn("__flat", flat).filter(F.length("__flat") > 0).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), last)))
    chunk = F.btrim(F.substr("__flat", F.col("chunk_index") * step + 1, F.lit(size)))
    return cut.withColumn("chunk_text", chunk).drop("__flat").withColumns({"char_count": F.length("chunk_text"), "token_count": F.size(F.split("chunk_text", r"\s+"))})


def chunks(pages: DataFrame, sections: DataFrame, *, size: int = 2000, overlap: int = 200) -> DataFrame:
    """Chunks of every page of a section, and of pages in none (section_order null)."""
    kept = pages.select("document_id", "page_number", "text")
    inside = page_sections(kept, sections).select("document_id", "section_order", "page_number", "text")
    outside = unassigned_pages(kept, sections).withColumn("section_order", F.lit(None).cast("int"))
    return chunk_texts(inside.unionByName(outside), size=size, overlap=overlap).drop("text").withColumnRenamed("chunk_text", "text")


def events(scenes: DataFrame, *, more: tuple[str, ...] = ()) -> DataFrame:
    """One event per scene. more: columns of the scene that its event has too."""
    return scenes.select("document_id", "story_order", "scene_order", F.lit(1).alias("event_order"), "text", F.lit(0.4).alias("confidence"), *more)
