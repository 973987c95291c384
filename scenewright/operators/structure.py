"""From positioned fragments or lines to sections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions import lexicons as L
from ..functions.ranges import first_of
from ..functions.text import squeezed

PAGE = ["document_id", "page_number"]
NUMBER = r"^\d+[.,:;]?$"
ROMAN = r"^(?i)[IVXLCDM]+[.,:;]?$"
INLINE = r"^(\d{1,4})[.)\-:]?\s+(.{2,100})$"
CANONICAL = r"^M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})$"


def page_stats(fragments: DataFrame) -> DataFrame:
    """Per page body_size (median font size or height, 20 without any) and width (1000 without any)."""
    size = F.when(F.abs("font_size") > 0.1, F.abs("font_size")).otherwise(F.when(F.abs("height") > 0.1, F.abs("height")))
    return fragments.groupBy(*PAGE).agg(F.coalesce(F.percentile(size, 0.5), F.lit(20.0)).alias("body_size"), F.coalesce(F.max(F.col("x") + F.coalesce("width", F.lit(0.0))), F.lit(1000.0)).alias("page_width"))


def _following(fragments: DataFrame, stats: DataFrame, reach: int) -> DataFrame:
    w = Window.partitionBy(*PAGE).orderBy("frag_idx").rowsBetween(1, reach)
    here = F.struct("frag_idx", F.btrim("text").alias("text"), "x", "y")
    return fragments.join(stats, PAGE).withColumn("next", F.collect_list(here).over(w)).withColumn("size", F.coalesce(F.abs("font_size"), F.abs("height"), "body_size"))


def _title(next_: Column, y: Column, body: Column, *, words: int = 6, headers: tuple[str, ...] = ()) -> Column:
    """Fragments of the same row, else of the next row, else those that follow up to a sentence end, a running header or a long one."""
    apart = F.greatest(0.75 * body, F.lit(10.0))
    same = F.filter(next_, lambda f: f["y"].isNotNull() & (F.abs(f["y"] - y) <= apart))
    under = F.filter(next_, lambda f: f["y"].isNotNull() & (F.abs(f["y"] - y) > apart) & (F.abs(f["y"] - y) <= 3 * apart))

    def gather(state: Column, f: Column) -> Column:
        stop = F.lower(f["text"]).isin(list(headers)) | (F.size(F.split(f["text"], r"\s+")) > words) | f["text"].rlike("[.!?]$") | f["text"].rlike(NUMBER)
        return F.struct((state["done"] | stop).alias("done"), F.when(state["done"] | stop, state["n"]).otherwise(state["n"] + 1).alias("n"))

    rest = F.aggregate(next_, F.struct(F.lit(False).alias("done"), F.lit(0).alias("n")), gather, lambda s: s["n"])
    return F.when(F.size(same) > 0, same).when(F.size(under) > 0, under).otherwise(F.slice(next_, 1, rest))


def heading_candidates(fragments: DataFrame, stats: DataFrame | None = None, *, keywords: list[str] | None = None, headers: tuple[str, ...] = (), reach: int = 11) -> DataFrame:
    """page, text, number, title, score, reasons, parts (the placed fragments it is made of): keyword, number and inline-number headings; the best of each text and page.

    "Near" is within the distance of the next row.
    """
    stats = page_stats(fragments) if stats is None else stats
    df = _following(fragments, stats, reach).withColumn("text", F.btrim("text"))
    large = F.col("size") >= 1.15 * F.col("body_size")
    apart = F.greatest(0.75 * F.col("body_size"), F.lit(10.0))
    near = F.filter(F.slice("next", 1, 7), lambda f: f["text"].rlike(NUMBER) | f["text"].rlike(ROMAN))
    near = F.filter(near, lambda f: f["y"].isNull() | F.col("y").isNull() | (F.abs(f["y"] - F.col("y")) <= 3 * apart))
    title = F.btrim(F.array_join(F.transform("title_parts", lambda f: f["text"]), " "))
    parts = _title(F.col("next"), F.col("y"), F.col("body_size"), headers=tuple(h.lower() for h in headers))
    words = F.size(F.split(F.col("title"), r"\s+"))
    score = lambda *rules: sum((F.when(c, w).otherwise(0) for c, w in rules), F.lit(0))
    names = lambda *rules: F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules]))
    titled = df.withColumn("title_parts", parts).withColumn("title", title)
    number = F.try_element_at(near, F.lit(1))["text"]
    place = lambda f: F.struct(f["text"].alias("text"), f["x"].cast("double").alias("x"), f["y"].cast("double").alias("y"))
    own = lambda t: F.struct(t.alias("text"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    following = F.transform("title_parts", place)
    numeral = F.filter(F.array(F.when(number.isNotNull(), place(F.try_element_at(near, F.lit(1))))), lambda f: f.isNotNull())
    has_title, prose = F.col("title") != "", (words > 10) | F.col("title").rlike("[.!?]$")
    shared = [*PAGE, "frag_idx", "x", "y"]
    by_word = titled.filter(F.lower(F.regexp_replace("text", "[.,:;]$", "")).isin(keywords or L.HEADING_KEYWORDS)).select(
        *shared, F.btrim(F.concat_ws(" ", "text", number, "title")).alias("text"), number.alias("number"), "title",
        score((F.lit(True), 3), (large, 2), (number.isNotNull(), 3), (has_title, 2)).alias("score"), names((F.lit(True), "keyword"), (large, "large"), (number.isNotNull(), "number_near"), (has_title, "title")).alias("reasons"),
        F.concat(F.array(own(F.col("text"))), numeral, following).alias("parts"),
    )
    by_number = titled.filter(F.col("text").rlike(NUMBER) & has_title & ~prose).select(
        *shared, F.concat_ws(" ", "text", "title").alias("text"), F.col("text").alias("number"), "title",
        score((F.lit(True), 5), (large, 2), (has_title, 3)).alias("score"), names((F.lit(True), "number"), (large, "large"), (has_title, "title")).alias("reasons"),
        F.concat(F.array(own(F.col("text"))), following).alias("parts"),
    )
    inline_title = F.regexp_extract("text", INLINE, 2)
    shaped = (F.size(F.split(inline_title, r"\s+")) <= 8) & inline_title.rlike(r"^\p{Lu}")
    inline = df.filter(F.col("text").rlike(INLINE) & ~F.col("text").rlike("[.!?]$") & (large | shaped)).select(
        *shared, "text", F.regexp_extract("text", INLINE, 1).alias("number"), inline_title.alias("title"),
        score((F.lit(True), 5), (large, 2), (shaped, 1)).alias("score"), names((F.lit(True), "inline_number"), (large, "large"), (shaped, "shape")).alias("reasons"),
        F.array(own(F.regexp_extract("text", INLINE, 1)), own(inline_title)).alias("parts"),
    )
    every = by_word.unionByName(by_number).unionByName(inline).withColumn("__low", F.lower("text"))
    return first_of(every, [*PAGE, "__low"], [F.desc("score"), F.col("frag_idx")]).drop("__low")


def labelled_candidates(fragments: DataFrame, label: str = "section_header") -> DataFrame:
    """Fragments that a layout model marked as headings and that read `numeral title`: score 10."""
    pattern = r"^(?i)((?:[IVXLCDM]+|\d{1,4}))[.)\-:]?\s+(.+)$"
    text = squeezed(F.col("text"))
    title = F.regexp_extract(text, pattern, 2)
    good = title.rlike(r"\p{L}") & (F.length(title) <= 140) & ~title.rlike(r"(?i)isbn|https?://|www\.")
    return fragments.filter((F.col("label") == label) & good).select(*PAGE, "frag_idx", "x", "y", text.alias("text"), F.regexp_extract(text, pattern, 1).alias("number"), title.alias("title"), F.lit(10).alias("score"), F.array(F.lit("labelled_heading")).alias("reasons"), F.array(*[F.struct(F.regexp_extract(text, pattern, k).alias("text"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")) for k in (1, 2)]).alias("parts"))


def select_candidates(layout: DataFrame, labelled: DataFrame) -> DataFrame:
    """A page with exactly one labelled heading uses it alone, other pages use both kinds."""
    one = labelled.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(*PAGE)
    return labelled.unionByName(layout.select(labelled.columns).join(one, PAGE, "left_anti"))


def classify_pages(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """page_type: NORMAL, CONTENTS (two numbered headings), SECTION_START (a titled, numbered one of 7 or more), UNKNOWN; and the strongest score."""
    numbered = F.col("number").isNotNull() & (F.col("number") != "")
    strong = F.max(F.when(numbered & (F.col("title") != ""), F.col("score")))
    found = candidates.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), F.count_if(numbered).alias("numbered"), strong.alias("best"), F.max("score").alias("strongest"))
    kind = F.when(F.col("n").isNull(), "NORMAL").when(F.col("numbered") >= 2, "CONTENTS").when(F.col("best") >= 7, "SECTION_START").otherwise("UNKNOWN")
    return pages.select(*PAGE).distinct().join(found, PAGE, "left").select(*PAGE, kind.alias("page_type"), "strongest")


#: How far right of the number a fragment belongs to another column, how far apart in height a title's fragments may lie, and marks of page numbers.
FAR_RIGHT, TITLE_SPREAD = 250.0, 40.0
PAGE_MARKS, ARTEFACTS = ["PAGE", "@PAGE", "AGE", "E", "E@", "»"], ["@PAGE", "PAGE", "AGE", "E@"]


def _numeral(text: Column) -> Column:
    bare = F.regexp_replace(F.btrim(text), "[.,:;]+$", "")
    return bare.rlike(NUMBER) | bare.rlike(ROMAN)


def title_parts(parts: Column) -> Column:
    """Of a candidate's fragments (text, x, y) those of the title, in order: after a number, no number, keyword or page mark, and not far right of the last number."""
    none = F.filter(F.transform(parts, lambda f: F.struct(f["text"].alias("text"), f["x"].alias("x"), f["y"].alias("y"))), lambda f: F.lit(False))
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(False).alias("seen"), none.alias("title"))

    def step(s: Column, f: Column) -> Column:
        number, text = _numeral(f["text"]), F.btrim(f["text"])
        keyword = F.lower(F.btrim(text, F.lit(".,:;"))).isin(L.HEADING_KEYWORDS)
        far = F.coalesce(f["x"] > s["x"] + FAR_RIGHT, F.lit(False))
        take = s["seen"] & ~number & ~keyword & ~far & (text != "") & ~F.upper(text).isin(ARTEFACTS)
        own = F.struct(text.alias("text"), f["x"].alias("x"), f["y"].alias("y"))
        return F.struct(F.when(number, f["x"]).otherwise(s["x"]).alias("x"), (s["seen"] | number).alias("seen"), F.when(take, F.concat(s["title"], F.array(own))).otherwise(s["title"]).alias("title"))

    return F.aggregate(parts, start, step, lambda s: s["title"])


def validate_sections(candidates: DataFrame, page_types: DataFrame, *, least: float = 7.0) -> DataFrame:
    """section_number, title, page_number, confidence of candidates whose fragments hold a number and a title and that score `least` or more.

    On top of the candidate's score: +2 and +2 for number and title, +1.5 where two fragments of
    the title or more lie within TITLE_SPREAD in height, -5 on pages that look like contents, -4
    where a fragment is a page mark. An entry with a number or page mark more than FAR_RIGHT to
    the right of its first number is a line of a table of contents and is left out.
    """
    is_number = F.filter("parts", lambda f: _numeral(f["text"]))
    first = F.try_element_at(is_number, F.lit(1))
    rows = candidates.filter(F.size(is_number) > 0).withColumns({"first": first, "named": title_parts(F.col("parts"))}).filter(F.size("named") > 0)
    listed = F.exists("parts", lambda f: F.coalesce(f["x"] > F.col("first.x") + FAR_RIGHT, F.lit(False)) & (_numeral(f["text"]) | F.upper(F.btrim(f["text"])).isin(PAGE_MARKS)))
    heights = F.transform(F.filter("named", lambda f: f["y"].isNotNull()), lambda f: f["y"])
    together = (F.size(heights) >= 2) & (F.array_max(heights) - F.array_min(heights) <= TITLE_SPREAD)
    marked = F.exists("parts", lambda f: F.upper(F.btrim(f["text"])).isin(ARTEFACTS))
    confidence = F.col("score") + 4.0 + F.when(together, 1.5).otherwise(0.0) - F.when(F.col("page_type") == "CONTENTS", 5.0).otherwise(0.0) - F.when(marked, 4.0).otherwise(0.0)
    by_x = F.array_sort(F.transform("named", lambda f, i: F.struct(F.coalesce(f["x"], F.lit(0.0)).alias("x"), i.alias("i"), f["text"].alias("text"))))
    title = F.array_join(F.transform(by_x, lambda f: f["text"]), " ")
    number = F.upper(F.regexp_replace(F.btrim("first.text"), "[.,:;]+$", ""))
    kept = rows.filter(~listed).join(page_types.select(*PAGE, "page_type"), PAGE).withColumn("confidence", confidence).filter(F.col("confidence") >= least)
    return kept.select(*PAGE, number.alias("section_number"), title.alias("title"), "confidence", F.lit("layout").alias("detection_method"))


def numeral_table(spark) -> DataFrame:
    """Roman numerals of 1 to 3999 by rule."""
    def place(unit: str, five: str, ten: str, digit: Column) -> Column:
        forms = ["", unit, unit * 2, unit * 3, unit + five, five, five + unit, five + unit * 2, five + unit * 3, unit + ten]
        return F.array(*[F.lit(f) for f in forms])[digit.cast("int")]

    n = F.col("value")
    roman = F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), place("C", "D", "M", F.floor(n / 100) % 10), place("X", "L", "C", F.floor(n / 10) % 10), place("I", "V", "X", n % 10))
    return spark.range(1, 4000).select(F.col("id").cast("int").alias("value")).select("value", roman.alias("numeral"))


def normalize_numerals(tokens: DataFrame, *, variants: dict[str, str] | None = None, column: str = "token", longest: int = 12, digits: bool = False) -> DataFrame:
    """original, normalized, changed, confidence of distinct numeral tokens that a scan may have garbled.

    Canonical numerals stay; else every replacement by look-alikes is tried, and the one with
    the fewest that is canonical wins, the first of several (1 - 0.5 * replaced / length).
    Tokens of digits alone are left as they are; digits=True reads them as letters too.
    """
    spark = tokens.sparkSession
    table = L.NUMERAL_VARIANTS if variants is None else variants
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))]
    options = F.create_map(*pairs)
    clean = F.upper(F.regexp_replace(column, r"[^\p{L}\p{N}]", ""))
    distinct = tokens.select(F.col(column).alias("original"), clean.alias("s")).distinct().filter("s <> ''")
    plain = distinct.filter(F.col("s").rlike(CANONICAL) | ((F.lit(not digits)) & F.col("s").rlike(r"^\d+$")))
    same = plain.select("original", F.col("s").alias("normalized"), F.lit(False).alias("changed"), F.lit(1.0).alias("confidence"))
    hard = distinct.join(plain, ["original", "s"], "left_anti").filter(F.length("s") <= longest)
    start = F.array(F.struct(F.lit("").alias("t"), F.lit(0).alias("n")))

    def grow(done: Column, c: Column) -> Column:
        each = F.transform(done, lambda d: F.concat(F.array(F.struct(F.concat(d["t"], c).alias("t"), d["n"].alias("n"))), F.transform(F.coalesce(options[c], F.array().cast("array<string>")), lambda v: F.struct(F.concat(d["t"], v).alias("t"), (d["n"] + 1).alias("n")))))
        return F.flatten(each)

    tried = hard.select("original", "s", F.posexplode(F.aggregate(F.split("s", ""), start, grow)).alias("at", "f")).select("original", "s", "at", "f.t", "f.n")
    fits = tried.join(F.broadcast(numeral_table(spark)), tried["t"] == F.col("numeral"))
    best = first_of(fits, ["original"], [F.col("n"), F.col("at")])
    return same.unionByName(best.select("original", F.col("t").alias("normalized"), F.lit(True).alias("changed"), F.round(1 - 0.5 * F.col("n") / F.length("s"), 6).alias("confidence")))


def reconcile_sections(sections: DataFrame, numerals: DataFrame | None = None) -> DataFrame:
    """Sections with corrected numbers, one of each (page, number, title), without noise.

    A corrected number scales the confidence by 0.90 + 0.05 of its own. Numbers that are no
    numeral, titles that begin in lower case and short ones of mixed case go (below 16).
    """
    numbers = normalize_numerals(sections.select(F.col("section_number").alias("token"))) if numerals is None else numerals
    numbers = numbers.select(F.col("original").alias("section_number"), "normalized", "changed", F.col("confidence").alias("__sure"))
    df = sections.join(numbers, "section_number").withColumn("confidence", F.when(F.col("changed"), F.col("confidence") * (0.90 + 0.05 * F.col("__sure"))).otherwise(F.col("confidence")))
    df = df.withColumn("section_number", F.col("normalized")).drop("normalized", "changed", "__sure")
    noisy = (F.col("title").rlike(r"^\p{Ll}") | ((F.length("title") <= 4) & F.col("title").rlike(r"\p{Ll}\p{Lu}"))) & (F.col("confidence") < 16)
    kept = df.filter(~noisy).withColumn("__t", F.upper("title"))
    return first_of(kept, ["document_id", "page_number", "section_number", "__t"], [F.desc("confidence"), F.col("title")]).drop("__t")


def recover_sections(candidates: DataFrame, page_types: DataFrame, sections: DataFrame) -> DataFrame:
    """sections with headings of weak pages (no contents, strongest 5 or more) whose page and number are not there yet."""
    weak = page_types.filter("page_type <> 'CONTENTS' AND strongest >= 5")
    found = validate_sections(candidates, weak, least=6.0).withColumn("detection_method", F.lit("recovery"))
    return sections.unionByName(found.join(sections.select(*PAGE, "section_number"), [*PAGE, "section_number"], "left_anti").select(sections.columns))


def plausible_sections(sections: DataFrame) -> DataFrame:
    return sections.filter(F.col("title").rlike(r"\p{L}") & ~F.col("title").rlike(r"^[\s$€£\d.,]+$"))


def lines_of(pages: DataFrame, *kept: Column) -> DataFrame:
    return pages.select(*PAGE, *kept, F.posexplode(F.split("text", r"\r?\n")).alias("line_idx", "line")).withColumn("line", F.btrim("line"))


def line_headings(pages: DataFrame, *, keywords: list[str] | None = None) -> DataFrame:
    """Lines with heading signals: keyword 4, numbered 2, roman numeral 2, short title 0.5, a scan confidence of 0.9 and more 0.5 (where pages have a column `confidence`); 2 and more stay."""
    words = [*(keywords or L.HEADING_KEYWORDS), *([] if keywords else ["introduction", "conclusion"])]
    scanned = F.coalesce(F.col("confidence") >= 0.9, F.lit(False)) if "confidence" in pages.columns else F.lit(False)
    lines = lines_of(pages, scanned.alias("scanned")).filter("line <> ''")
    parts = F.split(F.lower("line"), r"\s+")
    keyword, numbered, roman = F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])), F.col("line").rlike(r"^\d{1,4}[.):]?(?:\s+\S.*)?$"), F.col("line").rlike(ROMAN)
    short = (F.size(parts) <= 8) & F.col("line").rlike(r"^\p{Lu}") & ~F.col("line").rlike("[.!?,;]$")
    score = F.when(keyword, 4.0).otherwise(0.0) + F.when(numbered, 2.0).otherwise(0.0) + F.when(roman, 2.0).otherwise(0.0) + F.when(short, 0.5).otherwise(0.0) + F.when(F.col("scanned"), 0.5).otherwise(0.0)
    why = F.array_compact(F.array(F.when(keyword, F.lit("heading-keyword")), F.when(numbered, F.lit("numbered-heading")), F.when(roman, F.lit("roman-number")), F.when(short, F.lit("short-title")), F.when(F.col("scanned"), F.lit("clear-scan"))))
    return lines.select(*PAGE, "line_idx", "line", score.alias("score"), why.alias("reasons")).filter("score >= 2")


def line_sections(pages: DataFrame, *, keywords: list[str] | None = None, reach: int = 20) -> DataFrame:
    """Sections from keyword lines: number on the line or the next, then title lines until prose, a marker or punctuation.

    A page with several keyword lines is a table of contents and gives none.
    """
    pattern = rf"^(?i)({'|'.join(keywords or L.HEADING_KEYWORDS)})\b\s*([IVXLCDM]+|\d{{1,4}})?\s*[.:\-]?\s*(.*)$"
    lines = lines_of(pages).filter("line <> ''")
    w = Window.partitionBy(*PAGE).orderBy("line_idx")
    df = lines.withColumn("after", F.collect_list("line").over(w.rowsBetween(1, reach))).filter(F.col("line").rlike(pattern) & (F.size(F.split("line", r"\s+")) <= 10))
    df = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*PAGE))).filter("n = 1")
    own = F.regexp_extract("line", pattern, 2)
    below = F.coalesce(F.try_element_at("after", F.lit(1)), F.lit(""))
    takes_next = (own == "") & (below.rlike(NUMBER) | below.rlike(ROMAN))
    rest = F.when(takes_next, F.slice("after", 2, reach)).otherwise(F.col("after"))

    def gather(state: Column, line: Column) -> Column:
        letters = F.regexp_count(line, F.lit(r"\p{L}"))
        prose = (F.regexp_count(line, F.lit(r"\p{Ll}")) > 0.35 * letters) & (F.size(F.split(line, r"\s+")) > 8)
        stop = state["done"] | prose | line.rlike(pattern) | line.rlike("[.!?;,]$")
        return F.struct(stop.alias("done"), F.when(stop, state["text"]).otherwise(F.btrim(F.concat_ws(" ", state["text"], line))).alias("text"))

    gathered = F.aggregate(rest, F.struct(F.lit(False).alias("done"), F.regexp_extract("line", pattern, 3).alias("text")), gather, lambda s: s["text"])
    number = F.upper(F.regexp_replace(F.when(takes_next, below).otherwise(own), "[.,:;]$", ""))
    out = df.select(*PAGE, number.alias("section_number"), gathered.alias("title"))
    return out.withColumn("confidence", F.lit(4.0) + F.when(F.col("section_number") != "", 2.0).otherwise(0.0) + F.when(F.col("title") != "", 1.0).otherwise(0.0)).withColumn("detection_method", F.lit("lines"))


def chapter_markers(pages: DataFrame) -> DataFrame:
    """The first CHAPTER line of a page: number on it or on the next line, title until a sentence end."""
    lines = lines_of(pages).filter("line <> ''")
    w = Window.partitionBy(*PAGE).orderBy("line_idx")
    df = lines.withColumns({"next": F.lead("line").over(w), "then": F.lead("line", 2).over(w)}).filter(F.col("line").rlike(r"^(?i)chapter\b"))
    own = F.regexp_extract("line", r"^(?i)chapter\s+([IVXLCDM]+|\d{1,4})\b", 1)
    lower = (own == "") & (F.coalesce("next", F.lit("")).rlike(NUMBER) | F.coalesce("next", F.lit("")).rlike(ROMAN))
    title = F.coalesce(F.when(lower, F.col("then")).otherwise(F.col("next")), F.lit(""))
    return df.groupBy(*PAGE).agg(F.min_by(F.struct(F.when(lower, F.regexp_replace("next", "[.,:;]$", "")).otherwise(own).alias("number"), F.regexp_extract(title, r"^(.*?)(?:[.!?]|\s+IN\s|$)", 1).alias("title")), "line_idx").alias("m")).select(*PAGE, "m.number", "m.title")


def _median(values: Column) -> Column:
    """Median of an array in order (ascending or descending)."""
    n = F.size(values)
    return (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2


def _usable() -> Column:
    return F.coalesce(F.btrim("text") != "", F.lit(False)) & F.col("x").isNotNull() & F.col("y").isNotNull()


@F.pandas_udf(ArrayType(IntegerType()))
def line_starts(heights: pd.Series, tolerances: pd.Series) -> pd.Series:
    """Places (from 0) where lines start. As heights are in order, the median of a line is at its middle place; only heights go to Python."""

    def starts(mids: list[float], tolerance: float) -> list[int]:
        out = [0]
        for i in range(1, len(mids)):
            since, n = out[-1], i - out[-1]
            apart = abs(mids[i] - (mids[since + (n - 1) // 2] + mids[since + n // 2]) / 2)
            if apart > tolerance or (apart != apart and tolerance == tolerance):  # NaN is the largest number
                out.append(i)
        return out

    return pd.Series([starts(m.tolist(), t) for m, t in zip(heights, tolerances, strict=True)], dtype=object)


def layout_lines(fragments: DataFrame, source: str = "pdf_text") -> DataFrame:
    """page, line, y, text, scale: fragments (with a place and a text) grouped to lines by an ordered fold over each page.

    Fragments come by their middle height; one joins the line before it if it lies within the
    tolerance, 0.45 of the page's median height and 1.5 at least, of the median of that line as it stands, else it
    starts a line. Since heights only rise (fall, for native pages), no earlier line is ever nearer. Inside a line
    fragments go from left to right.
    """
    from ..functions.text import join_tokens

    usable = fragments.filter(_usable()).withColumn("mid", F.col("y") + F.coalesce(F.abs("height") / 2, F.lit(0.0)))
    way = -F.col("mid") if source.startswith("pdf") else F.col("mid")
    scale = F.coalesce(F.percentile(F.when(F.abs("height") > 0.1, F.abs("height")), 0.5), F.percentile(F.when(F.abs("font_size") > 0.1, F.abs("font_size")), 0.5), F.lit(8.0))
    page = usable.groupBy(*PAGE).agg(scale.alias("scale"), F.sort_array(F.collect_list(F.struct(way.alias("way"), "frag_idx", "x", "text", "mid"))).alias("f"))
    folded = page.withColumn("starts", line_starts(F.transform("f", lambda f: f["mid"].cast("double")), F.greatest(F.lit(1.5), 0.45 * F.col("scale")).cast("double")))
    # lines are cut out inside the page's row, so that no line carries its page along
    cut = F.transform("starts", lambda since, k: F.slice("f", since + 1, F.coalesce(F.get("starts", k + 1), F.size("f")) - since))
    lines = folded.select(*PAGE, "scale", F.posexplode(cut).alias("line", "in_line"))
    text = join_tokens(F.transform(F.sort_array(F.transform("in_line", lambda f, i: F.struct(f["x"].alias("x"), i.alias("i"), f["text"].alias("text")))), lambda f: f["text"]))
    return lines.select(*PAGE, "line", "scale", _median(F.transform("in_line", lambda f: f["mid"])).alias("y"), text.alias("text"))


def fragments_to_text(fragments: DataFrame, source: str = "pdf_text", *, para_sep: str = "\n\n") -> DataFrame:
    """page_number, text from positioned fragments: lines by `layout_lines`, paragraphs where lines lie far apart."""
    lines = layout_lines(fragments, source)
    by_line = Window.partitionBy(*PAGE).orderBy("line")
    gaps = lines.withColumn("gap", F.abs(F.col("y") - F.lag("y").over(by_line)))
    cut = gaps.withColumn("typical", F.percentile(F.when(F.col("gap") > 0, F.col("gap")), 0.5).over(Window.partitionBy(*PAGE)))
    cut = cut.withColumn("new", (F.col("gap") > F.greatest(1.8 * F.col("scale"), 0.9 * F.coalesce("typical", "scale"))).cast("int"))
    cut = cut.withColumn("para", F.sum(F.coalesce("new", F.lit(0))).over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    ordered = lambda key: F.transform(F.array_sort(F.collect_list(F.struct(key, "text"))), lambda f: f["text"])
    paragraphs = cut.groupBy(*PAGE, "para").agg(F.array_join(ordered("line"), " ").alias("text"))
    placed = paragraphs.groupBy(*PAGE).agg(F.array_join(ordered("para"), para_sep).alias("text"))
    # a page without lines has no usable fragment
    plain = fragments.filter(~_usable()).join(fragments.filter(_usable()).select(*PAGE).distinct(), PAGE, "left_anti").groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("frag_idx", F.btrim("text").alias("text")))), lambda f: f["text"]), " ").alias("text"))
    return placed.unionByName(plain)


def normalize_pages(pages: DataFrame, fragments: DataFrame | None = None, *, source: str = "ocr", para_sep: str = "\n\n") -> DataFrame:
    """pages (raw_text, source) with text, quality_score and method: native text by its lines, else fragments, else the raw text."""
    from ..functions.text import cleanup_text, rebuild_paragraphs, text_quality

    raw = rebuild_paragraphs(F.col("raw_text"), para_sep)
    native = (F.col("source") == "pdf_text") & (F.btrim("raw_text") != "")
    if fragments is None:
        out = pages.withColumns({"text": cleanup_text(raw), "method": F.when(native, "native_text").otherwise("raw_text")})
        return out.withColumn("quality_score", text_quality(F.col("text")))
    laid = fragments_to_text(fragments, source, para_sep=para_sep).withColumnRenamed("text", "__laid")
    sure = fragments.groupBy(*PAGE).agg(F.percentile("confidence", 0.5).alias("__sure"))
    out = pages.join(laid, PAGE, "left").join(sure, PAGE, "left")
    use = ~native & (F.coalesce("__laid", F.lit("")) != "")
    out = out.withColumns({"text": cleanup_text(F.when(use, F.col("__laid")).otherwise(raw)), "method": F.when(native, "native_text").when(use, "layout").otherwise("raw_text")})
    return out.withColumn("quality_score", text_quality(F.col("text"), confidence=F.col("__sure"))).drop("__laid", "__sure")
