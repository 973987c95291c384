"""Queries over documents read as books: a book is a source, its pages are its documents in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons
from ..functions.folders import kept, shared_folder
from ..functions.ranges import numbered
from ..functions.text import cleanup_text, sentences, text_quality
from ..operators import classify, entities, facts, identity, index, packages, retrieval, segment, structure

NAME = r"\p{Lu}\p{Ll}{2,}(?: \p{Lu}\p{Ll}{2,}){0,2}"
NAME_RULE = [("character", NAME, 0, 0.45, 2, True)]
_EDGE = r"[^\p{L}\p{Nd}_]"


def bounded_sql(pattern: str) -> str:
    """A pattern between word boundaries as DuckDB's regular expressions, whose own boundaries know ASCII letters only, can say it."""
    pattern = pattern.replace(r"\w", r"[\p{L}\p{M}\p{Nd}\p{Pc}]")
    return pattern.replace(r"(?i)\b", f"(?i)(?:^|{_EDGE})").removesuffix(r"\b") + f"(?:{_EDGE}|$)"


STOP_SQL = ", ".join(f"'{w}'" for w in lexicons.NAME_STOP)

PAGES_SQL = "pages_ AS (SELECT source AS document_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_number, doc_id, text FROM documents)"
SECTIONS_SQL = f"""{PAGES_SQL},
heads AS (SELECT document_id, page_number, trim(string_split(text, chr(10))[1]) AS title FROM pages_),
starts AS (SELECT * FROM heads WHERE title <> '' AND len(string_split(title, ' ')) <= 3),
ends AS (SELECT document_id, max(page_number) AS last_page FROM pages_ GROUP BY 1),
sections_ AS (
  SELECT s.document_id, row_number() OVER w AS section_order, s.title, s.page_number AS page_start,
         greatest(s.page_number, coalesce(lead(s.page_number) OVER w - 1, e.last_page)) AS page_end
  FROM starts s JOIN ends e USING (document_id) WINDOW w AS (PARTITION BY s.document_id ORDER BY s.page_number, s.title))"""
MENTIONS_SQL = rf"""raw_ AS (SELECT doc_id, source, text, unnest(regexp_extract_all(text, '{NAME}')) AS name FROM documents),
names_ AS (
  SELECT DISTINCT doc_id, source, text, name FROM raw_
  WHERE len(list_filter(string_split(name, ' '), lambda w: len(w) < 3 OR w IN ({STOP_SQL}))) = 0)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("source").alias("document_id"), "doc_id", "text")
    return numbered(docs, "document_id", "doc_id", "page_number")


def title_of(text: str) -> Column:
    return F.btrim(F.element_at(F.split(text, "\n"), 1))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their titles alone, so that finding sections moves no text."""
    docs = documents(spark, sf_dir).select(F.col("source").alias("document_id"), "doc_id", title_of("text").alias("title"))
    return numbered(docs, "document_id", "doc_id", "page_number")


def sections(book: DataFrame) -> DataFrame:
    """Sections of pages, by their titles where these are known, else by their texts."""
    title = F.col("title") if "title" in book.columns else title_of("text")
    found = book.select("document_id", "page_number", title.alias("title"), F.lit(1.0).alias("confidence"))
    return segment.section_ranges(found.filter((F.col("title") != "") & (F.size(F.split("title", " ")) <= 3)), book)


def page_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("source").alias("document_id"), F.lit(1).alias("story_order"), F.col("doc_id").alias("scene_order"), "text")


def name_mentions(spark: SparkSession, sf_dir: str, *, contexts: bool = True, signs: bool = False) -> DataFrame:
    scenes = page_scenes(spark, sf_dir)
    return entities.extract_mentions(scenes.withColumns(identity.text_signs(F.col("text"))) if signs else scenes, NAME_RULE, contexts=contexts)


def chunk_documents(spark, sf_dir):
    cut = segment.chunk_texts(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "chunk_index", F.md5("chunk_text").alias("chunk_md5"), "char_count", "token_count")


def normalize_text_quality(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(cleanup_text(F.col("text"))).alias("clean_md5"), text_quality(F.col("text")).alias("quality"))


def page_numbers_per_book(spark, sf_dir):
    return pages(spark, sf_dir).select("document_id", "doc_id", "page_number")


def section_ranges(spark, sf_dir):
    return sections(pages(spark, sf_dir)).select("document_id", "section_order", "title", "page_start", "page_end")


def stories_range_join(spark, sf_dir):
    heads = kept(sections(titles(spark, sf_dir)), "sections")
    return segment.stories(pages(spark, sf_dir), heads).select("document_id", "story_order", "title", "page_start", "page_end", F.length("text").alias("chars"), F.md5("text").alias("text_md5"))


def unassigned_pages(spark, sf_dir):
    book = pages(spark, sf_dir)
    return segment.unassigned_pages(book, sections(book)).select("document_id", "page_number", "doc_id")


def page_sections(spark, sf_dir):
    book = pages(spark, sf_dir)
    return segment.page_sections(book.select("document_id", "page_number", "doc_id"), sections(book)).select("document_id", "page_number", "doc_id", "section_order")


def scenes_of(spark, sf_dir):
    book = pages(spark, sf_dir)
    told = segment.stories(book, sections(book), para_sep="\n")
    return book, told, segment.scenes(told, para_sep="\n", split_on="\n")


def scene_fold(spark, sf_dir):
    return scenes_of(spark, sf_dir)[2].select("document_id", "story_order", "scene_order", "strategy", F.length("text").alias("chars"), F.md5("text").alias("text_md5"))


def scene_page_ranges(spark, sf_dir):
    """From lengths alone: no text is moved."""
    docs = documents(spark, sf_dir).select(F.col("source").alias("document_id"), "doc_id", title_of("text").alias("title"), "text")
    book = kept(numbered(segment.page_shapes(docs), "document_id", "doc_id", "page_number"), "page-shapes")
    heads = kept(sections(book), "sections")
    told = kept(segment.story_shapes(book, heads), "story-shapes")
    return segment.scene_pages(segment.scene_shapes(told), told, book, para_sep="\n").select("document_id", "story_order", "scene_order", "page_start", "page_end")


def scene_events(spark, sf_dir):
    return segment.events(scenes_of(spark, sf_dir)[2]).select("document_id", "story_order", "scene_order", "event_order", "confidence", F.length("text").alias("chars"))


def proper_name_mentions(spark, sf_dir):
    return name_mentions(spark, sf_dir).select(F.col("scene_order").alias("doc_id"), "canonical_name", "confidence", F.md5("context").alias("context_md5"))


def entity_profiles(spark, sf_dir):
    found = entities.entities(name_mentions(spark, sf_dir), order=["scene_order"])
    return found.select("document_id", "canonical_name", "confidence", "mention_count", F.md5("profile_text").alias("profile_md5"))


def exact_key_merge(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.lit(1).alias("document_id"), F.lit("part").alias("entity_type"), F.col("p_partkey").alias("entity_id"), F.initcap("p_name").alias("canonical_name"), F.round(F.col("p_size") / 50.0, 2).alias("confidence"))
    return entities.merge_exact(part).select("entity_id", "canonical_name", "canonical_id")


def cross_type_collision(spark, sf_dir):
    docs = documents(spark, sf_dir).select("lang", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Z][a-z]{2,}"), 0))).alias("canonical_name"))
    kinds = docs.select(F.lit(1).alias("document_id"), F.when(F.col("lang") == "en", "character").when(F.col("lang") == "de", "location").otherwise("environment").alias("entity_type"), "canonical_name").distinct()
    return identity.other_types(kinds).select("entity_type", "canonical_name", F.array_join("other_types", ",").alias("other_types"))


def gate_inputs(spark, sf_dir, *, contexts: bool = True):
    """Names of all books with their counts, written once since each step asks for them again, and their mentions."""
    ids = F.xxhash64("document_id", "canonical_name")
    known = name_mentions(spark, sf_dir, contexts=False).groupBy("document_id", "entity_type", "canonical_name", ids.alias("entity_id")).agg(F.count(F.lit(1)).alias("mention_count"))
    mentions = name_mentions(spark, sf_dir, contexts=contexts, signs=contexts).withColumn("entity_id", ids).withColumn("scene_id", F.col("scene_order"))
    return kept(known, "known"), mentions


def candidate_gate(spark, sf_dir):
    known, mentions = gate_inputs(spark, sf_dir)
    return identity.candidate_gate(known, mentions).select("document_id", "canonical_name", "decision", F.round("score", 3).alias("score"), F.array_join("reasons", ",").alias("reasons"))


def evidence_labels(spark, sf_dir):
    known, mentions = gate_inputs(spark, sf_dir)
    return identity.classify_evidence(known, mentions).join(known.select("entity_id", "canonical_name"), "entity_id").select("document_id", "canonical_name", "label", "score", "mention_count", "scene_count", F.array_join("reasons", ",").alias("reasons"))


def visual_entity_validation(spark, sf_dir):
    known = gate_inputs(spark, sf_dir)[0].withColumn("profile_text", F.lit(""))
    return identity.validate_visual_entities(known).select("document_id", "canonical_name", "visual_type", "decision", F.round("score", 2).alias("score"))


def rag_sources(spark, sf_dir):
    """Every layer: pages, sections with the text of their pages, stories, scenes, chunks, entities, events, turns and web pages."""
    book = kept(pages(spark, sf_dir), "pages")
    heads = kept(sections(titles(spark, sf_dir)), "sections")
    told = kept(segment.stories(book, heads, para_sep="\n"), "stories")
    # page ranges come from lengths; scenes take them by a join of narrow rows and are written once, for scenes and events
    shapes = segment.page_shapes(book)
    cut = segment.scenes(told, para_sep="\n", split_on="\n")
    split = kept(segment.scene_pages(cut, told, shapes, para_sep="\n"), "scenes")
    parts = segment.chunks(book, heads)
    known = entities.entities(name_mentions(spark, sf_dir), order=["scene_order"])
    scene_id = F.concat_ws(".", "story_order", "scene_order")
    story_id = F.col("story_order").cast("string").alias("parent_id")
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    web = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return retrieval.rag_documents({
        "page": book.select("document_id", F.col("doc_id").alias("source_id"), F.lit("").alias("title"), "text", F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end")),
        "section": heads.join(told.select("document_id", "section_order", "text"), ["document_id", "section_order"], "left").select("document_id", F.col("section_order").alias("source_id"), "title", F.coalesce("text", F.lit("")).alias("text"), "page_start", "page_end"),
        "story": told.select("document_id", F.col("story_order").alias("source_id"), "title", "text", F.col("section_order").cast("string").alias("parent_id"), "page_start", "page_end"),
        "scene": split.select("document_id", scene_id.alias("source_id"), "title", "text", story_id, "page_start", "page_end"),
        "chunk": parts.select("document_id", F.concat_ws(".", F.coalesce("section_order", F.lit(0)), "page_number", "chunk_index").alias("source_id"), F.lit("").alias("title"), "text", F.col("section_order").cast("string").alias("parent_id"), F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end")),
        "entity": known.select("document_id", F.concat_ws(".", "entity_type", "canonical_name").alias("source_id"), F.concat_ws(": ", "entity_type", "canonical_name").alias("title"), F.col("profile_text").alias("text")),
        "event": segment.events(split, more=("title", "page_start", "page_end")).select("document_id", F.concat_ws(".", "story_order", "scene_order", "event_order").alias("source_id"), "title", "text", scene_id.alias("parent_id"), "page_start", "page_end"),
        "turn": talk.select(F.col("conv_id").alias("document_id"), F.concat_ws(".", "conv_id", "turn").alias("source_id"), F.col("role").alias("title"), "text"),
        "web": web.select(F.col("page_id").alias("document_id"), F.col("page_id").alias("source_id"), F.col("url").alias("title"), F.col("html").alias("text")),
    })


def rag_union_counts(spark, sf_dir):
    return rag_sources(spark, sf_dir).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"), F.count("page_start").alias("with_pages"), F.sum(F.length("text")).alias("chars"))


_indexes: dict[tuple[str, str], str] = {}


def stored_index(spark, sf_dir):
    """The index of all documents, built once for a session and then read by every search."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        rag = documents(spark, sf_dir).select(F.col("doc_id").alias("rag_id"), F.lit("").alias("title"), "text")
        path = shared_folder(spark, "index")
        index.build_index(rag, path)
        _indexes[key] = path
    return index.open_index(spark, _indexes[key])


def passages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")


def bm25_topk(spark, sf_dir):
    """The 8 best documents among those that hold all words of a benchmark passage."""
    found = index.search_index(stored_index(spark, sf_dir), passages(spark, sf_dir), id_type="long")
    return found.select("query_id", "rank", F.col("id").cast("long").alias("doc_id"), F.round("score", 4).alias("score"))


def phrase_retrieval(spark, sf_dir):
    return index.phrase_index(stored_index(spark, sf_dir), passages(spark, sf_dir)).select("query_id", F.col("id").cast("long").alias("doc_id"))


LANGUAGE_WORDS = [(0, "language", "en", " the ", 3), (1, "language", "en", " of ", 2), (2, "language", "en", " and ", 2), (3, "language", "de", " und ", 3), (4, "language", "de", " der ", 2), (5, "language", "de", " die ", 2), (6, "language", "fr", " le ", 2), (7, "language", "fr", " les ", 3), (8, "language", "fr", " et ", 2), (9, "language", "es", " que ", 1), (10, "language", "es", " los ", 3), (11, "language", "es", " el ", 2)]


def lexicon_classification(spark, sf_dir):
    lexicon = spark.createDataFrame(LANGUAGE_WORDS, "position int, dimension string, label string, phrase string, weight int")
    found = classify.classify_documents(documents(spark, sf_dir), lexicon, id_col="doc_id")
    return found.select("doc_id", "dimension", "rank", "label", "score", "confidence", F.array_join("evidence", "|").alias("evidence"))


def mixed_evidence(spark, sf_dir):
    lexicon = spark.createDataFrame(LANGUAGE_WORDS, "position int, dimension string, label string, phrase string, weight int")
    found = classify.classify_documents(documents(spark, sf_dir), lexicon, id_col="doc_id")
    return classify.mixed_notes(found, id_col="doc_id", dimensions=("language",), below=0.7).select("doc_id", "note")


THINGS = ["idiot", "clown", "moron", "loser", "trash", "scum", "with", "from"]


def object_lexicon_mentions(spark, sf_dir):
    scenes = documents(spark, sf_dir).select("doc_id", "text")
    return entities.object_mentions(scenes, THINGS, keys=["doc_id"]).select("doc_id", "object", "confidence", F.md5("evidence").alias("evidence_md5"))


def visual_roles(spark, sf_dir):
    roles = [("first", "idiot|clown"), ("second", "trash"), ("third", "with")]
    return documents(spark, sf_dir).select("doc_id", classify.visual_role(F.col("text"), roles).alias("role"))


def audit_coverage(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    joined = docs.join(labels, "doc_id", "left")
    return joined.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.count("quality").alias("labelled"), F.round(100.0 * F.count("quality") / F.count(F.lit(1)), 2).alias("labelled_percent"), F.round(F.avg("quality"), 4).alias("mean_quality"), F.count_if(F.col("toxic") == 1).alias("toxic"))


def noise_top_n(spark, sf_dir):
    """A top-k report: the 20 longest names of four words and more."""
    found = documents(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{Ll}+(?: \p{L}+){3,5}"), 0)).alias("canonical_name")).distinct()
    return facts.noisy_names(found.withColumns({"document_id": F.lit(1), "confidence": F.lit(0.9)}), 20).select("canonical_name")


def duplicate_names(spark, sf_dir):
    named = documents(spark, sf_dir).select(F.col("source").alias("document_id"), F.element_at(F.split("text", "\n"), 1).alias("canonical_name"))
    return facts.duplicate_names(named)


def moments_topk(spark, sf_dir):
    scenes = documents(spark, sf_dir).select("doc_id", "text")
    best = packages.moments(scenes, keys=["doc_id"], k=3)
    return best.select("doc_id", "rank", "score", F.md5("moment").alias("moment_md5"))


def sentence_counts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.size(sentences(F.col("text"), 4)).alias("sentences"))


def dialogue_lines(spark, sf_dir):
    scenes = documents(spark, sf_dir).select("doc_id", "text")
    return packages.dialogue(scenes, "ordered", keys=["doc_id"], spoken="(?i)\\b(?:that|que|dass|und)\\b").select("doc_id", "rank", F.md5("line").alias("line_md5"))


def even_sample(spark, sf_dir):
    return packages.even_sample(documents(spark, sf_dir).select("doc_id", "source"), 24, "doc_id").select("place", "doc_id", "source")


def rendered(spark, sf_dir):
    docs = documents(spark, sf_dir)
    scenes = docs.select("doc_id", "text", F.element_at(F.split("text", "\n"), 1).alias("title"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"))
    top = packages.moments(scenes.select("doc_id", "text"), keys=["doc_id"], k=4).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "moment"))), lambda m: m["moment"]).alias("moments"))
    names = F.slice(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{Ll}{3,}"), 0)), 1, 3)
    return packages.render(scenes.join(top, "doc_id", "left").withColumn("moments", F.coalesce("moments", F.array().cast("array<string>"))).withColumn("names", names))


def package_quality(spark, sf_dir):
    return packages.quality_errors(rendered(spark, sf_dir), packages.PACKAGE_RULES).select("doc_id", F.array_join("errors", ",").alias("errors"), "status")


def prompts_by_mode(spark, sf_dir):
    made = rendered(spark, sf_dir).withColumn("scene_id", F.col("doc_id"))
    return packages.pick_prompt(made, "image").select(F.col("scene_id").alias("doc_id"), F.md5("prompt").alias("prompt_md5"), "reason")


RULES = [("empty_text", "text IS NULL OR trim(text) = ''"), ("short_text", "length(text) < 200"), ("long_text", "length(text) > 5000"), ("shouting", "contains(text, '!!')"), ("unlabelled", "quality IS NULL")]


def qa_histogram(spark, sf_dir):
    joined = documents(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left")
    return packages.quality_histogram(packages.quality_errors(joined, RULES))


def html_blocks_to_sections(spark, sf_dir):
    """A count of the plain opening tags of web pages: blocks, headings, and the place of the first heading; `html_sections` makes the sections."""
    web = spark.read.parquet(f"{sf_dir}/pages.parquet")
    blocks = web.select(F.col("page_id").alias("document_id"), F.lit(1).alias("page_number"), F.posexplode(F.regexp_extract_all("html", F.lit("<(h1|h2|p|li)>"), 0)).alias("frag_idx", "tag"))
    return blocks.groupBy("document_id").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("tag").isin("<h1>", "<h2>")).alias("headings"), F.min(F.when(F.col("tag").isin("<h1>", "<h2>"), F.col("frag_idx"))).alias("first_heading"))


def line_heading_scores(spark, sf_dir):
    return structure.line_headings(pages(spark, sf_dir), keywords=["the", "die", "les", "los"]).select("document_id", "page_number", "line_idx", "line", "score")


QUERIES = {f.__name__: f for f in (
    chunk_documents, normalize_text_quality, page_numbers_per_book, section_ranges, stories_range_join, unassigned_pages, page_sections, scene_fold,
    scene_page_ranges, scene_events, proper_name_mentions, entity_profiles, exact_key_merge, cross_type_collision, candidate_gate, evidence_labels,
    visual_entity_validation, rag_union_counts, bm25_topk, phrase_retrieval, lexicon_classification, mixed_evidence, object_lexicon_mentions, visual_roles,
    audit_coverage, noise_top_n, duplicate_names, moments_topk, sentence_counts, dialogue_lines, even_sample, package_quality, prompts_by_mode, qa_histogram,
    html_blocks_to_sections, line_heading_scores,
)}

_FOLD = "translate(lower({}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"
_TERMS = "list_filter(regexp_split_to_array(" + _FOLD + r", '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"
_LEXICON = "(VALUES " + ", ".join(f"({i}, '{d}', '{la}', '{p}', {w})" for i, d, la, p, w in LANGUAGE_WORDS) + ") AS lex(position, dimension, label, phrase, weight)"
_CLASSIFIED = f"""hits AS (
  SELECT d.doc_id, l.dimension, l.label, l.phrase, l.weight, l.position FROM documents d, {_LEXICON.replace('AS lex', 'AS l')}
  WHERE contains(lower(regexp_replace(d.text, '\\s+', ' ', 'g')), l.phrase)),
scored AS (SELECT doc_id, dimension, label, sum(weight) AS score, min(position) AS position, string_agg(phrase, '|' ORDER BY position) AS evidence FROM hits GROUP BY 1, 2, 3),
ranked AS (SELECT doc_id, dimension, row_number() OVER (PARTITION BY doc_id, dimension ORDER BY score DESC, position, label) AS rank, label, CAST(score AS BIGINT) AS score,
  round(least(0.995, 0.5 + 0.45 * (score / greatest(score + sum(score) OVER (PARTITION BY doc_id, dimension), 1))), 3) AS confidence, evidence FROM scored)"""
_SENTENCES = r"""flat_ AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents),
sent_ AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(1), 'g'), chr(1))) AS s FROM flat_),
long_ AS (SELECT doc_id, trim(s) AS s FROM sent_ WHERE trim(s) <> '' AND len(string_split(trim(s), ' ')) >= 4)"""

ORACLES = {
    "chunk_documents": r"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents),
c AS (SELECT doc_id, f, unnest(range(0, CAST(floor(greatest(length(f) - 201, 0) / 1800) AS BIGINT) + 1)) AS i FROM t WHERE length(f) > 0),
k AS (SELECT doc_id, i AS chunk_index, trim(substr(f, i * 1800 + 1, 2000)) AS x FROM c)
SELECT doc_id, chunk_index, md5(x) AS chunk_md5, length(x) AS char_count, len(string_split(x, ' ')) AS token_count FROM k""",
    "normalize_text_quality": rf"""SELECT doc_id,
  md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '\s+([,.;:!?%)\]}}])', '\1', 'g'), '([(\[{{])\s+', '\1', 'g'), '\s*\n\s*', ' ', 'g'))) AS clean_md5,
  CASE WHEN length(text) = 0 THEN 0.0 ELSE round(0.45 + 0.25 * least(length(text) / 1000.0::DOUBLE, 1.0::DOUBLE) + 0.30::DOUBLE * length(regexp_replace(text, '\P{{L}}', '', 'g')) / length(text), 3) END AS quality
FROM documents""",
    "page_numbers_per_book": f"WITH {PAGES_SQL} SELECT document_id, doc_id, page_number FROM pages_",
    "section_ranges": f"WITH {SECTIONS_SQL} SELECT * FROM sections_",
    "stories_range_join": f"""WITH {SECTIONS_SQL},
told AS (SELECT s.document_id, s.section_order, s.title, s.page_start, s.page_end, string_agg(p.text, chr(10) || chr(10) ORDER BY p.page_number) AS text
  FROM sections_ s JOIN pages_ p ON p.document_id = s.document_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE trim(p.text) <> '' GROUP BY ALL)
SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY section_order) AS story_order, section_order || '. ' || title AS title, page_start, page_end, length(text) AS chars, md5(text) AS text_md5 FROM told""",
    "unassigned_pages": f"WITH {SECTIONS_SQL} SELECT document_id, page_number, doc_id FROM pages_ p WHERE NOT EXISTS (SELECT 1 FROM sections_ s WHERE s.document_id = p.document_id AND p.page_number BETWEEN s.page_start AND s.page_end)",
    "page_sections": f"WITH {SECTIONS_SQL} SELECT p.document_id, page_number, doc_id, section_order FROM pages_ p JOIN sections_ s ON s.document_id = p.document_id AND p.page_number BETWEEN s.page_start AND s.page_end",
    "proper_name_mentions": f"""WITH {MENTIONS_SQL}, at_ AS (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_)
SELECT doc_id, name AS canonical_name, 0.45::DOUBLE AS confidence, md5(trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220))) AS context_md5 FROM at_""",
    "entity_profiles": f"""WITH {MENTIONS_SQL}, at_ AS (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_),
m AS (SELECT source, name, doc_id, trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220)) AS context, row_number() OVER (PARTITION BY source, name ORDER BY doc_id) AS n FROM at_)
SELECT source AS document_id, name AS canonical_name, 0.45::DOUBLE AS confidence, count(*) AS mention_count, md5(string_agg(context, chr(10) || chr(10) ORDER BY doc_id) FILTER (WHERE n <= 5)) AS profile_md5 FROM m GROUP BY 1, 2""",
    "exact_key_merge": """WITH e AS (SELECT p_partkey AS entity_id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS canonical_name, round(p_size / 50.0::DOUBLE, 2) AS confidence FROM part)
SELECT entity_id, canonical_name, first_value(entity_id) OVER (PARTITION BY lower(canonical_name) ORDER BY confidence DESC, entity_id) AS canonical_id FROM e""",
    "cross_type_collision": """WITH n AS (SELECT DISTINCT CASE lang WHEN 'en' THEN 'character' WHEN 'de' THEN 'location' ELSE 'environment' END AS entity_type, unnest(regexp_extract_all(text, '[A-Z][a-z]{2,}')) AS canonical_name FROM documents),
t AS (SELECT lower(canonical_name) AS low, list_sort(list_distinct(list(entity_type))) AS types FROM n GROUP BY 1)
SELECT entity_type, canonical_name, array_to_string(list_filter(types, lambda x: x <> entity_type), ',') AS other_types FROM n JOIN t ON lower(canonical_name) = low""",
    "bm25_topk": f"""WITH said AS (SELECT doc_id, unnest({_TERMS.format('text')}) AS term FROM documents),
posted AS (SELECT doc_id, term, count(*) AS tf FROM said GROUP BY 1, 2), sizes AS (SELECT doc_id, sum(tf) AS size FROM posted GROUP BY 1),
whole AS (SELECT count(*) AS n, avg(size) AS mean FROM sizes),
asked AS (SELECT DISTINCT item_id AS query_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
need AS (SELECT query_id, count(*) AS need FROM asked GROUP BY 1), dfs AS (SELECT term, count(*) AS df FROM posted GROUP BY 1),
scored AS (SELECT query_id, doc_id, count(*) AS have, sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))) AS s
  FROM asked JOIN posted USING (term) JOIN dfs USING (term) JOIN sizes USING (doc_id), whole GROUP BY 1, 2),
kept AS (SELECT query_id, doc_id, round(-s, 6) + 0.0::DOUBLE AS score FROM scored JOIN need USING (query_id) WHERE have = need)
SELECT query_id, rank, doc_id, round(score, 4) + 0.0::DOUBLE AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, doc_id) AS rank FROM kept) WHERE rank <= 8""",
    "phrase_retrieval": f"""WITH d AS (SELECT doc_id, ' ' || array_to_string({_TERMS.format('text')}, ' ') || ' ' AS t FROM documents),
q AS (SELECT item_id AS query_id, ' ' || array_to_string({_TERMS.format('text')}, ' ') || ' ' AS p FROM benchmark)
SELECT query_id, doc_id FROM d JOIN q ON contains(t, p)""",
    "lexicon_classification": f"WITH {_CLASSIFIED} SELECT * FROM ranked WHERE rank <= 5",
    "mixed_evidence": f"WITH {_CLASSIFIED} SELECT doc_id, 'Language evidence is mixed; treat classification as provisional.' AS note FROM ranked WHERE rank = 1 AND confidence < 0.7",
    "object_lexicon_mentions": f"""WITH s AS (SELECT DISTINCT doc_id, text, unnest(regexp_extract_all(lower(text), '[a-z][a-z''-]+')) AS term FROM documents),
h AS (SELECT *, strpos(lower(text), term) AS p FROM s WHERE term IN ({", ".join(f"'{w}'" for w in THINGS)}))
SELECT doc_id, upper(term[1]) || term[2:] AS object, 0.55::DOUBLE AS confidence, md5(trim(substr(text, greatest(1, p - 180), p - greatest(1, p - 180) + length(term) + 180))) AS evidence_md5 FROM h""",
    "visual_roles": "SELECT doc_id, CASE WHEN regexp_matches(text, 'idiot|clown') THEN 'first' WHEN contains(text, 'trash') THEN 'second' WHEN contains(text, 'with') THEN 'third' ELSE 'person' END AS role FROM documents",
    "audit_coverage": "SELECT source, count(*) AS pages, count(quality) AS labelled, round(100.0::DOUBLE * count(quality) / count(*), 2) AS labelled_percent, round(avg(quality), 4) AS mean_quality, count(*) FILTER (WHERE toxic = 1) AS toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "noise_top_n": r"""WITH n AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{L}+){3,5}')) AS canonical_name FROM documents)
SELECT canonical_name FROM n WHERE len(string_split(canonical_name, ' ')) >= 4 OR length(canonical_name) > 45 ORDER BY length(canonical_name) DESC, canonical_name LIMIT 20""",
    "duplicate_names": "SELECT source AS document_id, lower(trim(string_split(text, chr(10))[1])) AS name, count(*) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1",
    "sentence_counts": f"WITH {_SENTENCES} SELECT f.doc_id, count(s) AS sentences FROM flat_ f LEFT JOIN long_ l USING (doc_id) GROUP BY 1",
    "even_sample": """WITH r AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS place, count(*) OVER () AS c FROM documents)
SELECT place, doc_id, source FROM r WHERE place IN (SELECT least(c - 1, CAST(round(i * (c - 1) / 23.0::DOUBLE) AS BIGINT)) FROM range(24) t(i), (SELECT count(*) AS c FROM documents))""",
    "qa_histogram": """WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
e AS (SELECT unnest(list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty_text' END, CASE WHEN length(text) < 200 THEN 'short_text' END, CASE WHEN length(text) > 5000 THEN 'long_text' END, CASE WHEN contains(text, '!!') THEN 'shouting' END, CASE WHEN quality IS NULL THEN 'unlabelled' END], lambda x: x IS NOT NULL)) AS error FROM j)
SELECT error, count(*) AS n FROM e GROUP BY 1""",
    "html_blocks_to_sections": """WITH b AS (SELECT page_id, unnest(regexp_extract_all(html, '<(h1|h2|p|li)>')) AS tag, generate_subscripts(regexp_extract_all(html, '<(h1|h2|p|li)>'), 1) - 1 AS i FROM pages)
SELECT page_id AS document_id, count(*) AS blocks, count(*) FILTER (WHERE tag IN ('<h1>', '<h2>')) AS headings, min(i) FILTER (WHERE tag IN ('<h1>', '<h2>')) AS first_heading FROM b GROUP BY 1""".replace("\\\\", "\\"),
}

ORACLES["moments_topk"] = f"""WITH {_SENTENCES}, u AS (SELECT DISTINCT doc_id, s FROM long_),
k AS (SELECT * FROM u WHERE NOT regexp_matches(s, '{bounded_sql(packages.SPEECH)}') OR regexp_matches(s, '{bounded_sql(packages.L.ACTION)}')),
g AS (SELECT doc_id, s, 10 + CASE WHEN regexp_matches(s, '{bounded_sql(packages.L.ACTION)}') THEN 50 ELSE 0 END + CASE WHEN regexp_matches(s, '{bounded_sql(packages.L.DESTRUCTION)}') THEN 12 ELSE 0 END
  + CASE WHEN regexp_matches(s, '{bounded_sql(packages.L.COMBAT)}') THEN 8 ELSE 0 END + CASE WHEN regexp_matches(s, '{bounded_sql(packages.L.REACTION)}') THEN 6 ELSE 0 END AS score FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lower(s), s) AS rank FROM g)
SELECT doc_id, rank, CAST(score AS BIGINT) AS score, md5(s) AS moment_md5 FROM r WHERE rank <= 3"""

ORACLES["scene_fold"] = f"""WITH RECURSIVE {SECTIONS_SQL},
told AS (SELECT s.document_id, s.section_order, string_agg(p.text, chr(10) ORDER BY p.page_number) AS text
  FROM sections_ s JOIN pages_ p ON p.document_id = s.document_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE trim(p.text) <> '' GROUP BY ALL),
cut AS (SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY section_order) AS story_order, trim(text) AS text,
  list_filter(list_transform(string_split(trim(text), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ps FROM told),
fold AS (
  SELECT document_id, story_order, ps, 1 AS k, CAST([] AS VARCHAR[]) AS groups, ps[1] AS now, CAST(length(ps[1]) AS BIGINT) AS size FROM cut WHERE len(ps) > 1
  UNION ALL
  SELECT document_id, story_order, ps, k + 1,
    CASE WHEN size >= 900 AND size + length(ps[k + 1]) + 1 > 3500 THEN list_append(groups, now) ELSE groups END,
    CASE WHEN size >= 900 AND size + length(ps[k + 1]) + 1 > 3500 THEN ps[k + 1] ELSE now || chr(10) || ps[k + 1] END,
    CASE WHEN size >= 900 AND size + length(ps[k + 1]) + 1 > 3500 THEN length(ps[k + 1]) + 1 ELSE size + length(ps[k + 1]) + 1 END
  FROM fold WHERE k < len(ps)),
done AS (SELECT document_id, story_order, 'paragraph_group' AS strategy,
  CASE WHEN len(groups) > 0 AND size < 900 THEN list_append(groups[1:len(groups) - 1], groups[len(groups)] || chr(10) || now) ELSE list_append(groups, now) END AS g
  FROM fold WHERE k = len(ps) UNION ALL SELECT document_id, story_order, 'story_default', [text] FROM cut WHERE len(ps) = 1),
each AS (SELECT document_id, story_order, strategy, unnest(g) AS x, generate_subscripts(g, 1) AS scene_order FROM done)
SELECT document_id, story_order, scene_order, strategy, length(x) AS chars, md5(x) AS text_md5 FROM each"""

ORACLES["scene_events"] = ORACLES["scene_fold"].replace("scene_order, strategy, length(x) AS chars, md5(x) AS text_md5 FROM", "scene_order, 1 AS event_order, 0.4::DOUBLE AS confidence, length(x) AS chars FROM").replace("SELECT document_id, story_order, scene_order, 1 AS", "SELECT document_id, story_order, scene_order, CAST(1 AS BIGINT) AS")

_LISTED = lambda words: ", ".join(f"'{w}'" for w in words)
_VERBS = "|".join([*lexicons.SPEECH_VERBS, "rejoined", "called"])
ORACLES["candidate_gate"] = rf"""WITH {MENTIONS_SQL}, at_ AS (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_),
m AS (SELECT source, name, doc_id, trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220)) AS context FROM at_),
f AS (SELECT source, name, count(*) AS mentions, count(*) FILTER (WHERE contains(lower(context), lower(name))) AS exact,
  count(*) FILTER (WHERE regexp_matches(context, '{bounded_sql(identity.SPEECH)}')) AS speech, count(*) FILTER (WHERE regexp_matches(context, '{bounded_sql(identity.PRONOUN_ACTION)}')) AS action,
  count(*) FILTER (WHERE regexp_matches(context, '(?i)(?:^|{_EDGE})(?:(?:{_VERBS})\s+' || name || '|' || name || '\s+(?:{_VERBS})|{identity.CUED_TITLES}\s+' || name || ')(?:{_EDGE}|$)')) AS direct FROM m GROUP BY 1, 2),
b AS (SELECT *, list_filter(string_split(name, ' '), lambda w: lower(w) NOT IN ({_LISTED(lexicons.PERSON_TITLES)})) AS bare, regexp_matches(name, '(?i)^(?:{'|'.join(lexicons.PERSON_TITLES)})\.?\s+') AS title FROM f),
c AS (SELECT *, len(list_filter(bare, lambda w: lower(w) IN ({_LISTED(lexicons.COMMON_WORDS)}))) > 0 AS common, len(bare) = 1 AND NOT title AND direct = 0 AS one_word, len(bare) >= 2 AND NOT title AND direct = 0 AND exact < 3 AS untitled FROM b),
s AS (SELECT *, 0.25::DOUBLE + CASE WHEN title THEN 0.25 ELSE 0 END + CASE WHEN len(bare) >= 2 THEN 0.15 ELSE 0 END + CASE WHEN exact >= 2 THEN 0.15 ELSE 0 END + CASE WHEN mentions >= 3 THEN 0.10 ELSE 0 END
  + CASE WHEN mentions >= 2 THEN 0.10 ELSE 0 END + CASE WHEN direct > 0 THEN 0.25 ELSE 0 END + CASE WHEN speech > 0 THEN 0.05 ELSE 0 END + CASE WHEN action > 0 THEN 0.05 ELSE 0 END - CASE WHEN common THEN 0.45 ELSE 0 END AS raw FROM c),
t AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN untitled THEN least(CASE WHEN one_word THEN least(raw, 0.44::DOUBLE) ELSE raw END, 0.47::DOUBLE) WHEN one_word THEN least(raw, 0.44::DOUBLE) ELSE raw END)), 6) AS score FROM s),
e AS (SELECT *, CASE WHEN regexp_matches(name, '(?i)^(?:{'|'.join(lexicons.PERSON_TITLES)})\.?$') THEN 'title_only'
  WHEN lower(name) IN ({_LISTED(lexicons.COMMON_WORDS + lexicons.DEMOGRAPHIC_WORDS)}) THEN 'common_word_or_demographic_term' WHEN length(name) < 3 OR length(name) > 45 THEN 'name_length_anomaly'
  WHEN len(list_filter(bare, lambda w: NOT regexp_matches(w, '^[A-Z][A-Za-z''’-]+$'))) > 0 THEN 'non_name_token'
  WHEN NOT title AND len(list_filter(bare, lambda w: lower(w) IN ({_LISTED(lexicons.ROLE_WORDS)}))) > 0 THEN 'generic_non_person_name_pattern'
  WHEN title AND len(bare) = 1 AND common AND direct = 0 THEN 'title_with_stopword_name_without_direct_person_reference' END AS early FROM t)
SELECT source AS document_id, name AS canonical_name,
  CASE WHEN early IN ('title_only', 'common_word_or_demographic_term', 'generic_non_person_name_pattern') THEN 'non_character' WHEN early IS NOT NULL THEN 'review' WHEN score >= 0.75 THEN 'validated' WHEN score >= 0.48 THEN 'probable' ELSE 'review' END AS decision,
  round(CASE early WHEN 'title_only' THEN 1.0 WHEN 'common_word_or_demographic_term' THEN 1.0 WHEN 'name_length_anomaly' THEN 0.9 WHEN 'non_name_token' THEN 0.65 WHEN 'generic_non_person_name_pattern' THEN 0.95 WHEN 'title_with_stopword_name_without_direct_person_reference' THEN 0.35 ELSE score END::DOUBLE, 3) AS score,
  coalesce(early, array_to_string(list_filter([CASE WHEN title THEN 'personal_title' END, CASE WHEN len(bare) >= 2 THEN 'multiword_person_name' END, CASE WHEN exact >= 2 THEN 'name_repeated_in_context' END, CASE WHEN mentions >= 3 THEN 'recurring_mentions' END,
    CASE WHEN mentions >= 2 THEN 'multi_scene_presence' END, CASE WHEN direct > 0 THEN 'direct_person_reference' END, CASE WHEN speech > 0 THEN 'speech_context' END, CASE WHEN action > 0 THEN 'character_action_context' END, CASE WHEN common THEN 'stopword_name_component' END,
    CASE WHEN one_word THEN 'single_word_without_direct_person_reference' END, CASE WHEN untitled THEN 'untitled_name_without_repeated_direct_evidence' END], lambda x: x IS NOT NULL), ',')) AS reasons FROM e"""

_TOLD = """t_ AS (SELECT s.document_id, section_order, string_agg(p.text, chr(10) ORDER BY p.page_number) AS text
  FROM sections_ s JOIN pages_ p ON p.document_id = s.document_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE trim(p.text) <> '' GROUP BY 1, 2)"""
ORACLES["rag_union_counts"] = f"""WITH {SECTIONS_SQL}, {_TOLD},
scenes_ AS ({ORACLES["scene_fold"]}), chunks_ AS ({ORACLES["chunk_documents"]}),
profiles_ AS ({ORACLES["entity_profiles"].replace("md5(string_agg(context, chr(10) || chr(10) ORDER BY doc_id) FILTER (WHERE n <= 5)) AS profile_md5", "string_agg(context, chr(10) || chr(10) ORDER BY doc_id) FILTER (WHERE n <= 5) AS profile")})
SELECT 'page' AS source_type, count(*) AS n, count(*) AS with_pages, CAST(sum(length(text)) AS BIGINT) AS chars FROM pages_
UNION ALL SELECT 'section', (SELECT count(*) FROM sections_), (SELECT count(*) FROM sections_), CAST(sum(length(text)) AS BIGINT) FROM t_
UNION ALL SELECT 'story', count(*), count(*), CAST(sum(length(text)) AS BIGINT) FROM t_
UNION ALL SELECT 'scene', count(*), count(*), CAST(sum(chars) AS BIGINT) FROM scenes_
UNION ALL SELECT 'event', count(*), count(*), CAST(sum(chars) AS BIGINT) FROM scenes_
UNION ALL SELECT 'chunk', count(*), count(*), CAST(sum(char_count) AS BIGINT) FROM chunks_ JOIN pages_ p USING (doc_id) LEFT JOIN sections_ s ON s.document_id = p.document_id AND p.page_number BETWEEN s.page_start AND s.page_end
UNION ALL SELECT 'entity', count(*), 0, CAST(sum(length(profile)) AS BIGINT) FROM profiles_
UNION ALL SELECT 'turn', count(*), 0, CAST(sum(length(text)) AS BIGINT) FROM conversations
UNION ALL SELECT 'web', count(*), 0, CAST(sum(length(html)) AS BIGINT) FROM pages"""
