"""Queries of the operators' finer steps: layout, loads and exports, facts and their readings, merged entities, filtered searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons
from ..functions.folders import shared_folder
from ..functions.text import clean_dialogue, strip_heading
from ..operators import classify, continuity, entities, facts, index, jobs, packages, structure
from ..sources import tables as sources
from . import books, chains, oracles, tables
from .tables import read

# --- layout


def word_fragments(spark, sf_dir):
    """Documents as pages of placed words: a row of words for each line, a little uneven in height, larger where capitalised."""
    lines = books.documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "said"))
    words = lines.select("doc_id", "line", F.posexplode(F.split("said", " ")).alias("k", "text")).filter(F.btrim("text") != "")
    size = F.when(F.col("text").rlike(r"^\p{Lu}"), 14.0).otherwise(10.0)
    return words.select(
        F.col("doc_id").cast("string").alias("document_id"), F.lit(1).alias("page_number"), (F.col("line") * 100_000 + F.col("k")).alias("frag_idx"), "text", (F.col("k") * 10.0).alias("x"),
        (F.col("line") * 12.0 + F.col("k") % 3).alias("y"), size.alias("font_size"), F.lit(None).cast("double").alias("confidence"), F.lit(8.0).alias("width"), F.lit(10.0).alias("height"), F.lit("text").alias("label"),
    )


def page_stats(spark, sf_dir):
    return structure.page_stats(word_fragments(spark, sf_dir)).select("document_id", F.round("body_size", 3).alias("body_size"), "page_width")


def layout_lines(spark, sf_dir):
    """Lines of words put together by the running median of their heights."""
    return structure.layout_lines(word_fragments(spark, sf_dir), "ocr").select("document_id", "line", "y", F.md5("text").alias("text_md5"))


def layout_page_text(spark, sf_dir):
    """Lines and paragraphs of placed words; blank lines are wide gaps."""
    return structure.fragments_to_text(word_fragments(spark, sf_dir), "ocr").select("document_id", F.md5("text").alias("text_md5"))


def line_candidates(spark, sf_dir):
    """Lines of an order as the fragments of one heading candidate, placed by quantity and discount."""
    li, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    kind = F.col("l_partkey") % 7
    text = F.when(kind == 0, "PAGE").when(kind.isin(1, 2), (F.col("l_partkey") % 90).cast("string")).when(kind == 3, "Chapter.").otherwise(F.col("p_name"))
    rows = li.join(part, "l_partkey").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice").alias("o"), text.alias("text"), (10 + 6 * F.col("l_quantity")).cast("double").alias("x"), F.round(500 * F.col("l_discount")).alias("y"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("o", "text", "x", "y"))), lambda f: F.struct(f["text"].alias("text"), f["x"].alias("x"), f["y"].alias("y")))
    first = F.try_element_at(F.filter(F.col("parts"), lambda f: f["text"].rlike(r"^\d+$")), F.lit(1))["text"]
    return rows.groupBy(F.lit("orders").alias("document_id"), F.col("l_orderkey").alias("page_number")).agg(parts.alias("parts")).withColumns({"score": F.lit(2) + F.col("page_number") % 3, "number": first, "title": F.lit("t")})


def page_kinds(spark, sf_dir):
    """Kinds of pages: ten orders are a page, each a candidate."""
    c = line_candidates(spark, sf_dir).withColumns({"page_number": F.floor(F.col("page_number") / 10), "score": F.col("page_number") % 9})
    c = c.filter("page_number % 3 > 0 OR score < 2")
    pages = read(spark, sf_dir, "orders").select(F.lit("orders").alias("document_id"), F.floor(F.col("o_orderkey") / 10).alias("page_number"))
    return structure.classify_pages(pages, c).select("page_number", "page_type", F.col("strongest").cast("long").alias("strongest"))


def spatial_sections(spark, sf_dir):
    """Sections validated by where the fragments of their candidates lie."""
    c = line_candidates(spark, sf_dir)
    kinds = c.select("document_id", "page_number", F.when(F.col("page_number") % 5 == 0, "CONTENTS").otherwise("NORMAL").alias("page_type"))
    return structure.validate_sections(c, kinds, least=4.0).select("page_number", "section_number", "title", "confidence")


# --- loads and exports


def loaded_pages(spark, sf_dir):
    path = shared_folder(spark, "pages")
    docs = books.documents(spark, sf_dir).select(F.col("source").alias("document_id"), F.col("doc_id").cast("int").alias("page_number"), F.lit("body").alias("page_type"), F.col("lang").alias("source"), "text")
    docs.write.json(path)
    return sources.load_pages(spark, path, form="json").select("document_id", "page_number", "page_type", "source", F.md5("text").alias("text_md5"), F.col("raw_text").isNull().alias("no_raw"))


def loaded_fragments(spark, sf_dir):
    """Order lines as boxes: bad boxes lose their place, headers and blanks are dropped."""
    li = read(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_linenumber") == 1, "page_header").when(F.col("l_returnflag") == "A", "text")
    raw = li.select(
        F.col("l_returnflag").alias("document_id"), F.col("l_orderkey").cast("int").alias("page_number"), F.col("l_linenumber").alias("frag_idx"), F.when(F.col("l_suppkey") % 4 == 0, "  ").otherwise(F.col("l_partkey").cast("string")).alias("text"),
        F.col("l_quantity").cast("double").alias("x1"), F.lit(1.0).alias("y1"), F.lit(30.0).alias("x2"), F.lit(3.0).alias("y2"), label.alias("label"),
    )
    return sources.load_fragments(raw, pages=(10, 1_000_000)).select("document_id", "page_number", "frag_idx", "text", "x", "width", "height")


def exported_packages(spark, sf_dir):
    """Orders with their items as JSON lines, written and read back."""
    items = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("scene_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part")))).alias("items"))
    path = shared_folder(spark, "packages")
    sources.export_packages(items, path)
    back = spark.read.schema(items.schema).json(path)
    return back.select("scene_id", F.array_join(F.transform("items", lambda i: F.concat_ws(":", i["line"].cast("string"), i["part"].cast("string"))), ",").alias("items"))


def exported_texts(spark, sf_dir):
    """One folder of texts for each role of a conversation, written and read back."""
    turns = read(spark, sf_dir, "conversations").select(F.col("role").alias("kind"), F.regexp_replace("text", r"[\r\n]+", " ").alias("text")).filter("text <> ''")
    path = shared_folder(spark, "texts")
    sources.export_texts(turns, path)
    return spark.read.text(path).groupBy("kind", F.md5("value").alias("text_md5")).agg(F.count(F.lit(1)).alias("n"))


def package_summary(spark, sf_dir):
    checked = packages.quality_errors(books.documents(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id", "left"), books.RULES).select(F.col("doc_id").alias("scene_id"), "errors")
    out = sources.export_summary(checked)
    return out.select("scenes", "passed", "failed", F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["error"], e["count"].cast("string"))), ",").alias("errors"))


def cleaned_index(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    title = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("  Itâ€™s "), F.regexp_replace("p_name", " ", "  "))).when(F.col("p_partkey") % 3 == 1, F.concat(F.col("p_name"), F.lit(" cafÃ©"))).otherwise("   ")
    page = F.when(F.col("p_size") < 45, F.col("p_size").cast("string")).otherwise("x")
    return sources.clean_index(part.select("p_partkey", title.alias("title"), page.alias("page_number"))).select("p_partkey", "title", "page_number")


# --- text of scenes


def stripped_scenes(spark, sf_dir):
    """Scene texts without their title and number."""
    docs = books.documents(spark, sf_dir)
    first = F.element_at(F.split("text", " "), 1)
    text = F.concat(first, F.lit(" IV. "), F.col("text"))
    return docs.select("doc_id", F.md5(strip_heading(text, first)).alias("text_md5"))


def spoken_lines(spark, sf_dir):
    """Turns without a speaker's name in front."""
    turns = read(spark, sf_dir, "conversations")
    said = F.concat(F.initcap("role"), F.lit(" Smith: "), F.when(F.col("turn") % 2 == 0, "what ").otherwise(""), F.regexp_replace("text", r"\s+", " "))
    return turns.select("conv_id", "turn", F.md5(clean_dialogue(said, F.lit(""), r"^(?i)what$")).alias("text_md5"))


def compact_specs(spark, sf_dir):
    names = F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3,}"), 0)
    made = books.documents(spark, sf_dir).select(F.col("doc_id").alias("scene_id"), "text", names.alias("names"), F.split("text", "\n").alias("moments"), F.regexp_extract_all("text", F.lit("[a-z]{9,}"), 0).alias("objects"))
    spec = packages.compact_spec(made)
    return spec.select(F.col("scene_id").alias("doc_id"), F.array_join("names", ",").alias("names"), F.md5(F.array_join("actions", "|")).alias("actions_md5"), F.array_join("objects", ",").alias("objects"), F.md5(F.array_join("opening", "|")).alias("opening_md5"))


def evidence_kinds(spark, sf_dir):
    """Lines and items of each document as one list of evidence, counted by kind."""
    docs = books.documents(spark, sf_dir)
    typed = lambda c: F.transform(c, lambda t: F.struct(t.alias("text")))
    every = packages.evidence_list(("line", typed(F.split("text", "\n"))), ("name", typed(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3,}"), 0))))
    each = docs.select("doc_id", F.explode(every).alias("e"))
    return each.groupBy("doc_id", F.col("e.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("e.text")).alias("chars"))


def video_prompts(spark, sf_dir):
    """The prompt of the first clip; documents without a text have no plan and give a reason."""
    made = books.rendered(spark, sf_dir).withColumn("scene_id", F.col("doc_id"))
    ready = made.filter("doc_id % 5 > 0")
    bare = made.filter("doc_id % 5 = 0").withColumns({c: F.lit(None).cast(made.schema[c].dataType) for c in ("clips", "shots")})
    return packages.pick_prompt(ready.unionByName(bare), "video").select(F.col("scene_id").alias("doc_id"), F.md5("prompt").alias("prompt_md5"), "reason")


def document_labels(spark, sf_dir):
    """Books judged by all their pages, section titles and names."""
    book = books.pages(spark, sf_dir)
    heads = books.sections(book)
    names = books.name_mentions(spark, sf_dir).select("document_id", "canonical_name").distinct()
    lexicon = spark.createDataFrame(books.LANGUAGE_WORDS, "position int, dimension string, label string, phrase string, weight int")
    found = classify.classify_documents(classify.document_scope(book, heads, names), lexicon)
    return found.select("document_id", "dimension", "rank", "label", "score", "confidence")


# --- entities


def titled_parts(spark, sf_dir):
    """Parts, their nouns and titled nouns as characters (three ids in a row for each part key), with an item as a mention of one of them."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.initcap("p_name").alias("name"), F.initcap(F.element_at(F.split("p_name", " "), -1)).alias("noun"), (F.col("p_size") % 5 / 10.0 + 0.3).alias("c"))
    each = part.select(F.explode(F.array(F.struct((3 * F.col("p_partkey")).alias("id"), "name", "c"), F.struct((3 * F.col("p_partkey") + 1).alias("id"), F.col("noun").alias("name"), F.lit(0.4).alias("c")), F.struct((3 * F.col("p_partkey") + 2).alias("id"), F.concat(F.lit("Captain "), "noun").alias("name"), F.lit(0.8).alias("c")))).alias("e"))
    known = each.select(F.lit("b").alias("document_id"), F.lit("character").alias("entity_type"), F.col("e.id").alias("entity_id"), F.col("e.name").alias("canonical_name"), F.col("e.c").alias("confidence"), F.lit("").alias("profile_text"))
    li = read(spark, sf_dir, "lineitem")
    said = li.select((3 * F.col("l_partkey") + F.col("l_linenumber") % 3).alias("entity_id"), F.col("l_orderkey").alias("page_start"), F.col("l_linenumber").alias("scene_order"), F.concat_ws("-", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int")).alias("context"), F.round(F.col("l_discount") + 0.5, 2).alias("confidence"))
    return known, said


def merged_entities(spark, sf_dir):
    """Entities after both merges, with the profile of their first mentions."""
    kept = entities.resolve_entities(*titled_parts(spark, sf_dir))[0]
    return kept.select("entity_id", "canonical_name", F.round("confidence", 3).alias("confidence"), F.md5("profile_text").alias("profile_md5"))


def moved_mentions(spark, sf_dir):
    moved = entities.resolve_entities(*titled_parts(spark, sf_dir))[1]
    return moved.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_start").alias("pages"))


def entity_aliases(spark, sf_dir):
    return entities.resolve_entities(*titled_parts(spark, sf_dir))[2].select("entity_id", "alias", "method", F.round("confidence", 3).alias("confidence"))


def scene_candidates(spark, sf_dir):
    """All rules for people, places and settings over a sentence or two about each part: its noun speaks, its name is a place."""
    part = read(spark, sf_dir, "part")
    pick = lambda words: F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words) + 1).cast("int"))
    noun = F.initcap(F.element_at(F.split("p_name", " "), -1))
    text = F.concat(F.lit("Captain "), noun, F.lit(" said no. They went "), pick(lexicons.PLACE_CUES), F.lit(" the "), F.initcap("p_name"), F.lit(", past a dark "), pick(lexicons.SETTINGS), F.lit("."))
    found = entities.extract_mentions(part.select("p_partkey", text.alias("text")))
    return found.select("p_partkey", "entity_type", "canonical_name", "confidence")


# --- facts


#: What clauses in invented prose can say: (category, attribute, pattern, group, method).
PROSE_RULES = [
    ("appearance", "build", r"\b{name}\b[^.;!?]{{1,100}}\b(the|und|les|los)\b", 1, "subject"),
    ("clothing", "clothing", r"\b(?:with|avec|mit|con)\s+([^.;!?]{{3,40}})", 1, "worn"),
]


def clause_facts(spark, sf_dir):
    """Facts that clauses tell of the people they name."""
    mentions, members, found = chains.people(spark, sf_dir, contexts=True)
    told = facts.visual_facts(found, members, mentions.select("document_id", "entity_id", "scene_id", "context", "confidence"), PROSE_RULES)
    return told.select("document_id", "profile_id", "category", "attribute", "value", "scene_id", F.md5("evidence").alias("evidence_md5"), "confidence", "method")


def source_profiles(spark, sf_dir):
    """Canonical people with the names that they were put together from."""
    _, members, found = chains.people(spark, sf_dir)
    return facts.canonical_profiles(found, members).select("document_id", "group_id", F.array_join("source_ids", ",").alias("source_ids"))


def user_profiles(spark, sf_dir):
    """Users as profiles: every third an environment, every third an object."""
    e = read(spark, sf_dir, "events")
    kind = F.when(F.col("user_id") % 3 == 0, "environment").when(F.col("user_id") % 3 == 1, "object").otherwise("character")
    sums = e.groupBy("user_id").agg(F.round(F.count(F.lit(1)) / 50, 2).alias("confidence"))
    return sums.select(F.lit(1).alias("document_id"), F.col("user_id").alias("profile_id"), kind.alias("profile_type"), F.concat(F.lit("n"), (F.col("user_id") % 40).cast("string")).alias("canonical_name"), "confidence")


def profiles_by_kind(spark, sf_dir):
    """All profiles of the three kinds with how many facts they have and the surest of them."""
    known, told = user_profiles(spark, sf_dir), tables.event_facts(spark, sf_dir)
    out = None
    for kind in ("character", "environment", "object"):
        part = facts.profile_reads(known, told, kind)
        out = part if out is None else out.unionByName(part)
    first = F.try_element_at("facts", F.lit(1))
    return out.select("profile_id", "profile_type", "canonical_name", "confidence", F.size("facts").alias("facts"), F.concat_ws("=", first["attribute"], first["value"]).alias("surest"))


def profile_by_name(spark, sf_dir):
    """One profile of a name: the feature is the lookup."""
    found = facts.profile_reads(user_profiles(spark, sf_dir), tables.event_facts(spark, sf_dir), "object", name="n4")
    return found.select("profile_id", "canonical_name", "confidence", F.size("facts").alias("facts"))


def scene_states(spark, sf_dir):
    """Users seen in each stretch of events with the facts told there."""
    told = tables.event_facts(spark, sf_dir)
    seen = told.select(F.lit(1).alias("document_id"), "scene_id", F.col("profile_id").alias("entity_id"))
    owners = seen.select("entity_id", F.col("entity_id").alias("profile_id"), F.col("entity_id").cast("string").alias("canonical_name")).distinct()
    out = facts.scene_state(seen, owners, told)
    return out.select("scene_id", "profile_id", "canonical_name", F.size("facts").alias("facts"), F.md5(F.array_join(F.transform("facts", lambda f: F.concat_ws("=", f["attribute"], f["value"])), ",")).alias("facts_md5"))


def character_contexts(spark, sf_dir):
    told = tables.event_facts(spark, sf_dir).withColumn("category", F.when(F.col("attribute") == "clothing", "clothing").otherwise(F.col("category")))
    known = told.select(F.col("profile_id").alias("group_id"), F.col("profile_id").cast("string").alias("canonical_name")).distinct()
    names = told.select(F.col("profile_id").alias("group_id"), F.col("value").alias("alias"))
    out = facts.character_context(known, names, told)
    count = lambda k: F.coalesce(F.size(F.try_element_at("facts_by_category", F.lit(k))), F.lit(0))
    return out.select("profile_id", F.array_join("aliases", ",").alias("aliases"), count("appearance").alias("appearance"), count("clothing").alias("clothing"))


def expanded_scenes(spark, sf_dir):
    """Stretches of events with the profiles that their id arrays name."""
    told = tables.event_facts(spark, sf_dir)
    context = told.groupBy("scene_id").agg(F.array_sort(F.collect_set("profile_id")).alias("ids"))
    out = facts.expanded_context(context, user_profiles(spark, sf_dir).filter("confidence > 0.2"), ids={"ids": "characters"})
    return out.select("scene_id", F.size("characters").alias("characters"), F.md5(F.array_join(F.transform("characters", lambda c: c["canonical_name"]), ",")).alias("names_md5"))


def environment_states(spark, sf_dir):
    out = continuity.environment_state(user_profiles(spark, sf_dir).withColumn("canonical_name", F.concat_ws(".", "canonical_name", "profile_id")), tables.event_facts(spark, sf_dir))
    shown = F.transform(F.map_entries("environment_state"), lambda e: F.concat_ws(":", e["key"], F.array_join(F.transform(e["value"], lambda f: F.concat_ws("=", f["attribute"], f["value"])), ",")))
    return out.select("scene_id", F.md5(F.array_join(F.array_sort(shown), ";")).alias("state_md5"))


def health_report(spark, sf_dir):
    """Jobs, assets and uses of each order priority."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("media_type"))
    queue = tables.order_queue(spark, sf_dir).select(F.col("provider").alias("media_type"), "status")
    kept = tables.assets(spark, sf_dir).join(orders, "job_id").select("media_type", "status")
    used = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("job_id")).select("media_type")
    return jobs.health_report(queue, kept, used)


# --- searches


def bm25_of_language(spark, sf_dir):
    """The 8 best documents in English among those that hold all words of a passage."""
    english = books.documents(spark, sf_dir).filter("lang = 'en'").select("doc_id")
    found = index.search_index(books.stored_index(spark, sf_dir), books.passages(spark, sf_dir), allowed=english, id_type="long")
    return found.select("query_id", "rank", F.col("id").cast("long").alias("doc_id"), F.round("score", 4).alias("score"))


QUERIES = {f.__name__: f for f in (
    page_stats, layout_lines, layout_page_text, page_kinds, spatial_sections, loaded_pages, loaded_fragments, exported_packages, exported_texts, package_summary, cleaned_index,
    stripped_scenes, spoken_lines, compact_specs, evidence_kinds, video_prompts, document_labels, merged_entities, moved_mentions, entity_aliases, scene_candidates,
    clause_facts, source_profiles, profiles_by_kind, profile_by_name, scene_states, character_contexts, expanded_scenes, environment_states, health_report, bm25_of_language,
)}


# --- the same in SQL

_E = r"[^\p{L}\p{Nd}_]"
_N = r"[^.;!?\p{L}\p{Nd}_]"
_WORDS = r"""l_ AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS said, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
w_ AS (SELECT doc_id, line, unnest(string_split(said, ' ')) AS t, generate_subscripts(string_split(said, ' '), 1) - 1 AS k FROM l_),
words AS (SELECT doc_id, line, k, trim(t) AS t, line * 12.0::DOUBLE + k % 3 + 5 AS mid, CASE WHEN regexp_matches(t, '^\p{Lu}') THEN 14.0::DOUBLE ELSE 10.0::DOUBLE END AS size FROM w_ WHERE trim(t) <> '')"""
_LINES = rf"""{_WORDS},
lines_ AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS line, quantile_cont(mid, 0.5) AS y, string_agg(t, ' ' ORDER BY k) AS raw FROM words GROUP BY doc_id, words.line),
lines AS (SELECT doc_id, line, y, regexp_replace(regexp_replace(regexp_replace(raw, ' ([,.;:!?%)\]}}])', '\1', 'g'), '([(\[{{—–/]) ', '\1', 'g'), '- (\p{{Ll}})', '\1', 'g') AS t FROM lines_)"""
_PARTS = r"""f AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_discount, l_extendedprice) AS i,
  CASE WHEN l_partkey % 7 = 0 THEN 'PAGE' WHEN l_partkey % 7 IN (1, 2) THEN CAST(l_partkey % 90 AS VARCHAR) WHEN l_partkey % 7 = 3 THEN 'Chapter.' ELSE p_name END AS t, l_partkey % 7 IN (1, 2) AS num,
  10 + 6 * l_quantity AS x, round(500 * l_discount) AS y FROM lineitem JOIN part ON p_partkey = l_partkey)"""
_PARTED = """e AS (SELECT 3 * p_partkey AS id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name, p_size % 5 / 10.0::DOUBLE + 0.3::DOUBLE AS c FROM part
  UNION ALL SELECT 3 * p_partkey + 1, upper(string_split(p_name, ' ')[-1][1]) || lower(string_split(p_name, ' ')[-1][2:]), 0.4::DOUBLE FROM part
  UNION ALL SELECT 3 * p_partkey + 2, 'Captain ' || upper(string_split(p_name, ' ')[-1][1]) || lower(string_split(p_name, ' ')[-1][2:]), 0.8::DOUBLE FROM part),
x AS (SELECT *, first_value(id) OVER (PARTITION BY lower(name) ORDER BY c DESC, id) AS won FROM e),
winners AS (SELECT * FROM x WHERE id = won),
titled AS (SELECT s.id AS short, f.id AS long, s.name AS alias FROM winners f JOIN winners s ON f.name = 'Captain ' || s.name WHERE length(s.name) >= 4 AND f.c >= s.c),
mapping AS (SELECT x.id, coalesce(t.long, x.won) AS canonical, x.name FROM x LEFT JOIN titled t ON t.short = x.won),
said AS (SELECT coalesce(m.canonical, 3 * l_partkey + l_linenumber % 3) AS id, l_orderkey AS page, l_linenumber AS scene, concat_ws('-', l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER)) AS context, round(l_discount + 0.5, 2) AS c
  FROM lineitem LEFT JOIN mapping m ON m.id = 3 * l_partkey + l_linenumber % 3)"""
_USERS = "u AS (SELECT user_id AS profile_id, CASE user_id % 3 WHEN 0 THEN 'environment' WHEN 1 THEN 'object' ELSE 'character' END AS profile_type, 'n' || (user_id % 40) AS canonical_name, round(count(*) / 50.0::DOUBLE, 2) AS confidence FROM events GROUP BY user_id)"

ORACLES = {
    "page_stats": f"WITH {_WORDS} SELECT CAST(doc_id AS VARCHAR) AS document_id, round(quantile_cont(size, 0.5), 3) AS body_size, max(k * 10.0::DOUBLE + 8) AS page_width FROM words GROUP BY 1",
    "layout_lines": f"WITH {_LINES} SELECT CAST(doc_id AS VARCHAR) AS document_id, line, y, md5(t) AS text_md5 FROM lines",
    "layout_page_text": f"""WITH {_LINES}, g AS (SELECT *, abs(y - lag(y) OVER (PARTITION BY doc_id ORDER BY line)) AS gap FROM lines), ty AS (SELECT doc_id, quantile_cont(gap, 0.5) FILTER (WHERE gap > 0) AS typical FROM g GROUP BY 1),
c AS (SELECT g.*, sum(CASE WHEN gap > greatest(18.0, 0.9 * coalesce(typical, 10.0)) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS para FROM g JOIN ty USING (doc_id)),
p AS (SELECT doc_id, para, string_agg(t, ' ' ORDER BY line) AS t FROM c GROUP BY 1, 2)
SELECT CAST(doc_id AS VARCHAR) AS document_id, md5(string_agg(t, chr(10) || chr(10) ORDER BY para)) AS text_md5 FROM p GROUP BY 1""",
    "page_kinds": """WITH c AS (SELECT l_orderkey AS k, bool_or(l_partkey % 7 IN (1, 2)) AS num FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
p AS (SELECT k // 10 AS page_number, k % 9 AS score, num FROM c WHERE (k // 10) % 3 > 0 OR k % 9 < 2),
g AS (SELECT page_number, count(*) AS n, count(*) FILTER (WHERE num) AS numbered, max(score) FILTER (WHERE num) AS best, max(score) AS strongest FROM p GROUP BY 1),
o AS (SELECT DISTINCT o_orderkey // 10 AS page_number FROM orders)
SELECT page_number, CASE WHEN n IS NULL THEN 'NORMAL' WHEN numbered >= 2 THEN 'CONTENTS' WHEN best >= 7 THEN 'SECTION_START' ELSE 'UNKNOWN' END AS page_type, strongest FROM o LEFT JOIN g USING (page_number)""",
    "spatial_sections": f"""WITH {_PARTS},
w AS (SELECT *, last_value(CASE WHEN num THEN x END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nx, arg_min(x, i) FILTER (WHERE num) OVER (PARTITION BY k) AS fx FROM f),
t AS (SELECT *, coalesce(nx IS NOT NULL AND NOT num AND t <> 'Chapter.' AND t <> 'PAGE' AND x <= nx + 250, false) AS named FROM w),
g AS (SELECT k, arg_min(t, i) FILTER (WHERE num) AS section_number, string_agg(t, ' ' ORDER BY x, i) FILTER (WHERE named) AS title, count(*) FILTER (WHERE named) AS n, max(y) FILTER (WHERE named) - min(y) FILTER (WHERE named) AS spread,
  bool_or(x > fx + 250 AND (num OR t = 'PAGE')) AS listed, bool_or(t = 'PAGE') AS marked FROM t GROUP BY 1),
s AS (SELECT *, 2 + k % 3 + 4.0::DOUBLE + CASE WHEN n >= 2 AND spread <= 40 THEN 1.5 ELSE 0 END - CASE WHEN k % 5 = 0 THEN 5 ELSE 0 END - CASE WHEN marked THEN 4 ELSE 0 END AS confidence FROM g WHERE section_number IS NOT NULL AND n > 0 AND NOT listed)
SELECT k AS page_number, section_number, title, confidence FROM s WHERE confidence >= 4""",
    "loaded_pages": "SELECT source AS document_id, doc_id AS page_number, 'body' AS page_type, lang AS source, md5(text) AS text_md5, true AS no_raw FROM documents",
    "loaded_fragments": """SELECT l_returnflag AS document_id, l_orderkey AS page_number, l_linenumber AS frag_idx, CAST(l_partkey AS VARCHAR) AS text, CASE WHEN l_quantity <= 30 THEN CAST(l_quantity AS DOUBLE) END AS x, CASE WHEN l_quantity <= 30 THEN 30.0::DOUBLE - l_quantity END AS width, CASE WHEN l_quantity <= 30 THEN 2.0::DOUBLE END AS height
FROM lineitem WHERE l_suppkey % 4 <> 0 AND l_linenumber <> 1 AND l_orderkey BETWEEN 10 AND 1000000""",
    "exported_packages": "SELECT l_orderkey AS scene_id, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS items FROM lineitem GROUP BY 1",
    "exported_texts": r"SELECT role AS kind, md5(regexp_replace(text, '[\r\n]+', ' ', 'g')) AS text_md5, count(*) AS n FROM conversations WHERE regexp_replace(text, '[\r\n]+', ' ', 'g') <> '' GROUP BY 1, 2",
    "package_summary": """WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
r AS (SELECT doc_id, list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty_text' END, CASE WHEN length(text) < 200 THEN 'short_text' END, CASE WHEN length(text) > 5000 THEN 'long_text' END, CASE WHEN contains(text, '!!') THEN 'shouting' END, CASE WHEN quality IS NULL THEN 'unlabelled' END], lambda x: x IS NOT NULL) AS errors FROM j),
h AS (SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM r) GROUP BY 1)
SELECT count(*) AS scenes, count(*) FILTER (WHERE len(errors) = 0) AS passed, count(*) FILTER (WHERE len(errors) > 0) AS failed, (SELECT string_agg(error || ':' || n, ',' ORDER BY n DESC, error) FROM h) AS errors FROM r""",
    "cleaned_index": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'It''s ' || p_name ELSE p_name || ' café' END AS title, p_size AS page_number FROM part WHERE p_partkey % 3 < 2 AND p_size < 45",
    "stripped_scenes": r"SELECT doc_id, md5(trim(CASE WHEN regexp_matches(text, '^\s*[A-Z]') THEN regexp_replace(text, '^\s+', '') ELSE 'IV. ' || text END)) AS text_md5 FROM documents",
    "spoken_lines": r"""WITH t AS (SELECT *, upper(role[1]) || lower(role[2:]) AS who FROM conversations)
SELECT conv_id, turn, md5(trim(regexp_replace(CASE WHEN turn % 2 = 0 THEN 'what ' ELSE who || ' Smith: ' END || text, '\s+', ' ', 'g'))) AS text_md5 FROM t""",
    "compact_specs": r"""WITH a AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS x, generate_subscripts(regexp_extract_all(text, '[A-Z][a-z]{3,}'), 1) AS i FROM documents),
n AS (SELECT doc_id, lower(x) AS l, arg_min(x, i) AS x, min(i) AS i FROM a GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) <= 6), ns AS (SELECT doc_id, string_agg(x, ',' ORDER BY i) AS names FROM n GROUP BY 1),
b AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-z]{9,}')) AS x, generate_subscripts(regexp_extract_all(text, '[a-z]{9,}'), 1) AS i FROM documents),
o AS (SELECT doc_id, x, min(i) AS i FROM b GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) <= 8), os AS (SELECT doc_id, string_agg(x, ',' ORDER BY i) AS objects FROM o GROUP BY 1),
s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')[1:3] AS opening FROM documents)
SELECT doc_id, coalesce(names, '') AS names, md5(array_to_string(string_split(text, chr(10))[1:5], '|')) AS actions_md5, coalesce(objects, '') AS objects, md5(array_to_string(opening, '|')) AS opening_md5
FROM documents JOIN s USING (doc_id) LEFT JOIN ns USING (doc_id) LEFT JOIN os USING (doc_id)""",
    "evidence_kinds": """WITH e AS (SELECT doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS t FROM documents UNION ALL SELECT doc_id, 'name', unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}')) FROM documents)
SELECT doc_id, kind, count(*) AS n, sum(length(t))::BIGINT AS chars FROM e GROUP BY 1, 2""",
    "video_prompts": f"WITH {oracles._RENDERED} SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN md5(image_prompt) END AS prompt_md5, CASE WHEN doc_id % 5 = 0 THEN 'video_plan_unavailable' END AS reason FROM re",
    "document_labels": f"""WITH {books.SECTIONS_SQL}, {books.MENTIONS_SQL},
scope AS (SELECT source AS d, text AS t FROM documents UNION ALL SELECT document_id, title FROM sections_ UNION ALL SELECT source, name FROM names_),
hits AS (SELECT DISTINCT d, l.dimension, l.label, l.phrase, l.weight, l.position FROM scope, {books._LEXICON.replace('AS lex', 'AS l')} WHERE contains(lower(regexp_replace(t, '\\s+', ' ', 'g')), l.phrase)),
scored AS (SELECT d, dimension, label, sum(weight) AS score, min(position) AS position FROM hits GROUP BY 1, 2, 3)
SELECT d AS document_id, dimension, row_number() OVER (PARTITION BY d, dimension ORDER BY score DESC, position, label) AS rank, label, CAST(score AS BIGINT) AS score,
  round(least(0.995, 0.5 + 0.45 * (score / greatest(score + sum(score) OVER (PARTITION BY d, dimension), 1))), 3) AS confidence FROM scored""",
    "merged_entities": f"""WITH {_PARTED}, m AS (SELECT id, max(c) AS c FROM said GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page, scene, context) AS n FROM said),
p AS (SELECT id, substr(string_agg(context, chr(10) || chr(10) ORDER BY n), 1, 6000) AS profile FROM r WHERE n <= 12 GROUP BY 1)
SELECT w.id AS entity_id, w.name AS canonical_name, round(coalesce(m.c, w.c), 3) AS confidence, md5(coalesce(p.profile, '')) AS profile_md5 FROM winners w LEFT JOIN m USING (id) LEFT JOIN p USING (id) WHERE w.id NOT IN (SELECT short FROM titled)""",
    "moved_mentions": f"WITH {_PARTED} SELECT id AS entity_id, count(*) AS n, count(DISTINCT page) AS pages FROM said GROUP BY 1",
    "entity_aliases": f"""WITH {_PARTED}, a AS (SELECT canonical AS entity_id, name AS alias, 'source_spelling' AS method, 1.0::DOUBLE AS confidence, 1 AS rank FROM mapping
UNION ALL SELECT won, name, 'normalized_exact', least(c, 0.95), 0 FROM x WHERE id <> won UNION ALL SELECT long, alias, 'titled_name_variant', 0.82, 0 FROM titled)
SELECT entity_id, alias, method, round(confidence, 3) AS confidence FROM a QUALIFY row_number() OVER (PARTITION BY entity_id, lower(alias) ORDER BY rank, alias, confidence DESC, method) = 1""",
    "scene_candidates": f"""WITH n AS (SELECT p_partkey, list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])) AS w FROM part)
SELECT p_partkey, 'character' AS entity_type, 'Captain ' || w[-1] AS canonical_name, 0.8::DOUBLE AS confidence FROM n UNION ALL SELECT p_partkey, 'location', array_to_string(w, ' '), 0.6 FROM n
UNION ALL SELECT p_partkey, 'environment', 'a dark ' || ({chains._LIST(lexicons.SETTINGS)})[p_partkey % {len(lexicons.SETTINGS)} + 1], 0.65 FROM n""",
    "clause_facts": rf"""WITH RECURSIVE {chains.PEOPLE_SQL},
ctx AS (SELECT source || '|' || name AS id, doc_id, trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220)) AS context FROM (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_)),
own AS (SELECT m.d, m.g, m.id, m.name FROM members m JOIN people p ON p.d = m.d AND p.g = m.g WHERE p.status IS NOT NULL),
loc AS (SELECT d, g, name, doc_id, context, strpos(lower(context), lower(name)) AS p FROM own JOIN ctx USING (id)),
cut AS (SELECT d, g, name, doc_id, trim(unnest(string_split(regexp_replace(regexp_replace(substr(context, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220), '([.!?;])\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)))) AS clause FROM loc WHERE p > 0),
cl AS (SELECT * FROM cut WHERE clause <> '' AND contains(lower(clause), lower(name)) AND regexp_matches(translate(clause, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:^|{_E})' || translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '(?:{_E}|$)')),
v AS (SELECT *, 'appearance' AS category, 'build' AS attribute, 'subject' AS method, CASE WHEN regexp_matches(clause, '(?i)(?:{_E})(?:the|und|les|los)(?:{_E}|$)') THEN regexp_extract(clause, '(?i)(?:^|{_E})' || name || '(?:{_N}[^.;!?]{{0,98}}{_N}|{_N})(the|und|les|los)(?:{_E}|$)', 1) ELSE '' END AS value FROM cl
  UNION ALL SELECT *, 'clothing', 'clothing', 'worn', regexp_extract(clause, '(?i)(?:^|{_E})(?:with|avec|mit|con)\s+([^.;!?]{{3,40}})', 1) FROM cl),
c AS (SELECT * REPLACE (substr(regexp_replace(trim(value, ' ,.;:!?"()[]''' || chr(9) || chr(10) || chr(13)), '\s+', ' ', 'g'), 1, 300) AS value) FROM v)
SELECT d AS document_id, g AS profile_id, category, attribute, min(value) AS value, doc_id AS scene_id, md5(clause) AS evidence_md5, 0.45::DOUBLE AS confidence, method FROM c WHERE value <> '' GROUP BY d, g, category, attribute, doc_id, clause, method""",
    "source_profiles": f"""WITH RECURSIVE {chains.PEOPLE_SQL} SELECT p.d AS document_id, p.g AS group_id, string_agg(m.id, ',' ORDER BY m.confidence DESC, m.id) AS source_ids FROM members m JOIN people p ON p.d = m.d AND p.g = m.g WHERE p.status IS NOT NULL GROUP BY 1, 2""",
    "profiles_by_kind": f"""WITH {tables._FACTS}, {_USERS}, t AS (SELECT profile_id, count(*) AS n, arg_min(attribute || '=' || value, (-confidence, fact_id)) AS surest FROM f GROUP BY 1)
SELECT profile_id, profile_type, canonical_name, confidence, coalesce(n, 0) AS facts, coalesce(surest, '') AS surest FROM u LEFT JOIN t USING (profile_id)""",
    "profile_by_name": f"""WITH {tables._FACTS}, {_USERS}, b AS (SELECT * FROM u WHERE profile_type = 'object' AND canonical_name = 'n4' ORDER BY confidence DESC, profile_id LIMIT 1)
SELECT profile_id, canonical_name, confidence, (SELECT count(*) FROM f WHERE f.profile_id = b.profile_id) AS facts FROM b""",
    "scene_states": f"WITH {tables._FACTS} SELECT scene_id, profile_id, CAST(profile_id AS VARCHAR) AS canonical_name, count(*) AS facts, md5(string_agg(attribute || '=' || value, ',' ORDER BY attribute, value)) AS facts_md5 FROM f GROUP BY 1, 2",
    "character_contexts": f"WITH {tables._FACTS} SELECT profile_id, array_to_string(list_sort(list_distinct(list(value))), ',') AS aliases, count(*) FILTER (WHERE attribute <> 'clothing') AS appearance, count(*) FILTER (WHERE attribute = 'clothing') AS clothing FROM f GROUP BY 1",
    "expanded_scenes": f"""WITH {tables._FACTS}, {_USERS}, i AS (SELECT DISTINCT scene_id, profile_id FROM f)
SELECT scene_id, count(u.profile_id) AS characters, md5(coalesce(string_agg(canonical_name, ',' ORDER BY profile_id) FILTER (WHERE u.profile_id IS NOT NULL), '')) AS names_md5 FROM i LEFT JOIN (SELECT * FROM u WHERE confidence > 0.2) u USING (profile_id) GROUP BY 1""",
    "environment_states": f"""WITH {tables._FACTS}, {_USERS}, e AS (SELECT scene_id, canonical_name || '.' || profile_id || ':' || string_agg(attribute || '=' || value, ',' ORDER BY f.confidence DESC, fact_id) AS t FROM f JOIN u USING (profile_id) WHERE profile_type = 'environment' GROUP BY scene_id, profile_id, canonical_name)
SELECT scene_id, md5(string_agg(t, ';' ORDER BY t)) AS state_md5 FROM e GROUP BY 1""",
    "health_report": f"""WITH {tables._QUEUE}, a AS (SELECT l_orderkey AS o_orderkey, CASE min(l_returnflag) WHEN 'A' THEN 'validated' WHEN 'N' THEN 'pending' ELSE 'review' END AS status FROM lineitem GROUP BY 1), b AS (SELECT o_orderpriority AS p, status FROM a JOIN orders USING (o_orderkey))
SELECT provider AS media_type, 'queue' AS area, status, count(*) AS n FROM q GROUP BY 1, 2, 3 UNION ALL SELECT p, 'assets', status, count(*) FROM b GROUP BY 1, 2, 3 UNION ALL SELECT p, 'assets', 'total', count(*) FROM b GROUP BY 1
UNION ALL SELECT o_orderpriority, 'usage', 'records', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
    "bm25_of_language": books.ORACLES["bm25_topk"].replace("WHERE have = need)", "WHERE have = need AND doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en'))"),
}
