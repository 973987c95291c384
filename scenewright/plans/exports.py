"""Queries of exported layouts and of visual profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons
from ..functions.folders import kept, shared_folder
from ..operators import classify, entities, profiles, segment
from ..sources import layouts
from . import books, details, tables
from .tables import read


def exported_tables(spark, sf_dir):
    """The eight tables: sections and stories of books, documents as scenes, their names, the aliases of parts, and logged events."""
    book = books.pages(spark, sf_dir)
    cut = kept(books.sections(book), "sections")
    sections = cut.withColumns({"section_number": F.col("section_order") % 3, "confidence": 1 / F.col("section_order"), "detection_method": F.lit("opening")})
    stories = segment.stories(book, cut).withColumns({"section_id": F.col("section_order"), "confidence": 1 / F.col("story_order"), "segmentation_method": F.lit("section")})
    scenes = books.documents(spark, sf_dir).select(
        F.col("source").alias("document_id"), F.col("doc_id").alias("scene_id"), F.lit(1).alias("story_id"), F.col("doc_id").alias("scene_order"), F.element_at(F.split("text", "\n"), 1).alias("title"),
        F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), (1 / F.length("text")).alias("confidence"), F.lit("page").alias("segmentation_method"), "text",
    )
    said = kept(books.name_mentions(spark, sf_dir), "mentions")
    own = F.concat_ws("|", "document_id", "canonical_name")
    named = entities.entities(said, order=["scene_order"]).select("document_id", own.alias("entity_id"), F.lit("character").alias("entity_type"), "canonical_name", "profile_text", "confidence", F.lit("capitals").alias("discovery_method"))
    mentions = said.select(
        "document_id", F.concat_ws("|", "scene_order", "canonical_name").alias("mention_id"), own.alias("entity_id"), F.col("scene_order").alias("scene_id"), F.lit(1).alias("story_id"),
        F.col("scene_order").alias("page_start"), F.lit(None).cast("int").alias("page_end"), F.col("canonical_name").alias("mention_text"), "context", "confidence",
    )
    aliases = entities.resolve_entities(*details.titled_parts(spark, sf_dir))[2].select("document_id", F.concat_ws("|", "entity_id", "alias").alias("alias_id"), "entity_id", "alias", F.col("method").alias("resolution_method"), "confidence")
    events = read(spark, sf_dir, "events").select(
        F.col("event_type").alias("document_id"), "event_id", F.col("user_id").alias("scene_id"), F.col("event_id").alias("event_order"), F.col("event_type").alias("title"), F.lit(None).cast("int").alias("page_start"),
        F.lit(None).cast("int").alias("page_end"), (F.col("value") / 8).alias("confidence"), F.lit("log").alias("discovery_method"), F.col("props").alias("text"),
    )
    # a division by ranges looks at its rows twice, so what takes work is kept first
    return {"chapter_index": sections, "sections": sections, "stories": kept(stories, "stories"), "scenes": scenes, "entities": kept(named, "entities"), "entity_mentions": mentions, "entity_aliases": kept(aliases, "aliases"), "events": events}


def exported_layouts(spark, sf_dir):
    """Every table written as CSV in its layout and read back: how often each row is there."""
    path = shared_folder(spark, "layouts")
    found = exported_tables(spark, sf_dir)
    layouts.export_all(found, path)
    out = None
    for name in found:
        rows = layouts.read_layout(spark, name, f"{path}/{name}")
        rows = rows.select(F.lit(name).alias("layout"), F.md5(F.concat_ws("|", *rows.columns)).alias("row_md5"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("layout", "row_md5").agg(F.count(F.lit(1)).alias("n"))


#: Words that stand for signals of the world a document tells of; `saga` is a genre that no policy knows.
WORLD_WORDS = [
    (0, "narrative_type", "mythology", "und", 3), (1, "narrative_type", "fantasy", "que", 3), (2, "narrative_type", "historical", "trash", 2), (3, "narrative_type", "saga", "with", 1),
    (4, "culture", "greek", "les", 2), (5, "culture", "roman", "los", 2), (6, "period", "modern", "from", 1), (7, "period", "ancient", "that", 1),
]
PROFILE_ROLES = [("warrior", "idiot|clown"), ("elder", "the"), ("ruler", "que")]


def visual_profiles(spark, sf_dir):
    """Documents as characters named by their first line; what is told of the user of the same number is what the source tells."""
    docs = books.documents(spark, sf_dir)
    seen = classify.classify_documents(docs, spark.createDataFrame(WORLD_WORDS, "position int, dimension string, label string, phrase string, weight int"), id_col="doc_id")
    people = docs.select("doc_id", F.element_at(F.split("text", "\n"), 1).alias("canonical_name"), F.array("text").alias("contexts"))
    people = people.join(profiles.genres(seen, id_col="doc_id"), "doc_id", "left").join(profiles.context_labels(seen, id_col="doc_id"), "doc_id", "left")
    standing = F.when(F.col("value") == "error", "Conflict").otherwise("supported")
    name = F.when(F.col("attribute") == "hair", "hair_color").when(F.col("attribute") == "weather", "expression").otherwise("clothing")
    told = tables.event_facts(spark, sf_dir).select(F.col("profile_id").alias("doc_id"), name.alias("attribute"), "value", standing.alias("status"))
    out = profiles.visual_profiles(people, told, key="doc_id", roles=PROFILE_ROLES)
    join = lambda c, *f: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[n] for n in f])), "|")
    return out.select(
        "doc_id", "visual_role", "genre", "identity_anchor", join("source_facts", "attribute", "value").alias("source_facts"),
        join("inferred_facts", "attribute", "basis", "value").alias("inferred_facts"), F.array_join("unknown_attributes", "|").alias("unknown_attributes"),
    )


QUERIES = {f.__name__: f for f in (exported_layouts, visual_profiles)}

_PLACES = "CAST(CAST(format('{{:.3f}}', {0}) AS DOUBLE) AS VARCHAR)".format
_NUMBER = "CASE WHEN section_order % 3 = 0 THEN '' ELSE CAST(section_order % 3 AS VARCHAR) END"


def _rows(layout: str, key: str, values: list[str], rows: str) -> str:
    shown = " || '|' || ".join(f"coalesce(CAST({v} AS VARCHAR), '')" for v in [key, *values])
    return f"SELECT '{layout}' AS layout, md5({shown}) AS row_md5 FROM {rows}"


_CONTEXT = "trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220))"
_EXPORTED = [
    _rows("chapter_index", "document_id", [_NUMBER, "title", "page_start"], "sections_"),
    _rows("sections", "document_id", ["section_order", _NUMBER, "title", "page_start", "page_end", _PLACES("1 / section_order"), "'opening'"], "sections_"),
    _rows("stories", "document_id", ["story_order", "section_order", "section_order || '. ' || title", "page_start", "page_end", _PLACES("1 / story_order"), "'section'", "text"], "numbered_"),
    _rows("scenes", "source", ["doc_id", "1", "doc_id", "string_split(text, chr(10))[1]", "1", "1", _PLACES("1 / length(text)"), "'page'", "text"], "documents"),
    _rows("entities", "source", ["source || '|' || name", "'character'", "name", "profile", "'0.45'", "'capitals'"], "named_"),
    _rows("entity_mentions", "source", ["doc_id || '|' || name", "source || '|' || name", "doc_id", "1", "doc_id", "NULL", "name", "context", "'0.45'"], "said_"),
    _rows("entity_aliases", "'b'", ["entity_id || '|' || alias", "entity_id", "alias", "method", _PLACES("confidence")], "aliases_"),
    _rows("events", "event_type", ["event_id", "user_id", "event_id", "event_type", "NULL", "NULL", _PLACES("value / 8"), "'log'", "props"], "events"),
]


def _values(rows: list[tuple]) -> str:
    said = [", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in r) for r in rows]
    return "(VALUES " + ", ".join(f"({r})" for r in said) + ")"


_SUPPOSED = [(g, 100 + i, v) for g, vs in lexicons.GENRE_BASELINES.items() for i, v in enumerate(vs)]
_OF_ROLES = [(r, 200 + i, v) for r, vs in lexicons.ROLE_PRIORS.items() for i, v in enumerate(vs)]

ORACLES = {
    "exported_layouts": f"""WITH {books.SECTIONS_SQL}, {books.MENTIONS_SQL},
told_ AS (SELECT s.document_id, s.section_order, s.title, s.page_start, s.page_end, string_agg(p.text, chr(10) || chr(10) ORDER BY p.page_number) AS text
  FROM sections_ s JOIN pages_ p ON p.document_id = s.document_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE trim(p.text) <> '' GROUP BY ALL),
numbered_ AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY section_order) AS story_order FROM told_),
said_ AS (SELECT source, doc_id, name, {_CONTEXT} AS context FROM (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_)),
few_ AS (SELECT *, row_number() OVER (PARTITION BY source, name ORDER BY doc_id) AS k FROM said_),
named_ AS (SELECT source, name, string_agg(context, chr(10) || chr(10) ORDER BY doc_id) FILTER (WHERE k <= 5) AS profile FROM few_ GROUP BY 1, 2),
aliases_ AS ({details.ORACLES["entity_aliases"]}), out_ AS ({" UNION ALL ".join(_EXPORTED)})
SELECT layout, row_md5, count(*) AS n FROM out_ GROUP BY 1, 2""",
    "visual_profiles": rf"""WITH {tables._FACTS}, lex AS (SELECT * FROM {_values(WORLD_WORDS)} t(position, dimension, label, phrase, weight)),
hit AS (SELECT doc_id, dimension, label, sum(weight) AS s, min(position) AS p FROM documents JOIN lex ON contains(lower(text), phrase) GROUP BY ALL),
best AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id, dimension ORDER BY s DESC, p, label) = 1),
lab AS (SELECT doc_id, list('detected ' || dimension || ': ' || label ORDER BY dimension) AS labels FROM best WHERE dimension IN ('culture', 'period') GROUP BY 1),
c0 AS (SELECT doc_id, rtrim(substr(trim(regexp_replace(string_split(text, chr(10))[1], '\s+', ' ', 'g')), 1, 120)) AS name, rtrim(substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 220)) AS seen FROM documents),
c1 AS (SELECT doc_id, name, coalesce(b.label, 'general_narrative') AS genre, coalesce(labels, []) AS labels, name || ' ' || seen AS hay FROM c0 LEFT JOIN (SELECT * FROM best WHERE dimension = 'narrative_type') b USING (doc_id) LEFT JOIN lab USING (doc_id)),
c AS (SELECT *, CASE WHEN regexp_matches(hay, 'idiot|clown') THEN 'warrior' WHEN contains(hay, 'the') THEN 'elder' WHEN contains(hay, 'que') THEN 'ruler' ELSE 'person' END AS role FROM c1),
g AS (SELECT profile_id AS doc_id, CASE attribute WHEN 'hair' THEN 'hair_color' WHEN 'weather' THEN 'expression' ELSE 'clothing' END AS attribute, value FROM f WHERE value <> 'error'),
k AS (SELECT DISTINCT doc_id, CASE attribute WHEN 'clothing' THEN 'costume_direction' WHEN 'expression' THEN 'presentation' ELSE attribute END AS known FROM g),
src AS (SELECT doc_id, string_agg(attribute || ':' || value, '|' ORDER BY attribute, value) AS facts FROM (SELECT DISTINCT doc_id, attribute, value FROM g) GROUP BY 1),
base AS (SELECT * FROM {_values(_SUPPOSED)} t(genre, place, value)), prior AS (SELECT * FROM {_values(_OF_ROLES)} t(role, place, value)),
sup AS (SELECT doc_id, generate_subscripts(labels, 1) AS place, unnest(labels) AS value FROM c
  UNION ALL SELECT doc_id, place, value FROM c JOIN base b ON b.genre = CASE WHEN c.genre = 'saga' THEN 'general_narrative' ELSE c.genre END
  UNION ALL SELECT doc_id, place, value FROM c JOIN prior USING (role)),
att AS (SELECT doc_id, place, value, CASE WHEN regexp_matches(value, 'physique|anatomy') THEN 'physique' WHEN regexp_matches(value, 'presence|presentation|styling|body language|posture') THEN 'presentation'
  WHEN regexp_matches(value, 'garment|clothing') THEN 'costume_direction' WHEN starts_with(value, 'detected ') THEN 'world_context' WHEN regexp_matches(value, 'modern|materials|technology') THEN 'environment_rules' ELSE 'visual_style' END AS attribute
  FROM sup WHERE NOT contains(value, 'exact age')),
inf AS (SELECT doc_id, string_agg(attribute || ':' || CASE WHEN starts_with(value, 'detected ') THEN 'world_context' ELSE 'genre_prior' END || ':' || value, '|' ORDER BY place) AS facts
  FROM att a WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = a.doc_id AND k.known = a.attribute) GROUP BY 1)
SELECT c.doc_id, role AS visual_role, genre, 'vib-' || substr(sha256(concat_ws('|', CAST(c.doc_id AS VARCHAR), name, genre, array_to_string(labels, '|'))), 1, 12) AS identity_anchor, coalesce(src.facts, '') AS source_facts, coalesce(inf.facts, '') AS inferred_facts,
  'exact_age|exact_height|eye_color|facial_measurements' || CASE WHEN 'hair_color' IN (SELECT attribute FROM g WHERE g.doc_id = c.doc_id) THEN '' ELSE '|hair_color' END
    AS unknown_attributes
FROM c LEFT JOIN src USING (doc_id) LEFT JOIN inf USING (doc_id)""",
}
