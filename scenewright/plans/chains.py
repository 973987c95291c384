"""Queries that run several operators in a row, and the streaming ones."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons
from ..functions.folders import kept, shared_folder
from ..operators import continuity, entities, facts, identity, packages, structure
from ..sources import tables
from ..streaming import streams
from . import books


def people(spark: SparkSession, sf_dir: str, *, contexts: bool = False):
    """Mentions (with the text around them on demand), group members and canonical characters of all books."""
    known, mentions = books.gate_inputs(spark, sf_dir, contexts=contexts)
    # ids that sort by book and name: the order in which names found their groups
    own = F.concat_ws("|", "document_id", "canonical_name")
    known, mentions = known.withColumn("entity_id", own), mentions.withColumn("entity_id", own)
    # invented prose has no speech verbs or titles, so names are let through by how often they occur
    decision = F.when(F.col("mention_count") >= 5, "validated").when(F.col("mention_count") >= 2, "probable").otherwise("review")
    gate = known.withColumns({"decision": decision, "score": F.least(F.lit(1.0), F.col("mention_count") / 10)})
    groups, members = identity.identity_groups(gate)
    resolved = identity.resolve_groups(groups, members, evidence=identity.identity_evidence(groups, members))
    return mentions, members, identity.canonical_characters(groups, members, resolved, gate)


def canonical_people(spark, sf_dir):
    found = people(spark, sf_dir)[2]
    return found.select("document_id", "canonical_name", "status", F.round("confidence", 3).alias("confidence"))


def canonical_aliases(spark, sf_dir):
    _, members, found = people(spark, sf_dir)
    return identity.canonical_aliases(found, members).select("document_id", "alias", "relationship", F.round("confidence", 3).alias("confidence"))


def scene_context(spark, sf_dir):
    """Profiles and objects of each scene; a scene is a page."""
    mentions, members, found = people(spark, sf_dir)
    scenes = books.page_scenes(spark, sf_dir).select("document_id", F.col("scene_order").alias("scene_id"), "text")
    things = entities.object_mentions(scenes, books.THINGS, keys=["scene_id"])
    owners = facts.profiles(found, members).select("entity_id", "profile_id")
    out = facts.scene_context(scenes, mentions.select("scene_id", "entity_id"), owners, things)
    return out.select("document_id", "scene_id", F.size("character_profile_ids").alias("characters"), F.array_join("objects", ",").alias("objects"))


def audit_report(spark, sf_dir):
    """Coverage, continuity and noise of the facts that events tell of users."""
    from .tables import event_facts

    told = event_facts(spark, sf_dir)
    profiled = told.select(F.col("profile_id").cast("string").alias("canonical_name")).distinct().withColumn("confidence", F.lit(0.9))
    scenes = told.select("scene_id").distinct()
    context = told.groupBy("scene_id").agg(F.collect_set("profile_id").alias("character_profile_ids"), F.collect_set("attribute").alias("objects"))
    return facts.audit(scenes, profiled, told, context)


def scene_continuity(spark, sf_dir):
    """Per event: the user carried or changed, and the kind of event as its object."""
    from .tables import read, states as event_states

    states = event_states(spark, sf_dir)
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("scene_id"), F.col("event_type").alias("object"))
    out = continuity.scene_continuity(states, events, events.select("scene_id"))
    return out.select("scene_id", F.array_join("carried_ids", ",").alias("carried"), F.array_join("changed_ids", ",").alias("changed"), F.array_join("objects", ",").alias("objects"))


def presence(spark, sf_dir):
    """Whether a name of a page is seen to act there."""
    said = books.name_mentions(spark, sf_dir)
    keys = ["document_id", "scene_order"]
    return packages.presence(None, None, said, keys=keys).select("document_id", F.col("scene_order").alias("doc_id"), "canonical_name", "visible")


def directions(spark, sf_dir):
    docs = books.documents(spark, sf_dir)
    return docs.select("doc_id", packages.direction(F.col("text"), F.col("text").contains('"'), F.col("text").rlike("[A-Z][a-z]{3,}")).alias("direction"))


#: Scripts, styles and comments of a page.
UNSEEN = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->"
#: A block up to its own closing tag; one that is left open ends at the next block or at an edge of what holds it.
BLOCK = r"(?is)<(h1|h2|p|li)(?=[\s>])[^>]*>.*?(?=</\1\s*>|<(?:h1|h2|p|li)[\s>]|</?(?:article|aside|body|div|footer|header|html|main|nav|ol|section|table|ul)[\s>]|\z)"


def html_fragments(web: DataFrame) -> DataFrame:
    """Blocks of web pages (page_id, html) as positioned fragments, whole and without tags: headings are larger and labelled."""
    blocks = F.regexp_extract_all(F.regexp_replace("html", UNSEEN, ""), F.lit(BLOCK), F.lit(0))
    text = F.btrim(F.regexp_replace(F.regexp_replace("block", r"(?i)<br\s*/?>", " "), r"</?[A-Za-z][^>]*>", ""))
    rows = web.select(F.col("page_id").cast("string").alias("document_id"), F.lit(1).alias("page_number"), F.posexplode(blocks).alias("frag_idx", "block"))
    heading = F.col("block").rlike(r"^(?i)<h[12][\s>]")
    return rows.select(
        "document_id", "page_number", "frag_idx", F.concat_ws(" ", F.when(heading, (F.col("frag_idx") + 1).cast("string")), text).alias("text"),
        F.lit(10.0).alias("x"), (F.col("frag_idx") * 30.0).alias("y"), F.when(heading, 20.0).otherwise(10.0).alias("font_size"), F.lit(None).cast("double").alias("confidence"), F.lit(80.0).alias("width"), F.lit(10.0).alias("height"),
        F.when(heading, "section_header").otherwise("text").alias("label"),
    )


def html_sections(spark, sf_dir):
    """Heading candidates, page kinds, validated, reconciled and recovered sections of web pages."""
    # each of these is asked for several times by the steps after it
    parts = kept(html_fragments(spark.read.parquet(f"{sf_dir}/pages.parquet")), "fragments")
    candidates = kept(structure.select_candidates(structure.heading_candidates(parts), structure.labelled_candidates(parts)), "candidates")
    kinds = kept(structure.classify_pages(parts, candidates), "kinds")
    sections = kept(structure.reconcile_sections(structure.validate_sections(candidates, kinds)), "sections")
    every = structure.plausible_sections(structure.recover_sections(candidates, kinds, sections))
    return every.select("document_id", "page_number", "section_number", "title", F.round("confidence", 3).alias("confidence"), "detection_method")


def html_page_text(spark, sf_dir):
    """Web pages read as lines and paragraphs of their blocks."""
    text = structure.fragments_to_text(html_fragments(spark.read.parquet(f"{sf_dir}/pages.parquet")), "ocr")
    return text.select("document_id", "page_number", F.length("text").alias("chars"), F.md5("text").alias("text_md5"))


def run_stream(spark, df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there and read what it wrote."""
    path = shared_folder(spark, "stream")
    df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def event_stream(spark, sf_dir) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_status_counts(spark, sf_dir):
    """Events by day and type; a window is written once the watermark has passed it, so the last one stays open."""
    counted = streams.status_counts(event_stream(spark, sf_dir), event_time="ts", period="1 day", status="event_type")
    out = run_stream(spark, counted)
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_stale_jobs(spark, sf_dir):
    """Users whose last event was an error and who were not heard of for an hour of event time."""
    updates = event_stream(spark, sf_dir).select(F.col("user_id").alias("job_id"), F.col("ts").alias("updated_at"), F.when(F.col("event_type") == "error", "running").otherwise("done").alias("status"))
    return run_stream(spark, streams.stale_jobs(updates, minutes=60)).select("job", F.date_format("last_update", "yyyy-MM-dd HH:mm:ss").alias("last_update"))


def stream_sessions(spark, sf_dir):
    """Sessions of users: events that follow each other within six hours; told once the watermark has passed them."""
    out = run_stream(spark, streams.session_counts(event_stream(spark, sf_dir), event_time="ts", gap="6 hours", key="user_id"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return out.select("user_id", shown("start"), shown("stop"), "n")


def stream_attribute_changes(spark, sf_dir):
    """What each event changes of its user's state: the type, and whether k is large, as in state_changes but in order of time."""
    told = F.array(F.struct(F.lit("type").alias("attribute"), F.col("event_type").alias("value")), F.struct(F.lit("big").alias("attribute"), F.when(F.get_json_object("props", "$.k").cast("int") > 50, "yes").alias("value")))
    seen = event_stream(spark, sf_dir).select("user_id", "ts", "event_id", F.lit("state").alias("bucket"), F.explode(told).alias("f")).select("user_id", "ts", "event_id", "bucket", "f.*")
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, streams.ROCKS)
    try:
        out = run_stream(spark, streams.attribute_changes(seen, entity="user_id", order="ts", scene="event_id"))
    finally:
        spark.conf.set(name, before)
    return out.select("entity", "scene", "attribute", F.array_join("previous", ",").alias("previous"), F.array_join("new", ",").alias("new"), "change_type", "first")


def stream_page_store(spark, sf_dir):
    """Documents as a stream of pages, a file a batch, into a store of versions: what holds in the end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    raw = spark.readStream.schema(docs).option("maxFilesPerTrigger", 4).parquet(f"{sf_dir}/documents.parquet*")
    pages = raw.select(F.col("source").alias("document_id"), F.col("doc_id").alias("page_number"), "text")
    path = shared_folder(spark, "store")
    query = pages.writeStream.foreachBatch(lambda batch, version: streams.merge_pages(batch, f"{path}/pages", version)).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return streams.current_pages(spark, f"{path}/pages", pages.schema).select("document_id", "page_number", F.md5("text").alias("text_md5"))


def page_range_scan(spark, sf_dir):
    """Pages 10 to 40 of all books, from a table bucketed by book and sorted by page."""
    stored = tables.store_pages(books.pages(spark, sf_dir).select("document_id", "page_number", "doc_id"), f"book_pages_{uuid4().hex}", shared_folder(spark, "book-pages"))
    return tables.scan(stored, pages=(10, 40)).select("document_id", "page_number", "doc_id")


QUERIES = {f.__name__: f for f in (
    canonical_people, canonical_aliases, scene_context, audit_report, scene_continuity, presence, directions, html_sections, html_page_text,
    stream_status_counts, stream_stale_jobs, stream_sessions, stream_attribute_changes, stream_page_store, page_range_scan,
)}

_TITLE_SQL = "^(?i)(?:" + "|".join(lexicons.PERSON_TITLES) + r")\.?\s+"
_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
#: Groups of names by first fit, in rounds over all fitting pairs, and what becomes of them.
PEOPLE_SQL = f"""{books.MENTIONS_SQL},
known AS (SELECT source AS d, name, count(*) AS n FROM names_ GROUP BY 1, 2 HAVING count(*) >= 2),
kept AS (SELECT *, d || '|' || name AS id, trim(regexp_replace(lower(regexp_replace(name, '{_TITLE_SQL}', '')), '[^a-z0-9]+', ' ', 'g')) AS base,
  string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' ') AS f FROM known),
good AS (SELECT *, string_split(base, ' ') AS t FROM kept WHERE base <> '' AND NOT list_has_any(string_split(base, ' '), {_LIST(lexicons.SEMANTIC_BLOCK_WORDS)})),
prefix_ AS (SELECT s.d, s.id AS x, l.id AS y FROM good s JOIN good l ON s.d = l.d AND (s.f = l.f[1:len(l.f) - 1] OR (s.f = l.f[1:len(l.f) - 2] AND list_contains({_LIST(lexicons.QUALIFIERS)}, l.f[-1])))
  WHERE len(s.f) >= 2 AND list_contains({_LIST(lexicons.PERSON_TITLES)}, s.f[1])),
near_ AS (SELECT a.d, a.id AS a, b.id AS b, false AS p FROM good a JOIN good b ON a.d = b.d AND a.t[-1] = b.t[-1] AND a.id < b.id UNION ALL SELECT d, least(x, y), greatest(x, y), true FROM prefix_),
both_ AS (SELECT d, a, b, bool_or(p) AS p FROM near_ GROUP BY ALL),
judged AS (SELECT n.d, n.a, n.b, CASE WHEN a.base = b.base THEN 'normalized_exact' WHEN len(a.t) >= 2 AND len(b.t) >= 2 AND a.t[-1] = b.t[-1] THEN CASE WHEN len(a.t) = 2 AND len(b.t) = 2 AND a.t[1][1] = b.t[1][1] THEN 'same_surname_initial_variant' END
  WHEN a.t[-1] = b.t[-1] AND (len(a.t) = 1) <> (len(b.t) = 1) THEN 'surname_variant' WHEN n.p THEN 'qualified_identity_variant' END AS method
  FROM both_ n JOIN good a ON a.id = n.a JOIN good b ON b.id = n.b),
fit_ AS (SELECT *, CASE method WHEN 'normalized_exact' THEN 0.98::DOUBLE WHEN 'same_surname_initial_variant' THEN 0.86::DOUBLE WHEN 'surname_variant' THEN 0.82::DOUBLE ELSE 0.88::DOUBLE END AS confidence FROM judged WHERE method IS NOT NULL),
rounds AS (
  SELECT 0 AS i, id, CASE WHEN id IN (SELECT b FROM fit_) THEN NULL ELSE true END AS root FROM kept
  UNION ALL
  SELECT i + 1, id, CASE WHEN root IS NOT NULL THEN root WHEN taken THEN false WHEN settled THEN true END FROM (
    SELECT r.i, r.id, r.root, bool_or(coalesce(o.root, false)) AS taken, bool_and(o.root IS NOT NULL) AS settled
    FROM rounds r LEFT JOIN fit_ f ON f.b = r.id LEFT JOIN rounds o ON o.id = f.a WHERE r.i < 12 GROUP BY 1, 2, 3)),
roots AS (SELECT id, root FROM rounds WHERE i = 12),
home AS (SELECT f.b AS id, arg_min({{'g': f.a, 'c': f.confidence, 'm': f.method}}, f.a) AS h FROM fit_ f JOIN roots o ON o.id = f.a AND o.root JOIN roots x ON x.id = f.b AND NOT x.root GROUP BY 1),
members AS (SELECT k.d, coalesce(h.h.g, k.id) AS g, k.id, k.name, k.n, coalesce(h.h.c, 1.0::DOUBLE) AS confidence, coalesce(h.h.m, 'canonical') AS method,
  k.name LIKE '%-' OR (length(k.name) <= 4 AND NOT contains(regexp_replace(k.name, '{_TITLE_SQL}', ''), ' ')) AS fragment FROM kept k LEFT JOIN home h USING (id)),
held AS (SELECT d, g, count(*) AS n, min(confidence) AS c, any_value(name) FILTER (WHERE method = 'canonical') AS name, count(*) > 1 AND NOT bool_or(fragment) AS alias,
  min({{'id': id, 'name': name, 'score': least(1.0::DOUBLE, n / 10)}}) FILTER (WHERE n >= 5) AS v FROM members GROUP BY 1, 2),
people AS (SELECT d, g, CASE WHEN alias OR v IS NOT NULL THEN 'confirmed' WHEN n = 1 THEN 'singleton' END AS status, CASE WHEN alias OR v IS NULL THEN name ELSE v.name END AS name,
  greatest(CASE WHEN alias THEN least(c, greatest(c, 0.5)) ELSE c END, coalesce(v.score, 0)) AS confidence, coalesce(v.id, g) AS main FROM held)"""

ORACLES = {
    "scene_continuity": """WITH s AS (SELECT user_id, event_id, event_type, CASE WHEN CAST(props->>'$.k' AS INTEGER) > 50 THEN 'yes' END AS big FROM events),
w AS (SELECT *, row_number() OVER o = 1 OR (event_type = lag(event_type) OVER o AND big IS NOT DISTINCT FROM lag(big) OVER o) AS same FROM s WINDOW o AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id AS scene_id, CASE WHEN same THEN CAST(user_id AS VARCHAR) ELSE '' END AS carried, CASE WHEN same THEN '' ELSE CAST(user_id AS VARCHAR) END AS changed, event_type AS objects FROM w""",
    "stream_status_counts": """WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM events), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM e, m WHERE d + INTERVAL 1 DAY <= mark GROUP BY 1, 2""",
    "canonical_people": f"WITH RECURSIVE {PEOPLE_SQL} SELECT d AS document_id, name AS canonical_name, status, round(confidence, 3) AS confidence FROM people WHERE status IS NOT NULL",
    "canonical_aliases": f"""WITH RECURSIVE {PEOPLE_SQL} SELECT m.d AS document_id, m.name AS alias, CASE WHEN m.id = p.main THEN 'canonical' WHEN p.status = 'confirmed' THEN 'alias' ELSE 'variant' END AS relationship, round(m.confidence, 3) AS confidence
FROM members m JOIN people p ON p.d = m.d AND p.g = m.g WHERE p.status IS NOT NULL""",
    "scene_context": f"""WITH RECURSIVE {PEOPLE_SQL},
owners AS (SELECT m.id, m.g FROM members m JOIN people p ON p.d = m.d AND p.g = m.g WHERE p.status IS NOT NULL),
c AS (SELECT n.doc_id, count(DISTINCT o.g) AS characters FROM names_ n JOIN owners o ON o.id = n.source || '|' || n.name GROUP BY 1),
th AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z''-]+')) AS term FROM documents),
ob AS (SELECT doc_id, string_agg(upper(term[1]) || term[2:], ',' ORDER BY term) AS objects FROM th WHERE list_contains({_LIST(books.THINGS)}, term) GROUP BY 1)
SELECT d.source AS document_id, d.doc_id AS scene_id, coalesce(c.characters, 0) AS characters, coalesce(ob.objects, '') AS objects FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN ob USING (doc_id)""",
    "stream_sessions": """WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events),
e AS (SELECT user_id, ts, coalesce(ts > lag(ts) OVER w + INTERVAL 6 HOUR, true)::INT AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e),
g AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS stop, count(*) AS n FROM s GROUP BY user_id, k)
SELECT user_id, strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(stop, '%Y-%m-%d %H:%M:%S.%f') AS stop, n FROM g, m WHERE stop <= mark""",
    "stream_attribute_changes": """WITH m AS (SELECT date_trunc('millisecond', max(ts) - INTERVAL 10 MINUTE) AS mark FROM events),
s AS (SELECT user_id AS entity, ts, event_id AS scene, event_type AS type, CASE WHEN CAST(props->>'$.k' AS INTEGER) > 50 THEN 'yes' END AS big FROM events, m WHERE ts <= mark),
w AS (SELECT *, lag(type) OVER o AS ptype, lag(big) OVER o AS pbig, row_number() OVER o = 1 AS first FROM s WINDOW o AS (PARTITION BY entity ORDER BY ts, CAST(scene AS VARCHAR))),
c AS (SELECT entity, scene, 'state.type' AS attribute, ptype AS previous, type AS new, first FROM w UNION ALL SELECT entity, scene, 'state.big', pbig, big, first FROM w WHERE pbig IS NOT NULL OR big IS NOT NULL)
SELECT entity, scene, attribute, previous, new, CASE WHEN previous IS NULL THEN 'introduced' WHEN new IS NULL THEN 'removed' WHEN previous = new THEN 'carried' ELSE 'updated' END AS change_type, first FROM c""",
    "stream_page_store": "SELECT source AS document_id, doc_id AS page_number, md5(arg_max(text, text)) AS text_md5 FROM documents GROUP BY 1, 2",
    "page_range_scan": f"WITH {books.PAGES_SQL} SELECT document_id, page_number, doc_id FROM pages_ WHERE page_number BETWEEN 10 AND 40",
}
