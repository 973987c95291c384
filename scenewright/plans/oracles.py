"""DuckDB text of queries over books and chains whose SQL is long."""

from __future__ import annotations

from ..functions import lexicons
from ..operators import identity, packages, plans, structure
from . import books
from .books import MENTIONS_SQL, PAGES_SQL, SECTIONS_SQL, bounded_sql
from .tables import _FACTS

_W = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
_AT = f"""{MENTIONS_SQL}, at_ AS (SELECT *, strpos(lower(text), lower(name)) AS p FROM names_),
m AS (SELECT source, name, doc_id, trim(substr(text, greatest(1, p - 220), p - greatest(1, p - 220) + length(name) + 220)) AS context FROM at_)"""
_TITLES = "|".join(lexicons.PERSON_TITLES)


def listed(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def reasons(*rules: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in rules) + "], lambda x: x IS NOT NULL), ',')"


def points(*rules: tuple[str, float]) -> str:
    return " + ".join(["0.0::DOUBLE", *[f"CASE WHEN {c} THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for c, w in rules]])


_SHAPE = "len(string_split(n, ' ')) IN (2, 3)"
_TITLED = f"regexp_matches(n, '(?i)(?:^|[^A-Za-z0-9_])(?:{_TITLES})\\.?(?:[^A-Za-z0-9_]|$)')"
EVIDENCE_LABELS = rf"""WITH {_AT},
h AS (SELECT *, regexp_matches(regexp_replace(context, '\s+', ' ', 'g'), '(?i)(?:^|[^{_W[1:]})' || name || '(?:[^{_W[1:]}|$)') AS hit FROM m),
c AS (SELECT source, name AS n, count(*) AS m, count(DISTINCT doc_id) AS s, count(*) FILTER (WHERE hit) AS hits,
  count(*) FILTER (WHERE hit AND regexp_matches(context, '{bounded_sql(identity.DIALOGUE)}')) AS d, count(*) FILTER (WHERE hit AND regexp_matches(context, '{bounded_sql(identity.HUMAN_ACTION)}')) AS a,
  count(*) FILTER (WHERE hit AND regexp_matches(context, '{bounded_sql(identity.PRONOUN)}')) AS p FROM h GROUP BY 1, 2),
x AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, {points((_TITLED, 0.25), (_SHAPE, 0.08), ("m >= 10", 0.12), ("m BETWEEN 3 AND 9", 0.07), ("m = 1", -0.08), ("s >= 5", 0.08))}
  + least(0.30::DOUBLE, d * 0.10::DOUBLE) + least(0.18::DOUBLE, a * 0.03::DOUBLE) + least(0.08::DOUBLE, p * 0.015::DOUBLE))), 6) AS raw,
  CASE WHEN lower(n) IN ({listed(lexicons.NON_NAMES)}) THEN 'common_word_or_title_only'
    WHEN lower(n) IN ({listed(lexicons.PLACE_NAMES)}) OR regexp_matches(n, '(?i)(?:^|{books._EDGE})(?:{"|".join(lexicons.INSTITUTION_WORDS)})(?:{books._EDGE}|$)') THEN 'place_institution_or_publication_signal'
    WHEN length(n) > 45 THEN 'unusually_long_entity_name' WHEN hits = 0 THEN 'no_exact_name_in_mention_context' END AS early FROM c)
SELECT source AS document_id, n AS canonical_name,
  CASE early WHEN 'common_word_or_title_only' THEN 'reference' WHEN 'place_institution_or_publication_signal' THEN 'non_character' WHEN 'unusually_long_entity_name' THEN 'reference' WHEN 'no_exact_name_in_mention_context' THEN 'reference'
    ELSE CASE WHEN raw >= 0.70 THEN 'validated' WHEN raw >= 0.45 THEN 'probable' WHEN raw >= 0.20 THEN 'uncertain' ELSE 'reference' END END AS label,
  CASE early WHEN 'common_word_or_title_only' THEN 0.99::DOUBLE WHEN 'place_institution_or_publication_signal' THEN 0.98::DOUBLE WHEN 'unusually_long_entity_name' THEN 0.95::DOUBLE WHEN 'no_exact_name_in_mention_context' THEN 0.90::DOUBLE ELSE raw END AS score,
  m AS mention_count, s AS scene_count,
  coalesce(early, {reasons((_TITLED, "personal_title"), (_SHAPE, "person_name_shape"), ("d > 0", "dialogue_context_near_entity"), ("a > 0", "human_action_context_near_entity"), ("p > 0", "human_pronoun_context"),
    ("m >= 10", "strong_recurring_mentions"), ("m BETWEEN 3 AND 9", "recurring_mentions"), ("m = 1", "single_mention"), ("s >= 5", "multi_scene_presence"))}) AS reasons FROM x"""

_INSTITUTIONS = "|".join([*lexicons.INSTITUTION_WORDS, "times", "news", "station", "river", "mountain", "island", "ocean", "sea", "valley", "village", "hotel", "street", "road", "church", "expedition", "thousand", "hundred"])
VISUAL_ENTITIES = rf"""WITH {MENTIONS_SQL}, c AS (SELECT source, name AS n, count(*) AS m FROM names_ GROUP BY 1, 2),
x AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, {points(("true", 0.45), (f"regexp_matches(n, '(?i)^(?:{_TITLES})\\.?\\s+')", 0.20), (_SHAPE, 0.10), ("m >= 3", 0.10), ("m = 1", -0.05),
  (f"regexp_matches(lower(n), '{_INSTITUTIONS}')", -0.75), ("length(n) > 45", -0.35), ("regexp_matches(n, '(?:[-‐‑‒–—]|\\s)[A-Za-z]{1,3}$|^[A-Za-z]{1,3}[-‐‑‒–—]$') AND length(n) < 8", -0.50))})), 6) AS raw FROM c)
SELECT source AS document_id, n AS canonical_name, CASE WHEN raw >= 0.60 THEN 'character' WHEN raw >= 0.35 THEN 'character_candidate' ELSE 'reference' END AS visual_type,
  CASE WHEN raw >= 0.60 THEN 'validated' WHEN raw >= 0.35 THEN 'review' ELSE 'excluded' END AS decision, round(raw, 2) AS score FROM x"""

SCENE_PAGE_RANGES = f"""WITH {SECTIONS_SQL.replace("WITH ", "")},
p_ AS (SELECT s.document_id, s.section_order, s.page_start, s.page_end, p.page_number, length(p.text) AS n, sum(length(p.text) + 1) OVER (PARTITION BY s.document_id, s.section_order ORDER BY p.page_number) - 1 AS until
  FROM sections_ s JOIN pages_ p ON p.document_id = s.document_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE trim(p.text) <> ''),
st AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY section_order) AS story_order FROM (SELECT DISTINCT document_id, section_order, page_start, page_end FROM p_)),
sc AS (SELECT *, sum(chars + 1) OVER (PARTITION BY document_id, story_order ORDER BY scene_order) - 1 AS stop FROM ({books.ORACLES["scene_fold"]})),
k AS (SELECT sc.document_id, sc.story_order, sc.scene_order, sc.strategy, st.page_start, st.page_end, min(p_.page_number) AS a, max(p_.page_number) AS b
  FROM sc JOIN st USING (document_id, story_order) LEFT JOIN p_ ON p_.document_id = sc.document_id AND p_.section_order = st.section_order AND p_.until > sc.stop - sc.chars AND p_.until - p_.n < sc.stop GROUP BY ALL)
SELECT document_id, story_order, scene_order, CASE WHEN strategy = 'story_default' THEN page_start ELSE coalesce(a, page_start) END AS page_start, CASE WHEN strategy = 'story_default' THEN page_end ELSE coalesce(b, page_end) END AS page_end FROM k"""

PRESENCE = f"""WITH {_AT}
SELECT n.source AS document_id, n.doc_id, n.name AS canonical_name,
  bool_or(contains(lower(t.context), lower(n.name)) AND (regexp_matches(t.context, '{bounded_sql(lexicons.ACTION)}') OR regexp_matches(t.context, '{bounded_sql(lexicons.PRESENCE)}'))) AS visible
FROM m n JOIN m t ON t.doc_id = n.doc_id GROUP BY 1, 2, 3"""

PRESENCE_LISTS = f"""WITH {_AT}, t_ AS (SELECT doc_id, context AS t FROM m UNION ALL SELECT doc_id, text FROM documents),
w AS (SELECT *, regexp_matches(t, '{bounded_sql(lexicons.ACTION)}') OR regexp_matches(t, '{bounded_sql(lexicons.PRESENCE)}') AS acts FROM t_),
v AS (SELECT n.doc_id, n.name, bool_or(contains(lower(w.t), lower(n.name)) AND w.acts) AS visible FROM m n JOIN w ON w.doc_id = n.doc_id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, visible ORDER BY name) AS k FROM v)
SELECT doc_id, name AS canonical_name, visible FROM r WHERE k <= CASE WHEN visible THEN 6 ELSE 8 END"""

DIRECTIONS = f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{bounded_sql(lexicons.DESTRUCTION)}') THEN 'destruction' WHEN regexp_matches(text, '{bounded_sql(lexicons.COMBAT)}') THEN 'combat' WHEN regexp_matches(text, '{bounded_sql(lexicons.TRAVEL)}') THEN 'travel'
  WHEN contains(text, '"') THEN 'dialogue' WHEN regexp_matches(text, '[A-Z][a-z]{{3,}}') THEN 'characters' ELSE 'default' END AS direction FROM documents"""

_WORDS = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> ''))"
DIALOGUE_LINES = rf"""WITH q0 AS (SELECT doc_id, unnest(regexp_extract_all(text, '["“]([^"”]+)["”]', 1)) AS x, generate_subscripts(regexp_extract_all(text, '["“]([^"”]+)["”]', 1), 1) AS i FROM documents),
q1 AS (SELECT doc_id, trim(x) AS x, min(i) AS i FROM q0 WHERE {_WORDS.format("trim(x)")} >= 3 GROUP BY 1, 2),
q2 AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rank FROM q1),
f AS (SELECT doc_id, string_split(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
s0 AS (SELECT doc_id, trim(unnest(parts)) AS x, generate_subscripts(parts, 1) AS i FROM f),
s1 AS (SELECT doc_id, x, min(i) AS i FROM s0 WHERE x <> '' AND len(string_split(x, ' ')) >= 4
  AND (regexp_matches(x, '{bounded_sql("(?i)" + chr(92) + "b(?:that|que|dass|und)" + chr(92) + "b")}') OR (regexp_matches(x, '^(?:I|We|My|Our)(?:{books._EDGE}|$)') AND {_WORDS.format("x")} <= 28)) GROUP BY 1, 2),
s2 AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rank FROM s1)
SELECT doc_id, rank, md5(x) AS line_md5 FROM q2 WHERE rank <= 3
UNION ALL SELECT doc_id, rank, md5(x) FROM s2 WHERE rank <= 2 AND doc_id NOT IN (SELECT doc_id FROM q2)"""

_KEYS = listed(["the", "die", "les", "los"])
LINE_HEADINGS = rf"""WITH {PAGES_SQL}, l0 AS (SELECT document_id, page_number, string_split_regex(text, '\r?\n') AS ls FROM pages_),
l AS (SELECT document_id, page_number, trim(unnest(ls)) AS line, generate_subscripts(ls, 1) - 1 AS line_idx FROM l0),
k AS (SELECT *, regexp_split_to_array(lower(line), '\s+') AS parts FROM l WHERE line <> ''),
s AS (SELECT *, CASE WHEN list_has_any(parts, [{_KEYS}]) THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN regexp_matches(line, '^\d{{1,4}}[.):]?(?:\s+\S.*)?$') THEN 2.0 ELSE 0.0 END
  + CASE WHEN regexp_matches(line, '{structure.ROMAN.replace("^(?i)", "(?i)^")}') THEN 2.0 ELSE 0.0 END + CASE WHEN len(parts) <= 8 AND regexp_matches(line, '^\p{{Lu}}') AND NOT regexp_matches(line, '[.!?,;]$') THEN 0.5 ELSE 0.0 END AS score FROM k)
SELECT document_id, page_number, line_idx, line, score FROM s WHERE score >= 2"""

AUDIT_REPORT = f"""WITH {_FACTS.replace("event_type AS value", "event_type AS value, event_type AS v")},
c AS (SELECT count(*) AS facts, count(DISTINCT scene_id) AS scenes, count(DISTINCT profile_id) AS profiles FROM f),
s AS (SELECT count(*) AS several FROM (SELECT profile_id FROM f GROUP BY 1 HAVING count(DISTINCT scene_id) > 1))
SELECT r.section, r.metric, CAST(r.value AS DOUBLE) AS value FROM (SELECT unnest([
  {{'section': 'coverage', 'metric': 'scenes', 'value': scenes::DOUBLE}}, {{'section': 'coverage', 'metric': 'profiles', 'value': profiles::DOUBLE}}, {{'section': 'coverage', 'metric': 'facts', 'value': facts::DOUBLE}},
  {{'section': 'coverage', 'metric': 'scenes_with_context_percent', 'value': 100.0::DOUBLE}}, {{'section': 'coverage', 'metric': 'facts_with_evidence_percent', 'value': 100.0::DOUBLE}},
  {{'section': 'continuity', 'metric': 'scenes_with_characters', 'value': scenes::DOUBLE}}, {{'section': 'continuity', 'metric': 'scenes_with_objects', 'value': scenes::DOUBLE}},
  {{'section': 'continuity', 'metric': 'profiles_in_several_scenes', 'value': several::DOUBLE}}, {{'section': 'noise', 'metric': 'suspicious_names', 'value': 0.0::DOUBLE}}]) AS r FROM c, s)"""

STREAM_STATE_CHANGES = """WITH w AS (SELECT user_id AS entity, ts, event_type AS new, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS previous FROM events)
SELECT entity, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, previous, new, CASE WHEN previous IS NULL THEN 'introduced' ELSE 'updated' END AS change_type FROM w WHERE previous IS NULL OR previous <> new"""

STREAM_STALE_JOBS = """WITH l AS (SELECT user_id AS job, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS k FROM events)
SELECT job, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_update FROM l WHERE k = 1 AND event_type = 'error' AND ts + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE"""

# numbers as printed to 3 places: the binary value rounded to the nearest, ties to even
CSV_ROWS = "SELECT CAST(event_id AS VARCHAR) AS event_id, coalesce(event_type, '') AS event_type, coalesce(CAST(CAST(format('{:.3f}', value) AS DOUBLE) AS VARCHAR), '') AS value, coalesce(CAST(CAST(format('{:.3f}', value / 8) AS DOUBLE) AS VARCHAR), '') AS ratio FROM events"

_MOMENTS = books.ORACLES["moments_topk"].replace("md5(s) AS moment_md5 FROM r WHERE rank <= 3", "s AS moment FROM r WHERE rank <= 4")
_RENDERED = rf"""mo AS (SELECT doc_id, list(moment ORDER BY rank) AS moments FROM ({_MOMENTS}) GROUP BY 1),
n0 AS (SELECT doc_id, unnest(regexp_extract_all(text, '\p{{Lu}}\p{{Ll}}{{3,}}')) AS x, generate_subscripts(regexp_extract_all(text, '\p{{Lu}}\p{{Ll}}{{3,}}'), 1) AS i FROM documents),
n1 AS (SELECT doc_id, x, min(i) AS i FROM n0 GROUP BY 1, 2), n2 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM n1),
na AS (SELECT doc_id, list(x ORDER BY k) AS names FROM n2 WHERE k <= 3 GROUP BY 1),
pk AS (SELECT d.doc_id, d.text, string_split(d.text, chr(10))[1] AS title, coalesce(mo.moments, []) AS moments, coalesce(na.names, []) AS names FROM documents d LEFT JOIN mo USING (doc_id) LEFT JOIN na USING (doc_id)),
re AS (SELECT *, title || '. ' || coalesce(moments[1], 'Quiet scene.') || ' Characters: ' || array_to_string(names, ', ') || '. Source-grounded; unknown details stay unknown.' AS image_prompt FROM pk)"""
PROMPTS_BY_MODE = f"WITH {_RENDERED} SELECT doc_id, md5(image_prompt) AS prompt_md5, CAST(NULL AS VARCHAR) AS reason FROM re"
PACKAGE_QUALITY = f"""WITH {_RENDERED}, e AS (SELECT doc_id, {reasons(
    ("title IS NULL OR trim(title) = ''", "missing_title"), ("length(image_prompt) < 60", "image_prompt_too_short"), ("len(names) > 0 AND NOT contains(image_prompt, names[1])", "name_missing_in_prompt"),
    ("len(moments) = 0", "no_moments"), ("text IS NULL OR trim(text) = ''", "text_missing"))} AS errors FROM re)
SELECT doc_id, errors, CASE WHEN errors = '' THEN 'pass' ELSE 'fail' END AS status FROM e"""

_QUOTED = rf"""q0 AS (SELECT doc_id, unnest(regexp_extract_all(text, '["“]([^"”]+)["”]', 1)) AS x, generate_subscripts(regexp_extract_all(text, '["“]([^"”]+)["”]', 1), 1) AS i FROM documents),
q1 AS (SELECT doc_id, trim(x) AS x, min(i) AS i FROM q0 WHERE {_WORDS.format("trim(x)")} >= 3 GROUP BY 1, 2),
q2 AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rank FROM q1),
qq AS (SELECT doc_id, list(x ORDER BY rank) AS dialogue FROM q2 WHERE rank <= 3 GROUP BY 1)"""
_STYLE = "CASE direction " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in plans.STYLES.items()) + " END"
_SHOT = "[" + ", ".join(f"'{s}'" for s in plans.SHOTS) + "]"
_MOVING = "'{} ' || (i + 1) || ', 9:16. Source-anchored scene interpretation: ' || coalesce(moments[(i % n) + 1], 'Quiet scene.') || ' Cinematic direction: ' || style || '.' || grounded"
_PLANNED = f"""{_RENDERED}, {_QUOTED},
p0 AS (SELECT pk.*, coalesce(qq.dialogue, []) AS dialogue, d.direction FROM pk LEFT JOIN qq USING (doc_id) JOIN (SELECT doc_id, CASE WHEN regexp_matches(text, '{bounded_sql(lexicons.DESTRUCTION)}') THEN 'destruction' WHEN regexp_matches(text, '{bounded_sql(lexicons.COMBAT)}') THEN 'combat'
  WHEN regexp_matches(text, '{bounded_sql(lexicons.TRAVEL)}') THEN 'travel' END AS direction FROM documents) d USING (doc_id)),
p1 AS (SELECT * REPLACE (coalesce(direction, CASE WHEN len(dialogue) > 0 THEN 'dialogue' WHEN len(names) > 0 THEN 'characters' ELSE 'default' END) AS direction), greatest(len(moments), 1) AS n FROM p0),
p2 AS (SELECT *, {_STYLE} AS style, ' Characters: ' || CASE WHEN len(names) > 0 THEN array_to_string(names, ', ') ELSE 'none named' END || '. Source-grounded; unknown details stay unknown.' AS grounded, coalesce(moments[1], 'Quiet scene.') AS f0 FROM p1),
p3 AS (SELECT *, 'Source-grounded image, 9:16. PRIMARY SOURCE VISUAL MOMENT: ' || f0 || ' Source-anchored scene interpretation of ' || coalesce(title, 'an untitled scene') || ', pages 1 to 1. DETECTED STORY WORLD: as the source tells. Cinematic direction: ' || style || '.' || grounded
    || CASE WHEN len(dialogue) > 0 THEN ' Dialogue box: ' || array_to_string(dialogue[1:2], ' / ') ELSE ' Narrative box: ' || f0 END AS image_prompt,
  list_transform(range(0, 3), lambda i: {_MOVING.format("Clip")}) AS clips,
  list_transform(range(0, least({len(plans.SHOTS)}, greatest(4, len(moments)))), lambda i: {_SHOT}[i + 1] || ' shot. ' || {_MOVING.format("Shot")}) AS shots FROM p2)"""
_SHORT = "list_filter(list_transform({0}, lambda x, i: CASE WHEN length(trim(x)) < 160 THEN '{1}_prompt_short:' || i END), lambda e: e IS NOT NULL)"
_PLAN_ERRORS = f"""{_PLANNED}, er AS (SELECT doc_id, names, image_prompt, list_concat(list_concat(list_filter([
  CASE WHEN trim(coalesce(text, '')) = '' THEN 'plan_not_ready' END, CASE WHEN length(trim(image_prompt)) < 240 THEN 'image_prompt_short' END, CASE WHEN length(trim('Sounds of: ' || f0)) < 20 THEN 'sound_short' END], lambda e: e IS NOT NULL),
  {_SHORT.format("clips", "clip")}), {_SHORT.format("shots", "shot")}) AS errors FROM p3)"""
PLAN_PROMPTS = f"WITH {_PLANNED} SELECT doc_id, direction, md5(image_prompt) AS image_md5, md5(array_to_string(clips, chr(10))) AS clips_md5, md5(array_to_string(shots, chr(10))) AS shots_md5, len(shots) AS shots FROM p3"
PLAN_QUALITY = f"WITH {_PLAN_ERRORS} SELECT doc_id, array_to_string(errors, ',') AS errors, CASE WHEN len(errors) = 0 THEN 'pass' ELSE 'fail' END AS status FROM er"
PLAN_AUDIT = f"""WITH {_PLAN_ERRORS}, au AS (SELECT list_concat(list_filter([CASE WHEN len(errors) > 0 THEN 'plan_rules_failed' END, 'world_missing'], lambda e: e IS NOT NULL), list_transform(list_filter(names, lambda n: lower(n) IN ({listed(plans.NOT_NAMES)})), lambda n: 'question_word_as_name')) AS issues FROM er)
SELECT 'issue' AS kind, name, count(*) AS n FROM (SELECT unnest(issues) AS name FROM au) GROUP BY 2
UNION ALL SELECT 'observation', d, count(*) FROM au, (VALUES ('narrative_type_missing'), ('culture_missing'), ('religious_context_missing')) t(d) GROUP BY 2
UNION ALL SELECT 'scene', 'fail', count(*) FROM au HAVING count(*) > 0"""

_PROFILES = "pr AS (SELECT profile_id, round(avg(confidence), 4) AS confidence, CASE profile_id % 3 WHEN 0 THEN 'environment' WHEN 1 THEN 'object' ELSE 'character' END AS profile_type FROM f GROUP BY 1)"
FACT_DISTRIBUTION = f"""WITH {_FACTS}, {_PROFILES}
SELECT 'profile_type' AS kind, profile_type AS name, count(*) AS n, round(avg(confidence), 3) AS mean_confidence, CAST(NULL AS BIGINT) AS with_evidence FROM pr GROUP BY 2
UNION ALL SELECT 'category', attribute, count(*), round(avg(confidence), 3), count(*) FROM f GROUP BY 2"""
AUDIT_READINESS = f"""WITH {_FACTS}, c AS (SELECT round(100.0::DOUBLE * (SELECT count(DISTINCT scene_id) FROM f WHERE confidence > 0.9) / (SELECT count(DISTINCT scene_id) FROM f), 2) >= 95 AS context_ok, true AS evidence_ok,
  round((SELECT avg(c) FROM (SELECT avg(confidence) AS c FROM f GROUP BY attribute)), 3) >= 0.55 AS confidence_ok)
SELECT *, round(100.0::DOUBLE * (context_ok::INT + evidence_ok::INT + confidence_ok::INT) / 3, 1) AS score, CASE WHEN context_ok AND evidence_ok AND confidence_ok THEN 'PASS' ELSE 'NEEDS_REVIEW' END AS status FROM c"""
AUDIT_SAMPLES = f"""WITH {_FACTS}, {_PROFILES}, e AS (SELECT 'profile' AS kind, CAST(profile_id AS VARCHAR) AS name, confidence FROM pr UNION ALL SELECT 'fact', profile_id || ' ' || attribute || ' ' || value, confidence FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY confidence DESC, name) AS rank FROM e) SELECT kind, rank, name, confidence FROM r WHERE rank <= 10"""
RELEASE_CHECKS = f"""WITH {_FACTS}, v AS (SELECT profile_id, attribute, value, min(confidence) AS confidence, count(DISTINCT scene_id) AS own FROM f GROUP BY 1, 2, 3),
cl AS (SELECT * FROM v WHERE attribute = 'hair' AND (profile_id, attribute) IN (SELECT (profile_id, attribute) FROM v GROUP BY profile_id, attribute HAVING count(*) > 1)),
ev AS (SELECT profile_id, attribute, count(DISTINCT scene_id) AS every FROM f WHERE attribute = 'hair' GROUP BY 1, 2),
t AS (SELECT * FROM (VALUES
  ('canonical_profiles', (SELECT count(DISTINCT profile_id) FROM f), 1), ('canonical_facts', (SELECT count(*) FROM v), 1), ('strong_conflicts', (SELECT count(*) FROM cl JOIN ev USING (profile_id, attribute) WHERE confidence >= 0.6 AND every <= own), 0), ('unsupported', 0, 0),
  ('known_bad_phrase_facts', (SELECT count(*) FROM f WHERE contains(evidence, 'e77')), 0), ('canonical_characters', (SELECT count(DISTINCT profile_id) FROM f), 1), ('characters_without_profile', 0, 0), ('scene_context_rows', (SELECT count(DISTINCT scene_id) FROM f), 1),
  ('object_mentions', (SELECT count(*) FROM f WHERE attribute = 'hair'), 1), ('continuity_rows', (SELECT count(DISTINCT scene_id) FROM f), 1), ('continuity_state_rows', (SELECT count(*) FROM f), 1)) x("check", value, wanted))
SELECT "check", CAST(value AS BIGINT) AS value, CASE wanted WHEN 1 THEN value > 0 ELSE value = 0 END AS passed FROM t"""
SCENE_ASSEMBLY = f"""WITH {_FACTS}, th AS (SELECT DISTINCT scene_id, profile_id FROM f),
tx AS (SELECT DISTINCT th.scene_id, th.profile_id, f.attribute, f.value, f.confidence, f.attribute = 'hair' AS lasting FROM th JOIN f ON f.profile_id = th.profile_id AND (f.attribute = 'hair' OR f.scene_id = th.scene_id)),
fi AS (SELECT scene_id, min(lpad(CAST(profile_id AS VARCHAR), 9, '0')) AS p FROM th GROUP BY 1),
ff AS (SELECT tx.scene_id, string_agg(attribute || '=' || value, ',' ORDER BY lasting, confidence DESC, attribute, value) AS first_facts FROM tx JOIN fi ON fi.scene_id = tx.scene_id AND CAST(fi.p AS BIGINT) = tx.profile_id GROUP BY 1),
s AS (SELECT scene_id, count(DISTINCT profile_id) AS characters, count(*) AS mentions, array_to_string(list_sort(list_distinct(list(value))), ',') AS objects, count(*) AS events, count(DISTINCT profile_id) AS states FROM f GROUP BY 1)
SELECT s.*, (SELECT count(*) FROM tx WHERE tx.scene_id = s.scene_id) AS facts, coalesce(first_facts, '') AS first_facts, lag(s.scene_id) OVER (ORDER BY s.scene_id) AS previous_id, lead(s.scene_id) OVER (ORDER BY s.scene_id) AS next_id FROM s LEFT JOIN ff USING (scene_id)"""

CLEAN_OPENINGS = r"SELECT doc_id, md5(rtrim(substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 300))) AS opening_md5 FROM documents"
FIRST_WORDS = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM documents), e AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
d AS (SELECT doc_id, arg_min(x, i) AS x, min(i) AS i FROM e GROUP BY doc_id, lower(x)), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM d),
j AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS words FROM r WHERE k <= 12 GROUP BY 1) SELECT documents.doc_id, coalesce(words, '') AS words FROM documents LEFT JOIN j USING (doc_id)"""
UNQUOTED_TEXTS = """SELECT doc_id, md5(regexp_replace(text, '["“][^"”]*["”]', ' ', 'g')) AS text_md5 FROM documents"""
PARAGRAPHS = r"""WITH l0 AS (SELECT doc_id, string_split_regex(text, '\r?\n') AS ls FROM documents), l AS (SELECT doc_id, trim(unnest(ls)) AS x, generate_subscripts(ls, 1) AS i FROM l0),
g AS (SELECT *, sum(CASE WHEN x = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM l),
k AS (SELECT *, sum(CASE WHEN regexp_matches(x, '(?i)^(?:\d{1,4}|[ivxlcdm]{1,8})$') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, g ORDER BY i) AS said FROM g WHERE x <> ''),
p AS (SELECT doc_id, g, string_agg(x, ' ' ORDER BY i) AS p FROM k WHERE said > 0 GROUP BY 1, 2), t AS (SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY g) AS t FROM p GROUP BY 1)
SELECT documents.doc_id, md5(coalesce(t, '')) AS text_md5 FROM documents LEFT JOIN t USING (doc_id)"""
DIALOGUE_RANKED = rf"""WITH d AS (SELECT doc_id, '"' || replace(text, chr(10), '" "') || '"' AS t FROM documents), q0 AS (SELECT DISTINCT doc_id, t, unnest(regexp_extract_all(t, '["“]([^"”]+)["”]', 1)) AS x FROM d),
q1 AS (SELECT *, strpos(t, x) AS p FROM q0 WHERE {_WORDS.format("trim(x)")} >= 4),
q2 AS (SELECT doc_id, x, least(length(x), 120) + CASE WHEN regexp_matches(substr(t, greatest(1, p - 120), p - greatest(1, p - 120) + length(x) + 100), '{bounded_sql("(?i)" + chr(92) + "b(?:that|que|dass|und)" + chr(92) + "b")}') THEN 80 ELSE 0 END AS score FROM q1),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, x) AS rank FROM q2) SELECT doc_id, rank, md5(trim(x)) AS line_md5, score FROM r WHERE rank <= 3"""
INFERRED = f"""WITH {_FACTS}, v AS (SELECT DISTINCT profile_id, attribute, value FROM f), m AS (SELECT profile_id, attribute, count(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT DISTINCT profile_id, CASE WHEN profile_id % 2 = 0 THEN 'reader' ELSE 'buyer' END AS role FROM f), p AS (SELECT * FROM (VALUES ('reader', 'build', 'slight'), ('reader', 'hair', 'unknown'), ('buyer', 'build', 'tall')) t(role, attribute, value))
SELECT profile_id, attribute, value, 'source' AS source FROM v JOIN m USING (profile_id, attribute) WHERE NOT (attribute = 'hair' AND n > 1)
UNION ALL SELECT profile_id, p.attribute, p.value, 'inferred' FROM r JOIN p USING (role) WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.profile_id = r.profile_id AND m.attribute = p.attribute)"""
TITLED_MERGE = """WITH w AS (SELECT p_partkey AS id, p_partkey // 20 AS document_id, string_split(p_name, ' ')[1] AS low, round(p_size / 50.0::DOUBLE, 2) AS confidence FROM part),
e AS (SELECT *, upper(low[1]) || lower(low[2:]) AS word, id % 2 = 0 AS titled FROM w),
o AS (SELECT document_id, lower(word) AS key, min(id) AS id, min(word) AS alias, min(confidence) AS confidence FROM e WHERE NOT titled GROUP BY 1, 2 HAVING count(*) = 1),
m AS (SELECT o.document_id, o.id AS entity_id, e.id AS canonical_id, o.alias, row_number() OVER (PARTITION BY o.document_id, o.id ORDER BY e.id DESC) AS k FROM o JOIN e ON e.titled AND e.document_id = o.document_id AND lower(e.word) = o.key AND length(e.word) >= 4 AND e.confidence >= o.confidence)
SELECT document_id, entity_id, canonical_id, alias FROM m WHERE k = 1"""
PLACE_MENTIONS = f"""WITH {MENTIONS_SQL}, e AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]{{2,}}) [a-z]{{8,}}', 1)) AS name FROM documents)
SELECT doc_id, 'environment' AS entity_type, name AS canonical_name, 0.65::DOUBLE AS confidence FROM e
UNION ALL SELECT doc_id, 'character', name, 0.45::DOUBLE FROM names_ n WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.doc_id = n.doc_id AND lower(e.name) = lower(n.name))"""
CANONICAL_ID_MAP = """WITH l AS (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS i FROM lineitem),
e AS (SELECT l_orderkey AS scene_id, s_nationkey AS n, min(i) AS k FROM l JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0 GROUP BY 1, 2)
SELECT scene_id, string_agg(CAST(n AS VARCHAR), ',' ORDER BY k) AS canonical_ids FROM e GROUP BY 1"""

_DIGITS = {1000: ["", "M", "MM", "MMM"], 100: ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"], 10: ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"], 1: ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]}
_NUMERAL = " || ".join(f"[{listed(w)}][CAST((v // {k}) % 10 AS INTEGER) + 1]" for k, w in _DIGITS.items())
_VARIANTS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in lexicons.NUMERAL_VARIANTS.items()) + "}"
NUMERAL_TOKENS = f"""WITH tk AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[IVXLCDMKYGO]+')) AS original FROM documents), rn AS (SELECT {_NUMERAL} AS t FROM range(1, 4000) r(v)),
m AS (SELECT original, t, list_transform(range(1, length(original) + 1), lambda i: CASE WHEN original[i] = t[i] THEN 0 ELSE nullif(strpos(coalesce({_VARIANTS}[original[i]], ''), t[i]), 0) END) AS ix
  FROM tk JOIN rn ON length(t) = length(original) WHERE NOT regexp_matches(original, '{structure.CANONICAL}') AND length(original) <= 12),
k AS (SELECT *, len(list_filter(ix, lambda x: x > 0)) AS n FROM m WHERE len(list_filter(ix, lambda x: x IS NULL)) = 0), b AS (SELECT *, row_number() OVER (PARTITION BY original ORDER BY n, ix) AS r FROM k)
SELECT original, original AS normalized, false AS changed, 1.0::DOUBLE AS confidence FROM tk WHERE regexp_matches(original, '{structure.CANONICAL}')
UNION ALL SELECT original, t, true, round(1 - 0.5::DOUBLE * n / length(original), 6) FROM b WHERE r = 1"""

ORACLES = {
    "plan_prompts": PLAN_PROMPTS, "plan_quality": PLAN_QUALITY, "plan_audit": PLAN_AUDIT, "fact_distribution": FACT_DISTRIBUTION, "audit_readiness": AUDIT_READINESS, "audit_samples": AUDIT_SAMPLES, "release_checks": RELEASE_CHECKS,
    "scene_assembly": SCENE_ASSEMBLY, "clean_openings": CLEAN_OPENINGS, "first_words": FIRST_WORDS, "unquoted_texts": UNQUOTED_TEXTS, "paragraphs": PARAGRAPHS, "dialogue_ranked": DIALOGUE_RANKED,
    "inferred_attributes": INFERRED, "titled_merge": TITLED_MERGE, "place_mentions": PLACE_MENTIONS, "canonical_id_map": CANONICAL_ID_MAP,
    "evidence_labels": EVIDENCE_LABELS, "visual_entity_validation": VISUAL_ENTITIES, "scene_page_ranges": SCENE_PAGE_RANGES, "presence": PRESENCE, "presence_lists": PRESENCE_LISTS, "directions": DIRECTIONS,
    "dialogue_lines": DIALOGUE_LINES, "line_heading_scores": LINE_HEADINGS, "audit_report": AUDIT_REPORT, "stream_state_changes": STREAM_STATE_CHANGES, "stream_stale_jobs": STREAM_STALE_JOBS,
    "csv_rows": CSV_ROWS, "numeral_tokens": NUMERAL_TOKENS, "prompts_by_mode": PROMPTS_BY_MODE, "package_quality": PACKAGE_QUALITY,
}
