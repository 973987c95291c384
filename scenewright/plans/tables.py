"""Queries over the star schema, events and conversations: state, facts, jobs, assets, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..functions.folders import shared_folder
from ..operators import continuity, facts, identity, jobs, packages, structure
from ..sources import tables
from ..streaming import streams

NOW = "1998-06-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sightings(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("entity_id"), F.col("event_id").alias("scene_id"), "event_type", F.get_json_object("props", "$.k").alias("k"))


def states(spark, sf_dir):
    seen = sightings(spark, sf_dir)
    told = seen.select("entity_id", "scene_id", F.lit("state").alias("bucket"), F.explode(F.array(F.struct(F.lit("type").alias("attribute"), F.col("event_type").alias("value")), F.struct(F.lit("big").alias("attribute"), F.when(F.col("k").cast("int") > 50, "yes").alias("value")))).alias("f"), F.lit(0.7).alias("confidence"))
    told = told.select("entity_id", "scene_id", "bucket", "f.*", "confidence").filter("value IS NOT NULL")
    return continuity.entity_states(seen, told)


def state_changes(spark, sf_dir):
    return continuity.state_changes(states(spark, sf_dir)).select("entity_id", "scene_id", "attribute", F.array_join("previous", ",").alias("previous"), F.array_join("new", ",").alias("new"), "change_type")


def continuity_status(spark, sf_dir):
    return continuity.continuity_status(states(spark, sf_dir)).select("entity_id", "scene_id", "status")


def scene_neighbours(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn")
    return continuity.scene_neighbours(turns, group="conv_id", order=["turn"], id_col="turn").select("conv_id", "turn", "previous_id", "next_id")


def story_neighbours(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(".", "conv_id", "turn").alias("scene"))
    return continuity.story_neighbours(turns, keys=["conv_id"], order="turn", id_col="scene").select("conv_id", "turn", "scene", "previous_id", "next_id")


def event_facts(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("profile_id"), F.lit("appearance").alias("category"), F.when(F.col("event_id") % 3 == 0, "hair").when(F.col("event_id") % 3 == 1, "clothing").otherwise("weather").alias("attribute"), F.col("event_type").alias("value"), F.floor(F.col("event_id") / 200).alias("scene_id"), F.col("event_id").alias("fact_id"), F.round(F.col("event_id") % 50 / 50.0 + 0.3, 2).alias("confidence"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("evidence"))


def canonical_facts(spark, sf_dir):
    return facts.canonical_facts(event_facts(spark, sf_dir)).select("profile_id", "attribute", "value", "confidence", "evidence", "scene_id", "occurrences", "contradictory")


def fact_reconciliation(spark, sf_dir):
    return facts.reconcile_facts(event_facts(spark, sf_dir)).select("profile_id", "attribute", "value", "state_type", "status", "confidence", F.size("scene_ids").alias("scenes"), F.size("fact_ids").alias("facts"), F.md5(F.array_join("fact_ids", ",")).alias("facts_md5"))


def conflict_classes(spark, sf_dir):
    told = event_facts(spark, sf_dir).withColumn("confidence", F.col("confidence") + 0.35)
    return facts.classify_conflicts(facts.reconcile_facts(told)).select("profile_id", "attribute", "value", "classification", "confidence")


def integrity_checks(spark, sf_dir):
    o, c, li = (read(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    return facts.integrity_checks({
        "orders_without_customer": (o.join(c, o["o_custkey"] == c["c_custkey"], "left_anti"), 0),
        "lines_without_order": (li.join(o, li["l_orderkey"] == o["o_orderkey"], "left_anti"), 0),
        "customers_without_order": (c.join(o, o["o_custkey"] == c["c_custkey"], "left_anti"), None),
        "orders": (o, None), "negative_quantities": (li.filter("l_quantity < 0"), 0),
    })


def identity_anchor(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", packages.identity_anchor(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("anchor"))


def name_bases(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", base_name(F.concat(F.lit("Mr. "), "c_name")).alias("base"))


def compatible_names(spark, sf_dir):
    noun = F.element_at(F.split("p_name", " "), -1)
    part = read(spark, sf_dir, "part").select(F.explode(F.array(F.initcap("p_name"), F.initcap(F.concat_ws(" ", "p_type", noun)), F.initcap(noun))).alias("name")).distinct()
    gated = part.select(F.lit(1).alias("document_id"), F.xxhash64("name").alias("entity_id"), F.col("name").alias("canonical_name"))
    pairs = identity.compatible_pairs(gated)
    names = gated.select("entity_id", "canonical_name")
    out = pairs.join(names.withColumnsRenamed({"entity_id": "a", "canonical_name": "x"}), "a").join(names.withColumnsRenamed({"entity_id": "b", "canonical_name": "y"}), "b")
    return out.select(F.least("x", "y").alias("first_name"), F.greatest("x", "y").alias("second_name"), "confidence", "method")


def order_queue(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "O", "queued").when(F.col("o_orderstatus") == "F", "completed").otherwise("running")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("scene_id"), F.lit("image").alias("job_type"), status.alias("status"), F.col("o_orderdate").cast("timestamp").alias("scheduled_at"), (F.col("o_orderkey") % 5).cast("int").alias("attempts"), F.col("o_orderpriority").alias("provider"))


def autofill(spark, sf_dir):
    contexts = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scene_id"))
    return jobs.autofill(contexts, order_queue(spark, sf_dir), "image", 25, keys=["scene_id"], order=["scene_id"])


def enqueue(spark, sf_dir):
    queue = order_queue(spark, sf_dir)
    return jobs.enqueue(queue.filter("id % 2 = 0"), queue.filter("id % 2 = 1"), keys=["scene_id", "provider"]).select("id", "scene_id", "provider", "status")


def due_topk(spark, sf_dir):
    return jobs.due(order_queue(spark, sf_dir), F.lit(NOW).cast("timestamp"), 10).select("id", F.date_format("scheduled_at", "yyyy-MM-dd").alias("day"))


def stale_recovery(spark, sf_dir):
    return jobs.recover_stale(order_queue(spark, sf_dir), NOW, 120, updated="scheduled_at").select("id", "status", "recovered")


def retry_rule(spark, sf_dir):
    return jobs.retry(order_queue(spark, sf_dir), 3).select("id", "status", "attempts")


def schedule_spread(spark, sf_dir):
    plan = jobs.spread(order_queue(spark, sf_dir), NOW, 15, group="provider", order="id")
    return plan.select("id", "place", F.date_format("scheduled_at", "yyyy-MM-dd HH:mm").alias("at"))


def providers(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    media = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("image"))).when(F.col("s_suppkey") % 3 == 1, F.array(F.lit("video"))).otherwise(F.array(F.lit("image"), F.lit("video")))
    return s.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("int").alias("priority"), F.when(F.col("s_suppkey") % 4 == 0, 0.0).otherwise(F.round(F.abs("s_acctbal") / 10000, 4)).alias("cost"), (F.col("s_suppkey") % 7 != 0).alias("enabled"), (F.col("s_suppkey") % 5).cast("int").alias("quota"), media.alias("media_types"))


def provider_ranking(spark, sf_dir):
    p = providers(spark, sf_dir)
    routing = p.select(F.explode("media_types").alias("media_type"), "name", "priority").filter("priority % 2 = 0").groupBy("media_type").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("priority")).alias("o"), "name"))), lambda x: x["name"]).alias("names"))
    return jobs.rank_providers(p, routing, max_cost=0.6, allow_paid=True)


def provider_first(spark, sf_dir):
    return jobs.provider_by_priority(providers(spark, sf_dir))


def assets(spark, sf_dir):
    status = F.when(F.col("l_returnflag") == "A", "validated").when(F.col("l_returnflag") == "N", "pending").otherwise("review")
    one = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_returnflag").alias("l_returnflag"))
    return one.select(F.col("l_orderkey").alias("asset_id"), F.col("l_orderkey").alias("job_id"), status.alias("status"))


def register_assets(spark, sf_dir):
    done = order_queue(spark, sf_dir).select(F.col("id").alias("job_id"), "status")
    return jobs.register_assets(done, assets(spark, sf_dir).select("job_id", "status"))


def status_transitions(spark, sf_dir):
    asked = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("asset_id"), F.when(F.col("o_orderkey") % 4 == 0, "approved").when(F.col("o_orderkey") % 4 == 1, "rejected").when(F.col("o_orderkey") % 4 == 2, "lost").otherwise("approved").alias("wanted"))
    return jobs.transitions(assets(spark, sf_dir), asked).select("asset_id", "wanted", "accepted", "reason")


def asset_inspection(spark, sf_dir):
    return jobs.inspect(assets(spark, sf_dir))


def health_pivot(spark, sf_dir):
    return jobs.health(order_queue(spark, sf_dir), group="provider", statuses=["queued", "completed", "running"])


def usage_by_day(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("at"), F.col("l_quantity").alias("cost"))
    out = jobs.usage(rows, day_limit=700.0)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "cost", "over_limit")


def upsert_jobs(spark, sf_dir):
    q = order_queue(spark, sf_dir).withColumnRenamed("scheduled_at", "updated_at")
    out = jobs.upsert_jobs(q.filter("id % 3 <> 0"), q.filter("id % 3 = 0"), keys=["scene_id", "job_type", "provider"])
    return out.select("id", "scene_id", "provider", "status")


def output_check(spark, sf_dir):
    planned = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("output_id")).filter("output_id % 10 <> 1")
    outputs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("output_id"), F.when(F.col("o_orderkey") % 9 != 2, F.col("o_orderpriority")).alias("provider")).filter("output_id % 10 <> 3")
    return packages.output_check(planned, outputs).select("output_id", F.array_join("errors", ",").alias("errors"), "status")


def nested_document_export(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), "l_linenumber", "l_partkey", "l_quantity")
    docs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), "o_orderstatus")
    nested = tables.nested_documents(docs, {"lines": (lines, ["l_linenumber", "l_partkey", "l_quantity"])})
    return nested.select("document_id", "o_orderstatus", F.size("lines").alias("n"), F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"), x["l_quantity"].cast("int").cast("string"))), ",").alias("lines"))


def document_headers(spark, sf_dir):
    talk = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), F.when(F.col("role") == "user", "pdf_text").otherwise("ocr").alias("source"))
    return tables.document_header(talk)


def csv_rows(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ratio", F.col("value") / 8)
    return tables.export_rows(e, ["event_id", "event_type", "value", "ratio"])


def replace_document(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("row"))
    incoming = o.filter("path % 10 = 1").select("path", (F.col("row") + 1_000_000_000).alias("row"))
    return tables.replace_document(o, incoming)


def read_only_query(spark, sf_dir):
    return tables.read_only_sql(spark, "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price FROM ro_orders GROUP BY o_orderstatus", {"ro_orders": read(spark, sf_dir, "orders")})


def page_scan(spark, sf_dir):
    return tables.scan(read(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}, order=("o_orderkey",)).select("o_orderkey", "o_custkey")


def numeral_tokens(spark, sf_dir):
    tokens = read(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[IVXLCDMKYGO]+"), 0)).alias("token"))
    return structure.normalize_numerals(tokens)


def stream_state_changes(spark, sf_dir):
    """The streaming form over the events table as a stream of files, run until it has read them all."""
    e = read(spark, sf_dir, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{sf_dir}/events.parquet*")
    changes = streams.state_changes(stream.withColumn("ts", F.col("ts").cast("timestamp")), entity="user_id", order="ts", value="event_type")
    path = shared_folder(spark, "changes")
    changes.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


QUERIES = {f.__name__: f for f in (
    state_changes, continuity_status, scene_neighbours, story_neighbours, canonical_facts, fact_reconciliation, conflict_classes, integrity_checks,
    identity_anchor, name_bases, compatible_names, autofill, enqueue, due_topk, stale_recovery, retry_rule, schedule_spread, provider_ranking, provider_first,
    register_assets, status_transitions, asset_inspection, health_pivot, usage_by_day, upsert_jobs, output_check, nested_document_export, document_headers,
    csv_rows, replace_document, read_only_query, page_scan, numeral_tokens, stream_state_changes,
)}

_QUEUE = "q AS (SELECT o_orderkey AS id, o_custkey AS scene_id, 'image' AS job_type, CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'F' THEN 'completed' ELSE 'running' END AS status, o_orderdate AS scheduled_at, o_orderkey % 5 AS attempts, o_orderpriority AS provider FROM orders)"
_FACTS = "f AS (SELECT user_id AS profile_id, CASE event_id % 3 WHEN 0 THEN 'hair' WHEN 1 THEN 'clothing' ELSE 'weather' END AS attribute, event_type AS value, event_id // 200 AS scene_id, event_id AS fact_id, round(event_id % 50 / 50.0::DOUBLE + 0.3::DOUBLE, 2) AS confidence, 'e' || event_id AS evidence FROM events)"
_STATE = "s AS (SELECT user_id AS entity_id, event_id AS scene_id, event_type AS type, CASE WHEN CAST(props->>'$.k' AS INTEGER) > 50 THEN 'yes' END AS big FROM events), w AS (SELECT *, lag(type) OVER o AS ptype, lag(big) OVER o AS pbig, row_number() OVER o AS n FROM s WINDOW o AS (PARTITION BY entity_id ORDER BY scene_id))"
_PROVIDERS = "p AS (SELECT s_name AS name, s_suppkey AS priority, CASE WHEN s_suppkey % 4 = 0 THEN 0.0::DOUBLE ELSE round(abs(s_acctbal) / 10000, 4) END AS cost, s_suppkey % 7 <> 0 AS enabled, s_suppkey % 5 AS quota, unnest(CASE s_suppkey % 3 WHEN 0 THEN ['image'] WHEN 1 THEN ['video'] ELSE ['image', 'video'] END) AS media_type FROM supplier)"

ORACLES = {
    "state_changes": f"""WITH {_STATE}, c AS (
  SELECT entity_id, scene_id, 'state.type' AS attribute, ptype AS previous, type AS new FROM w WHERE n > 1 AND ptype IS DISTINCT FROM type
  UNION ALL SELECT entity_id, scene_id, 'state.big', pbig, big FROM w WHERE n > 1 AND pbig IS DISTINCT FROM big)
SELECT *, CASE WHEN previous IS NULL THEN 'introduced' WHEN new IS NULL THEN 'removed' ELSE 'updated' END AS change_type FROM c""",
    "continuity_status": f"WITH {_STATE} SELECT entity_id, scene_id, CASE WHEN n = 1 THEN 'introduced' WHEN type = ptype AND big IS NOT DISTINCT FROM pbig THEN 'carried' ELSE 'changed' END AS status FROM w",
    "scene_neighbours": "SELECT conv_id, turn, lag(turn) OVER w AS previous_id, lead(turn) OVER w AS next_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "story_neighbours": "WITH t AS (SELECT conv_id, turn, conv_id || '.' || turn AS scene FROM conversations) SELECT a.conv_id, a.turn, a.scene, p.scene AS previous_id, n.scene AS next_id FROM t a LEFT JOIN t p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1 LEFT JOIN t n ON n.conv_id = a.conv_id AND n.turn = a.turn + 1",
    "canonical_facts": f"""WITH {_FACTS}, g AS (SELECT profile_id, attribute, value, least(0.99::DOUBLE, max(confidence)) AS confidence, arg_min(evidence, (scene_id, evidence)) AS evidence, CASE WHEN count(DISTINCT scene_id) = 1 THEN max(scene_id) END AS scene_id, count(*) AS occurrences FROM f GROUP BY 1, 2, 3)
SELECT *, count(*) OVER (PARTITION BY profile_id, attribute) > 1 AS contradictory FROM g""",
    "fact_reconciliation": f"""WITH {_FACTS}, g AS (SELECT profile_id, attribute, value, min(confidence) AS confidence, count(DISTINCT scene_id) AS scenes, count(*) AS facts, md5(string_agg(CAST(fact_id AS VARCHAR), ',' ORDER BY fact_id)) AS facts_md5 FROM f GROUP BY 1, 2, 3),
t AS (SELECT *, CASE attribute WHEN 'hair' THEN 'stable' WHEN 'clothing' THEN 'stateful' ELSE 'contextual' END AS state_type FROM g)
SELECT *, CASE WHEN state_type = 'stable' AND count(*) OVER (PARTITION BY profile_id, attribute) > 1 THEN 'conflict' ELSE 'supported' END AS status FROM t""",
    "conflict_classes": f"""WITH {_FACTS}, k AS (SELECT * REPLACE (confidence + 0.35::DOUBLE AS confidence) FROM f WHERE attribute = 'hair'),
g AS (SELECT profile_id, attribute, value, min(confidence) AS confidence, count(DISTINCT scene_id) AS own FROM k GROUP BY 1, 2, 3), a AS (SELECT profile_id, count(DISTINCT scene_id) AS every, count(DISTINCT value) AS vals FROM k GROUP BY 1)
SELECT profile_id, attribute, value, CASE WHEN confidence < 0.6 THEN 'low_evidence' WHEN every > own THEN 'scene_scoped' ELSE 'strong_conflict' END AS classification, confidence FROM g JOIN a USING (profile_id) WHERE vals > 1""",
    "integrity_checks": """WITH c AS (SELECT 'orders_without_customer' AS "check", (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS value, 0 AS wanted
UNION ALL SELECT 'lines_without_order', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)), 0
UNION ALL SELECT 'customers_without_order', (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)), NULL
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), NULL UNION ALL SELECT 'negative_quantities', (SELECT count(*) FROM lineitem WHERE l_quantity < 0), 0)
SELECT "check", value, CASE WHEN wanted IS NULL THEN value > 0 ELSE value = wanted END AS passed FROM c""",
    "identity_anchor": "SELECT c_custkey, 'vib-' || substr(sha256(c_custkey || '|' || c_name || '|' || c_mktsegment), 1, 12) AS anchor FROM customer",
    "name_bases": "SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS base FROM customer",
    "compatible_names": """WITH r AS (SELECT unnest([p_name, p_type || ' ' || string_split(p_name, ' ')[-1], string_split(p_name, ' ')[-1]]) AS name FROM part),
n AS (SELECT DISTINCT array_to_string(list_transform(string_split(name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM r), t AS (SELECT name, string_split(lower(name), ' ') AS w FROM n)
SELECT a.name AS first_name, b.name AS second_name, CASE WHEN len(a.w) = 2 AND len(b.w) = 2 THEN 0.86::DOUBLE ELSE 0.82::DOUBLE END AS confidence, CASE WHEN len(a.w) = 2 AND len(b.w) = 2 THEN 'same_surname_initial_variant' ELSE 'surname_variant' END AS method
FROM t a JOIN t b ON a.name < b.name AND a.w[-1] = b.w[-1] AND ((len(a.w) = 2 AND len(b.w) = 2 AND a.w[1][1] = b.w[1][1]) OR (len(a.w) = 1) <> (len(b.w) = 1))""",
    "autofill": f"WITH {_QUEUE} SELECT c_custkey AS scene_id FROM customer WHERE c_custkey NOT IN (SELECT scene_id FROM q WHERE status IN ('queued', 'completed')) ORDER BY 1 LIMIT 25",
    "enqueue": f"""WITH {_QUEUE}, old AS (SELECT * FROM q WHERE id % 2 = 0), new AS (SELECT *, row_number() OVER (PARTITION BY scene_id, provider ORDER BY id) AS n FROM q WHERE id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.scene_id = q.scene_id AND o.provider = q.provider))
SELECT id, scene_id, provider, status FROM old UNION ALL SELECT id, scene_id, provider, status FROM new WHERE n = 1""",
    "due_topk": f"WITH {_QUEUE} SELECT id, strftime(scheduled_at, '%Y-%m-%d') AS day FROM q WHERE status = 'queued' AND scheduled_at <= TIMESTAMP '{NOW}' ORDER BY scheduled_at, id LIMIT 10",
    "stale_recovery": f"WITH {_QUEUE} SELECT id, CASE WHEN status = 'running' AND scheduled_at < TIMESTAMP '{NOW}' - INTERVAL 120 MINUTE THEN 'queued' ELSE status END AS status, status = 'running' AND scheduled_at < TIMESTAMP '{NOW}' - INTERVAL 120 MINUTE AS recovered FROM q",
    "retry_rule": f"WITH {_QUEUE} SELECT id, CASE WHEN attempts >= 3 THEN 'failed' ELSE 'queued' END AS status, CASE WHEN attempts >= 3 THEN attempts ELSE attempts + 1 END AS attempts FROM q",
    "schedule_spread": f"WITH {_QUEUE}, r AS (SELECT id, row_number() OVER (PARTITION BY provider ORDER BY id) AS place FROM q) SELECT id, place, strftime(TIMESTAMP '{NOW}' + to_minutes((place - 1) * 15), '%Y-%m-%d %H:%M') AS at FROM r",
    "provider_ranking": f"""WITH {_PROVIDERS}, c AS (SELECT media_type, name, -priority AS place FROM p WHERE priority % 2 = 0 AND enabled AND quota <> 0 AND cost <= 0.6),
f AS (SELECT media_type, name, priority + 1000 AS place FROM p WHERE enabled AND cost = 0 AND media_type NOT IN (SELECT media_type FROM c))
SELECT media_type, row_number() OVER (PARTITION BY media_type ORDER BY place, name) AS rank, name FROM (SELECT * FROM c UNION ALL SELECT * FROM f)""",
    "provider_first": f"WITH {_PROVIDERS} SELECT media_type, arg_min(name, (priority, name)) AS name FROM p WHERE enabled GROUP BY 1",
    "register_assets": f"""WITH {_QUEUE}, a AS (SELECT l_orderkey AS job_id, CASE min(l_returnflag) WHEN 'A' THEN 'validated' WHEN 'N' THEN 'pending' ELSE 'review' END AS status FROM lineitem GROUP BY 1)
SELECT * FROM a UNION ALL SELECT id, 'pending' FROM q WHERE status = 'completed' AND id NOT IN (SELECT job_id FROM a)""",
    "status_transitions": """WITH a AS (SELECT l_orderkey AS asset_id, CASE min(l_returnflag) WHEN 'A' THEN 'validated' WHEN 'N' THEN 'pending' ELSE 'review' END AS status FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey AS asset_id, CASE o_orderkey % 4 WHEN 1 THEN 'rejected' WHEN 2 THEN 'lost' ELSE 'approved' END AS wanted FROM orders),
j AS (SELECT asset_id, wanted, CASE WHEN status IS NULL THEN 'unknown_asset' WHEN wanted = 'lost' THEN 'unknown_status' WHEN wanted = 'approved' AND status <> 'validated' THEN 'not_validated' END AS reason FROM r LEFT JOIN a USING (asset_id))
SELECT asset_id, wanted, reason IS NULL AS accepted, reason FROM j""",
    "asset_inspection": "WITH a AS (SELECT CASE min(l_returnflag) WHEN 'A' THEN 'validated' WHEN 'N' THEN 'pending' ELSE 'review' END AS status FROM lineitem GROUP BY l_orderkey) SELECT status, count(*) AS n FROM a GROUP BY 1",
    "health_pivot": f"WITH {_QUEUE} SELECT provider, count(*) FILTER (WHERE status = 'queued') AS queued, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'running') AS running FROM q GROUP BY 1",
    "usage_by_day": "SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, sum(l_quantity) AS cost, sum(l_quantity) > 700 AS over_limit FROM lineitem GROUP BY 1",
    "upsert_jobs": f"WITH {_QUEUE} SELECT id, scene_id, provider, status FROM q QUALIFY row_number() OVER (PARTITION BY scene_id, provider ORDER BY scheduled_at DESC, id DESC) = 1",
    "output_check": """WITH b AS (SELECT o_orderkey AS output_id, o_orderkey % 10 <> 1 AS planned, o_orderkey % 10 <> 3 AS delivered, CASE WHEN o_orderkey % 9 <> 2 THEN o_orderpriority END AS provider FROM orders),
e AS (SELECT output_id, array_to_string(list_filter([CASE WHEN NOT delivered THEN 'missing_output' END, CASE WHEN NOT planned THEN 'unplanned_output' END, CASE WHEN delivered AND provider IS NULL THEN 'provider_missing' END], lambda x: x IS NOT NULL), ',') AS errors FROM b)
SELECT output_id, errors, CASE WHEN errors = '' THEN 'pass' ELSE 'fail' END AS status FROM e""",
    "nested_document_export": "SELECT o_orderkey AS document_id, o_orderstatus, count(l_orderkey) AS n, coalesce(string_agg(l_linenumber || ':' || l_partkey || ':' || CAST(l_quantity AS INTEGER), ',' ORDER BY l_linenumber, l_partkey, l_quantity), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
    "document_headers": "SELECT CAST(conv_id AS VARCHAR) AS document_id, CASE WHEN bool_and(role = 'user') THEN 'text' WHEN bool_and(role <> 'user') THEN 'scanned' ELSE 'mixed' END AS document_type, count(*) AS page_count, count(*) FILTER (WHERE role <> 'user') AS scanned_page_count FROM conversations GROUP BY 1",
    "replace_document": "SELECT o_custkey AS path, CASE WHEN o_custkey % 10 = 1 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS row FROM orders",
    "read_only_query": "SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price FROM orders GROUP BY 1",
    "page_scan": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
}
