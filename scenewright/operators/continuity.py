"""Ordered state: neighbours of scenes, states of entities, and what changes between sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import in_order


def scene_neighbours(scenes: DataFrame, *, group: str, order: list[str], id_col: str) -> DataFrame:
    """scenes with the previous and next id in order, which is one of whole numbers; of equal ones the lesser id comes first."""
    return in_order(scenes, [group], order, take=id_col, previous="previous_id", following="next_id")


def story_neighbours(scenes: DataFrame, *, keys: list[str], order: str, id_col: str) -> DataFrame:
    """scenes with the ids of order - 1 and order + 1 in the same story: null across a gap, unlike a lag."""
    near = lambda step, name: scenes.select(*keys, (F.col(order) - step).alias(order), F.col(id_col).alias(name))
    return scenes.join(near(-1, "previous_id"), [*keys, order], "left").join(near(1, "next_id"), [*keys, order], "left")


def entity_states(sightings: DataFrame, facts: DataFrame, *, entity: str = "entity_id", scene: str = "scene_id") -> DataFrame:
    """State of each entity at each scene that it is seen in: per bucket a map attribute -> sorted values, from facts of the scene or of none."""
    seen = sightings.select(entity, scene).distinct()
    told = facts.select(entity, scene, "bucket", "attribute", "value", "confidence")
    # facts of a scene meet it by key; only those of no scene go to all of an entity's scenes
    own = seen.join(told.filter(F.col(scene).isNotNull()), [entity, scene])
    lasting = seen.join(told.filter(F.col(scene).isNull()).drop(scene), entity).select(own.columns)
    values = own.unionByName(lasting).groupBy(entity, scene, "bucket", "attribute").agg(F.array_sort(F.collect_set("value")).alias("values"), F.max("confidence").alias("c"))
    entry = F.struct(F.concat_ws(".", "bucket", "attribute").alias("k"), F.col("values").alias("v"))
    states = values.groupBy(entity, scene).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("state"), F.max("c").alias("confidence"))
    none = F.map_from_entries(F.array().cast("array<struct<k:string,v:array<string>>>"))
    return seen.join(states, [entity, scene], "left").select(entity, scene, F.coalesce("state", none).alias("state"), "confidence")


def _same(a, b):
    """Maps have no equality of their own: compare their entries."""
    return F.array_sort(F.map_entries(a)) == F.array_sort(F.map_entries(b))


def continuity_status(states: DataFrame, *, entity: str = "entity_id", order: str = "scene_id") -> DataFrame:
    """states with previous_state and status: introduced at the first sighting, changed where it differs from the previous one, else carried."""
    w = Window.partitionBy(entity).orderBy(order)
    with_last = states.withColumn("previous_state", F.lag("state").over(w)).withColumn("__n", F.row_number().over(w))
    status = F.when(F.col("__n") == 1, "introduced").when(_same(F.col("state"), F.col("previous_state")), "carried").otherwise("changed")
    return with_last.withColumn("status", status).drop("__n")


def state_changes(states: DataFrame, *, entity: str = "entity_id", order: str = "scene_id") -> DataFrame:
    """entity, scene, attribute, previous, new, change_type (introduced, removed, updated) between sightings."""
    pairs = continuity_status(states, entity=entity, order=order).filter("previous_state IS NOT NULL")
    key = F.explode(F.array_union(F.map_keys("previous_state"), F.map_keys("state")))
    each = pairs.select(entity, order, "previous_state", "state", key.alias("attribute"))
    old, new = F.try_element_at("previous_state", F.col("attribute")), F.try_element_at("state", F.col("attribute"))
    kind = F.when(F.col("previous").isNull(), "introduced").when(F.col("new").isNull(), "removed").otherwise("updated")
    return each.select(entity, order, "attribute", old.alias("previous"), new.alias("new")).filter(~F.col("previous").eqNullSafe(F.col("new"))).withColumn("change_type", kind)


def scene_continuity(states: DataFrame, objects: DataFrame, scenes: DataFrame, *, entity: str = "entity_id", scene: str = "scene_id") -> DataFrame:
    """Per scene: entities carried (introduced ones included), changed, and its objects."""
    status = continuity_status(states, entity=entity, order=scene)
    ids = lambda c: F.array_sort(F.collect_list(F.when(c, F.col(entity))))
    people = status.groupBy(scene).agg(ids(F.col("status").isin("introduced", "carried")).alias("carried_ids"), ids(F.col("status") == "changed").alias("changed_ids"))
    things = objects.groupBy(scene).agg(F.array_sort(F.collect_set("object")).alias("objects"))
    return scenes.select(scene).join(people, scene, "left").join(things, scene, "left")


def environment_state(profiles: DataFrame, facts: DataFrame, *, scene: str = "scene_id") -> DataFrame:
    """Per scene a map of each environment's name to its facts of that scene, by falling confidence; scenes without any have no row."""
    places = profiles.filter("profile_type = 'environment'").select("profile_id", "canonical_name")
    told = facts.filter(F.col(scene).isNotNull()).join(places, "profile_id")
    fact = F.struct((-F.col("confidence")).alias("c"), "fact_id", "attribute", "value")
    each = told.groupBy(scene, "canonical_name").agg(F.transform(F.array_sort(F.collect_list(fact)), lambda f: F.struct(f["attribute"].alias("attribute"), f["value"].alias("value"), (-f["c"]).alias("confidence"))).alias("facts"))
    return each.groupBy(scene).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("canonical_name", "facts")))).alias("environment_state"))


def canonical_ids(scene_ids: DataFrame, mapping: DataFrame, *, scene: str = "scene_id") -> DataFrame:
    """scene_ids (scene, entity_ids) with entity ids replaced by canonical ones, ordered and unique; unmapped ids are dropped."""
    each = scene_ids.select(scene, F.posexplode("entity_ids").alias("at", "entity_id")).join(mapping.select("entity_id", "canonical_id"), "entity_id")
    first = each.groupBy(scene, "canonical_id").agg(F.min("at").alias("at"))
    return first.groupBy(scene).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "canonical_id"))), lambda x: x["canonical_id"]).alias("canonical_ids"))
