"""Visual profiles of characters: what the source says, and what genre, role and the document's world let one suppose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import squeezed
from .classify import visual_role

#: Statuses of facts that say nothing.
UNUSABLE = ["unknown", "rejected", "conflict", "contradictory"]


def attribute_of(value: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """The attribute that a supposed value is about: the first rule any of whose words it holds, else visual_style."""
    low = F.lower(value)
    out = F.lit("visual_style")
    for attribute, words in reversed(rules or L.PRIOR_ATTRIBUTES):
        held = F.lit(False)
        for w in words:
            held = held | (low.startswith(w[1:]) if w.startswith("^") else F.contains(low, F.lit(w)))
        out = F.when(held, F.lit(attribute)).otherwise(out)
    return out


def context_labels(classified: DataFrame, *, id_col: str = "document_id", dimensions: tuple[str, ...] = ("culture", "religious_context", "region", "period")) -> DataFrame:
    """id and labels: "detected <dimension>: <best label>" in the order of dimensions (classified: what classify_documents gives)."""
    best = classified.filter((F.col("rank") == 1) & F.col("dimension").isin(list(dimensions)))
    place = F.array_position(F.array(*[F.lit(d) for d in dimensions]), F.col("dimension"))
    told = F.concat(F.lit("detected "), F.replace("dimension", F.lit("_"), F.lit(" ")), F.lit(": "), "label")
    return best.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), told.alias("label")))), lambda x: x["label"]).alias("labels"))


def genres(classified: DataFrame, *, id_col: str = "document_id", dimension: str = "narrative_type") -> DataFrame:
    """id and genre: the best label of the dimension that tells kinds of narrative."""
    return classified.filter((F.col("rank") == 1) & (F.col("dimension") == dimension)).select(id_col, F.col("label").alias("genre"))


def _listed(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _chosen(choice: Column, table: dict[str, list[str]], otherwise: Column) -> Column:
    out = otherwise
    for name, values in table.items():
        out = F.when(choice == name, _listed(values)).otherwise(out)
    return out


def source_facts(facts: DataFrame, *, key: str = "profile_id") -> DataFrame:
    """key, attribute, value of facts that hold: values of at most 140 characters, blanks and unusable statuses left out."""
    status = F.lower(F.coalesce("status", F.lit("")))
    return facts.withColumn("value", F.rtrim(F.substring(squeezed(F.col("value")), 1, 140))).filter((F.col("value") != "") & ~status.isin(UNUSABLE))


def visual_profiles(
    characters: DataFrame, facts: DataFrame, *, key: str = "profile_id", baselines: dict[str, list[str]] | None = None, priors: dict[str, list[str]] | None = None,
    roles: list[tuple[str, str]] | None = None, default_genre: str = "general_narrative", traits: list[str] | None = None, locked: bool = True,
) -> DataFrame:
    """One row a character with its role, anchor, source facts, inferred facts and source attributes that stay unknown.

    characters: key, canonical_name and, as they are known, contexts (array of texts), genre and
    labels (array, see context_labels). facts: key, attribute, value, status. A genre that has no
    baseline takes the default's, but keeps its name. What is supposed comes in this order: labels of
    the world, the genre's baseline, the role's priors. A value is left out where its attribute
    is told by the source (under its alias too), where it speaks of a trait of identity that must
    not be supposed, or where it came before. Characters without facts are kept. The policy
    is a handful of literals in the plan, so facts are grouped and joined once, both by key.
    """
    baselines, priors, traits = baselines or L.GENRE_BASELINES, priors or L.ROLE_PRIORS, traits or L.IDENTITY_TRAITS
    low = F.lower(F.btrim("attribute"))
    standard = low
    for name, alias in L.ATTRIBUTE_ALIASES.items():
        standard = F.when(low == name, F.lit(alias)).otherwise(standard)
    told = source_facts(facts, key=key).groupBy(key).agg(
        F.collect_set(standard).alias("__known"), F.array_sort(F.collect_set(F.struct("attribute", "value"))).alias("source_facts"),
    )
    none = F.array().cast("array<string>")
    has = lambda c, kind, empty: F.coalesce(F.col(c), empty) if c in characters.columns else empty.cast(kind)
    name = F.rtrim(F.substring(squeezed(F.coalesce("canonical_name", F.lit(""))), 1, 120))
    seen = F.array_join(F.transform(has("contexts", "array<string>", none), lambda c: F.rtrim(F.substring(squeezed(c), 1, 220))), " ")
    base = characters.select(
        key, name.alias("canonical_name"), has("genre", "string", F.lit(default_genre)).alias("genre"), has("labels", "array<string>", none).alias("labels"),
        visual_role(F.concat_ws(" ", name, seen), roles).alias("visual_role"),
    ).join(told, key, "left")
    known = F.coalesce("__known", none)
    general = _listed(baselines[default_genre])
    supposed = F.concat("labels", _chosen(F.col("genre"), baselines, general), _chosen(F.col("visual_role"), priors, none))
    allowed = F.filter(supposed, lambda v: ~F.exists(_listed([t.replace("_", " ") for t in L.NEVER_SUPPOSED]), lambda t: F.contains(F.lower(v), t)))
    # an element that came before in another case is the same value
    folded = F.transform(allowed, F.lower)
    first = F.filter(allowed, lambda v, i: F.array_position(folded, F.lower(v)) == i + 1)
    each = F.transform(first, lambda v: F.struct(
        attribute_of(v).alias("attribute"), F.rtrim(F.substring(squeezed(v), 1, 180)).alias("value"),
        F.when(F.lower(v).startswith("detected "), "world_context").otherwise("genre_prior").alias("basis"), F.lit(locked).alias("locked"),
    ))
    anchor = F.concat(F.lit("vib-"), F.substring(F.sha2(F.concat_ws("|", F.col(key).cast("string"), "canonical_name", "genre", F.array_join("labels", "|")), 256), 1, 12))
    return base.select(
        key, "canonical_name", "visual_role", "genre", anchor.alias("identity_anchor"),
        F.coalesce("source_facts", F.array().cast("array<struct<attribute:string,value:string>>")).alias("source_facts"),
        F.filter(each, lambda x: ~F.array_contains(known, x["attribute"])).alias("inferred_facts"),
        F.array_sort(F.array_except(_listed(traits), known)).alias("unknown_attributes"),
    )
