"""From crosswalks to one scored row per building."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions import scoring
from plinth.operators.ranking import best_per

DETAILS = ["height", "num_floors", "overture_class", "names"]
VALUES = ["nsi_id", "nsi_occtype", "nsi_val_struct", "nsi_val_cont", "nsi_point_count"]


def full_outer(overture: DataFrame, bridge: DataFrame, fema: DataFrame) -> DataFrame:
    """The literal resolution: overture, bridge and fema joined full outer; one row per match."""
    b = bridge.select(F.col("overture_id").alias("b_overture_id"), F.col("fema_id").alias("b_fema_id"), "iou")
    f = fema.select(F.col("fema_id").alias("f_fema_id"), F.col("occ_cls").alias("fema_occ_cls"))
    o = overture.select("overture_id", *DETAILS)
    j = o.join(b, o.overture_id == b.b_overture_id, "full_outer").join(f, F.col("b_fema_id") == f.f_fema_id, "full_outer")
    ids = F.coalesce("overture_id", F.concat(F.lit("fema_only_"), F.col("f_fema_id")))
    source = F.when(F.col("overture_id").isNotNull(), "overture").when(F.col("f_fema_id").isNotNull(), "fema_only")
    return j.select(ids.alias("building_id"), "overture_id", F.col("f_fema_id").alias("fema_id"), F.col("iou").alias("fema_iou"), *DETAILS, "fema_occ_cls", source.alias("source"))


def collapse(resolved: DataFrame) -> DataFrame:
    """One row per building of ``full_outer``: its best second-source match (iou, then id) and how many there were."""
    both = F.col("overture_id").isNotNull() & F.col("fema_id").isNotNull()
    matched = resolved.filter(both)
    counted = matched.withColumn("fema_match_count", F.count("fema_id").over(Window.partitionBy("overture_id")))
    best = best_per(counted, ["overture_id"], [F.desc_nulls_last("fema_iou"), F.asc_nulls_last("fema_id")])
    alone = resolved.filter(F.col("overture_id").isNotNull() & F.col("fema_id").isNull()).withColumn("fema_match_count", F.lit(0).cast("long"))
    second = resolved.filter(F.col("overture_id").isNull() & F.col("fema_id").isNotNull()).withColumn("fema_match_count", F.lit(1).cast("long"))
    return best.unionByName(alone).unionByName(second)


def resolve(overture: DataFrame, bridge: DataFrame, fema: DataFrame) -> DataFrame:
    """``collapse(full_outer(...))`` for consistent bridges, without full outer joins: each side is shuffled once by its id."""
    f = fema.select(F.col("fema_id").alias("f_id"), F.col("occ_cls").alias("fema_occ_cls"))
    matches = bridge.join(f, bridge.fema_id == f.f_id).select("overture_id", "fema_id", F.col("iou").alias("fema_iou"), "fema_occ_cls")
    best = matches.groupBy("overture_id").agg(F.count("fema_id").alias("n"), F.min(F.struct((-F.col("fema_iou")).alias("minus"), "fema_id", "fema_occ_cls")).alias("m"))
    o = overture.select("overture_id", *DETAILS).join(best, "overture_id", "left")
    first = o.select(F.col("overture_id").alias("building_id"), "overture_id", F.col("m.fema_id").alias("fema_id"), (-F.col("m.minus")).alias("fema_iou"), *DETAILS, F.col("m.fema_occ_cls").alias("fema_occ_cls"), F.lit("overture").alias("source"), F.coalesce("n", F.lit(0)).cast("long").alias("fema_match_count"))
    rest = fema.filter("fema_id IS NOT NULL").join(bridge.select("fema_id"), "fema_id", "left_anti")
    second = rest.select(F.concat(F.lit("fema_only_"), F.col("fema_id")).alias("building_id"), "fema_id", F.col("occ_cls").alias("fema_occ_cls"), F.lit("fema_only").alias("source"), F.lit(1).cast("long").alias("fema_match_count"))
    return first.unionByName(second, allowMissingColumns=True)


def primary_values(bridge: DataFrame, key: str) -> DataFrame:
    """Per building: the most valuable point's id and code, the values' sums (0.0 of none) and the number of points."""
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c)
    first = F.min(F.struct(F.when(F.col("nsi_val_struct").isNull(), 1).otherwise(0).alias("last"), (-F.col("nsi_val_struct")).alias("minus"), "nsi_id", "nsi_occtype")).alias("p")
    rows = bridge.filter(F.col(key).isNotNull()).groupBy(key).agg(first, total("nsi_val_struct"), total("nsi_val_cont"), F.count("nsi_id").alias("nsi_point_count"))
    return rows.select(key, F.col("p.nsi_id").alias("nsi_id"), F.col("p.nsi_occtype").alias("nsi_occtype"), "nsi_val_struct", "nsi_val_cont", "nsi_point_count")


def enrich(buildings: DataFrame, nsi_bridge: DataFrame | None, nsi_fema: DataFrame | None) -> DataFrame:
    """Values from the points: by first-source id, then for second-source buildings without any by their own id.

    Without a bridge the columns are null, the count 0, and the second step does not happen."""
    if nsi_bridge is None:
        kinds = ("long", "string", "double", "double")
        return buildings.select("*", *(F.lit(None).cast(k).alias(c) for c, k in zip(VALUES, kinds, strict=False)), F.lit(0).cast("long").alias("nsi_point_count"), F.lit(False).alias("has_nsi_match"))
    out = buildings.join(primary_values(nsi_bridge, "overture_id"), "overture_id", "left")
    if nsi_fema is not None:
        fill = primary_values(nsi_fema, "fema_id").select("fema_id", *(F.col(c).alias(f"_{c}") for c in VALUES))
        use = (F.col("source") == "fema_only") & F.col("nsi_id").isNull()
        joined = out.join(fill, "fema_id", "left").withColumn("_use", use)
        out = joined.select(*buildings.columns, *(F.when(F.col("_use"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in VALUES))
    return out.withColumn("has_nsi_match", F.col("nsi_id").isNotNull())


def score(buildings: DataFrame, high_iou: float = 0.80) -> DataFrame:
    o, f = F.col("overture_id").isNotNull(), F.col("fema_id").isNotNull()
    fema, code = F.col("fema_occ_cls"), F.col("nsi_occtype")
    return buildings.withColumns({
        "conflation_confidence": scoring.confidence(o, f, scoring.iou_for_confidence(f, F.col("fema_iou")), high_iou),
        "general_occupancy": scoring.general_occupancy(fema, code),
        "occupancy_confidence": scoring.occupancy_confidence(fema, code),
    })


def with_geometry(buildings: DataFrame, overture: DataFrame, fema: DataFrame, columns: list[str] = ("geometry",)) -> DataFrame:
    """The first source's geometry wherever it has an id, else the second's; joined last so that it is shuffled once."""
    og = overture.select("overture_id", *(F.col(c).alias(f"_o{c}") for c in columns))
    fg = fema.select("fema_id", *(F.col(c).alias(f"_f{c}") for c in columns))
    j = buildings.join(og, "overture_id", "left").join(fg, "fema_id", "left")
    return j.select(*buildings.columns, *(F.when(F.col("overture_id").isNotNull(), F.col(f"_o{c}")).otherwise(F.col(f"_f{c}")).alias(c) for c in columns))


def review(unmatched: DataFrame, by_fema: DataFrame) -> DataFrame:
    """The points no footprint source holds, with a geometry in place of the text."""
    from plinth.functions.spatial import st_geomfromtext
    from plinth.operators.bridges import nsi_review

    return nsi_review(unmatched, by_fema).withColumn("geometry", st_geomfromtext("nsi_point_wkt")).drop("nsi_point_wkt")


def produce(overture: DataFrame, fema: DataFrame, bridge: DataFrame, nsi_bridge: DataFrame | None, nsi_fema: DataFrame | None, high_iou: float = 0.80) -> DataFrame:
    """The scored table, geometry and reserved columns included."""
    scored = score(enrich(resolve(overture, bridge, fema), nsi_bridge, nsi_fema), high_iou)
    none = F.lit(None).cast("string")
    return with_geometry(scored, overture, fema).withColumns({"osm_id": none, "osm_type": none})
