"""Territories: place names to publishers.

gazetteer: place_key (as place_norm gives it), kind ('national', 'abbreviation', 'region_synonym', 'region_group',
'county', 'city') and target: an authority for county and city, a region for region kinds, the long form of an
abbreviation. publishers: publisher, name, region_name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import place_norm

PRIORITY = {"national": 0, "region_synonym": 1, "region_group": 2, "county": 3, "city": 4, "name": 5}


def regions(publishers: DataFrame) -> DataFrame:
    return publishers.groupBy("region_name").agg(F.array_sort(F.collect_set("publisher")).alias("publishers"))


def place_index(gazetteer: DataFrame, publishers: DataFrame) -> DataFrame:
    """place_key, publishers (sorted) and absent: of every key's first kind in the order of PRIORITY the publishers, and the
    regions that the publishers lack. An authority that they lack adds nothing (``validate_gazetteer`` lists it)."""
    own = publishers.select("publisher", "name", "region_name")
    # A national key stands for a region that every publisher is in.
    areas = own.select("publisher", F.explode(F.array(F.struct(F.lit("region").alias("of"), F.col("region_name").alias("target")), F.struct(F.lit("nation").alias("of"), F.lit("").alias("target")))).alias("area")).select("publisher", "area.*")
    asked = gazetteer.where("kind in ('region_synonym', 'region_group', 'national')").select("place_key", "kind", F.when(F.col("kind") == "national", "").otherwise(F.col("target")).alias("target"), F.when(F.col("kind") == "national", "nation").otherwise("region").alias("of"))
    by_region = asked.join(areas, ["of", "target"], "left").select("place_key", "kind", "publisher", F.when(F.col("publisher").isNull(), F.col("target")).alias("absent"))
    none = F.lit(None).cast("string").alias("absent")
    plain = own.where("region_name is not null").select(place_norm(F.col("region_name")).alias("place_key"), F.lit("region_synonym").alias("kind"), "publisher", none)
    by_name = gazetteer.where("kind in ('county', 'city')").join(own, F.col("target") == F.col("name"), "left").select("place_key", "kind", "publisher", none)
    names = own.select(place_norm(F.col("name")).alias("place_key"), F.lit("name").alias("kind"), "publisher", none)
    rows = by_region.unionByName(plain).unionByName(by_name).unionByName(names)
    order = F.element_at(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv]), F.col("kind"))
    first = F.min("__order").over(Window.partitionBy("place_key"))
    sets = rows.withColumn("__order", order).withColumn("__first", first).where("__order = __first").groupBy("place_key")
    return sets.agg(F.array_sort(F.collect_set("publisher")).alias("publishers"), F.array_sort(F.collect_set("absent")).alias("absent"))


#: Where a place of several parts is split. The text as given is split, not its normal form, which has no commas.
PARTS = ",| and "


def resolve_territories(places: DataFrame, gazetteer: DataFrame, publishers: DataFrame, strict: bool = False) -> DataFrame:
    """place (as given), its sorted publishers, and the reason where there are none (publishers null).

    The whole text is tried first, so one publisher's name may hold commas; else it is split, and every part has to be
    known. A region that the publishers lack makes the place unresolved too, never smaller. ``strict`` ends the job with
    the reason of an unresolved place.
    """
    index = place_index(gazetteer, publishers)
    short = gazetteer.where("kind = 'abbreviation'").groupBy("place_key").agg(F.min("target").alias("__long")).withColumnRenamed("place_key", "__short")

    def found(df: DataFrame, column: str) -> DataFrame:
        """df with publishers and absent of the place in a column, null where it is not known; national keys come before
        abbreviations, which come before all others."""
        rows = df.withColumn("__key", place_norm(F.col(column))).join(short, F.col("__key") == F.col("__short"), "left")
        return rows.withColumn("place_key", F.coalesce("__long", "__key")).drop("__key", "__short", "__long").join(index, "place_key", "left").drop("place_key")

    one = places.select("place").distinct()
    whole = found(one, "place")
    pieces = F.filter(F.transform(F.split(F.coalesce("place", F.lit("")), PARTS), lambda x: F.trim(x)), lambda x: x != "")
    parts = whole.where("publishers is null").select("place", pieces.alias("parts"))
    split = parts.where(F.size("parts") > 1).select("place", F.posexplode("parts").alias("nth", "part"))
    unknown = F.array_sort(F.collect_list(F.when(F.col("publishers").isNull(), F.struct("nth", "part"))))
    many = found(split, "part").groupBy("place").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("publishers")))).alias("publishers"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("absent")))).alias("absent"), unknown.alias("unknown")
    )
    empty = F.array().cast("array<struct<nth:int,part:string>>")
    alone = parts.where(F.size("parts") <= 1).select("place", F.lit(None).cast("array<string>").alias("publishers"), F.lit(None).cast("array<string>").alias("absent"), F.array(F.struct(F.lit(0).alias("nth"), F.col("place").alias("part"))).alias("unknown"))
    known = whole.where("publishers is not null").withColumn("unknown", empty)
    every = known.unionByName(many).unionByName(alone)
    lost = F.concat(F.lit("absent: "), F.array_join("absent", ", "))
    reason = F.when(place_norm(F.col("place")) == "", "no territory given").when(F.size("unknown") > 0, F.concat(F.lit("unknown: "), F.get("unknown", F.lit(0))["part"])).when(F.size("absent") > 0, lost)
    out = every.withColumn("reason", reason).select("place", F.when(F.col("reason").isNull(), F.col("publishers")).alias("publishers"), "reason")
    if strict:
        refused = F.raise_error(F.concat(F.lit("territory "), F.coalesce("place", F.lit("null")), F.lit(": "), F.col("reason")))
        out = out.withColumn("publishers", F.when(F.col("reason").isNotNull(), refused.cast("array<string>")).otherwise(F.col("publishers")))
    return out


def resolve_many(resolved: DataFrame) -> DataFrame:
    return resolved.select(F.explode("publishers").alias("publisher")).distinct()


def validate_gazetteer(gazetteer: DataFrame, publishers: DataFrame) -> DataFrame:
    """Authorities that the gazetteer names and the publishers lack, and regions likewise."""
    names = gazetteer.where("kind in ('county', 'city')").select(F.col("target").alias("name")).distinct().join(publishers, "name", "left_anti")
    areas = gazetteer.where("kind in ('region_synonym', 'region_group')").select(F.col("target").alias("region_name")).distinct().join(publishers, "region_name", "left_anti")
    return names.unionByName(areas.select(F.col("region_name").alias("name"))).orderBy("name")
