"""Station totals, kept up batch by batch.

Of each batch the sums by place are kept (``station_parts``), of the rides that count for
it: a ride in several batches counts for the latest. The rides of all batches are kept by
ride id, bucketed (``sinks.keys``), so those that a batch shares with others are found
without a shuffle of what is stored, and without reading the stage zone of another month.

Loading a batch sums up its own rides anew. In other batches only shared rides change
hands: they are subtracted where they no longer count, and added where they count again.
The sums and the name of the load they were made from are one version of one small
table, so a run that dies leaves both as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import exact
from tripmart.plans import star
from tripmart.schemas import STATION_PARTS
from tripmart.sinks import keys
from tripmart.sinks.versions import replace_table, stage
from tripmart.sources.zones import read_table

#: What is kept of a ride.
RIDES = T.StructType(
    [T.StructField("ride_id", T.StringType()), T.StructField("batch", T.StringType()), T.StructField("minutes", T.DecimalType(18, 6))]
    + [
        T.StructField(f"{side}_{name}", kind)
        for side in ("start", "end")
        for name, kind in (("station_id", T.StringType()), ("station_name", T.StringType()), ("lat", T.DoubleType()), ("lng", T.DoubleType()))
    ]
)
_SUMS = STATION_PARTS.fieldNames()[6:]


def _rides(staged: DataFrame, batch: str) -> DataFrame:
    """The rides of a batch as they are kept."""
    minutes = exact.measure(F.col("trip_duration_minutes")).cast(RIDES["minutes"].dataType).alias("minutes")
    return staged.select("ride_id", F.lit(batch).alias("batch"), minutes, *RIDES.fieldNames()[3:])


def _sums(rides: DataFrame, sign=None) -> DataFrame:
    """Sums by batch and place of kept rides."""
    named = rides.withColumn("trip_duration_minutes", F.col("minutes"))
    carried = ("batch",) if sign is None else ("batch", "sign")
    return star.place_sums(star.ride_ends(named, *carried), "batch", sign=sign)


def counted_loads(parts: DataFrame) -> dict[str, str]:
    """Which load of each batch counts: one row a batch."""
    return {row.batch: row.load for row in parts.filter(F.col("station_id").isNull()).select("batch", "load").collect()}


def shared_with(spark: SparkSession, rides: DataFrame, path: str, loads: list[str]) -> DataFrame:
    """ride_id and batch of the stored rides, in the given loads, that ``rides`` has too; reads no other columns."""
    known = keys.stored(spark, path, RIDES, "ride_id").filter(F.col("load").isin(loads)).select("ride_id", "batch", "load")
    return known.join(rides.select("ride_id").distinct(), "ride_id", "left_semi")


def update_batch(spark: SparkSession, staged: DataFrame, batch: str, parts_path: str, rides_path: str) -> DataFrame:
    """Take in the staged rides of a batch, one row a ride, in place of what was known of it; returns the places' sums."""
    before = read_table(spark, parts_path, STATION_PARTS, first_load=True)
    loads = counted_loads(before)
    others = [load for name, load in loads.items() if name != batch]
    load = keys.add_load(spark, _rides(staged, batch), rides_path, RIDES, "ride_id")
    kept = keys.stored(spark, rides_path, RIDES, "ride_id")
    new = kept.filter(F.col("load") == load).drop("load")
    old = kept.filter(F.col("load") == loads.get(batch, "")).drop("load")

    both = new.select("ride_id", F.lit(True).alias("is_new")).unionByName(old.select("ride_id", F.lit(False).alias("is_new")))
    shared = stage(spark, shared_with(spark, both, rides_path, others))
    latest = shared.groupBy("ride_id").agg(F.max_by("load", "batch").alias("other_load"), F.max("batch").alias("other"))
    flags = both.join(latest, "ride_id").groupBy("ride_id", "other", "other_load").agg(F.bool_or("is_new").alias("in_new"), F.bool_or(~F.col("is_new")).alias("in_old"))
    flags = stage(spark, flags)

    later = flags.filter(F.col("other") > batch).select("ride_id")
    own = _sums(new.join(later, "ride_id", "left_anti")).withColumn("load", F.lit(load))
    # rides that earlier batches lose to this one, or get back from it
    hands = flags.filter((F.col("other") < batch) & (F.col("in_new") != F.col("in_old")))
    hands = hands.select("ride_id", "other_load", F.when(F.col("in_new"), -1).otherwise(1).alias("sign"))
    touched = [row.other_load for row in hands.select("other_load").distinct().collect()]  # a batch each
    rest = before.filter(F.col("batch") != batch)
    sums = rest.filter(F.col("station_id").isNotNull()).select("batch", *star.PLACE, *_SUMS)
    if touched:
        moved = kept.filter(F.col("load").isin(touched)).join(hands, "ride_id").filter(F.col("load") == F.col("other_load"))
        sums = sums.unionByName(_sums(moved, F.col("sign")))
    sums = sums.groupBy("batch", *star.PLACE).agg(*(F.sum(x).cast(STATION_PARTS[x].dataType).alias(x) for x in _SUMS))
    sums = sums.filter((F.col("out_rides") != 0) | (F.col("in_rides") != 0))
    names = F.create_map(*[F.lit(x) for pair in loads.items() for x in pair]) if loads else F.create_map().cast("map<string,string>")
    sums = sums.withColumn("load", names[F.col("batch")])
    marks = spark.createDataFrame([(batch, load, *[None] * (len(STATION_PARTS) - 2))], STATION_PARTS)
    columns = STATION_PARTS.fieldNames()
    after = sums.select(columns).unionByName(own.select(columns)).unionByName(marks).unionByName(rest.filter(F.col("station_id").isNull()))
    replace_table(spark, after.coalesce(1), parts_path)
    # loads that no version names any more: those before the one just replaced
    used = {load, *others, loads.get(batch)}
    keys.drop_loads(spark, rides_path, RIDES, "ride_id", [x for x in keys.loads(spark, rides_path) if x not in used])
    return read_table(spark, parts_path, STATION_PARTS)


def stations(parts: DataFrame) -> DataFrame:
    """All stations from the kept sums."""
    return star.stations_of(parts.filter(F.col("station_id").isNotNull()))
