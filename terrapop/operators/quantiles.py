"""Exact percentiles of large groups, without a group in one task.

A percentile lies between two ranks. The range of a group is cut into buckets, which are
counted with their least and greatest value; the bucket that holds a rank is the next range,
until a range is a single value. Each round is one pass with partial counts; what is kept
between rounds is a row for each group and rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapop.sources.files import stored


def exact_percentiles(df: DataFrame, by: str, value: str, shares: dict[str, float], buckets: int = 65_536, digits: int = 6) -> DataFrame:
    """(``by``, a column for each of ``shares``): percentiles by linear interpolation between
    the two nearest ranks, rounded. Null and NaN are left out; a group of nothing else has
    no row, and neither have rows without group."""
    data = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("g").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    ranks = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p"), F.lit(up).alias("up")) for n, p in shares.items() for up in (False, True)])
    ends = data.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("r", F.explode(ranks))
    place = F.col("r.p") * (F.col("n") - 1)
    # ``rank`` counts within the range lo to hi.
    state = stored(ends.select("g", "r.name", "r.up", (place - F.floor(place)).alias("part"), F.when(F.col("r.up"), F.ceil(place)).otherwise(F.floor(place)).alias("rank"), "lo", "hi"))
    while state.where("lo < hi").limit(1).count():
        open_ = state.where("lo < hi")
        spread = F.col("hi") / 2 - F.col("lo") / 2
        bucket = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / spread * buckets), F.lit(buckets - 1))
        counted = data.join(open_.select("g", "lo", "hi").distinct(), "g").where("v between lo and hi").groupBy("g", "lo", "hi", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("n").over(Window.partitionBy("g", "lo", "hi").orderBy("bucket")) - F.col("n")
        held = open_.join(counted.withColumn("before", before), ["g", "lo", "hi"]).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        found = held.select("g", "name", "up", "part", (F.col("rank") - F.col("before")).alias("rank"), F.col("least").alias("lo"), F.col("most").alias("hi"))
        state = stored(state.where("lo = hi").unionByName(found))
    at = lambda n, up: F.max(F.when((F.col("name") == n) & (F.col("up") == up), F.col("lo")))
    part = lambda n: F.max(F.when(F.col("name") == n, F.col("part")))
    return state.groupBy(F.col("g").alias(by)).agg(*[F.round((1 - part(n)) * at(n, False) + part(n) * at(n, True), digits).alias(n) for n in shares])
