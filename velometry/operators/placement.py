"""Where to put new stations: clusters of slow short taxi trips."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.functions import kmeans
from velometry.functions.geo import CITY, Box, in_bbox
from velometry.functions.sampling import drawn
from velometry.sources.writers import cut_lineage

# The names under which the three sizes are published.
LABELS = {"ten": 10, "fif": 50, "hun": 100}

PICKUP = ("pickup_latitude", "pickup_longitude")
DROPOFF = ("dropoff_latitude", "dropoff_longitude")


def in_city(trips: DataFrame, box: Box = CITY, max_miles: float = 10.0) -> DataFrame:
    """Trips below ``max_miles`` whose pickup lies inside ``box``."""
    return trips.filter((F.col("trip_distance") < max_miles) & in_bbox(*PICKUP, box))


def clean(trips: DataFrame, box: Box = CITY, max_miles: float = 10.0) -> DataFrame:
    """``in_city`` without rows that hold any null."""
    return in_city(trips, box, max_miles).na.drop("any")


def _points(df: DataFrame, lat: str, lon: str) -> DataFrame:
    assembler = VectorAssembler(inputCols=[lat, lon], outputCol="features")
    return assembler.transform(df.select(lat, lon)).select("features")


def _fit(points: DataFrame, k: int) -> KMeansModel:
    return KMeans(k=k, seed=1).fit(points)


def recommend_stations(
    trips: DataFrame, ks: Iterable[int] = (10, 50, 100), steady: bool = False
) -> DataFrame:
    """Cluster centres of the pickups for each ``k``: the places for new stations.

    Two columns are computed once, and every fit reads those.
    The centres are a fit's own result, at most ``k`` of them.  A centre at
    (0, 0) stands for missing coordinates and is left out.  Spark's fit also depends on
    how the trips are partitioned; with ``steady`` centres depend on the trips alone
    and are numbered from south to north, for some more jobs.
    """
    if steady:
        found = cut_lineage(kmeans.places(trips, *PICKUP))
        fits = {k: kmeans.fit(found, k) for k in ks}
    else:
        points = cut_lineage(_points(trips, *PICKUP))
        fits = {k: _fit(points, k).clusterCenters() for k in ks}
    rows = [
        (k, i, float(lat), float(lon))
        for k, found in fits.items()
        for i, (lat, lon) in enumerate(found)
    ]
    centres = trips.sparkSession.createDataFrame(
        rows, "k int, cluster_id int, latitude double, longitude double"
    )
    return centres.filter((F.col("latitude") != 0.0) | (F.col("longitude") != 0.0))


def centres_as_list(recommended: DataFrame) -> DataFrame:
    """Per ``k`` one nested list of ``[latitude, longitude]``, by cluster id."""
    point = F.struct("cluster_id", F.array("latitude", "longitude").alias("point"))
    return recommended.groupBy("k").agg(F.sort_array(F.collect_list(point))["point"].alias("centres"))


def assign_clusters(
    df: DataFrame,
    lat: str,
    lon: str,
    k: int = 10,
    out: str = "cluster",
    cut: bool = True,
    steady: bool = False,
) -> DataFrame:
    """``df`` with the cluster of each row's point in column ``out``.

    ``df`` is read by the fit and again by the result, so it is kept, unless
    ``cut`` is off because it comes from a table anyway.  ``steady`` is as in
    ``recommend_stations``; then a point without two numbers is in no cluster.
    """
    df = cut_lineage(df) if cut else df
    if steady:
        centres = kmeans.fit(cut_lineage(kmeans.places(df, lat, lon)), k)
        if not centres:
            return df.withColumn(out, F.lit(None).cast("int"))
        number = kmeans.nearest(F.col(lat), F.col(lon), centres)
        known = ~F.isnan(lat) & ~F.isnan(lon) & F.col(lat).isNotNull() & F.col(lon).isNotNull()
        return df.withColumn(out, F.when(known, number))
    model = _fit(_points(df, lat, lon), k).setPredictionCol(out)
    assembler = VectorAssembler(inputCols=[lat, lon], outputCol="features")
    return model.transform(assembler.transform(df)).drop("features")


def assign_pickups(df: DataFrame, k: int = 10, cut: bool = True) -> DataFrame:
    """Add ``pickup_cluster``."""
    return assign_clusters(df, *PICKUP, k, "pickup_cluster", cut)


def assign_dropoffs(df: DataFrame, k: int = 10) -> DataFrame:
    """Add ``dropoff_cluster`` on top of ``assign_pickups``, from whose kept rows it reads."""
    return assign_clusters(df, *DROPOFF, k, "dropoff_cluster", cut=False)


def cluster_sample(
    assigned: DataFrame, lat: str, fraction: float = 0.1, seed: int = 1
) -> DataFrame:
    """A share of the assigned trips for a plot, without zero latitudes.

    The share is exact, before the zeros go; a seeded hash of the trip draws it, so
    that cluster numbers and the order of rows do not matter.
    """
    columns = [c for c in assigned.columns if not c.endswith("_cluster")]
    sample = drawn(assigned, fraction, seed, columns, "__drawn").filter("__drawn")
    return sample.drop("__drawn").filter(F.col(lat) != 0.0)
