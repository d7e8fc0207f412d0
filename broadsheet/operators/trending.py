"""Ranking scores that keep their order as time passes, and Top-10 lists over a sliding window.

An article's points in a region are a weighted sum: freshness (full when published), relevance there, credibility of its
source, engagement and breaking news. They halve every ``HALF_LIFE_HOURS``. Two articles lose the same share in the same
time, so their order never changes, and what is stored is the logarithm with the decay taken forward to the time of publication:
``log2(points) + hours from the landmark / half life``. A later reader needs no other article and no recomputation: the value at any
time is ``2 ** (stored - hours then / half life)`` (from the same landmark).

``TopLists`` keeps the best ``SIZE`` articles of every region and hour of publication. A batch merges its own best with those of
the hours it brings, whatever else is stored. The list over a window is the best of the lists of its hours, so entries leave as
their hours do and no history is counted again. Lists go to the snapshot table through ``rankings.replace_top_ten_at``.

Null scores count as zero; rows without article, region or time of publication are no candidates. An article sent again keeps its higher score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed
from broadsheet.operators import rankings
from broadsheet.operators.serving import top_per_group
from broadsheet.session import cut

# Points of each part at its best.
POINTS = {"freshness": 35.0, "relevance": 30.0, "credibility": 20.0, "engagement": 10.0, "breaking": 5.0}
HALF_LIFE_HOURS = 12.0
# Hours are counted from here (2026-01-01), so that stored scores are small numbers of full precision.
LANDMARK_HOURS = 490_896
SIZE = fixed.TOP_TEN
CANDIDATES = "scope string, code string, article_id string, published_at timestamp, log_score double, hour bigint, day date"
SNAPSHOTS = "state_code string, ranking_date date, ranking_window string, category_filter string, article_id string, rank_position smallint, ranking_score decimal(12,4)"


def parts(relevance: Column, credibility: Column, engagement: Column, breaking: Column) -> Column:
    """Points of every part as a map: relevance and engagement from 0 to 1, credibility in percent, breaking a boolean."""
    share = {
        "freshness": F.lit(1.0), "relevance": relevance.cast("double"), "credibility": credibility.cast("double") / 100,
        "engagement": engagement.cast("double"), "breaking": breaking.cast("double"),
    }
    within = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(c, F.lit(0.0))))
    return F.create_map(*[x for name, points in POINTS.items() for x in (F.lit(name), F.lit(points) * within(share[name]))])


def total_points(points: Column) -> Column:
    # In the order of the parts, so that equal parts give equal sums.
    return sum((points[name] for name in list(POINTS)[1:]), points["freshness"])


def hours(time: Column) -> Column:
    return F.unix_micros(time) / 3.6e9


def log_score(points: Column, published_at: Column) -> Column:
    """What is stored: the order of scores at every time."""
    return F.round(F.log2(total_points(points)) + (hours(published_at) - LANDMARK_HOURS) / HALF_LIFE_HOURS, 6)


def score_at(stored: Column, time: Column) -> Column:
    """Points left at ``time``; null where the value is too large for its column, which only articles of a later time (ten days and more) reach."""
    return F.round(F.pow(F.lit(2.0), stored - (hours(time) - LANDMARK_HOURS) / HALF_LIFE_HOURS), 4).try_cast("decimal(12,4)")


def candidates(scored: DataFrame) -> DataFrame:
    """Rows (scope, code, article_id, published_at, log_score) with hour and day of publication; the best of each region and hour."""
    whole = scored.dropna(subset=["scope", "code", "article_id", "published_at", "log_score"])
    once = whole.groupBy("scope", "code", "article_id").agg(F.max(F.struct("log_score", "published_at")).alias("b")).select(
        "scope", "code", "article_id", "b.published_at", "b.log_score"
    )
    dated = once.withColumn("hour", F.floor(hours(F.col("published_at")))).withColumn("day", F.to_date("published_at"))
    return best(dated, ["scope", "code", "hour"], "kept").drop("kept")


def best(rows: DataFrame, group: list[str], rank: str) -> DataFrame:
    return top_per_group(rows, group, [F.col("log_score").desc(), F.col("article_id")], SIZE, rank)


class TopLists:
    """Stored best articles per region and hour, in a folder partitioned by day."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def create(self) -> None:
        self.spark.createDataFrame([], CANDIDATES).write.mode("overwrite").partitionBy("day").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(CANDIDATES).parquet(self.path)

    def merge(self, scored: DataFrame) -> None:
        """Add a batch: only the days that it publishes in are read and rewritten. A rerun changes nothing."""
        fresh = cut(candidates(scored), "candidates")
        days = fresh.select(F.col("day").alias("_day")).distinct()
        stored = self.rows()
        near = stored.join(days, stored["day"] == days["_day"], "left_semi")
        merged = cut(candidates(near.drop("hour", "day").unionByName(fresh.drop("hour", "day"))), "merged")
        columns = [f.split()[0] for f in CANDIDATES.split(", ")]
        merged.select(*columns).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

    def window(self, until: Column, window_hours: int) -> DataFrame:
        """The lists over the ``window_hours`` before the hour ``until`` (a timestamp, cut to its hour)."""
        end = F.floor(hours(until))
        from_day = F.to_date(until - F.make_dt_interval(hours=F.lit(window_hours)))
        inside = self.rows().filter((F.col("day") >= from_day) & (F.col("day") <= F.to_date(until)))
        inside = inside.filter((F.col("hour") >= end - window_hours) & (F.col("hour") < end))
        return best(inside, ["scope", "code"], "rank_position")


def publish(lists: TopLists, scope: str, path: str, until: str, window_hours: int = 24, category: str = "all") -> None:
    """Replace the snapshots of the date of ``until`` (a time, cut to its hour) for one scope; regions without entries lose theirs.

    ``path`` is a table of SNAPSHOTS partitioned by ranking_date, one per scope."""
    spark = lists.spark
    at = F.lit(until).cast("timestamp")
    window, date = f"{window_hours}h", F.to_date(at)
    fresh = cut(lists.window(at, window_hours).filter(F.col("scope") == scope).select(
        F.col("code").alias("state_code"), date.alias("ranking_date"), F.lit(window).alias("ranking_window"), F.lit(category).alias("category_filter"),
        "article_id", F.col("rank_position").cast("smallint").alias("rank_position"), score_at(F.col("log_score"), F.date_trunc("hour", at)).alias("ranking_score"),
    ), "snapshots")
    stored = spark.read.schema(SNAPSHOTS).parquet(path)
    before = stored.filter((F.col("ranking_date") == date) & (F.col("ranking_window") == window) & (F.col("category_filter") == category))
    touched = fresh.select(*rankings.SNAPSHOT).unionByName(before.select(*rankings.SNAPSHOT))
    rankings.replace_top_ten_at(path, stored.schema, touched, fresh)


def create_snapshots(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], SNAPSHOTS).write.mode("overwrite").partitionBy("ranking_date").parquet(path)
