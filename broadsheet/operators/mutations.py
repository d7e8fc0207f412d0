"""Table changes as DataFrames: upserts, replacements, get-or-create, cascades.

Every function takes the stored table and a change set and returns the new content (or the
affected rows). :func:`overwrite` puts the result back without reading and writing one folder
at the same time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from broadsheet import fixed
from broadsheet.functions import text
from broadsheet.session import cut


def overwrite(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Replace a table, or only the partitions present in ``df`` when it is partitioned."""
    staged = cut(df, "overwrite")
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def replace_partitions(path: str, touched: DataFrame, fresh: DataFrame, keys: list[str]) -> None:
    """Replace the touched groups of a table partitioned by ``keys``; the others are neither read nor written.

    Groups with fresh rows are overwritten; touched groups without any are deleted with their folders. The
    folders to delete are names of partitions, not rows.
    """
    spark = touched.sparkSession
    groups = cut(touched.select(*keys).distinct(), "touched")
    staged = cut(fresh.join(groups, keys, "left_semi"), "fresh")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    names = [F.col(k).cast("string").alias(k) for k in keys]
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for row in groups.join(staged.select(*keys).distinct(), keys, "left_anti").select(*names).toLocalIterator():
        folder = root("/".join([path, *[escape(k, row[k]) for k in keys]]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def replace_groups_at(path: str, schema: StructType, touched: DataFrame, fresh: DataFrame, keys: list[str], partition: str) -> None:
    """As :func:`replace_groups`, on a table partitioned by one of the keys.

    Only partitions of touched groups are read and written, each with the groups of its that stay; one that ends up
    empty is deleted. Partitions are as many as days, say, not as groups.
    """
    spark = touched.sparkSession
    groups = cut(touched.select(*keys).distinct(), "touched")
    parts = groups.select(F.col(partition).alias("_part")).distinct()
    stored = spark.read.schema(schema).parquet(path)
    kept = stored.join(parts, stored[partition] == parts["_part"], "left_semi").join(groups, keys, "left_anti")
    staged = cut(kept.unionByName(fresh.join(groups, keys, "left_semi").select(*stored.columns)), "fresh")
    # A partition is one set of files, whatever the number of tasks that hold its rows.
    staged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    left = staged.select(F.col(partition).alias("_left")).distinct()
    emptied = parts.join(left, F.col("_part") == F.col("_left"), "left_anti").select(F.col("_part").cast("string"))
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for row in emptied.toLocalIterator():
        folder = root(f"{path}/{partition}={row[0]}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_last(stored: DataFrame, changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Upsert where the change with the highest ``version`` wins over earlier ones and the table.

    Of changes with one version the one with the largest values wins, so reruns agree. ``max_by`` combines on the map side: a key changed a million times moves one row per task.
    """
    values = [c for c in stored.columns if c not in keys]
    tagged = stored.select(*keys, F.struct(*values).alias("row"), F.lit(None).cast("bigint").alias("version"))
    newer = changes.select(*keys, F.struct(*values).alias("row"), F.col(version).cast("bigint").alias("version"))
    merged = tagged.unionByName(newer).groupBy(*keys).agg(
        F.max_by("row", F.struct(F.coalesce("version", F.lit(-(1 << 62))), F.to_json("row"))).alias("row")
    )
    return merged.select(*[f"row.{c}" if c in values else c for c in stored.columns])


def upsert_country_links(stored: DataFrame, changes: DataFrame, version: str = "version") -> DataFrame:
    return upsert_last(stored, changes, ["article_id", "country_code"], version)


def upsert_state_links(stored: DataFrame, changes: DataFrame, version: str = "version") -> DataFrame:
    return upsert_last(stored, changes, ["article_id", "state_code"], version)


def apply_enrichment(articles: DataFrame, results: DataFrame) -> DataFrame:
    """Replace the AI fields of matched articles, also where the new value is null.

    ``results`` has one row per article id: summary, sentiment, keywords, share_caption,
    social_card_data. An absent card is stored as an empty one.
    """
    fields = ["summary", "sentiment", "keywords", "share_caption", "social_card_data"]
    new = results.select(F.col("article_id").alias("_id"), F.struct(*fields).alias("_new"))
    joined = articles.join(new, F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    changed = {f: F.when(hit, F.col(f"_new.{f}")).otherwise(F.col(f)) for f in fields}
    changed["ai_processed"] = hit | F.col("ai_processed")
    return joined.select(*[changed[c].alias(c) if c in changed else c for c in articles.columns])


def unmatched_enrichment(articles: DataFrame, results: DataFrame) -> DataFrame:
    """Enrichment rows whose article does not exist (the update reports not matched)."""
    return results.join(articles.select(F.col("id").alias("article_id")), "article_id", "left_anti")


def replace_groups(stored: DataFrame, touched: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Drop all stored rows of the touched keys, add the fresh ones; empty groups stay deleted."""
    kept = stored.join(touched.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(fresh.select(*stored.columns))


def favorite_country_error(codes: Column) -> Column:
    """Why a list of favourite countries is refused: size, repeats or shape."""
    clean = F.transform(codes, lambda c: F.upper(text.strip(c)))
    return (
        F.when(F.size(clean) > fixed.MAX_FAVORITE_COUNTRIES, "too_many_countries")
        .when(F.size(F.array_distinct(clean)) != F.size(clean), "repeated_country")
        .when(~F.forall(clean, lambda c: c.rlike(r"^\p{L}{2}$")), "country_code_invalid")
    )


def favorite_country_rows(changes: DataFrame) -> DataFrame:
    """(user_id, country_code, priority) from ordered code lists; priority is the list position."""
    return changes.select(
        "user_id", F.posexplode(F.transform("country_codes", lambda c: F.upper(text.strip(c)))).alias("pos", "country_code")
    ).select("user_id", "country_code", (F.col("pos") + 1).cast("smallint").alias("priority"))


def replace_favorite_countries(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace the lists of the users in ``changes``; refused lists change nothing."""
    valid = changes.filter(favorite_country_error(F.col("country_codes")).isNull())
    return replace_groups(stored, valid, favorite_country_rows(valid), ["user_id"])


def add_missing(stored: DataFrame, additions: DataFrame, keys: list[str]) -> DataFrame:
    """Insert rows whose key is not present; repeats in the additions collapse."""
    fresh = additions.select(*keys).distinct().join(stored.select(*keys), keys, "left_anti")
    return stored.unionByName(fresh.select(*stored.columns))


def remove(stored: DataFrame, deletions: DataFrame, keys: list[str]) -> DataFrame:
    return stored.join(deletions.select(*keys).distinct(), keys, "left_anti")


def removal_report(stored: DataFrame, deletions: DataFrame, keys: list[str]) -> DataFrame:
    """Each requested deletion with whether a row was removed."""
    present = stored.select(*keys).distinct().withColumn("_present", F.lit(True))
    return (
        deletions.select(*keys).distinct().join(present, keys, "left")
        .select(*keys, F.coalesce("_present", F.lit(False)).alias("removed"))
    )


def email_key(c: Column) -> Column:
    return F.lower(text.strip(c))


def get_or_create_users(users: DataFrame, requests: DataFrame) -> DataFrame:
    """(email, id, display_name, created) per distinct non-blank e-mail; the first request wins.

    ``requests`` needs seq, email, display_name.
    """
    wanted = requests.withColumn("email", email_key(F.col("email"))).filter(F.col("email") != "")
    first = wanted.groupBy("email").agg(F.min_by(F.struct("display_name"), "seq").alias("f"))
    known = users.select("email", F.col("id").alias("_id"), F.col("display_name").alias("_name"))
    joined = first.join(known, "email", "left")
    return joined.select(
        "email",
        F.coalesce("_id", F.sha2(F.col("email"), 256)).alias("id"),
        F.when(F.col("_id").isNotNull(), F.col("_name")).otherwise(F.col("f.display_name")).alias("display_name"),
        F.col("_id").isNull().alias("created"),
    )


def get_or_create_sources(sources: DataFrame, requests: DataFrame) -> DataFrame:
    """Existing sources unchanged plus one new row per unseen (name, source_type), first wins."""
    values = [c for c in sources.columns if c not in ("id", "name", "source_type")]
    first = requests.groupBy("name", "source_type").agg(F.min_by(F.struct(*values), "seq").alias("row"))
    created = first.join(sources.select("name", "source_type"), ["name", "source_type"], "left_anti").select(
        F.sha2(F.concat_ws("|", "name", "source_type"), 256).alias("id"), "name", "source_type", "row.*"
    )
    return sources.unionByName(created)


def upsert_regions(stored: DataFrame, catalog: DataFrame, now: Column) -> DataFrame:
    """Idempotent catalogue load: catalogue values win, creation times stay."""
    values = [c for c in catalog.columns if c != "code"]
    old = stored.select("code", F.struct(*[c for c in stored.columns if c != "code"]).alias("_old"))
    new = catalog.select("code", F.struct(*values).alias("_new"))
    merged = old.join(new, "code", "full")
    hit = F.col("_new").isNotNull()
    columns = []
    for c in stored.columns:
        if c == "code":
            columns.append(F.col("code"))
        elif c == "updated_at":
            columns.append(F.when(hit, now).otherwise(F.col("_old.updated_at")).alias(c))
        elif c == "created_at":
            columns.append(F.coalesce("_old.created_at", now).alias(c))
        elif c in values:
            columns.append(F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
        else:
            columns.append(F.col(f"_old.{c}").alias(c))
    return merged.select(*columns)


def cascade_articles(children: DataFrame, deleted: DataFrame) -> DataFrame:
    """Child rows (links, labels, rankings) left after articles are deleted."""
    return children.join(deleted.select("article_id").distinct(), "article_id", "left_anti")


def restricted_sources(articles: DataFrame, deletions: DataFrame) -> DataFrame:
    """Source deletions refused because articles still use the source."""
    used = articles.select("source_id").distinct()  # combined per task: a large publisher is one row each
    return deletions.join(used, "source_id", "left_semi")
