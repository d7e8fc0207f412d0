"""Ordered duplicate decisions: an article duplicates only earlier *accepted* articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.skew import HOT_ROWS, skew_lookup
from broadsheet.session import cut

STORED = "stored"
DUPLICATE = "duplicate"
FAILED = "failed"


def stored_url_keys(stored: DataFrame) -> DataFrame:
    """(lookup, article id) for each stored url and canonical url.

    One equi-join key column replaces ``url = ? OR canonical_url = ?``, which would otherwise
    be a nested loop.
    """
    return (
        stored.select(F.explode(F.array_distinct(F.array("url", "canonical_url"))).alias("lookup"), "id")
        .filter(F.col("lookup").isNotNull())
    )


def _wanted(keys: DataFrame, batch: DataFrame, lookup: str, name: str) -> DataFrame:
    """Smallest stored id per key, for the keys of the batch only.

    The batch has one row per key, so the semi join comes first: a small batch is broadcast by adaptive execution and the
    stored keys are pruned before anything of theirs is shuffled.
    """
    return keys.join(batch.select(lookup), lookup, "left_semi").groupBy(lookup).agg(F.min("id").alias(name))


def dedup_by_url(incoming: DataFrame, stored: DataFrame | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Exact decision when neither hashes nor canonical urls are set (both built-in providers).

    Adds status, duplicate_of and duplicate_reason. Needs seq, article_id, url. The first
    arrival per url comes from a partial ``min``; wide rows are shuffled once.
    """
    table = incoming.groupBy(F.col("url").alias("lookup")).agg(
        F.min(F.struct("seq", "article_id")).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    if stored is None:
        table = table.withColumn("_stored", F.lit(None).cast("string"))
    else:
        table = table.join(_wanted(stored_url_keys(stored), table, "lookup", "_stored"), "lookup", "left")
    found = skew_lookup(incoming, F.col("url"), F.col("article_id"), table, "lookup", "_n", hot_rows)
    accepted = F.col("_stored").isNull() & (F.col("_first.seq") == F.col("seq"))
    return found.select(
        *incoming.columns,
        F.when(accepted, STORED).otherwise(DUPLICATE).alias("status"),
        F.when(~accepted, F.coalesce("_stored", "_first.article_id")).alias("duplicate_of"),
        F.when(~accepted, "url").alias("duplicate_reason"),
    )


# Key kinds. A row *provides* the keys a later row may collide with and *probes* its own.
_PROBES = (("u", "url"), ("h", "content_hash"), ("c", "canonical_url"), ("i", "article_id"))
_PROVIDES = (("u", "url"), ("u", "canonical_url"), *_PROBES[1:])


def _keys(pairs: tuple) -> Column:
    tagged = F.array(*[F.concat(F.lit(kind + "|"), F.col(name)) for kind, name in pairs])
    return F.array_distinct(F.filter(tagged, lambda k: k.isNotNull()))


def _collisions(undecided: DataFrame, accepted: DataFrame | None, pending: bool, hot_rows: int) -> DataFrame:
    """For each undecided row and key kind: the smallest accepted and undecided providers.

    Adds columns new_<kind> (struct seq, id) and, when ``pending``, wait_<kind> (seq).
    """
    entry = lambda key, acc, wait, last, n: (key.alias("key"), acc.alias("acc"), wait.alias("wait"), last.alias("last"), n.alias("n"))
    seq_type = undecided.schema["seq"].dataType.simpleString()
    id_type = f"struct<seq: {seq_type}, article_id: string>"
    no_acc, no_wait, none, one = F.lit(None).cast(id_type), F.lit(None).cast(seq_type), F.lit(0), F.lit(1)
    sides = [undecided.select("seq", F.explode(_keys(_PROBES)).alias("k")).select(*entry(F.col("k"), no_acc, no_wait, F.col("seq"), one))]
    if pending:
        sides.append(
            undecided.filter(~F.col("unfit"))
            .select("seq", F.explode(_keys(_PROVIDES)).alias("k"))
            .select(*entry(F.col("k"), no_acc, F.col("seq"), no_wait, none))
        )
    if accepted is not None:
        sides.append(
            accepted.select("seq", "article_id", F.explode(_keys(_PROVIDES)).alias("k")).select(
                *entry(F.col("k"), F.struct("seq", "article_id").cast(id_type), no_wait, no_wait, none)
            )
        )
    table = (
        reduce(DataFrame.unionByName, sides)
        .groupBy("key")
        .agg(F.min("acc").alias("acc"), F.min("wait").alias("wait"), F.max("last").alias("last"), F.sum("n").alias("n"))
        # A key says something only to rows after its first provider; keys of one row drop out here.
        .filter(F.coalesce(F.col("acc.seq") < F.col("last"), F.lit(False)) | F.coalesce(F.col("wait") < F.col("last"), F.lit(False)))
    )
    # Written, since the search for hot keys and the lookup both read it.
    table = cut(table.select("key", "acc", "wait", "n"), "dedup-keys")
    # Only the row number and one key travel; what was found comes back to the row once.
    probes = undecided.select("seq", F.explode(_keys(_PROBES)).alias("k"))
    if table.filter(F.col("n") >= hot_rows).isEmpty():
        found = probes.join(table.drop("n"), F.col("k") == F.col("key"))
    else:
        spread = F.concat_ws("|", F.col("seq").cast("string"), "k")
        found = skew_lookup(probes, F.col("k"), spread, table, "key", "n", hot_rows).filter(F.col("acc").isNotNull() | F.col("wait").isNotNull())
    kind = F.substring("k", 1, 1)
    per_row = found.groupBy("seq").agg(
        *[F.min(F.when(kind == k, F.col("acc"))).alias(f"new_{k}") for k, _ in _PROBES],
        *[F.min(F.when(kind == k, F.col("wait"))).alias(f"wait_{k}") for k, _ in _PROBES],
    )
    return undecided.join(per_row, "seq", "left")


def dedup_ordered(
    incoming: DataFrame, stored: DataFrame | None = None, hot_rows: int = HOT_ROWS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The general decision over url, content hash, canonical url and id, in ``seq`` order.

    Input: seq (unique; a non-negative number or a non-empty text), article_id, url, canonical_url, content_hash, and
    ``unfit`` for rows that will fail for their own content (they can be duplicates but
    provide nothing). Returns seq, status, duplicate_of, duplicate_reason, and the columns of ``carry`` as given.

    Works in rounds. A row is decided as soon as no undecided earlier row can change its
    outcome, so the number of rounds follows the length of collision chains, not the number
    of rows. Each round is a written table: it cuts the lineage and survives lost executors.
    Stored articles are consulted once, before the first round; rows whose url they hold are duplicates at once.
    """
    names = ["seq", "article_id", "url", "canonical_url", "content_hash", "unfit"]
    names += [c for c in carry if c not in names]
    result = ["seq", "status", "duplicate_of", "duplicate_reason", *[c for c in carry if c != "seq"]]
    start = incoming.select(*names)
    seq_type = start.schema["seq"].dataType.simpleString()
    before_all = F.lit("" if seq_type == "string" else -1).cast(seq_type)
    best = [f"best_{k}" for k, _ in _PROBES]
    decided = []
    if stored is None or stored.isEmpty():
        undecided = cut(start.select(
            "*", *[F.lit(None).cast(f"struct<seq: {seq_type}, article_id: string>").alias(b) for b in best]
        ), "dedup-start")
    else:
        past = stored.select(
            before_all.alias("seq"), F.col("id").alias("article_id"), "url", "canonical_url",
            "content_hash",
        )
        first = _collisions(cut(start, "dedup-in"), past, False, hot_rows)
        known = cut(first.select(*names, *[F.col(f"new_{k}").alias(f"best_{k}") for k, _ in _PROBES]), "dedup-start")
        by_past = known.filter(F.col("best_u").isNotNull()).select(
            "*", F.lit(DUPLICATE).alias("status"), F.col("best_u.article_id").alias("duplicate_of"), F.lit("url").alias("duplicate_reason")
        )
        decided.append(by_past.select(*result))
        undecided = known.filter(F.col("best_u").isNull())
        if undecided.isEmpty():
            return decided[0]
    accepted = None
    while True:
        round_ = _collisions(undecided, accepted, True, hot_rows)
        for kind, _ in _PROBES:
            round_ = round_.withColumn(f"best_{kind}", F.least(f"best_{kind}", f"new_{kind}"))
        earlier = {k: F.coalesce(F.col(f"best_{k}.seq") < F.col("seq"), F.lit(False)) for k, _ in _PROBES}
        waits = {k: F.coalesce(F.col(f"wait_{k}") < F.col("seq"), F.lit(False)) for k, _ in _PROBES}
        status = (
            F.when(earlier["u"], DUPLICATE)
            .when(~waits["u"] & earlier["h"], DUPLICATE)
            .when(~waits["u"] & ~waits["h"] & (F.col("unfit") | earlier["c"] | earlier["i"]), FAILED)
            .when(~waits["u"] & ~waits["h"] & ~waits["c"] & ~waits["i"], STORED)
        )
        by_url = earlier["u"]
        outcome = cut(
            round_.select(
                *names, *best, status.alias("status"),
                F.when(status == DUPLICATE, F.when(by_url, F.col("best_u.article_id")).otherwise(F.col("best_h.article_id"))).alias("duplicate_of"),
                F.when(status == DUPLICATE, F.when(by_url, "url").otherwise("content_hash")).alias("duplicate_reason"),
            ),
            "dedup-round",
        )
        decided.append(
            outcome.filter(F.col("status").isNotNull()).select(*result)
        )
        undecided = outcome.filter(F.col("status").isNull()).select(*names, *best)
        accepted = outcome.filter(F.col("status") == STORED).select(*names[:5])
        if undecided.isEmpty():
            return reduce(DataFrame.unionByName, decided)


def hash_hits(incoming: DataFrame, stored: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stored article with the same content hash, per incoming row; null hashes never match."""
    counts = incoming.filter(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.count("*").alias("n"))
    found = _wanted(stored.select("content_hash", "id"), counts, "content_hash", "existing_id")
    table = found.join(counts, "content_hash").select(F.col("content_hash").alias("lookup"), "existing_id", "n")
    return skew_lookup(incoming, F.col("content_hash"), F.col("article_id"), table, "lookup", "n", hot_rows)


def url_hits(incoming: DataFrame, stored: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stored article whose url or canonical url equals the incoming url."""
    counts = incoming.groupBy(F.col("url").alias("lookup")).agg(F.count("*").alias("n"))
    table = _wanted(stored_url_keys(stored), counts, "lookup", "existing_id").join(counts, "lookup")
    return skew_lookup(incoming, F.col("url"), F.col("article_id"), table, "lookup", "n", hot_rows)
