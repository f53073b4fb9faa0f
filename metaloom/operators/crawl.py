"""Walks over captured links and redirects, level by level."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from metaloom.functions import urls
from metaloom.functions.bind import shuffled
from metaloom.operators.ordering import with_sequence
from metaloom.session import cut_and_measure, ensure_checkpoint_dir, written

# A page with more than one of so many of all links is kept in parts.
HUB_SHARE = 64
# Tables of visited pages at most.
TIERS = 4
# Rows of a hash table in one task at most, some 40 MB; above, a walk sorts.
HASHED_ROWS = 1_000_000


def new_links(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct links that were not visited; both have a column `url`."""
    return links.select("url").distinct().join(visited.select("url").distinct(), "url", "left_anti")


def crawl(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = None,
    domains: list[str] | None = None,
) -> DataFrame:
    """Breadth-first walk: every reachable url once, with its depth (seeds 0).

    `edges` has src, dst and, if the order of discovery matters, pos; then the result has `path`, the link
    positions that lead to a page, which sort as a first-in-first-out queue would visit; `crawl_queue` gives the place
    itself without paths. With `domains`, links to other hosts are not followed. A page without captured links ends the
    walk there.
    """
    return _walk(_followed(edges, domains), seeds, max_depth, "path" if "pos" in edges.columns else None)


def crawl_queue(
    edges: DataFrame, seeds: DataFrame, max_depth: int | None = None, domains: list[str] | None = None
) -> DataFrame:
    """The walk as a first-in-first-out queue visits it: url, depth and `place` from 1.

    A page is ordered by the place of the page that leads to it first and the position of that link there, two numbers,
    however deep the walk is. Links of one page at equal positions go by url; seeds too.
    """
    return _walk(_followed(edges, domains), seeds, max_depth, "place")


def _followed(edges: DataFrame, domains: list[str] | None) -> DataFrame:
    links = edges.select("src", "dst", *(["pos"] if "pos" in edges.columns else []))
    return links.filter(urls.in_domains(F.col("dst"), domains)) if domains else links


class _Buckets:
    """Tables of one walk, bucketed in the shared folder, so that joins on their keys move nothing of them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.names = spark, []
        # Fewer buckets than shuffle partitions, and the planner would shuffle the table again.
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/walk-{uuid.uuid4().hex}"

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(self.count, *keys)

    def write(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows should be dealt by their keys, by `dealt` or a join with another table: else a bucket gets many files."""
        name = f"metaloom_{uuid.uuid4().hex}"
        df.write.bucketBy(self.count, *keys).option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def together(self, names: list[str]) -> DataFrame:
        """The rows of tables of one schema as plain files: the planner takes a union of bucketed tables for bucketed, which it is not."""
        paths = [f"{self.folder}/{name}" for name in names]
        return self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*paths)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


class _Names:
    """Pages as numbers of eight bytes while a walk lasts: integers as they are, texts by a hash that no two of them share."""

    def __init__(self, links: DataFrame, seeds: DataFrame, tables: _Buckets, by_name: bool) -> None:
        types = {df.schema[c].dataType.simpleString() for df, c in ((links, "src"), (links, "dst"), (seeds, "url"))}
        self.type = seeds.select("url").union(links.select("dst")).schema["url"].dataType
        self.whole = types <= {"tinyint", "smallint", "int", "bigint"}
        # An order that ends on names needs them at every level.
        self.hashed = types == {"string"} and not by_name
        if self.hashed:
            pages = links.select(F.explode(F.array("src", "dst")).alias("url")).unionByName(seeds.select("url"))
            pages = pages.filter("url is not null").distinct()
            self.attempt, clash = -1, True
            while clash:
                self.attempt += 1
                named = pages.select(self.number("url").alias("_id"), F.col("url").alias("_name"))
                self.table = tables.write(tables.dealt(named, "_id"), "_id")
                clash = self.table.groupBy("_id").count().filter("count > 1").limit(1).count()

    @property
    def narrow(self) -> bool:
        return self.whole or self.hashed

    def number(self, page: str) -> Column:
        if self.whole:
            return F.col(page).cast("long")
        if self.hashed:
            return F.when(F.col(page).isNotNull(), _hash(F.col(page), self.attempt))
        return F.col(page) if page == "src" else F.col(page).cast(self.type)

    def back(self, walked: DataFrame) -> DataFrame:
        if self.hashed:
            rest = [c for c in walked.columns if c != "url"]
            joined = walked.join(shuffled(self.table), F.col("url") == F.col("_id"), "left")
            return joined.select(F.col("_name").alias("url"), *rest)
        return walked.withColumn("url", F.col("url").cast(self.type))


def _hash(page: Column, attempt: int) -> Column:
    return F.xxhash64(page, F.lit(attempt))


def _hubs(links: DataFrame, total: int) -> list[tuple]:
    """Pages with more than one of `HUB_SHARE` of all links, at most so many, and in how many parts each is kept."""
    counts = links.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HUB_SHARE > total)
    return [(r["src"], -(-r["n"] * HUB_SHARE // total)) for r in counts.collect()]


class _Visited:
    """Pages met so far, in few tables: when there are more than `TIERS`, the last ones of about one size become one."""

    def __init__(self, tables: _Buckets, hint: str) -> None:
        self.tables, self.hint, self.tiers = tables, hint, []

    def add(self, n: int) -> None:
        """The table written last, of `n` rows."""
        self.tiers.append((n, self.tables.names[-1]))
        if len(self.tiers) > TIERS:
            n, names = 0, []
            while self.tiers and (len(names) < 2 or self.tiers[-1][0] <= 2 * n):
                m, name = self.tiers.pop()
                n, names = n + m, [name, *names]
            self.tables.write(self.tables.dealt(self.tables.together(names), "url"), "url")
            self.tiers.append((n, self.tables.names[-1]))

    def without(self, reached: DataFrame) -> DataFrame:
        # The planner pushes an anti join below the join that made the rows, onto all links; an outer join stays in its place.
        for _, name in self.tiers:
            met = self.tables.spark.table(name).select(F.col("url").alias("_url"), F.lit(True).alias("_met"))
            # What was reached is the side that is hashed: visited pages stream past it.
            reached = reached.hint(self.hint).join(met, F.col("url") == F.col("_url"), "left")
            reached = reached.filter("_met is null").drop("_url", "_met")
        return reached

    def rows(self) -> DataFrame:
        return self.tables.together([name for _, name in self.tiers])


def _walk(
    links: DataFrame, seeds: DataFrame, max_depth: int | None, order: str | None = None, leaves: bool = False
) -> DataFrame:
    """Breadth-first levels over tables bucketed by key; with `leaves` a column `leaf`: no link leaves the page.

    The links are written once, bucketed by page; a page with very many links lies in several parts by a salt. Visited pages are
    bucketed by url. A level moves only its frontier, to the parts of its links, and what it reaches, to the urls'
    buckets: no exchange stands above links or visited pages. Links and visited pages are read at each level, as numbers that
    stream past hash tables of the frontier and of what it reaches, so nothing of them is sorted.
    """
    spark = links.sparkSession
    tables = _Buckets(spark)
    links, seeds = written(links), written(seeds.select("url").distinct())
    names = _Names(links, seeds, tables, order == "place")
    links = links.withColumns({"src": names.number("src"), "dst": names.number("dst")})
    n_links = links.count()
    # A hash table cannot spill: its rows have a fixed width, and a task gets a bounded number of them, frontier or reached.
    hashes = names.narrow and order != "path" and n_links <= tables.count * HASHED_ROWS
    hint = "shuffle_hash" if hashes else "merge"
    hubs = _hubs(links, n_links)
    if hubs:
        src = links.schema["src"].dataType.simpleString()
        # A share of all links bounds the number of hubs: at most HUB_SHARE rows.
        parts = F.broadcast(written(spark.createDataFrame(hubs, f"_hub {src}, _parts long").coalesce(1)))
        salted = links.join(parts, F.col("src") == F.col("_hub"), "left")
        salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("dst"), "_parts")).otherwise(F.lit(0)).cast("int")
        links = salted.withColumn("salt", salt).drop("_hub", "_parts")
    keys = ["src", "salt"] if hubs else ["src"]
    stored = tables.write(tables.dealt(links, *keys), *keys)

    start = seeds.select(names.number("url").alias("url"), F.lit(0).alias("depth"))
    if order == "path":
        path = F.array_append(F.array(F.lit(0)), F.col("pos"))
        start = start.withColumn("path", F.array(F.lit(0)).cast(links.select(path.alias("path")).schema["path"].dataType))
    elif order:
        start = _placed(start.withColumn("_key", F.struct("url")), 0)
    visited = _Visited(tables, hint)
    frontier = tables.write(tables.dealt(start, "url"), "url")
    n = frontier.count()
    visited.add(n)
    total, depth = n, 0
    while n and (max_depth is None or depth < max_depth):
        depth += 1
        near = frontier.select(F.col("url").alias("src"), *([order] if order else []))
        if hubs:
            near = near.join(parts, F.col("src") == F.col("_hub"), "left")
            copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)).cast("int") - 1)
            near = near.withColumn("salt", F.explode(copies)).drop("_hub", "_parts")
        onward = stored.join(near.hint(hint), keys).withColumnRenamed("dst", "url")
        if order == "path":
            reached = onward.groupBy("url").agg(F.min(F.array_append("path", F.col("pos"))).alias("path"))
        elif order:
            reached = onward.groupBy("url").agg(F.min(F.struct("place", "pos")).alias("_lead"))
        else:
            reached = onward.select("url").distinct()
        fresh = visited.without(reached).withColumn("depth", F.lit(depth))
        if order == "place":
            placed = _placed(fresh.select("url", "depth", F.struct("_lead", "url").alias("_key")), total)
            fresh = tables.dealt(placed, "url")
        seen = Observation()
        frontier = tables.write(fresh.observe(seen, F.count(F.lit(1)).alias("n")), "url")
        n = seen.get["n"]
        total += n
        if n:
            visited.add(n)
    out = visited.rows()
    if leaves:
        inner = stored.select(F.col("src").alias("_src")).distinct()
        out = out.join(shuffled(inner), F.col("url") == F.col("_src"), "left")
        out = out.withColumn("leaf", F.col("_src").isNull()).drop("_src")
    out = written(names.back(out))
    tables.drop()
    return out


def _placed(level: DataFrame, before: int) -> DataFrame:
    """Number the pages of a level in the order of `_key`, after the `before` pages of earlier levels."""
    numbered = with_sequence(level, "_key", "place").drop("_key")
    return numbered.withColumn("place", F.col("place") + before)


def visit_order(walked: DataFrame) -> DataFrame:
    """The walk in queue order."""
    return walked.orderBy("depth", "path", "url")


def catalogue_walk(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Everything below the root catalogues, with depth and whether it is a leaf page.

    `edges` has parent_id and child_id. Depth 1 is what a flat reading of a catalogue gives.
    """
    pairs = edges.select(F.col("parent_id").alias("src"), F.col("child_id").alias("dst"))
    return _walk(pairs, roots, max_depth, leaves=True).select("url", "depth", "leaf")


def sitemap_of_walk(walked: DataFrame) -> DataFrame:
    """The pages of a walk as sitemap entries."""
    return walked.select(F.col("url").alias("loc")).distinct()


def final_targets(redirects: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Where redirect chains with a 303 in them end: from_id, final_id, hops.

    `redirects` has one row per address: from_id, to_id, status. Chains are followed by pointer doubling: every round
    joins each open chain to the chain of its current end, so the number of rounds is the logarithm of the longest
    chain. A chain of any length closes some of its part in every round, so when a round closes nothing, only loops
    are left, and these have no final address. With `max_hops`, longer chains are left out as well.
    """
    hops = redirects.filter(F.col("to_id").isNotNull() & F.col("status").between(300, 399))
    still_open = F.count_if(~F.col("done"))
    state, seen = cut_and_measure(
        hops.select(
            "from_id",
            F.col("to_id").alias("final_id"),
            F.lit(1).cast("long").alias("hops"),
            (F.col("status") == 303).alias("seen"),
            F.lit(False).alias("done"),
        ),
        open=still_open,
    )
    last = None
    while seen["open"] and seen["open"] != last:
        last = seen["open"]
        after = state.select(
            F.col("from_id").alias("_from"),
            F.col("final_id").alias("_final"),
            F.col("hops").alias("_hops"),
            F.col("seen").alias("_seen"),
            F.col("done").alias("_done"),
        )
        open_chains = state.filter(~F.col("done"))
        moved = open_chains.join(shuffled(after), F.col("final_id") == F.col("_from"), "left").select(
            "from_id",
            F.coalesce("_final", "final_id").alias("final_id"),
            (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            (F.col("seen") | F.coalesce("_seen", F.lit(False))).alias("seen"),
            F.coalesce("_done", F.lit(True)).alias("done"),
        )
        state, seen = cut_and_measure(state.filter("done").unionByName(moved), open=still_open)
    ended = state.filter(F.col("done") & F.col("seen"))
    if max_hops is not None:
        ended = ended.filter(F.col("hops") <= max_hops)
    return ended.select("from_id", "final_id", "hops")
