"""Single-source shortest paths over an edge table, with the paths themselves.

Every edge costs 1, so a vertex is settled by the first message that reaches it. The search
therefore only appends: superstep k writes the vertices at k hops and never touches them
again. State lives in tables in the cluster's shared folder, laid out so that a superstep
moves nothing but its messages:

* edges are de-duplicated once and bucketed by source; they are never shuffled again,
* settled vertices are bucketed by id with the same number of buckets and partitioned by
  segment, so the frontier is one pruned partition, already co-located with its edges, and the
  check against settled vertices needs no shuffle of those,
* a level is a segment of its own at first; ``MERGED`` segments of one size are merged into one of the next size, so a
  superstep at depth D reads buckets times log D files, and each vertex is rewritten log D times,
* messages (destination, smallest sender) are combined on the map side before their
  shuffle, so a vertex with a third of all incoming edges costs one row per task.

A source with more than ``hot_degree`` edges is salted: its edges spread over many buckets
and its frontier row is repeated once per salt. E edges have at most E / ``hot_degree`` such sources;
Spark picks the join with them by their measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldtally.workspace import drop_run, new_run_dir, shuffle_partitions, sized_session

HOT_DEGREE = 1_000_000
MERGED = 8  #: settled segments of one size that become one
FIRST_MERGED = 1 << 30
HOT_SCHEMA = "hot_src LONG, salts LONG"
SETTLED_SCHEMA = "id LONG, parent LONG, hops INT"
PATHS_SCHEMA = "id LONG, parent LONG, path ARRAY<LONG>, hops INT"


def vertices(edges: DataFrame) -> DataFrame:
    """All distinct endpoints."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).where(F.col("id").isNotNull()).distinct()


def both_directions(edges: DataFrame) -> DataFrame:
    """Every edge and its reverse, in one scan."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(F.inline(ends))


def seed(all_vertices: DataFrame, source: int) -> DataFrame:
    """Initial state: the source at 0 hops, everything else unreached."""
    is_source = F.col("id") == source
    return all_vertices.select(
        "id", F.when(is_source, F.lit(0)).cast("int").alias("hops"), F.lit(None).cast("long").alias("parent")
    )


def frontier_messages(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One message per vertex the frontier points to, from the smallest sender.

    ``frontier`` has ``id`` and ``hops``, which is the same in all its rows; the result has
    ``dst``, ``hops`` and ``parent``.
    """
    return (
        frontier.join(edges, frontier["id"] == edges["src"])
        .groupBy("dst")
        .agg((F.min("hops") + 1).alias("hops"), F.min("src").alias("parent"))
    )


def unsettled(messages: DataFrame, state: DataFrame) -> DataFrame:
    """Messages to vertices that have no cost yet, as new state rows."""
    settled = state.where(F.col("hops").isNotNull()).select(F.col("id").alias("_settled"))
    return messages.join(settled, messages["dst"] == settled["_settled"], "left_anti").select(
        F.col("dst").alias("id"), "hops", "parent"
    )


def merge_state(state: DataFrame, improved: DataFrame) -> DataFrame:
    """Old and improved state as one: per vertex the row with the fewest hops."""
    best = F.min(F.struct(F.coalesce("hops", F.lit(2**31 - 1)).alias("rank"), "parent", "hops"))
    return (
        state.unionByName(improved)
        .groupBy("id")
        .agg(best.alias("best"))
        .select("id", F.col("best.hops").alias("hops"), F.col("best.parent").alias("parent"))
    )


def hops_histogram(paths: DataFrame) -> DataFrame:
    """Number of vertices per hop count; unreachable vertices count under NULL."""
    return paths.groupBy("hops").agg(F.count(F.lit(1)).alias("vertices"))


@dataclass(frozen=True)
class _Search:
    """Names and layout of one search's tables."""

    spark: SparkSession
    folder: str
    database: str
    buckets: int

    @property
    def edges(self) -> str:
        return f"{self.database}.edges"

    @property
    def hot(self) -> str:
        return f"{self.database}.hot"

    @property
    def settled(self) -> str:
        return f"{self.database}.settled"

    @property
    def settled_path(self) -> str:
        return f"{self.folder}/settled"

    def append_settled(self, rows: DataFrame, hops: int) -> int:
        """Writes one level (id, parent) as a segment and returns the number of its vertices."""
        return self.append_segment(rows.select("id", "parent", F.lit(hops).alias("hops")), hops)

    def append_segment(self, rows: DataFrame, segment: int) -> int:
        """Writes (id, parent, hops) as one segment, a file per bucket, and returns the number of its vertices."""
        level = Observation()
        (
            rows.select("id", "parent", "hops", F.lit(segment).alias("segment"))
            .observe(level, F.count(F.lit(1)).alias("vertices"))
            .write.mode("append")
            .partitionBy("segment")
            .bucketBy(self.buckets, "id")
            .sortBy("id")
            .option("path", self.settled_path)
            .saveAsTable(self.settled)
        )
        return level.get["vertices"]

    def read_segments(self, session: SparkSession, segments: list[int]) -> DataFrame:
        """The rows of finished segments, from their folders."""
        folders = [f"{self.settled_path}/segment={n}" for n in segments]
        return session.read.schema(SETTLED_SCHEMA).parquet(*folders)


@dataclass
class _Segments:
    """Which segments hold the settled vertices, a list per size: a level has its own number, merged ones count from ``FIRST_MERGED`` on.
    Readers use these lists alone, so they see either the old segments of a merge or the new one."""

    work: _Search
    sizes: list[list[int]]
    merged: int = 0

    def live(self) -> list[int]:
        return [n for size in self.sizes for n in size]

    def add(self, level: int) -> None:
        """Adds a level, and merges the oldest ``MERGED`` segments of each size that has more than so many."""
        self.sizes[0].append(level)
        for size in range(len(self.sizes)):
            if len(self.sizes[size]) > MERGED:
                self._merge(size)

    def _merge(self, size: int) -> None:
        old, new = self.sizes[size][:MERGED], FIRST_MERGED + self.merged
        rows = self.work.spark.table(self.work.settled).where(F.col("segment").isin(old))
        self.work.append_segment(rows.repartition(self.work.buckets, "id"), new)  # read by bucket, so this shuffles nothing
        self.merged += 1
        if size + 1 == len(self.sizes):
            self.sizes.append([])
        self.sizes[size + 1].append(new)
        del self.sizes[size][:MERGED]
        for n in old:
            drop_run(self.work.spark, f"{self.work.settled_path}/segment={n}")


def shortest_paths(
    edges: DataFrame,
    source: int,
    max_hops: int | None = None,
    directed: bool = True,
    with_path: bool = True,
    hot_degree: int = HOT_DEGREE,
) -> DataFrame:
    """Fewest hops from ``source`` to every vertex, with parent and path.

    ``edges`` has LONG columns ``src`` and ``dst``. The result has one row per vertex:
    ``id``, ``hops``, ``parent`` and, with ``with_path``, ``path`` (both ends included);
    all NULL where the source does not reach. Of equally short paths the one with the
    smallest parent id is kept, so the result does not depend on the order of rows.

    The search runs when called: a driver loop over Spark jobs that ends when a superstep
    settles nothing. A caller's ``max_hops`` may end it earlier; the column ``complete`` is false
    in every row if vertices were left to expand then, and true otherwise. The driver holds counts
    only. The returned frame reads the settled table, which stays in the shared folder like a
    checkpoint; the edge copy is dropped. Tables have ``spark.sql.shuffle.partitions`` buckets.
    """
    spark = edges.sparkSession
    folder = new_run_dir(spark, "shortest-paths")
    database = "search_" + folder.rsplit("-", 1)[1]
    edges = edges.select("src", "dst")
    usable = _usable(edges if directed else both_directions(edges))
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/work'")
    try:
        everything = _count_vertices(spark, edges, directed, folder, hot_degree)
        buckets = shuffle_partitions(spark)
        # the layout fixes every partition and join partner of a superstep, so there is nothing
        # to adapt while it runs, and each level is spared the planning; a bucket of edges is one sorted file, not sorted again
        session = sized_session(
            spark, buckets, spark__sql__adaptive__enabled="false", spark__sql__sources__bucketing__autoBucketedScan__enabled="false",
            spark__sql__legacy__bucketedTableScan__outputOrdering="true",
        )
        work = _Search(session, folder, database, buckets)
        salted = _store_edges(work, usable)
        depth, complete, segments = _search(work, everything, source, max_hops, salted)
        if depth < 0:
            reached = spark.createDataFrame([], PATHS_SCHEMA)
        else:
            reached = work.read_segments(spark, segments)
            if with_path:
                reached = _build_paths(spark, work, reached, depth)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    columns = ["hops", "parent", "path"] if with_path else ["hops", "parent"]
    return everything.join(reached, "id", "left").select("id", *columns, F.lit(complete).alias("complete"))


def _usable(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))


def _count_vertices(spark: SparkSession, edges: DataFrame, directed: bool, folder: str, hot_degree: int) -> DataFrame:
    """Writes all vertices with the numbers of their usable edges, and from these the sources to salt, in one pass over the edges. Returns the vertices."""
    usable = F.coalesce(F.col("src") != F.col("dst"), F.lit(False)).cast("long")
    incoming = F.lit(0).cast("long") if directed else usable
    ends = F.array(F.struct(F.col("src").alias("id"), usable.alias("n")), F.struct(F.col("dst").alias("id"), incoming.alias("n")))
    counted = edges.select(F.inline(ends)).where(F.col("id").isNotNull()).groupBy("id").agg(F.sum("n").alias("degree"))
    counted.write.parquet(f"{folder}/vertices")
    degrees = spark.read.schema("id LONG, degree LONG").parquet(f"{folder}/vertices")
    _write_hot(degrees.select(F.col("id").alias("src"), "degree"), f"{folder}/hot", hot_degree)
    return spark.read.schema("id LONG").parquet(f"{folder}/vertices")


def _list_hot_sources(edges: DataFrame, path: str, hot_degree: int) -> None:
    """Writes the sources to salt with their numbers of salts."""
    _write_hot(edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")), path, hot_degree)


def _write_hot(degrees: DataFrame, path: str, hot_degree: int) -> None:
    (
        degrees.where(F.col("degree") > hot_degree)
        .select(F.col("src").alias("hot_src"), F.ceil(F.col("degree") / hot_degree).alias("salts"))
        .write.parquet(path)
    )


def _store_edges(work: _Search, edges: DataFrame) -> bool:
    """Writes the bucketed edge table; returns whether some of its sources are salted.

    Where no source has many rows, repeated ones included, rows are de-duplicated in their buckets: one shuffle. Otherwise a source or a single
    edge may have more rows than a task should get, and they are de-duplicated before they are dealt.
    """
    listed = edges.sparkSession.read.schema(HOT_SCHEMA).parquet(f"{work.folder}/hot")
    salted = not listed.isEmpty()
    keys = ["src", "salt"] if salted else ["src"]
    if salted:
        edges = edges.distinct()
        hot = listed.withColumn("salts", F.least("salts", F.lit(work.buckets)).cast("int"))
        hot.write.saveAsTable(work.hot)
        salt = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")
        edges = edges.join(hot, F.col("src") == F.col("hot_src"), "left").select("src", "dst", salt)
    dealt = edges.repartition(work.buckets, *keys)
    dealt = dealt if salted else dealt.distinct()
    dealt.write.bucketBy(work.buckets, *keys).sortBy(*keys).saveAsTable(work.edges)
    return salted


def _search(work: _Search, all_vertices: DataFrame, source: int, max_hops: int | None, salted: bool) -> tuple[int, bool, list[int]]:
    """Appends one level after another; returns the number of the last one with a vertex,
    or -1 when the source is not in the graph, whether nothing was left to expand, and the settled segments."""
    start = all_vertices.where(F.col("id") == source).select("id", F.lit(None).cast("long").alias("parent"))
    active, hops, segments = work.append_settled(start, 0), 0, _Segments(work, [[]])
    while active:
        segments.add(hops)
        if max_hops is not None and hops >= max_hops:
            return hops, False, segments.live()
        active = work.append_settled(_superstep(work, hops, salted, segments.live()), hops + 1)
        hops += 1
    return hops - 1, True, segments.live()


def _superstep(work: _Search, hops: int, salted: bool, segments: Sequence[int] | None = None) -> DataFrame:
    """Vertices first reached from level ``hops``; ``segments`` hold all that is settled (by default all levels so far).

    The one shuffle is that of the messages (with salted sources also that of the frontier).
    """
    live = ", ".join(map(str, range(hops + 1) if segments is None else segments))
    return work.spark.sql(f"""
        SELECT dst AS id, parent
        FROM (SELECT dst, min(src) AS parent FROM ({_edges_of_frontier(work, hops, salted)}) GROUP BY dst)
        LEFT ANTI JOIN (SELECT id FROM {work.settled} WHERE segment IN ({live})) s ON s.id = dst""")


def _edges_of_frontier(work: _Search, hops: int, salted: bool) -> str:
    frontier = f"SELECT id FROM {work.settled} WHERE segment = {hops}"
    same = "e.src = f.id"
    if salted:
        frontier = f"""
            SELECT id, explode(sequence(0, coalesce(salts, 1) - 1)) AS salt
            FROM ({frontier}) LEFT JOIN {work.hot} h ON hot_src = id"""
        same = "e.src = f.id AND e.salt = f.salt"
    return f"SELECT e.src, e.dst FROM ({frontier}) f JOIN {work.edges} e ON {same}"


def _build_paths(spark: SparkSession, work: _Search, settled: DataFrame, depth: int) -> DataFrame:
    """Paths by pointer doubling: log2 of the depth rounds, not one per level.

    Every vertex starts with the piece of its path from below its parent to itself. In a round, each unfinished vertex
    puts the piece of the vertex above in front of its own, which doubles both its length and the distance to the
    vertex above. Those of fewer than ``2 ** k`` hops are finished after k rounds. Each round's pieces are written once to
    the shared folder, the finished ones apart, where the result reads them. The vertex above many others is a hot key with a single row on
    the other side; the caller's session has AQE broadcast that side when small and split the hot partition when not.
    """
    own = ["id", "parent", "path", "hops"]
    open_ones = settled.select("id", "parent", F.array("id").alias("path"), "hops", F.col("parent").alias("above"))
    done, finished, step = open_ones.where("hops = 0").select(own), [], 1
    open_ones = open_ones.where("hops > 0")
    while step <= depth:
        up = done.withColumn("above", F.lit(None).cast("long")).unionByName(open_ones)
        up = up.select(F.col("id").alias("_id"), F.col("path").alias("_path"), F.col("above").alias("_above"))
        longer = open_ones.join(up, F.col("above") == F.col("_id")).select(
            "id", "parent", F.concat("_path", "path").alias("path"), "hops", F.col("_above").alias("above"), (F.col("hops") < 2 * step).alias("done")
        )
        folder = f"{work.folder}/pieces/{step}"
        longer.write.partitionBy("done").parquet(folder)
        finished.append(f"{folder}/done=true")  # some vertex has ``step`` hops
        done = settled.where("hops = 0").select("id", "parent", F.array("id").alias("path"), "hops")
        done = done.unionByName(spark.read.schema(PATHS_SCHEMA).parquet(*finished))
        step *= 2
        if step <= depth:
            open_ones = spark.read.schema(f"{PATHS_SCHEMA}, above LONG").parquet(f"{folder}/done=false")
    return done
