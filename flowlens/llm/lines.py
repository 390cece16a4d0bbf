"""Line dedup over levelled sorted runs of line hashes.

Lines are hashed once into a narrow table. Batches of ascending ids pass through a ``LineRuns``
store: each batch reduces its own keys, meets the sorted, bucketed runs of earlier batches in merge
joins, and adds the keys that none of them has as a run of its own. Runs of one level are compacted into
one run of the next, bucket by bucket, without a shuffle. The lines of a batch are marked in one join
with its repeated keys. Texts move once, when each document meets the list of its dropped lines.

A store in a folder of its own outlives the call and the session: a later call goes on with its runs.

A frequent line is pre-aggregated before the shuffle; in the join that marks lines, its rows can be
split, as the other side has one row per key.

Defined cases: null and empty texts are one empty line; a null id counts as an id below all others;
rows with the same id are one document, each row with its own result; other columns are ignored.
With a store, a line stays with the document that first had it, also if a later call brings a smaller
id, and a document that is given again keeps what it kept before. Keys are compared by two independent
64-bit hashes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.text import BLANKS, lower_ascii
from flowlens.plans.small import small_table
from flowlens.plans.staging import fresh_path, stage

MIN_KEY_CHARS = 10
#: Fewest batches of a call, and most documents in one of more.
BATCHES, BATCH_DOCS = 4, 20_000_000
FAN_IN = 2
_KEY = ["h1", "h2"]
_LOWEST = -(2**63)
_STATE = "version long, level int, place int, path string, buckets int, fan_in int"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class LineRuns:
    """Sorted runs ``(h1, h2, owner)`` by level; ``owner`` is the id that keeps the line.

    With a ``folder`` the runs last: ``save`` commits them in one job as the newest version, and
    ``LineRuns.open`` goes on with it. What was not saved is as if it had not been. Without a folder
    ``close`` deletes all files.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int = FAN_IN, folder: str | None = None):
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.lasting, self.folder = folder is not None, folder or fresh_path(spark, "runs")
        self.levels: list[list[str]] = []
        self._paths: dict[str, str] = {}
        self._merged_away: list[str] = []
        self._version = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineRuns:
        """The store that was saved in ``folder``."""
        state = spark.read.schema(_STATE).parquet(f"{folder}/state")
        newest = state.agg(F.max("version")).first()[0]
        # As many rows as there are runs.
        rows = state.where(F.col("version") == newest).orderBy("level", "place").collect()
        store = cls(spark, rows[0].buckets, rows[0].fan_in, folder)
        store._version = newest
        for row in rows:
            store.levels += [[] for _ in range(row.level + 1 - len(store.levels))]
            store.levels[row.level].append(store._register(row.path))
        return store

    def _register(self, path: str) -> str:
        name = f"flowlens_run_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, owner BIGINT) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        self._paths[name] = path
        return name

    def save(self) -> None:
        """Commit the runs as the newest version; the files of runs that were merged away go."""
        if not self.lasting or not self.runs():
            return
        self._version += 1
        rows = [
            (self._version, level, place, self._paths[name], self.buckets, self.fan_in)
            for level, names in enumerate(self.levels)
            for place, name in enumerate(names)
        ]
        small_table(self.spark, rows, _STATE).coalesce(1).write.mode("append").parquet(f"{self.folder}/state")
        for path in self._merged_away:
            _delete(self.spark, path)
        self._merged_away = []

    def _write(self, rows: DataFrame) -> str:
        """A run of rows that are already placed by their keys."""
        name, path = f"flowlens_run_{uuid.uuid4().hex}", f"{self.folder}/run-{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY)
        writer.option("path", path).saveAsTable(name)
        self._paths[name] = path
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Rows of ``lines`` (h1, h2, ord, ...) whose line another document keeps; new keys become a run.

        Within a batch the smallest id keeps a line, so ids of a later batch should be above earlier ones.
        """
        keys = lines.groupBy(*_KEY).agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
        keys = keys.withColumn("known", F.lit(None).cast("long"))
        for name in self.runs():
            run = self.spark.table(name)
            keys = keys.join(run, _KEY, "left")
            keys = keys.select(*_KEY, "first", "last", F.coalesce("known", "owner").alias("known"))
        keys = stage(keys, "keys")
        owner = F.coalesce("known", "first").alias("owner")
        repeated = keys.select(*_KEY, "first", "last", owner).where("first <> owner OR last <> owner")
        marked = lines.join(repeated.select(*_KEY, "owner"), _KEY).where("ord <> owner").drop("owner")
        marked = stage(marked, "marked")
        fresh = keys.where("known IS NULL").select(*_KEY, F.col("first").alias("owner"))
        self._push(0, self._write(fresh.repartition(self.buckets, *_KEY)))
        return marked

    def merged(self, names: list[str]) -> DataFrame:
        """One run of several without a key in common: their buckets are merged in place."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("owner", "other")
            rows = rows.join(other, _KEY, "full").select(*_KEY, F.coalesce("owner", "other").alias("owner"))
        return rows

    def _push(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            compacted = self._write(self.merged(self.levels[level]))
            for part in self.levels[level]:
                self.spark.sql(f"DROP TABLE {part}")
                path = self._paths.pop(part)
                if self.lasting:  # the saved version may still name it
                    self._merged_away.append(path)
                else:
                    _delete(self.spark, path)
            self.levels[level] = []
            self._push(level + 1, compacted)

    def close(self) -> None:
        for name in self.runs():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels, self._paths = [], {}
        if not self.lasting:
            _delete(self.spark, self.folder)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    exploded = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(_LOWEST)).alias("ord"),
        F.xxhash64("text").alias("row"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    keyed = exploded.select("ord", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "ord", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_KEY_CHARS,
    batches: int | None = None,
    fan_in: int = FAN_IN,
    carry: tuple[str, ...] = (),
    store: LineRuns | None = None,
) -> DataFrame:
    """Every document with ``n_lines``, ``n_dropped`` and the remaining lines as ``kept_text``.

    ``carry`` names further columns that stay with the documents. ``store`` holds the runs of earlier
    calls; the new ones are saved in it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", *[F.col(c).alias(f"carried_{c}") for c in carry])
    carried = [F.col(f"carried_{c}") for c in carry]
    batches = batches or max(BATCHES, -(-docs.count() // BATCH_DOCS))
    quantiles = [i / batches for i in range(1, batches)]
    cuts = docs.select(F.percentile_approx("doc_id", quantiles, 10_000).alias("q")).first()["q"] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("ord") > cut).cast("int")
    path = fresh_path(spark, "lines")
    _lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = "ord long, row long, pos int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(path)
    runs = store or LineRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in)
    marked = None
    for number in range(len(cuts) + 1):
        found = runs.add(lines.where(F.col("batch") == number).drop("batch"))
        marked = found if marked is None else marked.unionByName(found)
    if store is None:
        runs.close()
    else:
        runs.save()
    _delete(spark, path)  # what is marked is written
    dropped = marked.groupBy("ord", "row").agg(F.collect_set("pos").alias("dropped"))
    keyed = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("doc_id"), F.lit(_LOWEST)).alias("ord"),
        F.xxhash64("text").alias("row"),
        *carried,
    )
    joined = keyed.join(dropped, ["ord", "row"], "left")
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    split = joined.select("doc_id", "text", "dropped", F.size(parts).alias("n_lines"), *carried)
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("dropped"))
    kept_lines = F.transform(F.array(F.split(F.col("text"), "\n")), lambda p: F.transform(kept, lambda i: F.get(p, i)))[0]
    return split.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce(F.col("text"), F.lit("")))
        .otherwise(F.array_join(kept_lines, "\n"))
        .alias("kept_text"),
        *[column.alias(name) for column, name in zip(carried, carry)],
    )
