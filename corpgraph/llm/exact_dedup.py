"""Exact deduplication by a log-structured merge index of text digests.

1. Every row goes to a log: identifier and SHA-256 of the normalised text.
2. Memtables (the log's parts) are flushed to sorted runs of level 0, one entry a
   digest: smallest and largest identifier, and count. Each run has a blocked Bloom filter.
3. ``FANOUT`` runs of a level are compacted to one of the next. An entry that counts
   one row and that no other run's filter passes moves as it is; only the others are
   shuffled and merged: smallest and largest identifier, sum of counts.
4. Digests with two rows or more are hits. Their texts are compared byte by byte;
   should texts differ under one digest, that digest is split by whole text.

The index is a folder. Later batches are added to it as new runs, and looked up
behind the runs' filters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.llm import bloom
from corpgraph.llm.work import WorkArea, delete, left_join

#: Hits of at most so many digests are broadcast (about 40 bytes each) to fetch their texts; more are joined by shuffle.
BROADCAST_HITS = 500_000
#: Filters of at most so many blocks (a row of some 150 bytes for the runs of a group) are broadcast; larger ones are joined by shuffle.
BROADCAST_BLOCKS = 1 << 18
#: Rows of a memtable, and runs of a level that are compacted to one of the next.
MEMTABLE_ROWS, FANOUT = 16_000_000, 4


def normalise(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def merged(entries: DataFrame, *by: str) -> DataFrame:
    """Entries of any number of runs, one a digest."""
    return entries.groupBy(*by, "digest").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("copies").alias("copies"))


ENTRIES, FILTERS = "run long, digest binary, first long, last long, copies long", "run long, block long, w0 long, w1 long, w2 long, w3 long"


@dataclass(frozen=True)
class Run:
    number: int
    born: int  # version that wrote it
    level: int
    entries: int
    blocks: int


class MergeIndex:
    """The index in folder ``path``: sorted runs, their filters, and a manifest that names the runs that count.

    A manifest is a new folder for each version, written after the runs that it names:
    a job that fails half-way leaves the version before. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.version, self.runs = spark, path, 0, []
        try:
            known = spark.read.parquet(f"{path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        self.version = known.agg(F.max("version").alias("v")).first().v
        rows = known.where((F.col("version") == self.version) & (F.col("number") >= 0)).collect()
        self.runs = [Run(r.number, r.born, r.level, r.entries, r.blocks) for r in sorted(rows, key=lambda r: r.number)]

    def _publish(self, runs: list[Run]) -> None:
        rows = [F.struct(*[F.lit(v).cast("long").alias(k) for k, v in vars(r).items()]) for r in runs or [Run(-1, 0, 0, 0, 0)]]
        self.spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*").coalesce(1).write.parquet(f"{self.path}/manifest/version={self.version + 1}")
        self.version, self.runs = self.version + 1, sorted(runs, key=lambda r: r.number)

    def _read(self, kind: str, schema: str, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.range(0).selectExpr(*[f"CAST(null AS {kind}) AS {name}" for name, kind in (c.split() for c in schema.split(", "))])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/v{r.born}/number={r.number}" for r in runs])

    def entries(self, runs: list[Run] | None = None) -> DataFrame:
        """Entries of all runs (or of some): run, digest, first, last, copies."""
        return self._read("runs", ENTRIES, self.runs if runs is None else runs)

    def _write(self, entries: DataFrame, levels: dict[int, int]) -> list[Run]:
        """Sorted runs and their filters from ``entries`` (with their run), in one job each; ``levels``: the level of each run."""
        born = self.version + 1
        entries.select(F.col("run").alias("number"), *[c.split()[0] for c in ENTRIES.split(", ")]).sortWithinPartitions("number", "digest").write.mode("overwrite").partitionBy("number").parquet(f"{self.path}/runs/v{born}")
        made = self.spark.read.schema(ENTRIES).parquet(f"{self.path}/runs/v{born}")
        sizes = {r.run: r["count"] for r in made.groupBy("run").count().collect()}
        # Runs that are written together have filters of one size.
        blocks = bloom.block_count(max(sizes.values(), default=1))
        bits = bloom.build(made, "digest", blocks, "run")
        bits.withColumn("number", F.col("run")).write.mode("overwrite").partitionBy("number").parquet(f"{self.path}/filters/v{born}")
        return [Run(k, born, levels[k], n, blocks) for k, n in sorted(sizes.items())]

    def add(self, log: DataFrame, memtables: int = 1) -> None:
        """Flushes a batch (doc_id, digest, and memtable from 0 where there are several) to runs of level 0."""
        at = 1 + max((r.number for r in self.runs), default=-1)
        run = F.lit(at).cast("long") if memtables == 1 else F.col("memtable") + F.lit(at).cast("long")
        flushed = log.groupBy(run.alias("run"), "digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("copies"))
        self._publish(self.runs + self._write(flushed, {at + k: 0 for k in range(memtables)}))

    def _suspects(self, digests: DataFrame, groups: list[list[Run]]) -> DataFrame:
        """``digests`` (run, group, digest, copies) with maybe: they count several rows, or the filter of another run of the group passes them.

        A group's filters are laid side by side, smaller ones repeated to the size of
        the largest, so that one look at one block answers for all runs.
        """
        runs = [r for g in groups for r in g]
        most, width = max(r.blocks for r in runs), max(map(len, groups))
        place = {r.number: (k, slot, r.blocks) for k, g in enumerate(groups) for slot, r in enumerate(g)}
        lookup = F.create_map(*[x for n, (k, slot, size) in place.items() for x in (F.lit(n).cast("long"), F.struct(F.lit(k).alias("group"), F.lit(slot).alias("slot"), F.lit(size).cast("long").alias("size")))])
        bits = self._read("filters", FILTERS, runs).withColumn("p", lookup[F.col("run")])
        wide = bits.select("p.*", "block", *bloom.WORDS).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), (F.lit(most) / F.col("size")).cast("long") - 1))).withColumn("block", F.col("block") + F.col("k") * F.col("size"))
        wide = wide.groupBy("group", "block").agg(*[F.max(F.when(F.col("slot") == i, F.col(w))).alias(f"{w}_{i}") for i in range(width) for w in bloom.WORDS])
        keyed = digests.withColumn("block", bloom.block_of(F.col("digest"), most)).withColumn("own", lookup[F.col("run")]["slot"])
        joined = keyed.join(F.broadcast(wide) if most * len(groups) <= BROADCAST_BLOCKS else wide, ["group", "block"], "left")
        maybe = F.col("copies") > 1
        for i in range(width):
            passed = F.lit(True)
            for mask, w in zip(bloom.masks(F.col("digest")), bloom.WORDS, strict=True):
                passed = passed & (F.col(f"{w}_{i}").bitwiseAND(mask) == mask)
            maybe = maybe | ((F.coalesce("own", F.lit(-1)) != i) & F.coalesce(passed, F.lit(False)))
        return joined.select("run", "group", *[c for c in digests.columns if c not in ("run", "group")], maybe.alias("maybe"))

    def compact(self, whole: bool = False) -> None:
        """Merges every ``FANOUT`` runs of a level to one of the next, as long as a level has so many; with ``whole`` until one run is left."""
        while True:
            levels: dict[int, list[Run]] = {}
            for r in self.runs:
                levels.setdefault(r.level, []).append(r)
            full = next((k for k, rs in sorted(levels.items()) if len(rs) >= FANOUT), None)
            if full is not None:
                groups = [levels[full][i : i + FANOUT] for i in range(0, len(levels[full]) // FANOUT * FANOUT, FANOUT)]
            elif whole and len(self.runs) > 1:
                groups = [sorted(self.runs, key=lambda r: r.level)[:FANOUT]]
            else:
                return
            old = [r for g in groups for r in g]
            at = 1 + max(r.number for r in self.runs)
            group = F.create_map(*[x for k, g in enumerate(groups) for r in g for x in (F.lit(r.number).cast("long"), F.lit(k))])
            flagged = self._suspects(self.entries(old).withColumn("group", group[F.col("run")]), groups)
            moved = flagged.where("not maybe").select("group", "digest", "first", "last", "copies")
            both = moved.unionByName(merged(flagged.where("maybe"), "group")).withColumn("run", F.col("group") + F.lit(at).cast("long"))
            made = self._write(both, {at + k: 1 + max(r.level for r in g) for k, g in enumerate(groups)})
            self._publish([r for r in self.runs if r not in old] + made)
            for r in old:
                delete(self.spark, f"{self.path}/runs/v{r.born}/number={r.number}")
                delete(self.spark, f"{self.path}/filters/v{r.born}/number={r.number}")

    def look_up(self, digests: DataFrame) -> DataFrame:
        """digest, first, last, copies of those of ``digests`` (digest) that the index has; only what a filter passes meets the entries."""
        if not self.runs:
            return self.entries().drop("run")
        asked = digests.select(F.lit(-1).cast("long").alias("run"), F.lit(0).alias("group"), "digest", F.lit(1).cast("long").alias("copies"))
        maybe = self._suspects(asked, [self.runs]).where("maybe").select("digest").distinct()
        return merged(self.entries().join(maybe, "digest", "left_semi"))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest=sha256) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when ``normalise(text)`` is the same; ``keep`` ("smallest" or
    "largest") says which doc_id of equal rows stays. ``digest`` may be any function
    of the normalised text; a weak one only costs time, as hits are verified.

    Null texts count as empty, and empty texts are equal to each other. Null ids
    take part in group sizes, but stay only where a group has no other id; then
    keep_id is null. Any long is an id. Rows that repeat both id and text are the same
    document: each of them carries the same answer. Empty tables give no rows. Other
    columns are not read, whatever their names. A group may hold any share of the
    rows: its entries are merged before they are shuffled, and the rows of the largest
    groups get their answer by broadcast.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    spark, stays = docs.sparkSession, "first" if keep == "smallest" else "last"
    area = WorkArea(spark, "exact-dedup")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalise(F.col(text_col)).alias("norm"))

    log = area.save(texts.select("doc_id", digest(F.col("norm")).alias("digest"), F.spark_partition_id().alias("part")), "log")
    total = log.count()
    memtables = max(FANOUT, -(-total // MEMTABLE_ROWS))
    index = MergeIndex(spark, f"{area.path}/index")
    index.add(log.withColumn("memtable", F.pmod("part", F.lit(memtables))), memtables)
    index.compact(whole=True)

    hits = area.save(index.entries().where("copies > 1").select("digest", "first", "last", "copies"), "hits")
    found = hits.count()
    keys = hits.select("digest")
    of_hits = texts.withColumn("digest", digest(F.col("norm"))).join(F.broadcast(keys) if found <= BROADCAST_HITS else keys, "digest", "left_semi")
    verified = area.save(of_hits.groupBy("digest").agg((F.min("norm") != F.max("norm")).alias("differ")).where("differ").select("digest"), "collisions")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    if digest is sha256 and verified.isEmpty():
        answers = hits.select("digest", F.col(stays).alias("keep_id"), "copies", F.lit(True).alias("hit"), F.col("copies").alias("weight"))
        rows = left_join(log.select("doc_id", "digest"), answers, ["digest"], "weight", total)
        rows = rows.withColumn("keep_id", F.when(F.col("hit"), F.col("keep_id")).otherwise(F.col("doc_id")))
        return rows.select("doc_id", "keep_id", F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    # Some digest stands for two texts (or isn't SHA-256): those groups are keyed by the texts themselves.
    keyed = texts.withColumn("digest", digest(F.col("norm"))).join(verified.withColumn("split", F.lit(True)), "digest", "left").withColumn("part", F.coalesce(F.when(F.col("split"), F.col("norm")), F.lit("")))
    groups = keyed.groupBy("digest", "part").agg((F.min if keep == "smallest" else F.max)("doc_id").alias("keep_id"), F.count("*").alias("copies")).withColumn("weight", F.col("copies"))
    rows = keyed.select("doc_id", "digest", "part", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"))
    return left_join(rows, groups, ["digest", "part"], "weight", total).select("doc_id", "keep_id", F.col("copies").alias("group_size"), kept.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay.

    Rows go by id and text, so another text under a dropped row's id stays, and a row
    with a null id goes where an equal text has an id. Rows that repeat id and text of
    a kept row stay too, as do all rows of a group without any id.
    """
    gone = exact_groups(docs, id_col=id_col, text_col=text_col, keep=keep).where("not kept")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_text")).distinct()
    # The keys are columns of their own: as expressions of the join they would be hashed again in every comparison of the sort.
    names, key = docs.columns, max(docs.columns, key=len)
    keyed = docs.withColumn(f"{key}_id", docs[id_col].cast("long")).withColumn(f"{key}_sha", sha256(normalise(docs[text_col])))
    same = keyed[f"`{key}_id`"].eqNullSafe(gone["gone_id"]) & (keyed[f"`{key}_sha`"] == gone["gone_text"])
    return keyed.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in names])
