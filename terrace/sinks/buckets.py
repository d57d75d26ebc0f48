"""A keyed layer to which a run adds the rows of its batch and nothing else.

The layer lies in hash buckets of its key. A run stores its batch as a delta, split by bucket, and
a manifest that lists for every bucket the folders it consists of: a base and the deltas since.
Reading a bucket that has deltas combines its rows: the newest of each key by recency, a later
run's row if they tie, or the sum of the `sums` columns for a layer of counts. Once a bucket has
more than `fold_after` deltas, or deltas of more than `FOLD_SHARE` of its base, the run that makes
it so folds it into a new base. So the bytes a merge writes follow its batch, and what is read
stays within a constant of the layer. Earlier runs stay readable as their folders are never
changed.

A bucket that outgrows `bucket_bytes` is split in two, four, ... when it is folded, so the number
of buckets follows the bytes. A removed key leaves a mark, so that an older record that comes later
does not bring it back; a fold drops marks that are `keep_marks` runs old, and a record older than
such a mark would be taken again.

Base files are sorted by key and have Bloom filters on it, for lookups of few keys.

The driver holds the manifest, at most `fold_after` + 1 rows a bucket.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from terrace.operators.changes import row_changes, row_history
from terrace.operators.dedupe import latest_per_key
from terrace.session import exists, get_record, get_records, put_record, remove, scratch_dir, setting, stored_bytes

BUCKET, OF, GONE, RUN = "_bucket", "_of", "_gone", "_run"
BASE, DELTA, EMPTY = "base", "delta", "empty"
ENTRY = Row("bucket", "of", "kind", "held_by", "n", "bytes")
RUN_ROW = Row("run_id", "number", "previous")
FOLD_SHARE = 0.5
# More would make the pushed filter too deep for its readers.
PROBED_KEYS = 200
MOST_DOUBLINGS = 4
# Smaller buckets would be mostly footers and filters.
LEAST_ROWS = 1_000
Slot = tuple[int, int]


def _doublings(size: int, most: int) -> int:
    """How often a bucket of `size` bytes must be halved to have at most `most`."""
    return max(0, math.ceil(math.log2(max(1, size) / most)))


class StaleBaseError(ValueError):
    """The merge would leave out runs that the layer has."""


@dataclass(frozen=True)
class Merge:
    """What a merge did: its run, the one it lies on, and the (of, bucket) slots that its batch
    touched and those of them that were folded."""

    run_id: str
    previous: str | None
    touched: Sequence[Slot]
    folded: Sequence[Slot]


@dataclass(frozen=True)
class BucketLayer:
    """A layer at `root` with unique `keys`. `recency` says which of two rows of a key is newer;
    with `sums` the layer adds these columns up instead and keeps the largest of the others."""

    root: str
    schema: StructType
    keys: tuple[str, ...]
    recency: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    bucket_bytes: int = 256 * 1024 * 1024
    fold_after: int = 8
    keep_marks: int = 30

    # --- runs and manifests -----------------------------------------------------------

    def runs(self, spark: SparkSession) -> list[Row]:
        """The finished merges, oldest first."""
        return sorted((RUN_ROW(*r) for r in get_records(spark, f"{self.root}/runs")), key=lambda r: (r.number, r.run_id))

    def entries(self, spark: SparkSession, run_id: str) -> list[Row]:
        return [ENTRY(*e) for e in get_record(spark, f"{self.root}/manifest/{run_id}.json")]

    def _base_run(self, runs: list[Row], run_id: str, previous: str | None, fresh: bool, branch: bool) -> str | None:
        known = [r.run_id for r in runs]
        if run_id in known:
            raise ValueError(f"run {run_id} is merged already; a run id is used once")
        if fresh:
            if previous is not None:
                raise ValueError("a fresh layer has no previous run")
            return None
        if previous is None:
            return known[-1] if known else None
        if previous not in known:
            raise StaleBaseError(f"there is no run {previous}")
        later = [r.run_id for r in runs if r.previous == previous]
        if later and not branch:
            raise StaleBaseError(f"run {later[-1]} lies on {previous} already; name the newest run or ask for a branch")
        return previous

    # --- rows and slots ---------------------------------------------------------------

    @property
    def _marked(self) -> StructType:
        return StructType([*self.schema.fields, StructField(GONE, BooleanType()), StructField(RUN, IntegerType())])

    def _combined(self, rows: DataFrame) -> DataFrame:
        if not self.sums:
            return latest_per_key(rows, self.keys, [*self.recency, RUN], ())
        added = [F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.sums]
        others = [F.max(c).alias(c) for c in self.schema.names if c not in self.keys and c not in self.sums]
        return rows.groupBy(*self.keys).agg(*added, *others, F.max(GONE).alias(GONE), F.max(RUN).alias(RUN)).select(*self._marked.names)

    def _live(self, rows: DataFrame) -> DataFrame:
        if not self.sums:
            return rows.filter(~F.col(GONE))
        some = F.lit(False)
        for name in self.sums:
            some = some | (F.col(name) != 0)
        return rows.filter(some)

    def _placed(self, rows: DataFrame, slots: dict[Slot, int]) -> DataFrame:
        """The rows with the slot they belong to, given for each slot the number of buckets to
        count in: its own, or more to split it."""
        key = F.xxhash64(*self.keys)
        place = lambda of: F.pmod(key, of.cast("long")).cast("int")
        if len({*slots.values()} | {of for of, _ in slots}) == 1:
            of = F.lit(next(iter(slots.values())))
            return rows.withColumns({OF: of, BUCKET: place(of)})
        # Buckets of several widths: a row belongs to one of them, whichever that is.
        listed = rows.sparkSession.createDataFrame([(of, b, new) for (of, b), new in slots.items()], "_at_of int, _at int, _new int")
        widths = F.explode(F.array(*[F.lit(of) for of in sorted({of for of, _ in slots})]))
        rows = rows.withColumn("_at_of", widths).withColumn("_at", place(F.col("_at_of")))
        met = rows.join(listed, ["_at_of", "_at"])
        return met.withColumns({OF: F.col("_new"), BUCKET: place(F.col("_new"))}).drop("_at_of", "_at", "_new")

    def _paths(self, entries: Iterable[Row]) -> list[str]:
        return [f"{self.root}/{e.kind}/run_id={e.held_by}/{OF}={e.of}/{BUCKET}={e.bucket}" for e in entries if e.kind != EMPTY]

    def _scan(self, spark: SparkSession, entries: Iterable[Row]) -> DataFrame:
        paths = sorted(self._paths(entries))
        if not paths:
            return spark.createDataFrame([], self._marked)
        return spark.read.schema(self._marked).parquet(*paths)

    def _store(self, rows: DataFrame, kind: str, run_id: str) -> list[tuple]:
        """Writes placed rows; returns the manifest rows of what was written."""
        spark, path = rows.sparkSession, f"{self.root}/{kind}/run_id={run_id}"
        ordered = rows.hint("rebalance", OF, BUCKET).sortWithinPartitions(OF, BUCKET, *self.keys)
        writer = ordered.write.option("compression", "snappy").partitionBy(OF, BUCKET)
        if kind == BASE:
            for key in self.keys:
                writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(path)
        places = StructType([StructField(OF, IntegerType()), StructField(BUCKET, IntegerType())])
        found = spark.read.schema(places).parquet(path).groupBy(OF, BUCKET).count().collect()  # one row a bucket
        size, total = stored_bytes(spark, path), sum(r["count"] for r in found)
        return [(r[BUCKET], r[OF], kind, run_id, r["count"], size * r["count"] // max(total, 1)) for r in found]

    # --- reading ----------------------------------------------------------------------

    def _resolved(self, spark: SparkSession, entries: Iterable[Row]) -> DataFrame:
        """One row a key, marks included. Only buckets with deltas are shuffled."""
        by_slot = defaultdict(list)
        for entry in entries:
            if entry.kind != EMPTY:
                by_slot[entry.of, entry.bucket].append(entry)
        plain = [e for own in by_slot.values() if len(own) == 1 for e in own]
        mixed = [e for own in by_slot.values() if len(own) > 1 for e in own]
        rows = self._scan(spark, plain)
        return rows.unionByName(self._combined(self._scan(spark, mixed))) if mixed else rows

    def read(self, spark: SparkSession, run_id: str | None = None) -> DataFrame:
        """The whole layer as of a run, the newest by default."""
        run_id = run_id or next((r.run_id for r in reversed(self.runs(spark))), None)
        if run_id is None:
            return spark.createDataFrame([], self.schema)
        return self._live(self._resolved(spark, self.entries(spark, run_id))).select(*self.schema.names)

    def delta(self, spark: SparkSession, run_id: str) -> DataFrame:
        """The rows that a run brought, with their marks."""
        for kind in (DELTA, BASE):
            path = f"{self.root}/{kind}/run_id={run_id}"
            if exists(spark, path):
                return spark.read.schema(self._marked).option("recursiveFileLookup", True).parquet(path)
        return spark.createDataFrame([], self._marked)

    def lookup(self, spark: SparkSession, run_id: str | None, wanted: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows of the `wanted` keys as of a run, with their marks, stored. Only buckets that
        hold such keys are opened; for few keys the scan gets them as a list, so that row groups
        are left out by the key's least and largest value and its Bloom filter."""
        columns = list(columns or self.schema.names)
        names = list(dict.fromkeys([*self.keys, *self.recency, *columns, GONE, RUN]))
        wanted = wanted.select(*self.keys).distinct()
        entries = self.entries(spark, run_id) if run_id else []
        slots = {(e.of, e.bucket): e.of for e in entries}
        touched = {(r[OF], r[BUCKET]) for r in self._placed(wanted, slots).select(OF, BUCKET).distinct().collect()} if slots else set()
        rows = self._scan(spark, [e for e in entries if (e.of, e.bucket) in touched]).select(*names)
        few = wanted.limit(PROBED_KEYS + 1).collect() if len(self.keys) == 1 else []
        path = f"{scratch_dir(spark, 'lookup')}/rows"
        with setting(spark, "spark.sql.parquet.pushdown.inFilterThreshold", str(PROBED_KEYS)):
            if 0 < len(few) <= PROBED_KEYS:
                rows = rows.filter(F.col(self.keys[0]).isin([r[0] for r in few]))
            else:
                same = [F.col(f"rows.{k}").eqNullSafe(F.col(f"wanted.{k}")) for k in self.keys]
                # Many keys are not broadcast, however small they are as stored.
                rows = rows.alias("rows").join(wanted.alias("wanted").hint("merge"), same, "left_semi")
            latest = latest_per_key(rows, self.keys, [*self.recency, RUN], ()) if not self.sums else self._combined(rows)
            latest.select(*names).write.parquet(path)
        return spark.read.schema(latest.select(*names).schema).parquet(path)

    # --- changes and history ----------------------------------------------------------

    def chain(self, spark: SparkSession, run_id: str | None = None, after: str | None = None) -> list[Row]:
        """The runs that `run_id` consists of, oldest first; only those behind `after`, if given."""
        runs = {r.run_id: r for r in self.runs(spark)}
        at = run_id or next(reversed(runs), None)
        found = []
        while at is not None and at != after:
            found.append(runs[at])
            at = runs[at].previous
        if after is not None and at is None:
            raise StaleBaseError(f"{run_id} does not lie on {after}")
        return found[::-1]

    def versions(self, spark: SparkSession, runs: Sequence[Row]) -> DataFrame:
        """The rows that these runs brought, with their marks and the number of their run."""
        out = spark.createDataFrame([], self._marked)
        for run in runs:
            out = out.unionByName(self.delta(spark, run.run_id))
        return out

    def changes(self, spark: SparkSession, from_run: str | None, to_run: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """What changed from one run to a later one that lies on it, as `row_changes` has it.
        Only keys that the runs between brought are looked up, in the buckets that hold them."""
        runs = self.chain(spark, to_run, from_run)
        to_run = runs[-1].run_id if runs else from_run
        keys = self.versions(spark, runs).select(*self.keys)
        before, after = (self.lookup(spark, run, keys).filter(f"NOT {GONE}") for run in (from_run, to_run))
        columns = columns if columns is not None else [c for c in self.schema.names if c not in self.keys]
        return row_changes(before, after, self.keys, columns)

    def history(self, spark: SparkSession, run_id: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Every state of every key with the numbers of the runs that it was valid for."""
        columns = columns if columns is not None else [c for c in self.schema.names if c not in self.keys]
        return row_history(self.versions(spark, self.chain(spark, run_id)), self.keys, columns, RUN, GONE, self.recency)

    # --- merging ----------------------------------------------------------------------

    def merge(
        self,
        batch: DataFrame,
        run_id: str,
        previous_run: str | None = None,
        gone: Column | None = None,
        buckets: int | None = None,
        fresh: bool = False,
        branch: bool = False,
    ) -> Merge:
        """Store the layer with `batch` merged in as `run_id`.

        It lies on the newest run. Another `previous_run` is refused if it has a successor, whose
        rows would be left out, unless `branch` says that this is wanted; `fresh` starts anew.
        Where the newest row of a key fulfils `gone`, a condition on the batch's columns, the key
        is removed. Keys of a layer that keeps the newest rows must not be NULL. `buckets` is the
        number a new layer starts with; else the stored size of its first batch decides.
        """
        spark = batch.sparkSession
        runs = self.runs(spark)
        previous = self._base_run(runs, run_id, previous_run, fresh, branch)
        number = 1 + max((r.number for r in runs), default=0)
        held = self.entries(spark, previous) if previous else []
        gone = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
        marked = batch.withColumns({GONE: gone, RUN: F.lit(number)}).select(*self._marked.names)
        # The batch may hold several rows of a key; ties in recency fall to the other columns.
        unique = self._combined(marked) if self.sums else latest_per_key(marked, self.keys, self.recency)
        if held:
            slots = {(e.of, e.bucket): e.of for e in held}
        else:
            if buckets is None:
                path = f"{scratch_dir(spark, 'first-merge')}/rows"
                unique.write.parquet(path)
                unique, buckets = spark.read.schema(self._marked).parquet(path), 1 << _doublings(stored_bytes(spark, path), self.bucket_bytes)
            slots = {(buckets, b): buckets for b in range(buckets)}
        written = self._store(self._placed(unique, slots), DELTA if held else BASE, run_id)
        touched = sorted({(of, bucket) for bucket, of, *_ in written})
        rows = [tuple(e) for e in held] + written
        folded = self._full(rows, touched) if held else []
        if folded:
            rows = self._folded(spark, rows, folded, run_id, number)
        taken = {(of, bucket) for bucket, of, *_ in rows}
        rows += [(bucket, of, EMPTY, run_id, 0, 0) for of, bucket in slots if not held and (of, bucket) not in taken]
        remove(spark, f"{self.root}/manifest/{run_id}.json")
        put_record(spark, f"{self.root}/manifest/{run_id}.json", rows)
        # Last of all: a merge that was stopped before is not there.
        put_record(spark, f"{self.root}/runs/{run_id}.json", (run_id, number, previous))
        return Merge(run_id, previous, touched, folded)

    def _full(self, rows: list[tuple], touched: Iterable[Slot]) -> list[Slot]:
        bases, deltas, pieces = defaultdict(int), defaultdict(int), defaultdict(int)
        for bucket, of, kind, _, n, _ in rows:
            (deltas if kind == DELTA else bases)[of, bucket] += n
            pieces[of, bucket] += kind == DELTA
        return [s for s in touched if pieces[s] > self.fold_after or deltas[s] > FOLD_SHARE * bases[s]]

    def _folded(self, spark: SparkSession, rows: list[tuple], slots: list[Slot], run_id: str, number: int) -> list[tuple]:
        """The manifest rows with the slots made one base each, split where they are too large."""
        chosen = set(slots)
        own = [ENTRY(*r) for r in rows if (r[1], r[0]) in chosen]
        size, held = defaultdict(int), defaultdict(int)
        for e in own:
            size[e.of, e.bucket] += e.bytes
            held[e.of, e.bucket] += e.n
        # Every doubling doubles the rows of the manifest, so a fold makes few of them.
        most = {s: min(MOST_DOUBLINGS, (held[s] // LEAST_ROWS).bit_length()) for s in slots}
        split = {s: s[0] << min(_doublings(size[s], self.bucket_bytes), most[s]) for s in slots}
        kept = self._combined(self._scan(spark, own))
        kept = self._live(kept) if self.sums else kept.filter(~(F.col(GONE) & (F.col(RUN) <= number - self.keep_marks)))
        written = self._store(self._placed(kept, split), BASE, run_id)
        taken = {(of, bucket) for bucket, of, *_ in written}
        for (of, bucket), new in split.items():
            for part in range(bucket, new, of):
                if (new, part) not in taken:
                    written.append((part, new, EMPTY, run_id, 0, 0))
        return [r for r in rows if (r[1], r[0]) not in chosen] + written
