"""A mirror laid out by key: buckets of a key hash, versions of buckets named by a commit, merged bucket by bucket.

Every load writes the newest row per key of its batch, dealt to ``buckets`` buckets and sorted by key. A commit (see ``CommitLog``)
then names what each bucket consists of: at most one compacted base and the later batches that touched it. Reading merges a bucket
where it lies: the files are scanned as a bucketed table, so neither the merge nor a join of two mirrors with equal
buckets on the join key needs a shuffle. Compaction rewrites only the buckets that batches have touched since.

Writers may run at once. Each writes to a folder of its own and takes the next commit number if nobody has; else its batch, made from
an old cursor, is dropped and made again. So the run log and the visible rows always agree. A commit carries the whole state, as
many entries as there are buckets and batches not yet compacted: fold them in from time to time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators.latest import latest_by_key
from bazaarlake.sources.commits import CommitConflict, CommitLog
from bazaarlake.sources.extract import EPOCH, changed_since
from bazaarlake.sources.storage import drop_folder, subfolders

#: Columns a stored row has beside its own: what it is ranked by, its batch, and whether it says that the key is gone.
RANK, BATCH, GONE = "_moment", "_batch", "_gone"
_HIDDEN = (RANK, BATCH, GONE)
ATTEMPTS = 10
#: Names of the bucketed tables that scans of a mirror's folder went through in this session.
_SCANS: dict[str, set[str]] = {}


class BucketMirror:
    """One mirrored table below ``root``.

    ``by`` are the columns that buckets are cut by, the key if not given. They must follow from the key: a row may not move to
    another bucket (an order line stays with its order). A row's rank is (cursor, batch, ties); equal cursors go to the batch
    loaded last.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        table: str,
        key: Sequence[str] = ("id",),
        cursor: str = "write_date",
        ties: Sequence[str] = (),
        by: Sequence[str] = (),
        buckets: int = 64,
    ):
        self.spark, self.table = spark, table
        self.key, self.cursor, self.ties = list(key), cursor, list(ties)
        self.by, self.buckets = list(by or key), buckets
        self._root = f"{root}/{table}"
        self._data = f"{self._root}/data"
        self.commits = CommitLog(spark, f"{self._root}/commits")

    # -- state ------------------------------------------------------------------------------------------------

    def state(self, version: int | None = None) -> tuple[int, dict]:
        """The commit number and what it says; a mirror never loaded has number 0."""
        number, state = self.commits.head() if version is None else (version, self.commits.read(version) if version else None)
        state = state or {"batch": 0, "mark": 0, "schema": None, "held": {}, "streams": {}, "buckets": self.buckets, "by": self.by}
        if (state["buckets"], state["by"]) != (self.buckets, self.by):
            raise ValueError(f"{self.table} is stored in {state['buckets']} buckets by {state['by']}")
        return number, state

    def checkpoint_log(self) -> DataFrame:
        """Every load committed, empty ones included."""
        runs = self.commits.notes("kind string, number bigint, mark bigint, rows bigint, at bigint").where("kind = 'load'")
        return runs.select(
            F.lit(self.table).alias("table_name"),
            F.timestamp_micros("mark").alias("last_write_date"),
            F.col("rows").alias("rows_loaded"),
            F.timestamp_micros("at").alias("run_ts"),
        )

    def _attempt(self) -> str:
        return uuid.uuid4().hex

    def _folder(self, attempt: str, bucket: int | None = None) -> str:
        path = f"{self._data}/attempt={attempt}"
        return path if bucket is None else f"{path}/bucket={bucket}"

    # -- loading ----------------------------------------------------------------------------------------------

    def load(
        self,
        source: DataFrame,
        select: Callable[[DataFrame], DataFrame] = lambda df: df,
        lookback: timedelta | None = None,
    ) -> int:
        """Append the rows changed since the last load, return their number."""

        def batch(state: dict) -> DataFrame:
            cursor = EPOCH + timedelta(microseconds=state["mark"])
            return select(changed_since(source, cursor, self.cursor, lookback))

        return self._append(batch)

    def append(self, rows: DataFrame, stream: str, epoch: int) -> int:
        """Append ``rows`` as epoch ``epoch`` of a stream; an epoch that is already in the mirror is not appended again.

        For ``foreachBatch``: a micro-batch repeated after a failure has its old number.
        """
        return self._append(lambda state: rows, (stream, epoch))

    def _append(self, batch: Callable[[dict], DataFrame], epoch: tuple[str, int] | None = None) -> int:
        for _ in range(ATTEMPTS):
            number, state = self.state()
            if epoch and state["streams"].get(epoch[0], -1) >= epoch[1]:
                return 0
            seen, rows = Observation(), batch(state)
            moment = F.unix_micros(F.col(self.cursor).cast("timestamp"))
            rows = rows.observe(seen, F.max(moment).alias("mark"), F.count(F.lit(1)).alias("rows"))
            attempt = self._attempt()
            touched, stored = self._write(self._ranked(rows), attempt, state["batch"] + 1)
            streams = state["streams"] | ({epoch[0]: epoch[1]} if epoch else {})
            found = seen.get if touched else {"mark": None, "rows": 0}  # nothing is observed of a plan found to be empty
            mark = max(state["mark"], found["mark"] or 0)
            if self._commit_batch(number, state, attempt, touched, stored, mark, found["rows"], streams):
                return found["rows"]
            drop_folder(self.spark, self._folder(attempt))
        raise CommitConflict(f"{self.table}: {ATTEMPTS} loads in a row were overtaken")

    def _ranked(self, rows: DataFrame, rank: Column | None = None, gone: Column | None = None) -> DataFrame:
        return rows.withColumns(
            {RANK: F.col(self.cursor).cast("timestamp") if rank is None else rank, GONE: F.lit(False) if gone is None else gone}
        )

    def _bucket(self) -> Column:
        """The bucket that Spark's writer puts a row into."""
        return F.pmod(F.hash(*self.by), F.lit(self.buckets))

    def _write(self, rows: DataFrame, attempt: str, batch: int, merged: bool = False) -> tuple[dict[str, int], T.StructType]:
        """Write the newest row per key in bucket order; rows per bucket written (at most ``buckets`` numbers), and their schema."""
        if not merged:
            rows = rows.withColumn(BATCH, F.lit(batch).cast("bigint"))
            rows = latest_by_key(rows, self.key, self._order()).repartition(self.buckets, *self.by)
        name = f"bucket_write_{attempt}"
        writer = rows.withColumn("bucket", self._bucket()).write.format("parquet").partitionBy("bucket")
        writer.bucketBy(self.buckets, *self.by).sortBy(*dict.fromkeys([*self.by, *self.key])).option("path", self._folder(attempt)).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        written = self.spark.read.schema("bucket int").option("basePath", self._folder(attempt))
        sizes = written.parquet(self._folder(attempt)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        return {str(r["bucket"]): r["n"] for r in sizes.collect()}, rows.schema

    def _order(self) -> list[str]:
        return [RANK, BATCH, *self.ties]

    def _commit_batch(self, number, state, attempt, touched, stored, mark, rows, streams=None, kind="load") -> bool:
        """Commit a written batch. Compactions in between don't matter to it; any other batch does."""
        batch = state["batch"] + 1
        while True:
            held = {b: dict(v) for b, v in state["held"].items()}
            for b, n in touched.items():
                own = held.setdefault(b, {"base": None, "later": []})
                own["later"] = [*own["later"], [attempt, batch, n]]
            new = state | {"batch": batch, "mark": mark, "held": held, "streams": streams or state["streams"]}
            new["schema"] = state["schema"] or stored.json()
            note = {"kind": kind, "number": number + 1, "mark": mark, "rows": rows, "at": int(datetime.now(timezone.utc).timestamp() * 1_000_000)}
            if self.commits.commit(number + 1, new, note):
                return True
            number, state = self.state()
            if state["batch"] != batch - 1:
                return False

    # -- reading ----------------------------------------------------------------------------------------------

    def _parts(self, state: dict, buckets=None) -> list[tuple[str, str]]:
        """(attempt, bucket) folders that make up the state."""
        out = []
        for b, own in state["held"].items():
            if buckets is None or b in buckets:
                out += [(own["base"][0], b)] if own["base"] else []
                out += [(attempt, b) for attempt, _, _ in own["later"]]
        return out

    def _scan(self, state: dict, parts: list[tuple[str, str]], in_place: bool = True) -> DataFrame:
        """The rows of some folders. ``in_place``: as a bucketed table, whose buckets are not shuffled to be brought together."""
        stored = T.StructType.fromJson(json.loads(state["schema"]))
        if not parts:
            return self.spark.createDataFrame([], stored)
        if not in_place:
            return self.spark.read.schema(stored).parquet(*[self._folder(a, b) for a, b in parts])
        name = f"bucket_scan_{hashlib.md5(json.dumps([self._data, self.by, self.buckets, sorted(parts)]).encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
        by = ", ".join(f"`{c}`" for c in self.by)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, attempt STRING, bucket INT) USING parquet PARTITIONED BY (attempt, bucket) "
            f"CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self._data}'"
        )
        folders = [f"PARTITION (attempt = '{a}', bucket = {b}) LOCATION '{self._folder(a, b)}'" for a, b in parts]
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(folders)}")
        _SCANS.setdefault(self._data, set()).add(name)
        return self.spark.table(name).select(*stored.names)

    def even(self, state: dict, most: float = 4.0) -> bool:
        """Whether no bucket holds more than ``most`` times the mean, so that a task per bucket is a fair deal."""
        sizes = [sum(n for *_, n in [*([own["base"]] if own["base"] else []), *own["later"]]) for own in state["held"].values()]
        return not sizes or max(sizes) <= most * max(sum(sizes) / self.buckets, 1000)

    def _merged(self, state: dict, buckets=None, in_place: bool | None = None) -> DataFrame:
        """The newest row per key, keys that are gone included."""
        chosen = {b for b in state["held"] if buckets is None or b in buckets}
        in_place = self.even(state) if in_place is None else in_place
        rows = self._scan(state, self._parts(state, chosen), in_place)
        if all(not state["held"][b]["later"] for b in chosen):
            return rows  # bases are unique already
        keys = list(dict.fromkeys([*self.by, *self.key]))
        return latest_by_key(rows, keys, self._order())

    def current(self, version: int | None = None, in_place: bool | None = None) -> DataFrame:
        """One row per key, as of a commit (the last one if not given).

        Buckets are merged where they lie unless one of them is far larger than the others (a hot ``by`` value): then rows are
        read as plain files, and merged by a shuffle that Spark can split.
        """
        _, state = self.state(version)
        if state["schema"] is None:
            raise FileNotFoundError(f"{self.table} has never been loaded")
        return self._merged(state, in_place=in_place).where(~F.col(GONE)).drop(*_HIDDEN)

    def as_of(self, version: int, buckets: set[str], among: DataFrame | None = None) -> DataFrame:
        """Current rows of some buckets as of a commit (0: none yet), if given only those whose ``by`` value is ``among``."""
        number, state = self.state(version)
        if state["schema"] is None:
            state = state | {"schema": self.state()[1]["schema"]}
        rows = self._merged(state, buckets).where(~F.col(GONE)).drop(*_HIDDEN)
        if among is not None:
            rows = rows.join(among, F.col(self.by[0]) == F.col(among.columns[0]), "left_semi")
        return rows

    def changes(self, old: int, new: int) -> tuple[set[str], DataFrame]:
        """Buckets touched between two commits, and the ``by`` and key columns of the rows that were written or went in them."""
        touched, rows = self.changed_rows(old, new)
        return touched, rows.distinct()

    def changed_rows(self, old: int, new: int) -> tuple[set[str], DataFrame]:
        """``changes`` with a row as often as it was written, for callers that go on to tell fewer columns apart.

        Where no compaction came in between, only the batches themselves are read.
        """
        (_, before), (_, now) = self.state(old), self.state(new)
        names = list(dict.fromkeys([*self.by, *self.key]))
        after = before["batch"]
        late = {b: [(a, b) for a, n, _ in own["later"] if n > after] for b, own in now["held"].items()}
        folded = {b for b, own in now["held"].items() if (own["base"] and own["base"][1] > after)}
        folded |= {b for b, own in before["held"].items() if (own["base"] or own["later"]) and not self._parts(now, {b})}
        touched = {b for b, parts in late.items() if parts} | folded
        written = self._scan(now, [p for b, parts in late.items() if b not in folded for p in parts], in_place=False) if now["schema"] else None
        if written is None:
            raise FileNotFoundError(f"{self.table} has never been loaded")
        rows = written.select(*names)
        if folded:
            held = self._merged(now, folded)
            rows = rows.unionByName(held.where(F.col(BATCH) > after).select(*names))
            rows = rows.unionByName(self.as_of(old, folded).select(*names).join(held.where(~F.col(GONE)).select(*names), names, "left_anti"))
        return touched, rows

    def lookup(self, *values) -> DataFrame:
        """Current rows of some values of ``by`` (a single column). Only the buckets that can hold them are opened."""
        if len(self.by) != 1:
            raise ValueError("a lookup needs one bucket column")
        _, state = self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"{self.table} has never been loaded")
        kind = T.StructType.fromJson(json.loads(state["schema"]))[self.by[0]].dataType
        asked = self.spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(self.by[0], kind)]))
        buckets = {str(r["b"]) for r in asked.select(self._bucket().alias("b")).collect()}
        rows = self._merged(state, buckets, in_place=False).where(F.col(self.by[0]).isin(*values))
        return rows.where(~F.col(GONE)).drop(*_HIDDEN)

    # -- compaction -------------------------------------------------------------------------------------------

    def compact(self) -> int:
        """Fold the batches into the buckets that they touched; the number of buckets rewritten. Other buckets stay as they are."""
        _, state = self.state()
        dirty = {b for b, own in state["held"].items() if own["later"]}
        if not dirty:
            return 0
        attempt = self._attempt()
        rows = self._merged(state, dirty).where(~F.col(GONE))
        sizes, _ = self._write(rows, attempt, 0, merged=True)
        upto = {b: state["held"][b]["later"][-1][1] for b in dirty}
        while True:
            number, now = self.state()
            held = {b: dict(v) for b, v in now["held"].items()}
            if any(held[b]["base"] != state["held"][b]["base"] for b in dirty):
                drop_folder(self.spark, self._folder(attempt))  # another compaction was faster
                return 0
            for b in dirty:
                later = [x for x in held[b]["later"] if x[1] > upto[b]]
                held[b] = {"base": [attempt, upto[b], sizes[b]] if b in sizes else None, "later": later}
            if self.commits.commit(number + 1, now | {"held": held}, {"kind": "compact", "number": number + 1}):
                return len(dirty)

    def vacuum(self, keep: int = 2) -> int:
        """Delete folders of buckets that none of the last ``keep`` commits names; how many. Run it while nobody writes.

        The tables that this session's scans went through are dropped, too; frames made before must be made again.
        """
        for name in _SCANS.pop(self._data, ()):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        numbers = self.commits.numbers()[-keep:]
        named = {p for n in numbers for p in self._parts(self.commits.read(n))}
        return drop_unnamed(self.spark, self._data, named)

    # -- reconciliation ---------------------------------------------------------------------------------------

    def reconcile(self, source: DataFrame, select: Callable[[DataFrame], DataFrame] = lambda df: df, ranges: int = 64) -> dict[str, int]:
        """Make the mirror equal to the whole ``source``, deletions included, reading in full only key ranges that differ.

        ``ranges`` ranges of each bucket are compared by count and two checksums of their rows, in one pass over both sides. Rows of
        differing ranges are then compared one by one: new and changed rows are appended, and keys that the source
        has no more get a row that says so. Returns the numbers of ranges read and of rows appended and gone.
        """
        for _ in range(ATTEMPTS):
            number, state = self.state()
            theirs = select(source)
            names = theirs.columns
            if state["schema"] is None:
                state = state | {"schema": self._ranked(theirs).withColumn(BATCH, F.lit(0).cast("bigint")).schema.json()}
            ours = self._merged(state)
            live = ours.where(~F.col(GONE))
            digest = F.xxhash64(*names)
            fine = F.pmod(F.xxhash64(F.lit("range"), *self.key), F.lit(ranges))

            def differing(a: DataFrame, b: DataFrame, by: list[Column]) -> DataFrame:
                """Values of ``by`` (at most buckets x ranges) in which the two sides have different rows."""
                sums = [F.count(F.lit(1)).alias("n"), F.bit_xor(digest).alias("x"), F.sum(F.shiftright(digest, 32)).alias("s")]
                a, b = (side.groupBy(*by).agg(*sums) for side in (a, b))
                places = a.columns[: len(by)]
                return a.unionByName(b).groupBy(*a.columns).agg(F.count(F.lit(1)).alias("sides")).where("sides = 1").select(*places).distinct()

            wanted = differing(theirs, live, [self._bucket().alias("_b"), fine.alias("_f")])
            places = wanted.collect()
            if not places:
                return {"ranges": 0, "rows": 0, "gone": 0}
            coarse = {str(p["_b"]) for p in places}
            inside = self._bucket().isin([int(b) for b in coarse])
            rows = self._merged(state, coarse)
            wanted = F.broadcast(self.spark.createDataFrame([tuple(p) for p in places], wanted.schema))
            here = [self._bucket() == F.col("_b"), fine == F.col("_f")]
            new = theirs.where(inside).join(wanted, here, "left_semi").select(F.struct(*names).alias("new"), *[F.col(k).alias(f"_k_{k}") for k in self.key])
            old = rows.join(wanted, here, "left_semi")
            same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.key]
            both = old.select(F.struct(*rows.columns).alias("old"), *self.key).join(new, same_key, "full_outer")
            held = F.struct(*[F.col(f"old.{c}") for c in names])
            lost = F.col("new").isNull() & ~F.col(f"old.{GONE}")
            changed = F.col("new").isNotNull() & (F.col("old").isNull() | F.col(f"old.{GONE}") | ~held.eqNullSafe(F.col("new")))
            both = both.where(lost | changed).withColumn("row", F.coalesce("new", held))
            rank = F.greatest(F.col(f"old.{RANK}"), F.col(f"row.{self.cursor}").cast("timestamp"))
            fixes = both.select("row.*", rank.alias(RANK), F.col("new").isNull().alias(GONE))
            seen = Observation()
            fixes = fixes.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(GONE)).alias("gone"))
            attempt = self._attempt()
            touched, stored = self._write(fixes, attempt, state["batch"] + 1)
            found = seen.get if touched else {"rows": 0, "gone": 0}
            if self._commit_batch(number, state, attempt, touched, stored, state["mark"], found["rows"], kind="reconcile"):
                return {"ranges": len(places), "rows": found["rows"], "gone": found["gone"]}
            drop_folder(self.spark, self._folder(attempt))
        raise CommitConflict(f"{self.table}: {ATTEMPTS} reconciliations in a row were overtaken")


def drop_unnamed(spark: SparkSession, data: str, named: set[tuple[str, str]]) -> int:
    dropped = 0
    for attempt in subfolders(spark, data):
        for bucket in subfolders(spark, f"{data}/{attempt}"):
            if bucket.startswith("bucket=") and (attempt.removeprefix("attempt="), bucket.removeprefix("bucket=")) not in named:
                drop_folder(spark, f"{data}/{attempt}/{bucket}")
                dropped += 1
    return dropped
