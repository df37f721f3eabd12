"""Replay-safe tables on plain parquet, over any number of runs.

A batch is named by the run that writes it (one per checkpoint) and its number in that run, and has a folder of its own, so a
replay replaces exactly what it wrote before. Readers reduce the batches: newest or first row per key, sum of increments, or
distinct members.

Only one run writes at a time. A run that starts, or starts again, claims the next *term*; from then on every older term is
closed: its batches are those that were complete when the claim was made, and a writer that still holds it gets
:class:`Fenced` before or right after it writes, so that its checkpoint does not commit a batch nobody will read. The place
of a batch in the table's history is (term, number): a resumed run goes on after everything stored meanwhile, while a batch that
it repeats keeps its old place.

    terms/<term>.claim, <term>.seal              the run that holds a term; the last batch of a closed term
    log/term=<t>/batch_id=<n>/[<partition>=../]  rows of a batch, complete once ``_done`` is there
    state/home=<h>/[<partition>=../]             rows of compacted batches, reduced
    marks/<n>.json                               manifest: up to which place, and which home holds each partition

Compaction rewrites only the partitions that its batches touch, and then publishes a manifest; a compaction that dies before
leaves the old one current. It may run beside the writer, in any process: batches that could still be repeated are left
alone. :meth:`_Ledger.vacuum` removes what no kept manifest refers to. Nothing is changed in place.

Everything in ``terms`` and ``marks`` is created exclusively and never changed, so its content is cached by name. A claim or
manifest without content (its writer died) counts for nothing.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidecart.operators.counting import sum_by
from tidecart.operators.pick import first_by_key, latest_by_key
from tidecart.sources.folders import content, create_once, matching, remove

_TERM, _BATCH, _HOME = "term", "batch_id", "home"
_PLACE = [_TERM, _BATCH]
_DONE = "_done"


class Fenced(RuntimeError):
    """Another run has claimed the table; this one must start again before it may write."""


class Place(NamedTuple):
    """A batch's place in the history of a table."""

    term: int
    batch: int


class _Term(NamedTuple):
    no: int
    run: str
    first: int
    last: int | None  # of a closed term

    def holds(self, batch: int) -> bool:
        return self.first <= batch and (self.last is None or batch <= self.last)


class _Mark(NamedTuple):
    no: int
    upto: Place
    homes: dict[str | None, str]  # partition (as text) to home
    written: dict[str, int]  # home to the number of partitions it was written with


class _Ledger:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], partition: str | None = None):
        if clash := {_TERM, _BATCH, _HOME} & set(schema.names):
            raise ValueError(f"reserved column names: {sorted(clash)}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.partition = partition
        self.run: str | None = None
        self.term: int | None = None
        self._known: dict[str, str] = {}

    # -- runs and terms

    def bind(self, run: str) -> None:
        """Write as ``run`` from now on, and close every earlier term. A run that starts again binds again."""
        if not re.fullmatch(r"[\w-]+", run):
            raise ValueError(f"not a run name: {run!r}")
        if run in self._retired():
            raise ValueError(f"run {run} is retired from {self.path}")
        no = 1 + max(self._claims(), default=0)
        while not create_once(self.spark, f"{self.path}/terms/{no:010d}.claim", run):
            no += 1
        # Batches that complete from here on make their writer fail, so what is seen now is all there will be.
        for t in self._terms():
            if t.no < no and t.last is None:
                seen = [p.batch for p in [*self._complete(), self._mark().upto] if p.term == t.no and t.holds(p.batch)]
                create_once(self.spark, f"{self.path}/terms/{t.no:010d}.seal", str(max(seen, default=t.first - 1)))
        self.run, self.term = run, no

    def retire(self, run: str) -> None:
        """Declare that ``run`` never comes back, so that its last batch can be compacted like any other."""
        create_once(self.spark, f"{self.path}/terms/{run}.retired", run)

    def _read_once(self, name: str) -> str:
        if name not in self._known:
            text = content(self.spark, f"{self.path}/{name}")
            if not text:
                return ""
            self._known[name] = text
        return self._known[name]

    def _claims(self) -> list[int]:
        return [int(n.split(".")[0]) for n in matching(self.spark, f"{self.path}/terms/*.claim")]

    def _retired(self) -> set[str]:
        return {n.removesuffix(".retired") for n in matching(self.spark, f"{self.path}/terms/*.retired")}

    def _terms(self) -> list[_Term]:
        """Claimed terms in order. The batches of a run's terms follow one another."""
        sealed = {int(n.split(".")[0]): n for n in matching(self.spark, f"{self.path}/terms/*.seal")}
        result, next_of = [], {}
        for no in self._claims():
            run = self._read_once(f"terms/{no:010d}.claim")
            seal = self._read_once(f"terms/{sealed[no]}") if no in sealed else ""
            if run:
                term = _Term(no, run, next_of.get(run, 0), int(seal) if seal else None)
                next_of[run] = term.first if term.last is None else max(term.first, term.last + 1)
                result.append(term)
        return result

    def _complete(self) -> list[Place]:
        names = matching(self.spark, f"{self.path}/log/{_TERM}=*/{_BATCH}=*/{_DONE}", 3)
        return [Place(*(int(part.split("=")[1]) for part in n.split("/")[:2])) for n in names]

    def _batches(self) -> list[Place]:
        """Complete batches of the table in order; what a fenced writer left behind is not among them."""
        terms = {t.no: t for t in self._terms()}
        return sorted(p for p in self._complete() if p.term in terms and terms[p.term].holds(p.batch))

    def _place(self, batch: int) -> Place:
        """Where a batch of this run stands: in the term that first completed it, else in the current one."""
        if self.run is None:
            self.bind("default")
        return next((Place(t.no, batch) for t in self._terms() if t.run == self.run and t.holds(batch)), Place(self.term, batch))

    def _check_fence(self) -> None:
        if max(self._claims(), default=0) != self.term:
            raise Fenced(f"{self.path} is written by a newer run than {self.run}")

    # -- layout

    def _mark(self) -> _Mark:
        """The newest whole manifest."""
        for name in reversed(matching(self.spark, f"{self.path}/marks/*.json")):
            try:
                m = json.loads(self._read_once(f"marks/{name}"))
            except ValueError:
                continue
            return _Mark(int(name.split(".")[0]), Place(*m["upto"]), {p: h for p, h in m["homes"]}, m["written"])
        return _Mark(0, Place(0, -1), {}, {})

    def _folder_of(self, part: str) -> str | None:
        """The folder name of a partition value; none for a value that is not written as it is."""
        return f"{self.partition}={part}" if re.fullmatch(r"[\w-]+", part) else None

    def _rows(self, folder: str, paths: list[str], more: dict) -> DataFrame | None:
        schema = StructType(list(self.schema.fields))
        for name, kind in more.items():
            schema = schema.add(name, kind)
        if not paths:
            return None
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}")
        return reader.parquet(*[f"{self.path}/{folder}/{p}" for p in paths]).select(*self.schema.names, *more)

    def _state(self, mark: _Mark, part: str | None = None) -> DataFrame | None:
        """Compacted rows; none if there are no files to read."""
        if part is not None and self._folder_of(part):
            home = mark.homes.get(part)
            one = self._rows("state", [f"{_HOME}={home}/{self._folder_of(part)}"] if home else [], {_HOME: StringType()})
            return None if one is None else one.select(*self.schema.names)
        live: dict[str, list[str | None]] = {}
        for part, home in mark.homes.items():
            live.setdefault(home, []).append(part)
        rows = self._rows("state", [f"{_HOME}={h}" for h in live], {_HOME: StringType()})
        if rows is None:
            return None

        def current(home: str, parts: list[str | None]) -> Column:
            here = F.col(_HOME) == home
            if len(parts) == mark.written[home]:
                return here
            part = F.col(self.partition).cast("string")
            listed = part.isin([p for p in parts if p is not None])
            return here & (listed | part.isNull() if None in parts else listed)

        if any(len(p) != mark.written[h] for h, p in live.items()):
            rows = rows.where(reduce(lambda a, b: a | b, [current(h, p) for h, p in live.items()]))
        return rows.select(*self.schema.names)

    def _log(self, batches: list[Place], part: str | None = None) -> DataFrame | None:
        """Rows of batches with their place; none if there are no files to read."""
        paths = [f"{_TERM}={p.term}/{_BATCH}={p.batch}" for p in batches]
        if part is not None and batches and (folder := self._folder_of(part)):
            here = matching(self.spark, f"{self.path}/log/{_TERM}=*/{_BATCH}=*/{folder}", 3)
            paths = [name for name in here if name.rsplit("/", 1)[0] in set(paths)]
        return self._rows("log", paths, {_TERM: LongType(), _BATCH: LongType()})

    def _save(self, df: DataFrame, folder: str) -> None:
        if self.partition:
            # Few files per folder, and adaptive execution splits a folder that is too big for one task.
            df = df.hint("rebalance", F.col(self.partition))
        writer = df.write.mode("overwrite")
        if self.partition:
            writer = writer.partitionBy(self.partition)
        writer.parquet(f"{self.path}/{folder}")

    # -- writing

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Record the rows of a batch, replacing an earlier attempt of the same batch of the same run."""
        place = self._place(batch_id)
        self._check_fence()
        if place <= (upto := self._mark().upto):
            raise ValueError(f"batch {batch_id} of {self.run} is already compacted (up to {upto})")
        folder = f"log/{_TERM}={place.term}/{_BATCH}={place.batch}"
        self._save(self.prepare(df.select(*self.schema.names)), folder)
        create_once(self.spark, f"{self.path}/{folder}/{_DONE}")
        self._check_fence()

    def compact(self, upto: int | None = None) -> bool:
        """Reduce committed batches into the state, rewriting only the partitions they touch; true if there were any.

        ``upto`` names the last committed batch of this run. Without it every batch counts as committed but the last of each
        run, which that run could repeat; so compaction goes up to the first of those (see :meth:`retire`).
        """
        mark, batches = self._mark(), self._batches()
        runs = {t.no: t.run for t in self._terms()}
        last = {runs[p.term]: p for p in batches}
        limit = None
        if upto is not None:
            limit = self._place(upto)
            last.pop(self.run, None)
        open_from = min((p for run, p in last.items() if run not in self._retired()), default=None)
        ripe = [p for p in batches if p > mark.upto and (limit is None or p <= limit) and (open_from is None or p < open_from)]
        if not ripe:
            return False
        log, state = self._log(ripe), self._state(mark)
        touched: list[str | None] = [None]
        if self.partition:
            part = F.col(self.partition).cast("string")
            touched = [r[0] for r in log.select(part).distinct().collect()]  # one row per partition
            known = [p for p in touched if p in mark.homes]
            among = part.isin([p for p in known if p is not None])
            state = state.where(among | part.isNull() if None in known else among) if known else None
        home = uuid.uuid4().hex
        self._save(self.combine(state, log), f"state/{_HOME}={home}")
        homes = {**mark.homes, **{p: home for p in touched}}
        written = {h: n for h, n in mark.written.items() if h in homes.values()} | {home: len(touched)}
        if not self._publish(mark.no + 1, ripe[-1], homes, written):
            remove(self.spark, f"{self.path}/state/{_HOME}={home}")  # another compaction was first
            return False
        return True

    def _publish(self, no: int, upto: Place, homes: dict, written: dict) -> bool:
        text = json.dumps({"at": time.time(), "upto": upto, "homes": list(homes.items()), "written": written})
        return create_once(self.spark, f"{self.path}/marks/{no:010d}.json", text)

    def vacuum(self, keep: int = 2, older_than: float = 3600) -> None:
        """Remove what only manifests before the newest ``keep`` refer to, and the batches that all kept ones hold.

        A manifest goes once another has replaced it for ``older_than`` seconds: a frame read under it must be evaluated by then.
        """
        marks = {}
        for name in matching(self.spark, f"{self.path}/marks/*.json"):
            try:
                marks[name] = json.loads(self._read_once(f"marks/{name}"))
            except ValueError:
                continue
        names = list(marks)
        latest = time.time() - older_than
        dropped = [n for n, newer in zip(names[: -max(keep, 1)], names[1:]) if marks[newer]["at"] <= latest]
        kept = names[len(dropped) :]
        if not dropped:
            return
        live = {h for name in kept for _, h in marks[name]["homes"]}
        for home in {h for name in dropped for _, h in marks[name]["homes"]} - live:
            remove(self.spark, f"{self.path}/state/{_HOME}={home}")
        for p in self._complete():
            if p <= Place(*marks[kept[0]]["upto"]):
                remove(self.spark, f"{self.path}/log/{_TERM}={p.term}/{_BATCH}={p.batch}")
        for name in dropped:
            remove(self.spark, f"{self.path}/marks/{name}")

    # -- reading

    def read(self, before: int | None = None, where: Column | str | None = None, part: str | None = None, only: DataFrame | None = None) -> DataFrame:
        """Current rows; with ``before``, the rows as they were before that batch of this run, so that a replay sees the same.

        ``where`` may use key columns only; it reaches the files of every batch and, on the partition column, prunes folders.
        ``part`` is one value of the partition column: no other folder is even listed. ``only`` holds values of some key columns:
        rows of other keys are left out before anything is reduced; mark it for broadcast if its size is known.
        """
        end = None if before is None else self._place(before)
        mark = self._mark()
        if end is not None and end <= mark.upto:
            raise ValueError(f"the state before batch {before} of {self.run} is compacted away (up to {mark.upto})")
        log = self._log([p for p in self._batches() if p > mark.upto and (end is None or p < end)], part)
        state = self._state(mark, part)
        if part is not None:
            here = F.col(self.partition) == part
            where = here if where is None else here & (F.expr(where) if isinstance(where, str) else where)
        if where is not None:
            state, log = (None if rows is None else rows.where(where) for rows in (state, log))
        if only is not None:
            names = self.schema.names
            state, log = (None if rows is None else rows.join(only, only.columns, "left_semi").select(*names, *more)
                          for rows, more in ((state, []), (log, _PLACE)))
        if log is None:
            return self.spark.createDataFrame([], self.schema) if state is None else state
        return self.combine(state, log)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Shape the rows of one batch before they are written."""
        return df

    def combine(self, state: DataFrame | None, log: DataFrame) -> DataFrame:
        """Current rows from compacted ones, if there are any, and those of later batches."""
        raise NotImplementedError


def _all(state: DataFrame | None, log: DataFrame) -> DataFrame:
    """Rows with their place; compacted ones come before all batches."""
    return log if state is None else state.withColumns({name: F.lit(-1).cast("bigint") for name in _PLACE}).unionByName(log)


class KeyedLedger(_Ledger):
    """Upsert by key: the row of the newest batch wins; within a batch the one with the largest ``order``.

    With ``order`` given, it also decides between batches, so a late older row does not replace a newer one.
    With a ``partition`` column (a day, mostly), keys must include it: a filter on it then prunes folders.
    """

    def __init__(self, spark, path, schema, keys, partition=None, order: Sequence[str] = ()):
        super().__init__(spark, path, schema, keys, partition)
        if partition is not None and partition not in self.keys:
            raise ValueError("the partition column must be part of the key")
        self.order = list(order)

    def prepare(self, df: DataFrame) -> DataFrame:
        return latest_by_key(df, self.keys, self.order)

    def combine(self, state: DataFrame | None, log: DataFrame) -> DataFrame:
        if self.order:
            return latest_by_key(_all(state, log), self.keys, [*self.order, *_PLACE]).drop(*_PLACE)
        newest = latest_by_key(log, self.keys, _PLACE).drop(*_PLACE)
        if state is None:
            return newest
        # The log is short after a compaction, so the anti join is planned as a broadcast and the state is not shuffled.
        changed = newest.select([F.col(k).alias(f"__{k}") for k in self.keys])
        same_key = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
        return state.join(changed, same_key, "left_anti").unionByName(newest)


class FirstLedger(_Ledger):
    """Insert by key where there is none: the row of the oldest batch stays; within a batch the one with the smallest ``order``."""

    def __init__(self, spark, path, schema, keys, partition=None, order: Sequence[str] = ()):
        super().__init__(spark, path, schema, keys, partition)
        if partition is not None and partition not in self.keys:
            raise ValueError("the partition column must be part of the key")
        self.order = list(order)

    def prepare(self, df: DataFrame) -> DataFrame:
        return first_by_key(df, self.keys, self.order)

    def combine(self, state: DataFrame | None, log: DataFrame) -> DataFrame:
        return first_by_key(_all(state, log), self.keys, _PLACE).drop(*_PLACE)


class CounterLedger(_Ledger):
    """Running totals of ``count`` per key as a sum of per-batch increments."""

    def prepare(self, df: DataFrame) -> DataFrame:
        return sum_by(df, self.keys).select(*self.schema.names)

    def combine(self, state: DataFrame | None, log: DataFrame) -> DataFrame:
        return sum_by(_all(state, log), self.keys).select(*self.schema.names)


class SetLedger(_Ledger):
    """Distinct members."""

    def prepare(self, df: DataFrame) -> DataFrame:
        return df.distinct()

    def combine(self, state: DataFrame | None, log: DataFrame) -> DataFrame:
        return _all(state, log).drop(*_PLACE).distinct()
