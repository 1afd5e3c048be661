"""Parquet storage of the run history, as folders that a log of commits refers to."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import ScaleLimits
from riskloom.plans import tracking as K
from riskloom.plans.commits import Change, CommitLog, State
from riskloom.session import join_path, list_folder, path_exists, remove_path

APPENDED = ("training_runs", "run_metrics", "threshold_evaluations", "run_artifacts")
PROMOTIONS = "baseline_promotions"
INDEX = "run_index"


class RunStore:
    """The history of training runs below one root folder.

    Rows are written to new folders, which count once a commit names them, so a reader sees
    all tables as one commit left them, and nothing is overwritten while it is read. A writer
    that another one was faster than works out its change anew.
    """

    def __init__(self, spark: SparkSession, root: str, limits: ScaleLimits | None = None) -> None:
        self.spark = spark
        self.root = root
        self.limits = limits or ScaleLimits()
        self.log = CommitLog(spark, root)

    def run_directory(self, run_id: str) -> str:
        return join_path(self.root, "runs", run_id)

    # -- reading

    def table(self, name: str, state: State | None = None) -> DataFrame:
        return self._read(name, state or self.log.read())

    def tables(self) -> dict[str, DataFrame]:
        """The five tables as of one commit."""
        state = self.log.read()
        return {name: self._read(name, state) for name in (*APPENDED, PROMOTIONS)}

    def index(self) -> DataFrame | None:
        state = self.log.read()
        return K.run_index(self._read(INDEX, state)) if state.folders.get(INDEX) else None

    def register_views(self) -> None:
        """The tables and ``fact_model_runs`` as temporary views for SQL."""
        tables = self.tables()
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        K.fact_model_runs(tables, self.limits).createOrReplaceTempView("fact_model_runs")

    def _folder(self, name: str, folder: str) -> str:
        return join_path(self.root, name, folder)

    def _read(self, name: str, state: State) -> DataFrame:
        """The rows of a table, without those of runs that were deleted after they came."""
        groups: dict[tuple[str, ...], list[str]] = {}
        for folder, version in state.folders.get(name, ()):
            ids = {i for at, own in state.deleted if at > version for i in own}
            groups.setdefault(tuple(sorted(ids)), []).append(self._folder(name, folder))
        parts = []
        for ids, paths in groups.items():
            reader = self.spark.read if name == INDEX else self.spark.read.schema(K.table_schema(name))
            rows = reader.parquet(*paths)
            parts.append(_without_runs(rows, name, ids) if ids else rows)
        if not parts:
            return self.spark.createDataFrame([], K.table_schema(name))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # -- writing

    def _write(self, name: str, rows: DataFrame) -> str:
        """A new folder with the rows; without a commit that names it, it counts for nothing."""
        folder = uuid4().hex
        rows.write.parquet(self._folder(name, folder))
        return folder

    def append(self, name: str, rows: DataFrame) -> None:
        """Insert the rows whose key is new; the others stay as they are."""
        rows = K.conform(rows, name)

        def change(state: State) -> Change:
            new = K.absent_rows(rows, self._read(name, state), K.KEYS[name])
            return Change(add={name: [self._write(name, new)]})

        self.log.transact(change)

    def record(
        self,
        metadata: Mapping[str, Any],
        report: Mapping[str, Any],
        run_row: DataFrame,
        metric_rows: DataFrame,
        threshold_rows: DataFrame,
        artifact_rows: DataFrame,
    ) -> None:
        """Add one finished run to all tables and to the index, in one commit; a known id is
        an error."""
        run_id = metadata["run"]["run_id"]
        rows = {
            "training_runs": run_row,
            "run_metrics": metric_rows,
            "threshold_evaluations": threshold_rows,
            "run_artifacts": artifact_rows,
        }
        checked = {n: K.conform(df, n) for n, df in rows.items()}
        row = K.index_row(self.spark, metadata, report, f"runs/{run_id}")
        written: dict[str, str] = {}

        def change(state: State) -> Change:
            if not self._read("training_runs", state).filter(F.col("run_id") == run_id).isEmpty():
                raise FileExistsError(f"run {run_id} is recorded already")
            if not written:
                broken = K.violations(checked).filter("violations > 0").collect()
                if broken:
                    raise ValueError(f"rows break the table rules: {[tuple(b) for b in broken]}")
                written.update({n: self._write(n, df) for n, df in checked.items()})
            old = state.folders.get(INDEX)
            index = K.upsert_last(self._read(INDEX, state), row, "run_id") if old else row
            return self._replacing(INDEX, index, state, {n: [f] for n, f in written.items()})

        self.log.transact(change)

    def _replacing(
        self, name: str, snapshot: DataFrame, state: State, add: dict[str, Sequence[str]] | None = None
    ) -> Change:
        old = [f for f, _ in state.folders.get(name, ())]
        return Change(add={**(add or {}), name: [self._write(name, snapshot)]}, remove={name: old})

    def promote(self, run_id: str, overwrite: bool = False) -> None:
        """Make a recorded run the active baseline."""

        def change(state: State) -> Change:
            run = self._read("training_runs", state).filter(F.col("run_id") == run_id)
            if run.isEmpty():
                raise FileNotFoundError(f"no run {run_id}")
            promotions = self._read(PROMOTIONS, state)
            if not overwrite and not promotions.filter("is_active").isEmpty():
                raise FileExistsError("a baseline is active; pass overwrite to replace it")
            candidate = run.select(
                "run_id",
                F.current_timestamp().alias("promoted_at"),
                F.coalesce("audit_status", F.lit("not_available")).alias("audit_status"),
                "pipeline_sha256",
                "metadata",
            )
            return self._replacing(PROMOTIONS, K.promote(promotions, candidate), state)

        self.log.transact(change)

    def delete(self, *run_ids: str, purge: bool = True) -> None:
        """Delete runs with their rows in all tables; promotions stay without the run's id.

        One commit makes every reader leave the runs out. What their rows lie in is written
        anew by ``purge``, now or later, so a job that stops between the two leaves nothing
        half done. Files in the runs' own folders stay.
        """
        self.log.transact(lambda state: Change(delete=sorted(set(run_ids))) if run_ids else None)
        if purge:
            self.purge()

    def purge(self) -> None:
        """Write the folders that hold rows of deleted runs anew without them."""

        def change(state: State) -> Change | None:
            if not state.deleted:
                return None
            ids = sorted({i for _, own in state.deleted for i in own})
            add, remove = {}, {}
            for name in state.folders:
                touched = self._touched(name, state, ids)
                if touched:
                    only = State(state.version, {name: [f for f in state.folders[name] if f[0] in touched]}, state.deleted)
                    add[name], remove[name] = [self._write(name, self._read(name, only))], sorted(touched)
            return Change(add=add, remove=remove, purged=[at for at, _ in state.deleted])

        self.log.transact(change)

    def _touched(self, name: str, state: State, ids: Sequence[str]) -> set[str]:
        """The folders of a table that hold rows of the given runs."""
        paths = [self._folder(name, f) for f, _ in state.folders[name]]
        if not paths:
            return set()
        rows = self.spark.read.parquet(*paths).filter(F.col("run_id").isin(list(ids)))
        folder = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder")
        return {r["folder"] for r in rows.select(folder).distinct().collect()}

    def vacuum(self, hours: float = 24.0) -> None:
        """Remove folders that no commit names any more (or never did) and that are older than
        any reader or writer that is still at work."""
        state, before = self.log.read(), time.time() - hours * 3600
        for name in (*APPENDED, PROMOTIONS, INDEX):
            path = join_path(self.root, name)
            used = {f for f, _ in state.folders.get(name, ())}
            for folder, changed in list_folder(self.spark, path) if path_exists(self.spark, path) else ():
                if folder not in used and changed <= before:
                    remove_path(self.spark, self._folder(name, folder))

    def leaderboard(self, metric: str = "test_pr_auc", count: int = 10) -> DataFrame:
        index = self.index()
        if index is None:
            raise FileNotFoundError("no training run is recorded yet")
        return K.leaderboard(index, metric, count)


def _without_runs(rows: DataFrame, name: str, ids: Sequence[str]) -> DataFrame:
    gone = F.coalesce(F.col("run_id").isin(list(ids)), F.lit(False))
    if name == PROMOTIONS:
        return rows.withColumn("run_id", F.when(~gone, F.col("run_id")))
    return rows.filter(~gone)
