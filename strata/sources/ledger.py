"""Run ledger: high-water marks and the progress of runs as numbered commits.

A commit is a small JSON file ``{number}.json`` that holds the whole state
(marks of sources, steps done by unfinished runs, notes), so the newest file
is all a reader needs. A commit's file is created only if it does not exist,
and it is complete when it appears: of two writers that both start from the
same state one gets the next number, and the other has to look again. A mark
moves by compare-and-set (:meth:`Marks.set` fails if it moved since it was
read), in the same commit as the step that earned it.

A run is a sequence of named steps. A step that is done returns its recorded
result without running again, so a run that failed resumes at the step that
failed; a finished run forgets its steps, and running it again runs them all.
"""
from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 20


class LedgerConflict(RuntimeError):
    """Someone else committed what this commit depends on."""


@dataclass
class State:
    marks: dict[str, str] = field(default_factory=dict)
    runs: dict[str, dict[str, object]] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)


class RunLedger:
    """``path`` is a folder on any Hadoop file system whose rename does not
    overwrite, or a local one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, self._conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(self._conf)
        self._fs.mkdirs(self._folder)

    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def last(self) -> tuple[int, State]:
        """Number and state of the newest commit; (0, empty) before the first."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        return (max(numbers), self.at(max(numbers))) if numbers else (0, State())

    def at(self, number: int) -> State:
        """The state as of a commit: commits are never changed."""
        stream = self._fs.open(self._file(f"{number:0{_DIGITS}d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text))

    def _create(self, number: int, state: State) -> bool:
        """Put a complete commit file in place unless the number is taken."""
        made = self._file(f".{uuid.uuid4().hex}.tmp")
        out = self._fs.create(made, False)
        try:
            out.write(bytearray(json.dumps(state.__dict__, sort_keys=True).encode()))
        finally:
            out.close()
        final = self._file(f"{number:0{_DIGITS}d}.json")
        try:
            if self._fs.getScheme() == "file":  # a local rename may overwrite; a link never does
                try:
                    os.link(made.toUri().getPath(), final.toUri().getPath())
                except FileExistsError:
                    return False
                return True
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
            try:
                context.rename(made, final, self._no_options())
            except Py4JJavaError as err:
                if "FileAlreadyExists" in str(err.java_exception):
                    return False
                raise
            return True
        finally:
            self._fs.delete(made, False)

    def _no_options(self):
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        return self.spark.sparkContext._gateway.new_array(rename, 0)

    def commit(self, change: Callable[[State], None]) -> int:
        """Apply ``change`` to the newest state and commit it. On a lost race
        it is applied again to the state that won, so a change that depends on
        something has to check it there (and may raise)."""
        while True:
            number, state = self.last()
            change(state)
            if self._create(number + 1, state):
                return number + 1

    def marks(self) -> Marks:
        return Marks(self)

    def run(self, run_id: str) -> Run:
        """A run, resumed if it was not finished."""
        return Run(self, run_id)


class Marks:
    """High-water marks by source, with the interface of ``HighWaterMarks``."""

    def __init__(self, ledger: RunLedger):
        self.ledger, self._read = ledger, {}

    def get(self, source: str, default: str) -> str:
        self._read[source] = self.ledger.last()[1].marks.get(source)
        return default if self._read[source] is None else self._read[source]

    def check(self, state: State, source: str) -> None:
        if source in self._read and state.marks.get(source) != self._read[source]:
            raise LedgerConflict(f"the mark of {source} moved to {state.marks.get(source)} since it was read")

    def set(self, source: str, value: str) -> None:
        """Move a mark, unless it moved since this object read it."""

        def change(state: State) -> None:
            self.check(state, source)
            state.marks[source] = value

        self.ledger.commit(change)
        self._read[source] = value


class Run:
    def __init__(self, ledger: RunLedger, run_id: str):
        self.ledger, self.run_id = ledger, run_id

    def done(self) -> dict[str, object]:
        """Results of the steps done so far."""
        return self.ledger.last()[1].runs.get(self.run_id, {})

    def step(self, name: str, work: Callable[[], object], also: Callable[[State, object], None] | None = None):
        """Run ``work`` unless this run has done the step, and commit its
        result (JSON values) together with what ``also`` changes (a mark, a
        note). Work has to be repeatable: it runs again if the process ends
        between it and the commit. A second process that did the same step
        meanwhile makes the commit fail."""
        before = self.done()
        if name in before:
            return before[name]
        result = work()

        def change(state: State) -> None:
            steps = state.runs.setdefault(self.run_id, {})
            if name in steps:
                raise LedgerConflict(f"step {name} of {self.run_id} was done by another process")
            steps[name] = result
            if also:
                also(state, result)

        self.ledger.commit(change)
        return result

    def finish(self) -> None:
        self.ledger.commit(lambda state: state.runs.pop(self.run_id, None))
