"""Steps that depend on each other, run in order and taken up again (ORC-01 to ORC-07)."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Step:
    """A table made from others: build(inputs) gives it, needs names the steps it reads."""

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs: Sequence[str] = ()
    tries: int = 1


@dataclass
class Run:
    """The steps of a folder. A step whose table is complete isn't made again, unless a table it reads is newer."""

    spark: SparkSession
    folder: str
    steps: Sequence[Step]
    report: list[dict] = field(default_factory=list)

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _made(self, name: str) -> int | None:
        """When the step's table was completed, in milliseconds; None if it isn't there whole."""
        marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(name) + "/_SUCCESS")
        files = marker.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return files.getFileStatus(marker).getModificationTime() if files.exists(marker) else None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def check(self) -> None:
        """Refuses steps that need what no earlier step makes (ORC-06)."""
        seen: set[str] = set()
        for step in self.steps:
            if lacking := [n for n in step.needs if n not in seen]:
                raise ValueError(f"{step.name} needs {lacking}, which no earlier step makes")
            seen.add(step.name)

    def go(self, only: Sequence[str] | None = None, begin: str | None = None) -> list[dict]:
        """Run all steps, only some, or those from one on; ends at the first that fails all its tries."""
        self.check()
        names = [s.name for s in self.steps]
        wanted = set(only or names[names.index(begin) if begin else 0 :])
        for step in self.steps:
            if step.name not in wanted:
                continue
            made = self._made(step.name)
            newest = max([self._made(n) or 0 for n in step.needs], default=0)
            if made is not None and made >= newest:
                self.report.append({"step": step.name, "state": "there", "seconds": 0.0})
                continue
            began, error = time.time(), ""
            for _ in range(step.tries):
                try:
                    step.build({n: self.table(n) for n in step.needs}).write.mode("overwrite").parquet(self._path(step.name))
                    error = ""
                    break
                except Exception as e:  # noqa: BLE001, the report says what it was
                    error = str(e)[:500]
            self.report.append({"step": step.name, "state": "failed" if error else "made", "seconds": round(time.time() - began, 3), **({"error": error} if error else {})})
            if error:
                raise RuntimeError(f"{step.name} failed: {error}")
        return self.report

    def as_json(self) -> str:
        return json.dumps(self.report, indent=1)
