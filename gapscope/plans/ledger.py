"""A job's finished steps, recorded in the shared folder, so that a job that is run again goes on where it failed."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import SparkSession

from .. import files


class Ledger:
    """One small file for each finished step: what it was made from, what it made, and its result.

    A step counts as done if its record names the same inputs and all its outputs
    are there; what it was made from includes the records of the steps before it, so
    a step that runs again makes those after it run again.  An output is removed
    before a step tries to make it: what a failed attempt left is never read.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ran: list[str] = []
        self.kept: list[str] = []

    def _path(self, step: str) -> str:
        return f"{self.folder}/{re.sub(r'[^A-Za-z0-9_.-]', '-', step)}.json"

    def run(self, step: str, do: Callable[[], dict[str, Any]], inputs: dict[str, Any], outputs: Iterable[str] = (),
            after: Iterable[dict[str, Any]] = (), retries: int = 0, delay: float = 0.0) -> dict[str, Any]:
        """The step's result: as recorded, or of running ``do`` (up to ``retries`` times more, ``delay`` seconds apart).

        ``inputs`` and the result must be JSON values; the result gets the key ``record``.  ``outputs`` are paths
        known beforehand; further ones that have to be there for the step to count as done are the result's ``made``.
        """
        outputs = list(outputs)
        made_from = json.loads(json.dumps({"inputs": inputs, "after": [a["record"] for a in after]}))
        text = files.read_text(self.spark, self._path(step))
        known = json.loads(text) if text else None
        if known and known["made_from"] == made_from and all(files.exists(self.spark, o) for o in [*known["outputs"], *known["result"].get("made", [])]):
            self.kept.append(step)
            return known["result"]
        files.delete(self.spark, self._path(step))
        for attempt in range(retries + 1):
            for output in outputs:
                files.delete(self.spark, output)
            try:
                result = do()
                break
            except Exception:  # noqa: BLE001 - tried again, raised in the end
                if attempt == retries:
                    raise
                time.sleep(delay)
        result = json.loads(json.dumps({**result, "record": uuid.uuid4().hex}))
        files.write_text(self.spark, self._path(step), json.dumps({"made_from": made_from, "outputs": outputs, "result": result}))
        self.ran.append(step)
        return result
