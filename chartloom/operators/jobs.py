"""Jobs given as rows, run by a function with one-time set-up for each task; results are rows.

A job that fails is a row with its status and message; a lost executor's jobs
run again elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def run_jobs(jobs: DataFrame, work: Callable, init: Callable | None = None, key: str = "job_index", parts: int | None = None) -> DataFrame:
    """(key, status, message): work(row) -> int for each row; init() runs first in each task.

    A status of 0 is success. An exception is status 1 and its text; a failing
    init fails all rows of the task.
    """
    kind = dict(jobs.dtypes)[key]

    def run(batches):
        import pandas as pd

        broken = None
        try:
            if init is not None:
                init()
        except Exception as e:  # noqa: BLE001 - any failure is reported as a row
            broken = f"init: {e}"
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                if broken is not None:
                    out.append((row[key], 1, broken))
                    continue
                try:
                    out.append((row[key], int(work(row) or 0), None))
                except Exception as e:  # noqa: BLE001
                    out.append((row[key], 1, str(e)))
            yield pd.DataFrame(out, columns=[key, "status", "message"])

    return (jobs.repartition(parts) if parts else jobs).mapInPandas(run, f"{key} {kind}, status int, message string")
