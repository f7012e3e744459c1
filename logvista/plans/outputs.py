"""Files that an analysis leaves behind: tables as CSV and documents as JSON."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling as P
from ..operators import stats as T
from ..operators import validate as V
from .release import file_hashes, write_json
from .schema import FORBIDDEN_PUBLIC


def write_table(df: DataFrame, path: str, order: list | None = None) -> None:
    """A small table as one CSV part with a header, in ``order``."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").options(header=True, nullValue="", emptyValue="").csv(path)


def write_odds_ratios(df: DataFrame, flags: list[str], label: str, path: str) -> None:
    """The table of odds ratios of ``flags``, the largest first."""
    write_table(T.odds_table(df, flags, label), path, [F.desc("odds_ratio"), "flag"])


def write_results(spark: SparkSession, results: dict[str, dict], path: str) -> None:
    """A row a model (``benchmark``, ``ablation``), with all its numbers, in the order in which they were made."""
    names = list(dict.fromkeys(k for r in results.values() for k in r))
    rows = [(i, name, *(None if r.get(k) is None else float(r[k]) for k in names)) for i, (name, r) in enumerate(results.items())]
    schema = "place int, model string, " + ", ".join(f"`{k}` double" for k in names)
    write_table(spark.createDataFrame(rows, schema), path, ["place"])


def write_gains(spark: SparkSession, gains: list[tuple[str, float, float, float]], path: str) -> None:
    write_table(spark.createDataFrame(gains, "model string, original double, tuned double, gain double"), path)


def write_sample(sample: DataFrame, path: str) -> None:
    """A sample in parts whose rows follow each other by actor, number in the sequence and id."""
    columns = sample.columns
    P.in_sample_order(sample).orderBy("position").select(*columns).write.mode("overwrite").options(header=True, nullValue="", emptyValue="").csv(path)


def written_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A written restricted release (Parquet) with ``line``, the place of each row over all its parts."""
    back = spark.read.parquet(folder).select("event_time", "event_id", F.col("_metadata.file_name").alias("file_"), F.monotonically_increasing_id().alias("at_"))
    return P.number_rows(back, [F.col("file_"), F.col("at_")], "line")


def read_manifest(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def validate_release(spark: SparkSession, public: DataFrame, restricted: DataFrame, manifest: dict, folders: dict[str, str], out: str | None = None) -> dict:
    """All checks of a written release against its manifest; ``status`` is PASS or FAIL, and ``failed`` says by what.

    ``folders`` are where the written tables are, by the names that the manifest gives them under ``sha256``. The report is
    written to ``out``.
    """
    report = V.report(restricted, public, manifest["public_columns"])
    found = {name: file_hashes(spark, folder) for name, folder in folders.items()}
    report["out_of_order"] = V.out_of_order(written_lines(spark, folders["restricted"]), "line") if "restricted" in folders else None
    failed = [k for k in ("schema",) if report[k]] + [k for k in ("public_differs", "recomputed_differs", "hours_backwards", "out_of_order") if report[k]]
    failed += [f"invariant {k}" for k, n in report["invariants"].items() if n]
    failed += [f"hash {name}" for name, files in found.items() if manifest["sha256"].get(name) != files]
    failed += [f"forbidden {c}" for c in V.forbidden(public, FORBIDDEN_PUBLIC)]
    failed += ["rows"] if report["rows"] != manifest["events"] else []
    failed += ["restricted columns"] if restricted.columns != manifest["restricted_columns"] else []
    report |= {"status": "FAIL" if failed else "PASS", "failed": failed}
    if out:
        write_json(report, out)
    return report
