"""Publishing a set of tables so that readers see all of one run or none of it.

Layout: ``<base>/version=<n>/<table>`` and ``<base>/manifests/<n>``. A run
writes all its tables into the folder of the next number, which no reader
looks at, and then the manifest of that number, by renaming a finished file.
Readers take the newest manifest, so a run that is killed anywhere before the
rename leaves the set of the run before as it was. A second run that takes the
same number at the same time finds its manifest there and raises.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..streaming.days import _path, folders, path_exists, remove


def _numbers(spark: SparkSession, base: str) -> list[int]:
    p, fs = _path(spark, f"{base}/manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def current_version(spark: SparkSession, base: str) -> int | None:
    """The number of the newest complete set, None before the first."""
    return next(reversed(_numbers(spark, base)), None)


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict[str, str]:
    """Table -> folder of a complete set, the newest one by default."""
    version = current_version(spark, base) if version is None else version
    if version is None:
        raise FileNotFoundError(f"nothing is published below {base}")
    text = spark.read.text(f"{base}/manifests/{version}", wholetext=True).first()[0]
    return {name: f"{base}/version={version}/{folder}" for name, folder in json.loads(text).items()}


def read_published(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the newest complete set. Take ``version`` from ``current_version`` to read several of one run."""
    return spark.read.parquet(manifest(spark, base, version)[name])


def publish_version(spark: SparkSession, base: str, write: Callable[[str], dict[str, str]], keep: int = 2) -> int:
    """Run ``write(folder)``, which writes tables below ``folder`` and returns table -> path, and
    make them the current set; its number. The newest ``keep`` sets stay for readers that
    still use them, older ones and what killed runs left are removed.
    """
    done = _numbers(spark, base)
    started = [int(n) for n in folders(spark, base, "version=")]
    version = max([*done, *started, 0]) + 1
    folder = f"{base}/version={version}"
    paths = write(folder)
    outside = [p for p in paths.values() if not p.startswith(folder + "/")]
    if outside:
        raise ValueError(f"written outside of the version's folder: {outside}")
    final, fs = _path(spark, f"{base}/manifests/{version}")
    part, _ = _path(spark, f"{base}/manifests/_{version}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps({n: p[len(folder) + 1:] for n, p in paths.items()}).encode()))
    out.close()
    if path_exists(spark, f"{base}/manifests/{version}") or not fs.rename(part, final):
        raise RuntimeError(f"version {version} of {base} was published by another run")
    kept = [*done, version][-max(1, keep):]
    for n in done:  # manifests first: no reader finds a set that is being removed
        if n not in kept:
            remove(spark, f"{base}/manifests/{n}")
    for n in started:
        if n not in kept:
            remove(spark, f"{base}/version={n}")
    return version
