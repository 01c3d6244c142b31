"""Named places for tables and files, through Spark's file systems; file:, hdfs:, s3a: and others alike."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

KINDS = ("filesystem", "object")


class Store:
    """exists, read, write and list below a root URI."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def uri(self, path: str) -> str:
        if ".." in path.split("/"):
            raise ValueError(f"{path!r} leaves the store")
        return f"{self.root}/{path.lstrip('/')}"

    def _fs(self, uri: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(uri)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def exists(self, path: str) -> bool:
        fs, p = self._fs(self.uri(path))
        return fs.exists(p)

    def list(self, path: str = "") -> list[str]:
        """Files below a path, relative to the root, in order."""
        fs, p = self._fs(self.uri(path))
        if not fs.exists(p):
            return []
        base = fs.makeQualified(self._fs(self.root)[1]).toString().rstrip("/")
        out, it = [], fs.listFiles(p, True)
        while it.hasNext():
            out.append(it.next().getPath().toString()[len(base) + 1 :])
        return sorted(out)

    def binary(self, path: str = "") -> DataFrame:
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.uri(path))

    def table(self, path: str) -> DataFrame:
        return self.spark.read.parquet(self.uri(path))

    def save(self, df: DataFrame, path: str, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(self.uri(path))


def registry(spark: SparkSession, config: dict[str, dict[str, str]]) -> dict[str, Store]:
    """Stores of {name: {kind, root}}."""
    out = {}
    for name, c in config.items():
        if c.get("kind") not in KINDS:
            raise ValueError(f"store {name!r}: kind is one of {KINDS}")
        if not c.get("root"):
            raise ValueError(f"store {name!r}: no root")
        out[name] = Store(spark, c["root"])
    return out


def get(config: dict[str, Any], path: str, *default: Any) -> Any:
    """A dotted path of nested dicts; KeyError if it is missing and no default is given."""
    at: Any = config
    for part in path.split("."):
        if not isinstance(at, dict) or part not in at:
            if default:
                return default[0]
            raise KeyError(f"missing key: {path}")
        at = at[part]
    return at


def settings(defaults: dict[str, Any], given: dict[str, Any], checks: dict[str, Any] | None = None) -> dict[str, Any]:
    """defaults with what was given over them, nested; checks {path: test} must hold; _meta.fingerprint is a hash of it all."""

    def over(a, b):
        return {k: over(a[k], b[k]) if isinstance(a.get(k), dict) and isinstance(b.get(k), dict) else b.get(k, a.get(k)) for k in {**a, **b}}

    out = over(defaults, given)
    for path, test in (checks or {}).items():
        if not test(get(out, path, None)):
            raise ValueError(f"{path}: {get(out, path, None)!r} is not valid")
    out["_meta"] = {"fingerprint": hashlib.sha256(json.dumps(out, sort_keys=True).encode()).hexdigest()}
    return out


def load_settings(path: str, defaults: dict[str, Any], checks: dict[str, Any] | None = None) -> dict[str, Any]:
    """Settings from a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return settings(defaults, yaml.safe_load(f) or {}, checks)
