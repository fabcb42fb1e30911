"""Corpus readers: JSON lines, text, Parquet, tables and mixed directories."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CORRUPT = "_corrupt_record"


def read_corpus_jsonl(spark: SparkSession, path: str | list[str], key: str = "text") -> DataFrame:
    """One row per JSON line with a non-null ``key``; other lines are dropped."""
    rows = spark.read.schema(f"`{key}` string, {_CORRUPT} string").json(path, mode="PERMISSIVE")
    return rows.where(F.col(_CORRUPT).isNull() & F.col(f"`{key}`").isNotNull()).select(f"`{key}`")


def read_corpus_text(spark: SparkSession, path: str | list[str], key: str = "text") -> DataFrame:
    """One row per line."""
    return spark.read.text(path).withColumnRenamed("value", key)


def read_corpus_parquet(spark: SparkSession, path: str | list[str], key: str = "text") -> DataFrame:
    """The text column of Parquet files or directories."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.parquet(*paths).select(f"`{key}`")


READERS = {
    ".jsonl": read_corpus_jsonl,
    ".txt": read_corpus_text,
    ".parquet": read_corpus_parquet,
}


# Codecs that Spark's line readers undo by the file's name.
CODECS = (".gz", ".bz2", ".zst", ".deflate", ".lz4", ".snappy")


def _suffix(path: str) -> str | None:
    """The reader's suffix, which a codec's may follow if the format is one of lines."""
    name = path.rstrip("/")
    plain = next((name.removesuffix(c) for c in CODECS if name.endswith(c)), name)
    found = next((s for s in READERS if plain.endswith(s)), None)
    return None if found == ".parquet" and plain != name else found


def _children(spark: SparkSession, path: str) -> tuple[bool, list[tuple[str, bool]]]:
    """Whether a path is a directory, and its visible entries as ``(path, is directory)``."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(where):
        raise FileNotFoundError(f"no such corpus file or directory: {path}")
    if fs.getFileStatus(where).isFile():
        return False, []
    entries = [(e.getPath().toString(), e.isDirectory()) for e in fs.listStatus(where)]
    return True, sorted(e for e in entries if not re.match(r"[._]", e[0].rsplit("/", 1)[-1]))


def _is_dataset(entries: list[tuple[str, bool]]) -> bool:
    """A directory of Parquet files only, or partitioned by directories."""
    return bool(entries) and all(
        p.endswith(".parquet") and not is_dir or is_dir and "=" in p.rsplit("/", 1)[-1]
        for p, is_dir in entries
    )


def read_corpus(spark: SparkSession, path: str, key: str = "text") -> DataFrame:
    """Read by suffix, or else a dataset directory, or a mixed directory one level deep.

    A mixed directory is one read per format, put together by ``unionByName``. Files of
    other kinds and directories that are no dataset are passed over.
    """
    is_dir, entries = _children(spark, path)
    suffix = _suffix(path)
    if suffix is not None:
        return READERS[suffix](spark, path, key)
    if not is_dir:
        raise ValueError(f"unknown corpus file type: {path}; use one of {sorted(READERS)}")
    if _is_dataset(entries):
        return read_corpus_parquet(spark, path, key)
    found: dict[str, list[str]] = {}
    for child, child_is_dir in entries:
        suffix = _suffix(child)
        if suffix is None and child_is_dir and _is_dataset(_children(spark, child)[1]):
            suffix = ".parquet"
        if suffix is not None:
            found.setdefault(suffix, []).append(child)
    if not found:
        raise ValueError(f"no corpus files in {path}")
    parts = []
    for suffix, paths in sorted(found.items()):
        if suffix == ".parquet":
            parts += [read_corpus_parquet(spark, p, key) for p in paths]
        else:
            parts.append(READERS[suffix](spark, paths, key))
    return reduce(DataFrame.unionByName, parts)


def read_corpus_table(spark: SparkSession, name: str, key: str = "text") -> DataFrame:
    """The text column of a named table."""
    return spark.read.table(name).select(f"`{key}`")


def convert_corpus(spark: SparkSession, source: str, target: str, key: str = "text") -> DataFrame:
    """Write a JSON lines corpus as Parquet; gives the written corpus."""
    read_corpus_jsonl(spark, source, key).write.parquet(target)
    return read_corpus_parquet(spark, target, key)
