"""Writers. Each takes a DataFrame and a path, and lets Spark write in parallel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_objects(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """CSV with exactly these columns, in order."""
    rows.select(*columns).write.mode(mode).option("header", True).csv(path)


def union_sorted(frames: list[DataFrame]) -> DataFrame:
    """All rows, with the sorted union of the frames' columns; a missing one is null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*sorted(out.columns))


def write_csv_union(frames: list[DataFrame], path: str) -> None:
    d = union_sorted(frames)
    write_csv(d, path, d.columns)


def append_status(rows: DataFrame, path: str) -> None:
    """Appends (doi, status, seconds, error) with the time of writing to a status log of JSON lines."""
    rows.withColumn("timestamp_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")).write.mode("append").json(path)


def write_raw_pages(pages: DataFrame, path: str) -> None:
    """Pages as they came, before any filter."""
    pages.write.mode("append").parquet(path)


def write_documents(parsed: DataFrame, path: str) -> None:
    """Parsed documents by kind: (doc, kind, ord, name, content) as partitioned Parquet."""
    parsed.write.mode("overwrite").partitionBy("kind").parquet(path)


def write_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Replaces just the partitions that the rows have."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_report(one: DataFrame, path: str) -> None:
    """A report of one text."""
    one.write.mode("overwrite").text(path)


def yaml_lines(config: dict, depth: int = 0) -> list[str]:
    """Nested settings as YAML text lines, keys in their order."""
    out = []
    for k, v in config.items():
        pad = "  " * depth
        if isinstance(v, dict) and v:
            out += [f"{pad}{k}:", *yaml_lines(v, depth + 1)]
        elif isinstance(v, list) and v:
            out += [f"{pad}{k}:", *[f"{pad}- {_scalar(x)}" for x in v]]
        else:
            out.append(f"{pad}{k}: {_scalar(v)}")
    return out


def _scalar(v) -> str:
    import json

    return "null" if v is None else json.dumps(v, ensure_ascii=False)
