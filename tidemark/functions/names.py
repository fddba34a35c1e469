"""Names: tables, applications, versions, places."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F


def table_name(template: str, topic: str) -> str:
    return template.replace("${topic}", topic)


def app_id(topic: str, partition: int, prefix: str = "sink") -> str:
    return f"{prefix}:{topic}:{partition}"


def app_id_column(topic: Column, partition: Column, prefix: str = "sink") -> Column:
    return F.format_string(f"{prefix}:%s:%d", topic, partition.cast("int"))


def version_name(version: int) -> str:
    return f"{version:020d}"


def commit_file(version: int) -> str:
    return f"{version_name(version)}.json"


def checkpoint_file(version: int) -> str:
    return f"{version_name(version)}.checkpoint.parquet"


def scheme(path: str) -> str:
    """Lower-cased scheme of a path; none, or a path that cannot be read as an address, is a file."""
    try:
        return urlsplit(path).scheme.lower() or "file"
    except ValueError:
        return "file"


def container_and_path(path: str) -> tuple[str, str]:
    """Container and base path of scheme://container@account/path, or of scheme://container/path."""
    parts = urlsplit(path)
    container = parts.netloc.split("@")[0]
    if not container:
        raise ValueError(f"no container in '{path}'")
    return container, parts.path.strip("/")
