"""Fields of partition paths, segment names and object keys."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def safe(name: str) -> str:
    """A path component that can't leave its folder."""
    if not _SAFE.fullmatch(name) or ".." in name:
        raise ValueError(f"not a plain path component: {name!r}")
    return name


def unix(path: Column) -> Column:
    """Forward slashes, no empty or ``.`` components."""
    s = F.regexp_replace(path, r"\\", "/")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "/+", "/"), r"(/\.)+(?=/)", ""), r"^\./", "")


def hive(path: Column, key: str) -> Column:
    """The value of ``key=value`` in a path of either style; null if there is none."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|[/\\]){key}=([^/\\]+)", 1), F.lit(""))


def node(path: Column) -> Column:
    return F.coalesce(hive(path, "node"), F.lit("DEFAULT"))


def canonical_key(key: Column) -> Column:
    """The key without a legacy ``l1/`` in front, with ``node=DEFAULT`` after the date or hour where no node is given."""
    s = F.regexp_replace(unix(key), "^l1/", "")
    bare = ~s.contains("/node=")
    return F.when(bare, F.regexp_replace(s, r"(/date=[^/]+(?:/hour=[^/]+)?)/", "$1/node=DEFAULT/")).otherwise(s)


def segment_fields(name: Column) -> dict[str, Column]:
    """Start instant and node of ``segment-<ts>-<node>.ndjson[.sealed[.compacted]]``, and its state."""
    p = r"segment-(\d{8}T\d{6}Z?|\d+)-([^.]+)\.ndjson"
    return {
        "segment_ts": F.nullif(F.regexp_extract(name, p, 1), F.lit("")),
        "node_id": F.nullif(F.regexp_extract(name, p, 2), F.lit("")),
        "state": F.when(name.endswith(".ndjson.sealed.compacted"), "compacted").when(name.endswith(".ndjson.sealed"), "sealed").when(name.endswith(".ndjson"), "active"),
    }
