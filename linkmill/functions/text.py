"""Column expressions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkmill.fixed_values import FLOWER_SHARD_NAME


def parent_name(path: Column) -> Column:
    """Name of the directory that holds the file."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def base_name(path: Column) -> Column:
    """Name of the file itself."""
    return F.regexp_extract(path, r"([^/]+)$", 1)


def before_first(text: Column, mark: str) -> Column:
    """Text before the first ``mark``."""
    return F.substr(text, F.lit(1), F.instr(text, mark) - 1)


def after_first(text: Column, mark: str) -> Column:
    """Text after the first ``mark``."""
    return F.substr(text, F.instr(text, mark) + len(mark))


def label_line(label: Column, name: Column) -> Column:
    """``label:name``."""
    return F.concat_ws(":", label.cast("string"), name)


def shard_file(split: Column, shard: Column, shards: int) -> Column:
    """Name of one shard of one split."""
    return F.format_string(FLOWER_SHARD_NAME, split, shard, F.lit(shards))
