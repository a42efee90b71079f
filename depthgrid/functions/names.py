"""Column expressions that read keys out of file names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_folder(path: Column, levels: int = 1) -> Column:
    """Name of the folder ``levels`` above the file; the path must be that deep."""
    return F.substring_index(F.substring_index(path, "/", -1 - levels), "/", 1)


def without(name: Column, part: Column) -> Column:
    return F.replace(name, part, F.lit(""))


def period_of(name: Column, huc8: Column) -> Column:
    """Return period in an estimate's file name: drop ``_{huc8}_depth.tif``, then ``.tif``."""
    return without(without(name, F.concat(F.lit("_"), huc8, F.lit("_depth.tif"))), F.lit(".tif"))


def group_label(*keys: Column) -> Column:
    """Keys joined with an underscore, as in ``{huc8}_{return_period}``."""
    return F.concat_ws("_", *keys)
