"""Expressions on upload paths ``customer/entity/yyyy-MM-dd/file``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlake.contracts import MARKER

ZONES = ("bronze", "silver", "gold")


def is_marker(path: Column) -> Column:
    """True for the file that ends a complete upload."""
    return path.endswith(MARKER)


def upload_folder(path: Column) -> Column:
    """Path without its file name."""
    return F.regexp_replace(path, "/[^/]*$", "")


def parse_upload_path(path: Column) -> dict[str, Column]:
    """Customer, entity, date and file name, counted from the end of the path."""
    parts = F.split(path, "/")
    return {
        "customer": F.try_element_at(parts, F.lit(-4)),
        "entity": F.try_element_at(parts, F.lit(-3)),
        "upload_date": F.try_to_date(F.try_element_at(parts, F.lit(-2)), "yyyy-MM-dd"),
        "file": F.try_element_at(parts, F.lit(-1)),
    }


def data_glob(path: Column, pattern: str = "*.json") -> Column:
    """The glob of the data files that a marker path stands for."""
    return F.replace(path, F.lit(MARKER), F.lit(pattern))


def staging_name(path: Column) -> Column:
    """Name of the staging table of one upload."""
    return F.translate(F.replace(path, F.lit("/" + MARKER), F.lit("")), "/-", "__")


def staging_name_of(marker_path: str) -> str:
    return marker_path.removesuffix("/" + MARKER).replace("/", "_").replace("-", "_")


def upload_name(marker_path: str) -> str:
    """``customer/entity/yyyy-MM-dd`` of a marker's path, whatever stands before it."""
    return "/".join(marker_path.split("/")[-4:-1])


def relative_marker(path: Column) -> Column:
    """``customer/entity/yyyy-MM-dd/end_file.txt`` of a marker's path or URI."""
    return F.regexp_extract(path, rf"([^/]+/[^/]+/[^/]+/{MARKER})$", 1)


def zone_path(root: str, zone: str, customer: str, entity: str) -> str:
    """``{root}/{zone}/{customer}/{entity}``; upload and day are partitions below it."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    return f"{root.rstrip('/')}/{zone}/{customer}/{entity}"


def zone_path_column(root: str, zone: str, customer: Column, entity: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit(zone), customer, entity)
