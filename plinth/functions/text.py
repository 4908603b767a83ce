"""String and key builders as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical_key(key: Column) -> Column:
    """The empty string and the marker of a missing key are null."""
    return F.when(key.isin("", "NO_GNAF"), F.lit(None)).otherwise(key)


def key_for_path(key: Column) -> Column:
    """SF-04."""
    return F.coalesce(F.nullif(key, F.lit("")), F.lit("NO_GNAF"))


def without_jpg(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)\.jpg$", "")


def capture_id(name: Column) -> Column:
    """SF-01: digits between _ and -; null if there are none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(name, r"\.jpg$", ""), r"_([0-9]+)-", 1), F.lit(""))


def object_names(name: Column, region: Column) -> Column:
    """SF-02: the names to try, in order."""
    stem = F.concat(without_jpg(name), F.lit(".jpg"))
    special = (region == "wagga") & name.contains("NoRoad")
    return F.when(special, F.array(F.replace(stem, F.lit("NoRoad.jpg"), F.lit("OutsideAOI.jpg")), stem)).otherwise(F.array(stem))


def clip_name(pano: Column, edge: Column, view: Column) -> Column:
    """SF-03."""
    return F.concat(without_jpg(pano), F.lit("_edge"), edge.cast("string"), F.lit("_"), view, F.lit(".jpg"))


def building_folder(id_: Column, building: Column, gnaf: Column) -> Column:
    return F.concat_ws("_", id_.cast("string"), building, key_for_path(gnaf))


def humanised(size: Column, last: str = "EB") -> Column:
    """SF-07: bytes with one decimal and the largest unit, up to last, that keeps it at 1 or more."""
    units = ["B", "KB", "MB", "GB", "TB", "PB", "EB"]
    top = units.index(last)
    out = F.concat(F.format_string("%.1f", F.bround(size / float(1024**top), 1)), F.lit(f" {last}"))
    for i in range(top - 1, -1, -1):
        out = F.when(size < float(1024 ** (i + 1)), F.concat(F.format_string("%.1f", F.bround(size / float(1024**i), 1)), F.lit(f" {units[i]}"))).otherwise(out)
    return out


def display_name(name: Column) -> Column:
    """SF-08."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def masked(secret: Column, shown: int = 4) -> Column:
    """SF-09: all but the last characters hidden."""
    return F.when(F.length(secret) <= shown, F.lit("****")).otherwise(F.concat(F.lit("****"), F.right(secret, F.lit(shown))))
