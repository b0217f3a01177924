"""Code tables of the fixed-width records (P18) as literal map lookups (no UDF,
no join: each table is a handful of entries)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables of the record format, in natural order.
COURSES = {"01": "札幌", "02": "函館", "03": "福島", "04": "新潟", "05": "東京",
           "06": "中山", "07": "中京", "08": "京都", "09": "阪神", "10": "小倉"}
GROUND = {"1": "良", "2": "稍重", "3": "重", "4": "不良"}
WEATHER = {"1": "晴", "2": "曇", "3": "雨", "4": "小雨", "5": "雪", "6": "小雪"}
SEX = {"1": "牡", "2": "牝", "3": "セ"}
TURF, DIRT, JUMP = "芝", "ダート", "障害"
RIGHT, LEFT = "右", "左"


def lookup(code: Column, table: dict, keep_unknown: bool = False) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    v = F.try_element_at(m, code) if not keep_unknown else F.coalesce(F.try_element_at(m, code), code)
    return F.when(code.isNotNull(), v)


def course_name(code: Column) -> Column:
    """Known course codes map to names, unknown codes stay as they are."""
    return lookup(code, COURSES, keep_unknown=True)


def surface(track: Column) -> Column:
    """Track code: 1x/2x turf, 3x dirt, 5x/6x jumps; blank, 00 or other -> null."""
    first = F.substring(track, 1, 1)
    return (F.when(track.isNull() | (track == "") | (track == "00"), F.lit(None).cast("string"))
             .when(first.isin("1", "2"), TURF).when(first == "3", DIRT).when(first.isin("5", "6"), JUMP))


def direction(track: Column) -> Column:
    """Track codes 11-19 run right-handed, 21-29 left-handed."""
    return (F.when(track.rlike("^1[1-9]$"), RIGHT).when(track.rlike("^2[1-9]$"), LEFT))
