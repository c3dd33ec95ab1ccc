"""Text: keywords, photo stamps. All patterns are Unicode-aware."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sealstone.rules import DEALER, OFFICIAL_WORDS, SCAN, STORE

#: What marks a stamp segment as a time.
TIME_PARTS = (r"\d{1,2}:\d{2}", r"\d{4}[-–]\d{2}[-–]\d{2}", r"星期[一二三四五六日]")
CJK = r"[\x{4E00}-\x{9FFF}]"
CJK_SHARE = 0.4


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def contains_any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def keyword_hit(text: Column) -> Column:
    """The first seal keyword, by precedence, that a text contains; else null."""
    return F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in (SCAN, STORE)])


def keyword_cooccur(text: Column) -> Column:
    """1 if a photo's text has both the seal's and the dealer's keyword."""
    return (text.contains(SCAN) & text.contains(DEALER)).cast("int")


def joined(detections: Column) -> Column:
    return F.array_join(detections["text"], " ")


def photo_has_seal(detections: Column) -> Column:
    return F.exists(detections, lambda d: d["text"].contains(SCAN))


def dealer_only(detections: Column, length: int = 40) -> Column:
    """The first text, cut, if there are two texts or more and none is official; else null."""
    official = F.exists(detections, lambda d: contains_any(d["text"], OFFICIAL_WORDS))
    return F.when((F.size(detections) >= 2) & ~official, F.substring(F.get(detections, F.lit(0))["text"], 1, length))


def endpiece(text: Column) -> Column:
    t = F.lower(strip(text))
    return (t.contains("authorized") | t.contains("authorised")) & t.contains("reseller")


def _is_time(s: Column) -> Column:
    return reduce(lambda a, b: a | b, [s.rlike("(?U)" + p) for p in TIME_PARTS])


def _squeezed(parts: Column) -> Column:
    return strip(F.regexp_replace(F.array_join(parts, " "), r"(?U)\s+", " "))


def cjk_share(s: Column) -> Column:
    return F.regexp_count(s, F.lit(CJK)) / F.greatest(F.length(F.replace(s, F.lit(" "), F.lit(""))), F.lit(1))


def parse_stamp(segments: Column) -> Column:
    """A photo stamp's segments to struct(time, place); separators are dropped, and so are places with too few CJK characters."""
    parts = F.filter(F.transform(segments, strip), lambda s: (s != "") & ~s.rlike(r"(?U)^[|｜\s]+$"))
    time = F.transform(F.filter(parts, _is_time), lambda s: strip(F.regexp_replace(s, "[|｜]", " ")))
    place = F.filter(F.filter(parts, lambda s: ~_is_time(s)), lambda s: cjk_share(s) >= CJK_SHARE)
    return F.struct(_squeezed(time).alias("time"), _squeezed(place).alias("place"))


def number(v: Column, digits: int, signed: bool = False) -> Column:
    """A number with a fixed count of decimals, rounded by its exact binary value; only exact halves go to the even digit.

    Of the candidate below, n, the sign of 2 x scale x v - (2n + 1) decides: v is split into two halves whose products are exact.
    """
    scale = 10**digits

    def split(x: Column) -> Column:
        wide = x * 134217729.0
        high = wide - (wide - x)
        return F.struct(high.alias("high"), (x - high).alias("low"), F.floor(x * scale).cast("long").alias("n"))

    def rounded(x: Column) -> Column:
        n = x["n"]
        over = (x["high"] * (2 * scale) - (2 * n + 1)) + x["low"] * (2 * scale)
        return n + F.when((over > 0) | ((over == 0) & (n % 2 == 1)), 1).otherwise(0)

    def told(n: Column) -> Column:
        whole = (n - n % scale) / scale
        return F.concat(whole.cast("long").cast("string"), *([F.lit("."), F.lpad((n % scale).cast("string"), digits, "0")] if digits else []))

    sign = F.when(v < 0, "-").otherwise("+" if signed else "")
    return F.concat(sign, _let(_let(_let(F.abs(v.cast("double")), split), rounded), told))


def _let(value: Column, of) -> Column:
    return F.get(F.transform(F.array(value), of), F.lit(0))


def placed(x: Column, y: Column) -> Column:
    return F.concat(F.lit("rel_x="), number(x, 3), F.lit(", rel_y="), number(y, 3))
