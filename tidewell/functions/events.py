"""Column expressions for keys, times and positions as they are written in event and shop tables.

All are JVM expressions; null in gives null out, and what can't be read gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "０１２３４５６７８９．，＝"
NARROW = "0123456789.,="


def strip(c: Column) -> Column:
    """Without surrounding white space of any kind; blank becomes null."""
    plain = F.regexp_replace(c, r"(?U)^[\s​﻿]+|[\s​﻿]+$", "")
    return F.nullif(F.when(c.rlike(r"^[!-~]+$"), c).otherwise(plain), F.lit(""))


def shop_key(c: Column) -> Column:
    """A shop number without label, wide digits, decimal tail and leading zeros; a text that holds no number stays as it is."""
    text = strip(c)
    number = F.regexp_extract(F.regexp_replace(F.translate(text, WIDE, NARROW), r"(?U)\s", ""), r"(?i)^(?:shop_?id[=:])?0*([1-9][0-9]*)(?:\.0*)?$", 1)
    return F.when(text.rlike("^[1-9][0-9]*$"), text).when(number != "", number).otherwise(text)


def epoch_ms(c: Column) -> Column:
    """Milliseconds of a time that is in ms or, below 10^12, in seconds."""
    return F.when(c < 10**12, c * 1000).otherwise(c)


def event_name(c: Column) -> Column:
    """An event's name without case, white space and punctuation."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def _degrees(text: Column) -> Column:
    """Degrees of one coordinate that isn't a plain number: with hemisphere or degree sign, in degrees, minutes and seconds,
    with a decimal comma, in wide digits, or as whole millionths."""
    t = F.upper(F.regexp_replace(F.translate(text, WIDE + "′″’”－", NARROW + "'\"'\"-"), r"(?U)\s+", ""))
    dms = r"^[ENWS]?(\d{1,3})°(\d{1,2})'(\d{1,2}(?:\.\d+)?)(?:\"|'')?[ENWS]?$"
    take = lambda i: F.regexp_extract(t, dms, i).try_cast("double")
    plain = F.translate(F.regexp_extract(t, r"^[ENWS]?([-+]?\d{1,3}(?:[.,]\d+)?)°?[ENWS]?$", 1), ",", ".").try_cast("double")
    whole = F.regexp_extract(t, r"^[ENWS]?(\d{7,9})[ENWS]?$", 1).try_cast("double") / 1e6
    size = F.coalesce(plain, take(1) + take(2) / 60 + take(3) / 3600, whole)
    return F.when(t.rlike("[WS]"), -size).otherwise(size)


def position(lng: Column, lat: Column, lng_range=(90.0, 130.0), lat_range=(15.0, 50.0)) -> Column:
    """struct(lng, lat) in degrees if both can be told from the two texts, else null.

    Texts in each other's place are put right where the ranges tell which is which. The ranges must not overlap.
    """

    def read(c: Column) -> Column:
        fast = c.try_cast("double")
        return F.when(fast.between(-180, 180), fast).otherwise(_degrees(c))

    x, y = read(lng), read(lat)
    both = F.struct(x.alias("x"), y.alias("y"))
    pick = lambda p: F.when(p.x.between(*lng_range) & p.y.between(*lat_range), F.struct(p.x.alias("lng"), p.y.alias("lat"))).when(p.y.between(*lng_range) & p.x.between(*lat_range), F.struct(p.y.alias("lng"), p.x.alias("lat")))
    return F.when(lng.isNotNull() & lat.isNotNull(), F.element_at(F.transform(F.array(both), lambda p: pick(p)), 1))
