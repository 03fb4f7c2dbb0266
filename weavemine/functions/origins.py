"""Column functions over where things come from: dates as programs write them, ids that carry their maker, labels and locators."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Hours east of UTC of the short zone names in Java's dates.
ZONES = {"UTC": 0, "GMT": 0, "WET": 0, "BST": 1, "WEST": 1, "CET": 1, "CEST": 2, "MET": 1, "MEST": 2, "EET": 2, "EEST": 3, "MSK": 3, "IST": 5.5, "JST": 9, "KST": 9, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13, "HST": -10, "AKST": -9, "AKDT": -8, "PST": -8, "PDT": -7, "MST": -7, "MDT": -6, "CST": -6, "CDT": -5, "EST": -5, "EDT": -4}
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
JAVA_DATE = r"(?m)^#(\w{3}) (\w{3}) ([ \d]\d) (\d\d:\d\d:\d\d) (\S+) (\d{4})\s*$"
EXTENSION = r"(?i)\.(mdzipx?|mdxml|xmi|xml|uml|zip|rdzip)$"


def _lookup(key: Column, values: dict) -> Column:
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def java_date(head: Column) -> Column:
    """struct(iso, raw): the first date of a properties file; with an offset where the zone is known, iso null where it is no date."""
    part = lambda k: F.regexp_extract(head, JAVA_DATE, k)
    month = _lookup(part(2), {m: f"{k + 1:02d}" for k, m in enumerate(MONTHS)})
    day = F.concat_ws("-", part(6), month, F.lpad(F.trim(part(3)), 2, "0"))
    local = F.concat(day, F.lit("T"), part(4))
    valid = month.isNotNull() & F.try_to_timestamp(F.replace(local, F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    offset = _lookup(part(5), {z: f"{'-' if h < 0 else '+'}{int(abs(h)):02d}:{int(abs(h) % 1 * 60):02d}" for z, h in ZONES.items()})
    raw = F.concat_ws(" ", part(1), part(2), part(3), part(4), part(5), part(6))
    there = part(6) != ""
    return F.struct(F.when(there & valid, F.concat(local, F.coalesce(offset, F.lit("")))).alias("iso"), F.when(there, raw).alias("raw"))


def utc_text(iso: Column) -> Column:
    """An ISO time in UTC without its offset; a time without an offset is taken as it is."""
    offset = F.regexp_extract(iso, r"([+-]\d\d:\d\d)$", 1)
    moved = F.to_utc_timestamp(F.to_timestamp(F.replace(F.regexp_replace(iso, r"([+-]\d\d:\d\d)$", ""), F.lit("T"), F.lit(" "))), offset)
    return F.when(offset != "", F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(iso)


def iso_day(day: Column) -> Column:
    """Days since 1970 as a date; 0 and null are none."""
    return F.when(day != 0, F.date_from_unix_date(day).cast("string"))


def id_marks(xid: Column) -> Column:
    """struct(maker, ms): who made an element and when, where its id's shape tells."""
    t = F.split(F.regexp_replace(xid, "^_+", ""), "_")
    back = lambda k: F.try_element_at(t, F.lit(-k))
    number = lambda c: c.rlike(r"^\d+$")
    time = lambda c: c.rlike(r"^\d{12,13}$")
    versions = F.forall(F.slice(t, F.lit(1), F.greatest(F.size(t) - 4, F.lit(0))), lambda x: x.rlike(r"^\d+x?$"))
    made = (F.size(t) >= 5) & time(back(3)) & back(4).rlike("^[0-9a-f]{4,8}$") & number(back(2)) & number(back(1)) & versions
    old = (F.size(t) == 4) & time(F.get(t, F.lit(1))) & number(F.get(t, F.lit(2))) & number(F.get(t, F.lit(3)))
    ms = F.when(made, back(3)).when(old, F.get(t, F.lit(1))).cast("long")
    return F.struct(F.when(made, back(4)).alias("maker"), ms.alias("ms"))


def _blake2b(xid: pd.Series) -> pd.Series:
    return xid.map(lambda x: None if x is None else int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True)).astype("Int64")


def id_hash(xid: Column) -> Column:
    """The 64-bit BLAKE2b of an id, as a signed number (no built-in function computes it)."""
    return F.pandas_udf(_blake2b, LongType())(xid)


def short_id(sha: Column) -> Column:
    return F.substring(F.regexp_replace(sha, "^sha256:", ""), 1, 8)


def chunk_ref(project: Column, chunk: Column) -> Column:
    return F.concat(short_id(project), F.lit(":"), F.substring(chunk, 1, 12))


def project_label(name: Column, sha: Column, most: int = 32) -> Column:
    """The start of a file's name, cut at a separator, and the project's short id."""
    stem = F.regexp_replace(name, EXTENSION, "")
    head = F.substring(stem, 1, most)
    at = F.char_length(F.regexp_extract(head, "(?s)^(.*)[ _.-]", 1))
    cut = F.regexp_replace(F.when(head.rlike("[ _.-]") & (at > most // 2), F.substring(head, F.lit(1), at)).otherwise(head), "[ _.-]+$", "")
    return F.concat(F.when(F.char_length(stem) > most, F.concat(cut, F.lit("…"))).otherwise(stem), F.lit(" ["), short_id(sha), F.lit("]"))


def locator(sha: Column, entry: Column, xid: Column, line: Column) -> Column:
    """Content, archive entry, element and line in one string; missing parts are left out."""
    part = lambda mark, c: F.when(F.coalesce(c.cast("string"), F.lit("")).isin("", "0"), "").otherwise(F.concat(F.lit(mark), c.cast("string")))
    return F.concat(F.lit("sha256:"), F.substring(sha, 1, 16), part("!", entry), part("#", xid), part("@L", line))


def found_place(path: Column, chain: Column, metadata: Column, missing: Column) -> Column:
    """Where a content was found: file name and archive chain, its metadata, and whether the input is gone."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    meta = F.array_join(F.transform(F.map_entries(metadata), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", ")
    place = F.concat(F.lit("`"), F.array_join(F.concat(F.array(name), chain), "!"), F.lit("`"))
    return F.concat(place, F.when(meta != "", F.concat(F.lit(" ("), meta, F.lit(")"))).otherwise(""), F.when(missing, " (input missing)").otherwise(""))


def folder_of(path: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(path, "!.*$", ""), "^(.*)/", 1)


def omg_name(uri: Column) -> Column:
    """The readable part of a standard library's reference; null for others."""
    fragment, base = F.substring_index(uri, "#", -1), F.regexp_extract(uri, "^(.*)#", 1)
    library = F.regexp_extract(base, r"/(\w+)\.xmi$", 1)
    old = F.regexp_replace(F.substring_index(fragment, "-", -1), "_PackageableElement$", "")
    root = F.when(library != "", library).otherwise(fragment)
    name = F.when(fragment.startswith("_SysML_Libraries"), old).when(fragment.isin("", "_0"), root).otherwise(F.substring_index(fragment, ".", -1))
    return F.when(F.contains(uri, F.lit("omg.org/spec/")) & F.contains(uri, F.lit("#")), name)


def library_name(base: Column) -> Column:
    """A standard library's name and version; null for others."""
    part = lambda k: F.regexp_extract(base, r"omg\.org/spec/([^/]+)/([^/]+)/(\w+)\.xmi$", k)
    spec = F.when(part(3) == part(1), "OMG").otherwise(F.concat(F.lit("OMG "), part(1)))
    return F.when(part(1) != "", F.concat(part(3), F.lit(" ("), F.when(part(3) == part(1), F.lit("OMG, ")).otherwise(F.concat(spec, F.lit(", "))), part(2), F.lit(")")))


def external_label(reference: Column, known: Column | None = None) -> Column:
    """How a reference outside the project reads: a known name, a library's, else its id's last part."""
    names = [omg_name(reference), F.substring_index(reference, "#", -1)]
    return F.coalesce(*([F.nullif(known, F.lit(""))] if known is not None else []), *names)
