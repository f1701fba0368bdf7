"""Names, numbers and table text, as column expressions."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_concept(c: Column, ordinals: bool = True) -> Column:
    """A concept's name in lower case without signs; spelt-out tiers become digits."""
    out = F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    return F.regexp_replace(F.regexp_replace(out, "tierone", "tier1"), "tiertwo", "tier2") if ordinals else out


def canonical_name(c: Column) -> Column:
    """A firm's name in capitals without signs: spellings of one firm agree."""
    return F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", ""))


def blank_name(c: Column) -> Column:
    """True for names that are null or nothing but signs."""
    return F.coalesce(canonical_name(c) == "", F.lit(True))


def accession_no_dash(c: Column) -> Column:
    return F.regexp_replace(c, "-", "")


def accession_dashed(c: Column) -> Column:
    """18 digits as ten, two and six with dashes; anything else is null."""
    plain = accession_no_dash(c)
    return F.when(plain.rlike("^[0-9]{18}$"), F.regexp_replace(plain, "^([0-9]{10})([0-9]{2})([0-9]{6})$", "$1-$2-$3"))


def cik10(c: Column) -> Column:
    """A positive number of at most ten digits, padded with zeros; else an error."""
    n = c.cast("string").try_cast("long")
    ok = F.coalesce(n.between(1, 9_999_999_999), F.lit(False))
    return F.when(ok, F.lpad(n.cast("string"), 10, "0")).otherwise(F.raise_error(F.concat(F.lit("not a CIK: "), F.coalesce(c.cast("string"), F.lit("null")))))


def number(c: Column) -> Column:
    """Text of a table cell as a decimal: commas, blanks and currency signs go, parentheses mean minus."""
    bare = F.regexp_replace(c, r"[\s ,$€£%]", "")
    minus = bare.rlike(r"^\(.*\)$")
    value = F.regexp_replace(bare, "[()]", "").try_cast("decimal(38,6)")
    return F.when(minus, -value).otherwise(value)


#: Powers of ten by scale, exact; wide enough for what filings use.
SCALES = {s: f"1{'0' * s}" for s in range(13)}


def scaled_inline_value(text: Column, scale: Column, sign: Column) -> Column:
    """An inline number times ten to its scale, minus if the sign says so or it stands in parentheses; exact.
    Text that is no number passes as null; a missing scale is 0, a negative one divides."""
    s = F.coalesce(scale.cast("int"), F.lit(0))
    up = F.element_at(F.create_map(*[x for k, v in SCALES.items() for x in (F.lit(k), F.lit(v).cast("decimal(18,0)"))]), F.abs(s))
    base = number(text).cast("decimal(20,6)")
    value = F.when(s >= 0, (base * up).cast("decimal(38,6)")).otherwise((base / up).cast("decimal(38,6)"))
    return F.when(F.coalesce(sign, F.lit("")) == "-", -value).otherwise(value)


def dimensions(c: Column) -> Column:
    """``axis=member;axis=member`` as a map; blank as an empty one."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.create_map().cast("map<string,string>")).otherwise(F.str_to_map(c, F.lit(";"), F.lit("=")))


def plain_text(html: Column) -> Column:
    """Visible text: scripts, styles and inline headers go, tags and entities of blanks become blanks."""
    out = F.regexp_replace(html, r"(?is)<(script|style|ix:header)\b.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    out = F.regexp_replace(out, r"(?i)&(nbsp|#160|#xa0|#8201|#8194|#8195|#x2009);|[\u00A0\u2002\u2003\u2009]", " ")
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(out, "(?i)&amp;", "&"), "(?i)&lt;", "<"), "(?i)&gt;", ">")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def segment(text: Column, anchor: str, length: int = 5000) -> Column:
    """``length`` characters from the first place of the anchor on; null without one."""
    at = F.locate(anchor, F.lower(text))
    return F.when(at > 0, F.substring(text, at, F.lit(length)))


def numbers_in(text: Column) -> Column:
    """All numbers of a text in order, as doubles."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?[0-9][0-9,]*(?:\.[0-9]+)?)")), lambda x: F.regexp_replace(x, ",", "").cast("double"))


def every_other(array: Column) -> Column:
    """The elements at even places: values where values and changes alternate."""
    return F.filter(array, lambda x, i: i % 2 == 0)


def best_identity(array: str) -> Column:
    """Of the six readings (a, b, c) of three numbers the one with least relative error of c = b * a / 100."""
    def reading(a: int, b: int, c: int) -> Column:
        v = F.col(array)
        err = F.when(v[c] > 0, F.abs(v[c] - v[b] * v[a] / 100) / v[c])
        return F.struct(err.isNull().alias("none"), err.alias("err"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c"))

    return F.array_min(F.array(*[reading(*p) for p in permutations(range(3))]))


def quote_around(text: Column, pattern: str, before: int = 80, length: int = 240) -> Column:
    """A stretch of text around the first match, as evidence; null without one."""
    hit = F.regexp_extract(text, f"((?i:{pattern}))", 1)
    at = F.instr(text, hit)
    return F.when(hit != "", F.substring(text, F.greatest(F.lit(1), at - before), F.lit(length)))


def companyfacts_label(unit: Column, frame: Column) -> Column:
    """The context of a company fact: ``companyfacts:unit:frame``; a fact without a frame ends in the colon."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.concat_ws(":", F.lit("companyfacts"), blank(unit), blank(frame))
