"""Secrets by sliding-window Shannon entropy, in built-in functions only.

Strict patterns give the base spans. Long strings of one character class are candidates too: the entropy of
each window is had from the last one's by the counts of the two characters that change. A candidate with some
window above the threshold of its characters is a secret, unless an allow-list knows it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import native as N
from .store import read

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "entropy_hex", "entropy_base64")
PATTERNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
}
VALUE = r"regexp_extract($m, r'^[A-Za-z_]+[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)$', 1)"
VALID = {"assign": f"length({VALUE}) >= 8", "access": "true", "hex": "true"}
GUARD = {"assign": r"text rlike '(?i)(passw|secret|token|api_?key)'", "access": "contains(text, 'AKIA')", "hex": r"text rlike '[0-9a-f]{32}'"}

WINDOW = 20
#: Class: characters, pattern of a candidate, bits from which a window of x is that of a secret. Of random strings of 20
#: characters in one case with digits 1 % have no window of 3.4 bits, in both cases, with or without symbols, 3.6 bits.
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", r"(?<![0-9A-Za-z+/_=-])[0-9A-Fa-f]{20,}+(?![0-9A-Za-z+/_=-])", "3.0D"),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", r"(?<![0-9A-Za-z+/_=-])[0-9A-Za-z+/_=-]{20,}+", "case when x.s rlike '[A-Z]' and x.s rlike '[a-z]' then 3.6D else 3.4D end"),
}
LONG = r"[0-9A-Za-z+/_=-]{20}"
#: Well-known examples, alphabets, and identifiers.
KNOWN = r"(?i)(example|sample|dummy|placeholder|changeme|x{6}|abcdefgh|01234567|12345678|deadbeef|lorem)|^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"
#: A number, or a word in lower, upper or camel case with some digits around it.
WORD = r"(?:[0-9]{1,8}+(?![0-9A-Za-z])|[0-9]{0,4}+(?:[A-Z]++(?![a-z])|[A-Z]?[a-z]++)(?:[A-Z][a-z]{2,}+)*+[0-9]{0,4}+)"
#: Nothing but such words and what joins them: paths, slugs, options, ruled lines. Possessive, so that long strings need no stack.
WORDS = rf"^[-_=+/]*+(?:{WORD}(?:[-_=+/]++|$))*+$"
ALLOWED = f"{WORDS}|{KNOWN}"
MIXED = r"(?=.*[0-9])(?=.*[A-Za-z])"


PIECE = 512  # windows that are folded at a time


def above(s: str, alphabet: str, bits: str, window: int = WINDOW) -> str:
    """Whether some window of the string has a Shannon entropy of ``bits`` or more. Pieces of PIECE windows are looked
    at in order until one has such a window."""
    places = f"transform(slice(split({s}, ''), 1, length({s})), c -> instr('{alphabet}', c))"
    pieces = f"transform(sequence(0, cast((size(v) - {window}) div {PIECE} as int)), k -> slice(v, k * {PIECE} + 1, {PIECE + window - 1}))"
    return f"length({s}) >= {window} and " + N.let(places, "v", f"exists({pieces}, w -> {peak('w', len(alphabet), window)} >= {bits})")


def peak(v: str, size: int, window: int = WINDOW) -> str:
    """The highest Shannon entropy, in bits, of the windows of an array of numbers from 1 to ``size``."""
    f = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(window + 2)) + ")"
    # Counts, and sum of c * log2(c) over the characters of the window that ends at i; only two counts change.
    new, old = f"{v}[i - 1]", f"case when i > {window} then {v}[i - {window} - 1] else 0 end"
    count = lambda k: f"coalesce(get(a.n, {k} - 1), 0)"
    add, less = f"{f}[{count('io.new')} + 1] - {f}[{count('io.new')}]", f"case when io.old = 0 then 0D else {f}[{count('io.old')} - 1] - {f}[{count('io.old')}] end"
    total = f"case when io.new = io.old then a.t else a.t + {add} + {less} end"
    counts = "case when io.new = io.old then a.n else transform(a.n, (c, j) -> c + case when j + 1 = io.new then 1 when j + 1 = io.old then -1 else 0 end) end"
    step = f"""transform(array(named_struct('new', {new}, 'old', {old})), io -> named_struct(
        'n', {counts}, 't', {total}, 'least', case when i >= {window} then least(a.least, {total}) else a.least end))[0]"""
    start = f"named_struct('n', array_repeat(0, {size}), 't', 0D, 'least', {window * math.log2(window)!r}D)"
    return f"aggregate(sequence(1, size({v})), {start}, (a, i) -> {step}, a -> {math.log2(window)!r}D - a.least / {window})"


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(id, base, spans, and text if asked for) for each row of ``docs``: arrays of (kind, start, end, s) in code
    points, end exclusive, by start and kind. ``base`` holds the strict matches, ``spans`` these and the
    candidates of high entropy that share no character with them; the allow-list suppresses only the latter.

    A null or empty text has no spans. Whole texts are searched. Rows, also repeated ones, give one row each;
    other columns are not looked at. Base spans are blanked before candidates are sought, so what is left of a
    string beside one is judged by itself.
    """
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    for k in BASE:
        df = df.withColumn(f"m_{k}", F.expr(N.matches("text", PATTERNS[k], GUARD[k])))
    df = df.withColumns({f"b_{k}": F.expr(N.spans("text", f"m_{k}", PATTERNS[k], k, VALID[k])) for k in BASE})
    df = df.withColumn("base", F.expr(f"case when size(m_assign) + size(m_access) + size(m_hex) = 0 then {N.NO_SPANS} else {N.ordered('concat(b_assign, b_access, b_hex)', KINDS, False)} end"))
    blank = N.replaced("text", N.joined("base"), "repeat(' ', x.end - x.start)")
    df = df.withColumn("rest", F.expr(f"case when not text rlike {N.quoted(LONG)} then '' when size(base) = 0 then text else {blank} end"))
    for k, (_, p, _) in CLASSES.items():
        df = df.withColumn(f"c_{k}", F.expr(N.matches("rest", p)))
    judged = lambda k: f"$m rlike {N.quoted(MIXED)} and not $m rlike {N.quoted(ALLOWED)} and {above('$m', CLASSES[k][0], CLASSES[k][2].replace('x.s', '$m'))}"
    df = df.withColumns({f"h_{k}": F.expr(N.spans("rest", f"c_{k}", p, k, judged(k))) for k, (_, p, _) in CLASSES.items()})
    df = df.withColumn("more", F.expr(f"case when size(h_entropy_hex) + size(h_entropy_base64) = 0 then h_entropy_hex else {N.outermost('concat(h_entropy_hex, h_entropy_base64)', KINDS)} end"))
    df = df.withColumn("spans", F.expr(f"case when size(more) = 0 then base else {N.ordered('concat(base, more)', KINDS, False)} end"))
    return df.select("id", F.expr(N.short("base")).alias("base"), F.expr(N.short("spans")).alias("spans"), *(["text"] if keep_text else []))


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = spans(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(F.expr(N.written("base")), 256).alias("base_sha256"), F.expr(N.written("spans")).alias("spans"))


def secret_base_texts(spark, sf_dir: str) -> DataFrame:
    """The strict matches of each document by kind: how many, and their texts in order, for the check by SQL."""
    found = spans(read(spark, sf_dir, "documents"))
    own = {k: f"filter(base, x -> x.kind = '{k}')" for k in BASE}
    counts = [F.expr(f"cast(size({e}) as bigint)").alias(f"n_{k}") for k, e in own.items()]
    return found.select(F.col("id").alias("doc_id"), *counts, *[F.expr(f"array_join(transform({e}, x -> x.s), ',')").alias(f"{k}_texts") for k, e in own.items()])
