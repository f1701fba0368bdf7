"""Personal data by gradient boosting over candidate spans, in built-in functions only.

Strict patterns give the base spans, which stay. Over the text with these blanked, wide generators propose further
spans, which may overlap; boosted trees judge each by its format and its context, and a threshold for its kind,
calibrated on sentences that were written by hand and not used to fit the trees, selects. The trees are fitted on
the driver over a bounded set of made-up labelled sentences and then run as SQL.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import native as N
from .boosting import Boosted, fit
from .store import read

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = ("email", "ip", "card", "phone")
EXAMPLES = 1800  # labelled sentences that the trees are fitted on
CERTAIN = 0.9  # probability from which a proposed span is taken where none has been calibrated

LOCAL = "[A-Za-z0-9._%+-]"
#: The strict patterns. Lookbehinds and possessive repeats only save time: no match starts inside a run whose
#: start failed. Each equals the plain pattern with failing matches dropped.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DIGITS = r"regexp_replace($m, '[^0-9]', '')"
#: From the last digit on, each second one counts double, as the sum of its digits.
LUHN = N.let("regexp_extract_all(reverse($m), '([0-9])', 1)", "e", "size(e) > 0 and aggregate(transform(e, (c, i) -> case when i % 2 = 0 then int(c) else (2 * int(c)) % 10 + int(int(c) div 5) end), 0, (t, c) -> t + c) % 10 = 0")
VALID = {
    "email": "true",
    "ip": "forall(split($m, '[.]'), p -> coalesce(try_cast(p as bigint) <= 255, false))",
    "card": LUHN,
    "phone": f"length({DIGITS}) between 8 and 15",
}
GUARD = {"email": "contains(text, '@')", "ip": r"text rlike '[0-9][.][0-9]'", "card": r"text rlike '[0-9][ -]?[0-9][ -]?[0-9]'", "phone": "contains(text, '+')"}

FILL = "\x01"  # stands for the characters of base spans where further spans are sought
EDGE_BEFORE, EDGE_AFTER = "(?<![0-9A-Za-z.,+-])", "(?![0-9A-Za-z])"
UNI = r"[^\s\x01@<>()\[\],;:\"]"
#: What proposes further spans: kind, pattern, what the text has to hold for it to be tried, what a match m has to be.
PROPOSALS = (
    ("email", rf"(?<!{LOCAL}){LOCAL}{{1,64}}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{{1,63}}(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{{2,63}}){{1,4}}+", r"rest rlike '[(\\[ ](at|dot)[)\\] ]' and rest rlike '(dot|[.][a-z])'", "true"),
    ("email", rf"(?<!{LOCAL}){LOCAL}{{1,64}}\x20@\x20[A-Za-z0-9-]{{1,63}}(?:\x20?\.\x20?[A-Za-z0-9-]{{2,63}}){{1,3}}+", "contains(rest, ' @ ')", "true"),
    ("email", rf"(?<![^\s\x01@<>()\[\],;:\"]){UNI}{{1,64}}+@(?:(?!\.){UNI}){{1,63}}+(?:\.(?:(?!\.){UNI}){{1,63}}+)+", "contains(rest, '@')", "true"),
    ("phone", rf"{EDGE_BEFORE}(?:\+|00)?\(?[0-9]{{1,8}}\)?(?:[\x20./-]{{1,2}}\(?[0-9]{{1,8}}\)?){{1,6}}+{EDGE_AFTER}", r"rest rlike '[0-9][ ./)-]{1,2}[(]?[0-9]{2}'", "length(regexp_replace($m, '[^0-9]', '')) between 7 and 15"),
    ("phone", rf"{EDGE_BEFORE}(?:\+?1[\x20.-]?)?(?:\([2-9][0-9]{{2}}\)\x20?|[2-9][0-9]{{2}}[\x20.-])[0-9]{{3}}[\x20.-][0-9]{{4}}{EDGE_AFTER}", r"rest rlike '[0-9]{3}[ .-][0-9]{4}'", "true"),
    ("phone", rf"{EDGE_BEFORE}(?:\+|00?)[1-9][0-9]{{7,13}}{EDGE_AFTER}", "rest rlike '[+0][0-9]{8}'", "true"),
    ("card", r"(?<![0-9A-Za-z.-])3[0-9](?:[\x20-]?[0-9]){12,13}(?![0-9A-Za-z])", "rest rlike '3[0-9][ -]?[0-9]'", LUHN),
    ("ssn", r"(?<![0-9A-Za-z.-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])", r"rest rlike '[0-9][ -][0-9]{2}[ -][0-9]'", "true"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", r"rest rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'", "true"),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", r"rest rlike '[0-9A-Fa-f]:[0-9A-Fa-f]'", "true"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])", "contains(rest, '::')", "true"),
)
#: Of equal or nested proposals the outer one counts, of equal ones that of the first kind here.
PRIORITY = ("email", "ip", "iban", "card", "ssn", "phone")
#: Words before a span that speak for and against it.
FOR = r"(?i)\b(phone|tel|call|calls|called|ring|mobile|fax|cell|ssn|social security|mail|email|e-mail|contact|reach|write to|iban|account|transfer|bank|host|address|server|card|amex|text|whatsapp|telefon|handy|mobil|fon|kontakt|konto|ruf|rufen|anruf|karte|téléphone|tél|portable|courriel|appelez|compte|carte|correo|teléfono|llame|llámame|cuenta|móvil|tarjeta)[^\n]{0,15}$"
AGAINST = r"(?i)\b(version|order|invoice|page|part|serial|isbn|issn|item|sku|model|section|figure|table|total|pages|range|build|chapter|score|scores|row|ticket|size|years?|doi|batch|lot|euros?|usd|eur|price|bestell|bestellung|rechnung|seite|artikel|commande|facture|réf|pedido|factura|ref)[^\n]{0,15}$"
IBAN_DIGITS = "regexp_replace(concat(substring({0}, 5), left({0}, 4)), ' ', '')"


def _features(x: str) -> str:
    """An array of numbers for the span x: format first, then context."""
    s, before = f"{x}.s", f"{x}.before"
    flag = lambda c: f"case when {c} then 1D else 0D end"
    digits = f"regexp_replace({s}, '[^0-9]', '')"
    groups = f"transform(regexp_extract_all({s}, '([0-9]+)', 1), g -> length(g))"
    luhn = LUHN.replace("$m", s)
    # The remainder by 97 of an IBAN, letters as 10 to 35, with its head at the end.
    moved = f"regexp_extract_all({IBAN_DIGITS.format(s)}, '([0-9A-Z])', 1)"
    rest97 = f"aggregate({moved}, 0, (t, c) -> cast(case when c >= 'A' then (t * 100 + ascii(c) - 55) % 97 else (t * 10 + ascii(c) - 48) % 97 end as int))"
    return "array(" + ", ".join([
        f"cast(array_position(array({', '.join(repr(k) for k in KINDS)}), {x}.kind) as double)",
        f"cast(length({s}) as double)",
        f"cast(length({digits}) as double)",
        f"cast(length(regexp_replace({s}, '[^A-Za-z]', '')) as double)",
        f"cast(size(array_distinct(regexp_extract_all({s}, '([0-9])', 1))) as double)",
        f"cast(size({groups}) as double)",
        f"cast(coalesce(array_max({groups}), 0) as double)",
        f"cast(coalesce(array_min({groups}), 0) as double)",
        f"cast(coalesce(get({groups}, size({groups}) - 1), 0) as double)",
        flag(f"{s} rlike '[(\\\\[](at|dot)[)\\\\]]'"),
        flag(f"{s} rlike '[.]'"),
        flag(f"{s} rlike '[.] '"),
        flag(f"{s} rlike {N.quoted(r'([(\[]dot[)\]]| dot )')}"),
        flag(f"{s} rlike '^[(]'"),
        flag(f"{s} rlike '^[+]'"),
        flag(f"{s} rlike '^[(]?0'"),
        flag(f"{s} rlike '@'"),
        flag(f"{s} rlike '[.][A-Za-z]{{2,6}}$'"),
        flag(f"size(array_distinct(regexp_extract_all({s}, '([^0-9A-Za-z()]+)', 1))) <= 1"),
        flag(f"{s} rlike '(^|[^0-9])(1[89]|20)[0-9]{{2}}([^0-9]|$)'"),
        flag(f"{s} rlike '^(000|666|9)' or {s} rlike '-0000$'"),
        flag(f"{x}.kind = 'iban' and {rest97} = 1"),
        flag(luhn),
        flag(f"{before} rlike {N.quoted(FOR)}"),
        flag(f"{before} rlike {N.quoted(AGAINST)}"),
        flag(f"{before} rlike '[0-9A-Za-z][,;]? $'"),
        flag(f"{before} rlike '[0-9][,;]? ?$'"),
        flag(f"{before} rlike '[$€£#%=] ?$'"),
        flag(f"{x}.after rlike '^[0-9A-Za-z_/=]'"),
        flag(f"{x}.after rlike '^ ?([€$£%]|(km|kg|eur|usd|mm|cm|ms|mb|gb|kb|dollars|euros|people|items|units)([^a-z]|$))'"),
        flag(f"{x}.after rlike '^[,;]? ?[0-9]'"),
    ]) + ")"


def _base(df: DataFrame) -> DataFrame:
    """df(id, text) with ``base``, the strict spans by kind and start."""
    for k in BASE:
        df = df.withColumn(f"m_{k}", F.expr(N.matches("text", PATTERNS[k], GUARD[k])))
    df = df.withColumns({f"b_{k}": F.expr(N.spans("text", f"m_{k}", PATTERNS[k], k, VALID[k])) for k in BASE})
    return df.withColumn("base", F.expr(f"concat({', '.join(f'b_{k}' for k in BASE)})"))


def _proposed(df: DataFrame) -> DataFrame:
    """Adds ``proposed``, what the wide patterns find in the text with the base spans blanked."""
    blank = N.replaced("text", N.joined("base"), "repeat('\\u0001', x.end - x.start)")
    df = df.withColumn("rest", F.expr(f"case when size(base) = 0 then text else {blank} end"))
    for i, (_, p, guard, _) in enumerate(PROPOSALS):
        df = df.withColumn(f"p_{i}", F.expr(N.matches("rest", p, guard)))
    df = df.withColumns({f"q_{i}": F.expr(N.spans("rest", f"p_{i}", p, k, valid)) for i, (k, p, _, valid) in enumerate(PROPOSALS)})
    return df.withColumn("proposed", F.expr(f"concat({', '.join(f'q_{i}' for i in range(len(PROPOSALS)))})"))


def examples(n: int = EXAMPLES) -> list[tuple[str, str]]:
    """Made-up sentences, each with what is personal in it, or nothing."""
    r = random.Random(11)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    nz = lambda: r.choice("23456789")
    name = lambda: r.choice(["anna", "j.smith", "kontakt", "m_lopez", "info", "luc.martin", "hélène", "jürgen", "nuñez"])
    host = lambda: r.choice(["example", "mail", "firma", "correo-uno", "münchen", "café"])
    word = lambda: "".join(r.choice(["th", "an", "er", "ein", "sch", "ou", "le", "ción", "os", "re"]) for _ in range(r.choice([1, 2, 3, 4])))
    tld = lambda: r.choice(["com", "org", "de", "fr", "es"])
    good_before = ["call me on ", "phone: ", "Tel. ", "my mobile is ", "Telefon ", "téléphone : ", "contact ", "llame al ", "reach us: ", "Handy ", "tél. ", "text ", "", "the ", "and "]
    bad_before = ["order no. ", "version ", "invoice ", "pages ", "part ", "serial ", "Rechnung ", "facture ", "pedido ", "model ", "table ", "scores ", "ref "]
    plain = ["the ", "and then ", "seen in ", "", "es war ", "il y a ", "sum "]
    year = lambda: str(r.randrange(1900, 2030))

    def phone() -> str:
        return r.choice([f"({nz()}{d(2)}) {d(3)}-{d(4)}", f"{nz()}{d(2)}-{d(3)}-{d(4)}", f"{nz()}{d(2)} {d(3)} {d(4)}", f"{nz()}{d(2)}.{d(3)}.{d(4)}", f"00{r.randrange(1, 9)}{d(10)}", f"0{r.randrange(1, 8)} {d(2)} {d(2)} {d(2)} {d(2)}",
            f"0{nz()}{d(2)} {d(7)}", f"0{nz()}{d(2)}/{d(6)}", f"0{nz()}{d(2)}-{d(7)}", f"+{r.randrange(1, 99)} ({d(3)}) {d(3)}-{d(4)}", f"0{nz()}{d(8)}", f"+{nz()}{d(10)}", f"0{nz()}{d(1)} {d(4)} {d(4)}", f"6{d(2)} {d(3)} {d(3)}"])

    def number() -> str:
        """Digits that are no phone."""
        return r.choice([f"{d(4)}-{d(4)}-{d(4)}", f"{year()} {year()} {year()}", f"{d(3)} {d(3)} {d(3)}", " ".join(d(1) for _ in range(7)), " ".join(d(2) for _ in range(5)), f"{year()}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{year()}", f"{nz()}{d(2)}-{d(1)}-{d(5)}-{d(3)}-{d(1)}",
            f"{d(1)}.{d(2)}.{d(4)}", f"{nz()} {d(3)} {d(3)}", f"{nz()}{d(1)} {d(3)} {d(3)}", f"{year()}-{year()}", f"{year()}/{d(5)}", f"00{d(8)}", f"{d(3)}-{d(5)}"])

    def luhn(head: str, size: int) -> str:
        x = head + d(size - len(head) - 1)
        return next(x + c for c in "0123456789" if sum(int(e) if i % 2 == 0 else sum(divmod(2 * int(e), 10)) for i, e in enumerate(reversed(x + c))) % 10 == 0)

    def iban(land: str) -> str:
        body = d(18) if land == "DE" else d(20)
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        x = f"{land}{check:02d}{body}"
        return x if r.random() < 0.4 else " ".join(x[i : i + 4] for i in range(0, len(x), 4))

    def v6() -> str:
        part = lambda: f"{r.randrange(1, 1 << 16):x}"
        return r.choice([":".join(part() for _ in range(8)), f"2001:db8::{part()}", f"fe80::{part()}:{part()}", f"{part()}:{part()}::{part()}:{part()}:{part()}"])

    out = []
    for _ in range(n):
        good = r.random() < 0.5
        kind = r.choice(["phone", "phone", "phone", "email", "email", "ssn", "iban", "ip", "card"])
        lead, tail = r.choice(bad_before if r.random() < 0.6 else plain), ""
        x = ""
        if kind == "phone":
            x = phone() if good else number()
            lead = r.choice(good_before) if good else lead
        elif kind == "email":
            lead = r.choice(["write to ", "mail: ", "contact ", "", "Kontakt "]) if good else r.choice(plain)
            good_x = [f"{name()} (at) {host()} (dot) {tld()}", f"{name()}[at]{host()}[dot]{tld()}", f"{name()} at {host()} dot {tld()}", f"{name()}é@{host()}.{tld()}", f"{name()}@{host()}ö.{tld()}", f"{name()} @ {host()}.{tld()}", f"{name()} @ {host()} . {tld()}"]
            bad_x = ["meet at noon. Then we", "look at this. The", "arrived at home. It", "at the dot of noon", "stay at it dot it", *[f"{word()} at {word()}. {word().capitalize()} {word()}"] * 6, f"{d(1)} @ {d(2)}.{d(2)}", "@éa.b", f"v{d(1)}é@{d(2)}.{d(1)}"]
            x = r.choice(good_x if good else bad_x)
        elif kind == "ssn":
            x = f"{r.randrange(100, 600)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}" if good else f"{r.choice(['000', '666', d(3)])}{r.choice('- ')}{d(2)}{r.choice('- ')}{d(4)}"
            lead = r.choice(["SSN ", "social security number ", "my ssn: ", "ssn is "]) if good else lead
        elif kind == "iban":
            x = iban(r.choice(["DE", "ES"])) if good else r.choice([f"{r.choice(['AB', 'QX'])}{d(2)} " + " ".join("".join(r.choice("ABCDEFGH") for _ in range(4)) for _ in range(3)), f"DE{d(2)} " + " ".join(d(4) for _ in range(4))])
            lead = r.choice(["IBAN ", "account ", "Konto ", "transfer to ", "compte ", "", "and "]) if good else lead
        elif kind == "card":
            x = r.choice([luhn("34", 15), luhn("37", 15), luhn("30", 14)]) if good else luhn("3" + d(1), 15)
            x = x if r.random() < 0.5 else f"{x[:4]} {x[4:10]} {x[10:]}"
            lead = r.choice(["card ", "my amex ", "Karte ", "carte ", "tarjeta ", "", "paid with "]) if good else r.choice(bad_before)
        else:
            x = v6() if good else r.choice([":".join(d(2) for _ in range(8)), f"std::{r.choice(['add', 'cab', 'be'])}"])
            lead = r.choice(["host ", "from ", "address ", "server ", "", "ping "]) if good else lead
        if not good and kind in ("phone", "card") and r.random() < 0.3:
            tail = r.choice([" km", " EUR", " items", "%"])
        out.append(("It is said: " + lead + x + tail + r.choice([" today.", ".", ", thanks", "\nmore"]), x if good else ""))
    return out


#: Sentences written by hand, and what is personal in them. They set the thresholds.
HELD = (
    ("Please ring Maria on 0171 4567812 after six.", "0171 4567812"), ("Fax 06 12 34 56 78 or come by.", "06 12 34 56 78"), ("You can reach the office at 020 7946 0958.", "020 7946 0958"),
    ("(212) 664-7665 is the number of the studio", "(212) 664-7665"), ("Texted 415.555.2671 twice, no reply", "415.555.2671"), ("Mi móvil: 612 345 678, gracias", "612 345 678"),
    ("Rückruf bitte unter 089/636480", "089/636480"), ("Tel 0033612345678 in the evening", "0033612345678"), ("her cell is 646-555-0199.", "646-555-0199"), ("Anruf an 030-1234567 genügt", "030-1234567"),
    ("Zimmer, +1 (826) 555-4081 und mehr", "+1 (826) 555-4081"), ("a des +49 30 901820 oder", "+49 30 901820"), ("call 1-800-555-0134 toll free", "1-800-555-0134"),
    ("The league table reads 12 34 56 78 90", ""), ("Figures for 1998 1999 2000 2001 follow", ""), ("It has 7 000 000 000 inhabitants", ""), ("ISBN 978-3-16-148410-0 is out of print", ""), ("on 2021-03-04 we left", ""), ("am 24.12.2019 war es kalt", ""),
    ("The sum of 125 000 000 euros was paid", ""), ("invoice 2023-0045-7781 is due", ""), ("lottery numbers 4 8 15 16 23 42 108", ""), ("Artikel 448-77120 ist ausverkauft", ""), ("a distance of 384 400 000 km", ""), ("pages 1203-1245 of volume 7", ""), ("build 10.0.19045 was rolled back", ""),
    ("write to sam (at) wonder (dot) org soon", "sam (at) wonder (dot) org"), ("mail: lea[at]studio[dot]fr", "lea[at]studio[dot]fr"), ("try peter dot", ""), ("He is at school. The bus came", ""), ("bob @ company.com wrote back", "bob @ company.com"), ("andré@société.fr est en copie", "andré@société.fr"), ("3 @ 4.50 each", ""),
    ("I paid with 3782 822463 10005 yesterday", "3782 822463 10005"), ("amex 371449635398431 exp 01/29", "371449635398431"), ("serial 378282246310005 on the case", ""), ("her social security number is 219-09-9999", "219-09-9999"), ("part 219-09-9999 is back in stock", ""),
    ("IBAN DE89 3704 0044 0532 0130 00 bitte", "DE89 3704 0044 0532 0130 00"), ("transfer to ES9121000418450200051332 now", "ES9121000418450200051332"), ("lot AB12 CDEF GHAB CDEF GHAB arrived", ""), ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is up", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"), ("ping fe80::1ff:fe23:4567:890a please", "fe80::1ff:fe23:4567:890a"), ("times 10:20:30:40:50:11:12:13 in the log", ""), ("use std::dec there", ""),
)


def _cut(p: np.ndarray, y: np.ndarray) -> float:
    """Of the numbers halfway between two neighbouring probabilities the one that parts the personal spans from the
    others with fewest errors, the larger of equally good ones; CERTAIN if there is but one sort."""
    if y.all() or not y.any():
        return CERTAIN
    known = np.unique(p)
    cuts = (known[1:] + known[:-1]) / 2
    wrong = [int((y & (p < c)).sum() + (~y & (p >= c)).sum()) for c in cuts] or [0]
    return float(cuts[len(cuts) - 1 - int(np.argmin(wrong[::-1]))]) if len(cuts) else CERTAIN


_fitted: dict[int, tuple[Boosted, dict[str, float]]] = {}


def model(spark: SparkSession, n: int = EXAMPLES) -> tuple[Boosted, dict[str, float]]:
    """The trees, fitted over ``n`` made-up sentences, and the threshold of each kind, which parts its
    proposals in HELD with fewest errors; once in a driver."""
    if n not in _fitted:
        every = [*((0, t, x) for t, x in examples(n)), *((1, t, x) for t, x in HELD)]
        rows = ", ".join(f"({i}, {h}, {N.quoted(t)}, {N.quoted(x)})" for i, (h, t, x) in enumerate(every))
        df = _proposed(_base(spark.sql(f"select * from values {rows} as t(id, held, text, own)"))).selectExpr("held", "own", "text", "explode(proposed) as x")
        # A proposal is personal if it is what the sentence says is, or a part of it, or has it with little more.
        near = "own <> '' and (contains(own, x.s) or contains(x.s, own) and length(x.s) <= length(own) + 3)"
        got = df.selectExpr("held", f"({near}) as y", "x.kind", f"{_features('x')} as f").collect()
        fitted = [r for r in got if not r.held]
        trees = fit(np.array([r.f for r in fitted]), np.array([float(r.y) for r in fitted]))
        limits = {}
        for kind in KINDS:
            own = [r for r in got if r.held and r.kind == kind]
            limits[kind] = CERTAIN
            if own:
                p = 1 / (1 + np.exp(-(trees.slope * trees.raw(np.array([r.f for r in own])) + trees.shift)))
                limits[kind] = _cut(p, np.array([r.y for r in own], bool))
        _fitted[n] = trees, limits
    return _fitted[n]


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", certain: float | None = None, keep_text: bool = False) -> DataFrame:
    """(id, base, spans, and text if asked for) for each row of ``docs``: arrays of (kind, start, end, s) in code
    points, end exclusive, by kind and start. ``base`` holds the strict matches, ``spans`` these and the proposed
    ones whose calibrated probability reaches the threshold of their kind (or ``certain``, if given); a proposed
    span inside another that is taken goes. Proposed spans share no character with base ones.

    A null or empty text has no spans. Whole texts are searched. Rows, also repeated ones, give one row each;
    other columns are not looked at. Equal spans of one kind count once.
    """
    trees, limits = model(docs.sparkSession)
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = _proposed(_base(df))
    least = f"{certain!r}D" if certain is not None else "case x.kind " + " ".join(f"when '{k}' then {p!r}D" for k, p in limits.items()) + " end"
    judged = f"filter(proposed, x -> {N.let(_features('x'), 'f', trees.sql('f'))} >= {least})"
    df = df.withColumn("taken", F.expr(f"case when size(proposed) = 0 then proposed else {judged} end"))
    df = df.withColumn("found", F.expr(N.outermost("taken", PRIORITY)))
    df = df.withColumn("spans", F.expr(f"case when size(found) = 0 then base else {N.ordered('concat(base, found)', KINDS, True)} end"))
    return df.select("id", F.expr(N.short("base")).alias("base"), F.expr(N.short("spans")).alias("spans"), *(["text"] if keep_text else []))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span in its text replaced by its kind in brackets, overlapping ones as one; all else, and
    null texts, as before."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    df = docs.select(F.struct(*[F.col(f"`{c}`").alias(names[c]) for c in docs.columns]).alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = spans(df, "id", "text", keep_text=True)
    own = f"id.{names[text_col]}"
    clean = F.expr(f"case when size(spans) = 0 then {own} else {N.replaced('text', N.joined('spans'), chr(39) + '[' + chr(39) + ' || upper(x.kind) || ' + chr(39) + ']' + chr(39))} end")
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"id.{names[c]}").alias(c) for c in docs.columns])


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = spans(read(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(F.expr(N.written("base")), 256).alias("base_sha256"), F.expr(N.written("spans")).alias("spans"))


def pii_base_texts(spark, sf_dir: str) -> DataFrame:
    """The strict matches of each document by kind: how many, and their texts in order, for the check by SQL."""
    found = spans(read(spark, sf_dir, "documents"))
    own = {k: f"filter(base, x -> x.kind = '{k}')" for k in BASE}
    counts = [F.expr(f"cast(size({e}) as bigint)").alias(f"n_{k}") for k, e in own.items()]
    return found.select(F.col("id").alias("doc_id"), *counts, *[F.expr(f"array_join(transform({e}, x -> x.s), ',')").alias(f"{k}_texts") for k, e in own.items()])
