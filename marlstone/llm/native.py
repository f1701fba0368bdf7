"""Pieces of SQL for spans of text, in code points, by built-in functions only.

Array functions copy what they build, so a fold that appends is quadratic. Folds over many entries therefore go
by blocks of about the square root of their number: see prefixes() and replaced().
"""

from __future__ import annotations

SPAN = "struct<kind:string,start:int,end:int,s:string,before:string,after:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"
BEFORE, AFTER = 30, 8  # characters of context that a span knows


def quoted(s: str) -> str:
    """A raw SQL string literal."""
    return "r'" + s.replace("'", r"\x27") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once as ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def matches(text: str, pattern: str, guard: str = "true") -> str:
    """The leftmost non-overlapping matches of a pattern without capturing groups, where ``guard`` lets it look."""
    return f"case when {guard} then regexp_extract_all({text}, {quoted('(' + pattern + ')')}, 1) else cast(array() as array<string>) end"


def prefixes(values: str, zero: str, step: str) -> str:
    """For each number of an array that is not empty, what ``step``, an expression over s and x, makes of ``zero`` and
    the numbers before it. ``step`` must be associative: blocks are folded first, then the entries of each."""
    appended = f"named_struct('s', {step.replace('$s', 'a.s').replace('$x', 'x')}, 'o', concat(a.o, array(a.s)))"
    start = lambda s: f"named_struct('s', {s}, 'o', cast(array() as array<int>))"
    whole = f"aggregate(d, {zero}, (s, x) -> {step.replace('$s', 's').replace('$x', 'x')})"
    heads = f"aggregate(transform(c, d -> {whole}), {start(zero)}, (a, x) -> {appended}, a -> a.o)"
    within = f"flatten(zip_with(c, {heads}, (d, h) -> aggregate(d, {start('h')}, (a, x) -> {appended}, a -> a.o)))"
    blocks = "transform(sequence(0, cast((size(v) - 1) div b as int)), k -> slice(v, k * b + 1, b))"
    return let(values, "v", let("cast(ceil(sqrt(size(v))) as int)", "b", let(blocks, "c", within)))


def spans(text: str, found: str, pattern: str, kind: str, valid: str) -> str:
    """The spans of ``found``, the column of matches(), for which ``valid`` holds, an expression over $m. What
    lies between the matches gives their places and contexts."""
    place = "p[i] + length(w[i])"
    before = f"right(case when i > 0 then concat({found}[i - 1], w[i]) else w[i] end, {BEFORE})"
    span = f"named_struct('kind', '{kind}', 'start', {place}, 'end', {place} + length(m), 's', m, 'before', {before}, 'after', left(w[i + 1], {AFTER}))"
    sizes = f"transform({found}, (m, i) -> length(w[i]) + length(m))"
    every = let(prefixes(sizes, "0", "$s + $x"), "p", f"transform({found}, (m, i) -> {span})")
    kept = every if valid == "true" else f"filter({every}, z -> {valid.replace('$m', 'z.s')})"
    return f"case when size({found}) = 0 then {NO_SPANS} else {let(f'split({text}, {quoted(pattern)}, -1)', 'w', kept)} end"


def written(array: str) -> str:
    """kind:start:end of each span, joined by commas."""
    return f"array_join(transform({array}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def short(array: str) -> str:
    """The spans without their contexts."""
    return f"transform({array}, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 's', x.s))"


def ordered(array: str, kinds: tuple[str, ...], by_kind: bool) -> str:
    """Spans by kind as listed and start, or by start and kind; the end settles the rest. Repeats go."""
    rank = f"array_position(array({', '.join(repr(k) for k in kinds)}), x.kind)"
    first, second = (rank, "cast(x.start as bigint)") if by_kind else ("cast(x.start as bigint)", rank)
    keyed = f"array_sort(transform({array}, x -> named_struct('a', {first}, 'b', {second}, 'c', x.end, 'x', x)))"
    new = "i = 0 or y.a <> k[i - 1].a or y.b <> k[i - 1].b or y.c <> k[i - 1].c"
    return let(keyed, "k", f"transform(filter(k, (y, i) -> {new}), y -> y.x)")


def outermost(array: str, kinds: tuple[str, ...]) -> str:
    """The spans that lie in no other one, in order of start; of equal ones that of the kind listed first."""
    rank = f"array_position(array({', '.join(repr(k) for k in kinds)}), x.kind)"
    keyed = f"transform(array_sort(transform({array}, x -> named_struct('a', x.start, 'b', -x.end, 'c', {rank}, 'x', x))), y -> y.x)"
    ends = prefixes("transform(o, x -> x.end)", "-1", "greatest($s, $x)")
    return f"case when size({array}) < 2 then {array} else {let(keyed, 'o', let(ends, 'q', 'filter(o, (x, i) -> x.end > q[i])'))} end"


def joined(array: str) -> str:
    """Spans (kind, start, end) without overlaps that cover what those of ``array``, not empty, do, in order; each has
    the kind of the first span in it."""
    ends = prefixes("transform(o, x -> x.end)", "-1", "greatest($s, $x)")
    heads = "filter(sequence(0, size(o) - 1), i -> o[i].start >= q[i])"
    last = "case when j + 1 < size(h) then q[h[j + 1]] else array_max(transform(o, x -> x.end)) end"
    span = f"named_struct('kind', o[i].kind, 'start', o[i].start, 'end', {last})"
    keyed = f"transform(array_sort(transform({array}, x -> named_struct('a', x.start, 'b', -x.end, 'x', x))), y -> y.x)"
    return let(keyed, "o", let(ends, "q", let(heads, "h", f"transform(h, (i, j) -> {span})")))


def replaced(text: str, array: str, by: str) -> str:
    """The text with each span of an array, not empty, in order and without overlaps, replaced by ``by``, an
    expression over x. The text is cut at every b-th span first, so that no cut counts from its start."""
    first = "case when k = 0 then 0 else v[k * b].start end"
    stop = f"case when (k + 1) * b < size(v) then v[(k + 1) * b].start else length({text}) end"
    gap = "substring(t, (case when i = 0 then f else c[i - 1].end end) - f + 1, x.start - (case when i = 0 then f else c[i - 1].end end))"
    tail = "substring(t, c[size(c) - 1].end - f + 1)"
    part = f"concat(array_join(transform(c, (x, i) -> concat({gap}, {by})), ''), {tail})"
    part = let("slice(v, k * b + 1, b)", "c", let(first, "f", let(f"substring({text}, f + 1, {stop} - f)", "t", part)))
    parts = f"transform(sequence(0, cast((size(v) - 1) div b as int)), k -> {part})"
    return let(array, "v", let("cast(ceil(sqrt(size(v))) as int)", "b", f"array_join({parts}, '')"))
