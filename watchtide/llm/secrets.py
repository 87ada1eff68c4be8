"""Secrets in text: known forms by pattern, and unknown ones by the entropy of a sliding window.

Runs of the characters that keys are written in lose the parts that the allow-list knows as something harmless; what is
left of a run is judged by itself. A *candidate* is a run of one class's characters in what is left. A window of fixed width slides over it and keeps
the number of times each character is inside; a step changes two of these counts, and with them the sum of
``c * log2(c)``, from which the Shannon entropy follows. Each character class has its own alphabet, width and limit. A
candidate whose highest window passes the limit is a secret.
Only built-in functions are used, and no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: The known forms, and which group of a match has to be how long at least. A run of ``access`` or ``hex``
#: ends where no match can begin inside it, so its length is part of the pattern; a short ``assign`` match uses up text.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
    r"[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KNOWN = (("assign", ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]{14,}", 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16))
#: What a match of ``assign`` begins with; texts without it are not searched further.
ASSIGN_WORD = r"[pP][aA][sS][sS][wW]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"


@dataclass(frozen=True)
class EntropyClass:
    """Candidates ``characters{width,}``; a window of ``width`` must reach ``bits`` of entropy per character."""

    kind: str
    characters: str
    width: int
    bits: float
    must: str


#: Limits that most random keys of a class's shortest length pass, and that words, names and numbers seldom do.
ENTROPY = (
    EntropyClass("entropy_hex", "0-9A-F", 20, 2.9, r"[0-9][A-F]|[A-F][0-9]"),
    EntropyClass("entropy_base64", "A-Za-z0-9+/_-", 20, 3.7, r"(?s)^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])"),
)

#: Keys of fewer kinds of characters. A candidate inside one of another class is reported once, as the longer one.
NARROW = (
    EntropyClass("entropy_base36", "a-z0-9", 20, 3.5, r"(?s)^(?=.*[a-z])(?=.*[0-9])"),
    EntropyClass("entropy_base32", "A-Z0-9", 16, 3.1, r"(?s)^(?=.*[A-Z])(?=.*[0-9])"),
    EntropyClass("entropy_letters", "A-Za-z", 24, 3.95, r"(?s)^(?=.*[a-z])(?=.*[A-Z])"),
    EntropyClass("entropy_lower", "a-z", 24, 3.7, "[a-z]"),
    EntropyClass("entropy_upper", "A-Z", 24, 3.7, "[A-Z]"),
)

#: What a run is made of, besides the characters of the classes in use. It ends with a hyphen.
RUN = "A-Za-z0-9+/_-"


def _ordered(signs: str, least: int = 8) -> str:
    """The first ``least`` of ``signs`` and as many of the next as follow in order."""
    more = ""
    for sign in reversed(signs[least:]):
        more = f"(?:{sign}{more})?"
    return signs[:least] + more


#: A part of a path that reads like one: words, numbers and very short names. Keys are rarely made of such parts only.
_NAME = r"(?:(?:[A-Z]?[a-z]{2,14}|[A-Z]{2,14})(?:[A-Z][a-z]{2,14}){0,2}[0-9]{0,4}|[0-9]{1,8}|[A-Za-z0-9]{1,3})"
_SEGMENT = rf"{_NAME}(?:[_-]{_NAME}){{0,4}}"

#: Harmless parts of a run: example keys, alphabets in order, image data, integrity sums, names of four words, paths, UUIDs. A part covers
#: what the pattern matches and nothing else; the rest of the run is judged. A placeholder word covers itself, and at
#: the end of a run the rest of an example key of 40 characters. Groups that repeat without bound are possessive: the
#: engine takes them one after the other instead of calling itself for each.
ALLOW = (
    r"[A-Za-z0-9+/]{0,32}[A-Za-z0-9+]EXAMPLE(?:KEY)?$",
    r"(?i:example|sample|placeholder|changeme|x{6,}|0{8,})",
    rf"(?i:{_ordered('abcdefghijklmnopqrstuvwxyz')}|{_ordered('0123456789')}|{_ordered('1234567890')})",
    r"^(?:iVBORw0KGgo|R0lGOD|/9j/|PHN2Zy)[A-Za-z0-9+/]*",
    r"^sha(?:256-[A-Za-z0-9+/]{0,43}|384-[A-Za-z0-9+/]{0,64}|512-[A-Za-z0-9+/]{0,86})",
    r"(?:[A-Z][a-z]{2,14}){4,}+",
    rf"^/?(?:{_SEGMENT}/){{2,}}+(?:{_SEGMENT}$)?",
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
)


#: Neighbours that are added up in one go. Arrays are copied as they grow, so they grow in pieces of this size.
_CHUNK = 128
_HIT = "array<struct<start:int,whole:string,part:string>>"
_SPAN = "array<struct<start:int,back:int,rank:int,kind:string,value:string,entropy:double>>"


def _let(value: Column, use) -> Column:
    """``use(value)``, where the value is made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _before(values: Column, join, zero: Column) -> Column:
    """Of each element of an array, all earlier ones joined: in chunks, then over the chunks."""

    def along(items: Column, of) -> Column:
        start = F.struct(zero.alias("all"), F.array().cast("array<int>").alias("each"))
        return F.aggregate(items, start, lambda s, x: F.struct(join(s["all"], of(x)).alias("all"), F.concat(s["each"], F.array(s["all"])).alias("each")))

    def joined(values: Column) -> Column:
        last = F.greatest(F.size(values) - 1, F.lit(0))
        chunks = F.transform(F.sequence(F.lit(0), F.floor(last / _CHUNK).cast("int")), lambda k: along(F.slice(values, k * _CHUNK + 1, F.lit(_CHUNK)), lambda x: x))

        def moved(chunks: Column, earlier: Column) -> Column:
            return F.flatten(F.transform(chunks, lambda chunk, k: F.transform(chunk["each"], lambda x: join(F.get(earlier, k), x))))

        return _let(chunks, lambda chunks: _let(along(chunks, lambda chunk: chunk["all"])["each"], lambda earlier: moved(chunks, earlier)))

    return _let(values, joined)


def _placed(zipped: Column) -> Column:
    """The gaps and matches of a text in turn, with ``at``: where in the text the gap begins."""
    size = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["whole"]), F.lit(0))
    at = lambda z: _before(F.transform(z, size), lambda a, b: a + b, F.lit(0))
    return _let(zipped, lambda z: _let(at(z), lambda at: F.transform(z, lambda x, i: F.struct(F.get(at, i).alias("at"), x.alias("x")))))


def _matches(text: Column, pattern: str | Column, group: int) -> Column:
    """Structs ``(start, whole, part)`` of the leftmost non-overlapping matches, starts in code points.

    What lies between matches tells where they are: the lengths of the pieces and matches before one add up to it.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    arrays = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole")]
    if group:
        arrays.append(F.regexp_extract_all(text, pattern, F.lit(group)).alias("part"))

    def hit(p: Column) -> Column:
        start = p["at"] + F.length(p["x"]["gap"])
        return F.struct(start.alias("start"), p["x"]["whole"].alias("whole"), p["x"]["part" if group else "whole"].alias("part"))

    return F.transform(F.filter(_placed(F.arrays_zip(*arrays)), lambda p: p["x"]["whole"].isNotNull()), hit)


def _rest(run: Column, allow: tuple[str, ...]) -> Column:
    """Structs like those of ``_matches`` of the parts of a run that no pattern of ``allow`` matches."""
    part = lambda at, text: F.struct(at.alias("start"), text.alias("whole"), text.alias("part"))
    whole = F.array(part(run["start"], run["whole"]))
    if not allow:
        return whole
    pattern = "|".join(f"(?:{a})" for a in allow)
    zipped = F.arrays_zip(F.split(run["whole"], pattern, -1).alias("gap"), F.regexp_extract_all(run["whole"], F.lit(pattern), F.lit(0)).alias("whole"))
    left = F.transform(_placed(zipped), lambda p: part(run["start"] + p["at"], p["x"]["gap"]))
    return F.when(run["whole"].rlike(pattern), left).otherwise(whole)


def highest_entropy(candidate: Column, width: Column, widest: int) -> Column:
    """The greatest Shannon entropy, in bits per character, of ``width`` neighbouring ASCII characters; else null.
    No width is above ``widest``.

    State: the sum of c * log2(c) over the counts c of the window, and its least value over the full windows so far. A
    step changes two counts, that of the character which enters and that of the one which leaves.
    """
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(widest + 2)])
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))

    def step(codes: Column, state: Column, i: Column) -> Column:
        enters = F.get(codes, i - 1)
        leaves = F.when(i > width, F.get(codes, i - width - 1)).otherwise(-1)
        window = F.slice(codes, F.greatest(i - width, F.lit(1)), F.least(i - 1, width))
        count = lambda code: F.size(F.filter(window, lambda c: c == code))
        gain = _let(count(enters), lambda n: F.get(weigh, n + 1) - F.get(weigh, n))
        loss = F.when(leaves >= 0, _let(count(leaves), lambda n: F.get(weigh, n) - F.get(weigh, n - 1))).otherwise(0.0)
        total = F.when(enters == leaves, state["sum"]).otherwise(state["sum"] + gain - loss)
        return _let(total, lambda t: F.struct(t.alias("sum"), F.when(i >= width, F.least(state["least"], t)).otherwise(state["least"]).alias("least")))

    def finish(state: Column) -> Column:
        return F.when(state["least"] < float("inf"), F.log2(width) - state["least"] / width)

    # The codes are an argument of a function, so that they are made once and not at every step.
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))
    steps = F.sequence(F.lit(1), F.length(candidate))
    return _let(codes, lambda codes: F.aggregate(steps, start, lambda state, i: step(codes, state, i), finish))


def _span(hit: Column, start: Column, rank: Column, kind: Column, entropy: Column) -> Column:
    """A span that sorts by start, then the longer first, then rank. ``back`` is the end with its sign turned."""
    cells = {"start": start, "back": -(start + F.length(hit["whole"])), "rank": rank, "kind": kind, "value": hit["part"], "entropy": entropy}
    return F.struct(*[c.alias(n) for n, c in cells.items()])


def _literals(c: EntropyClass, rank: int) -> Column:
    cells = {"rank": rank, "kind": c.kind, "pattern": f"[{c.characters}]{{{c.width},}}", "must": c.must, "width": c.width, "bits": c.bits}
    return F.struct(*[F.lit(v).alias(n) for n, v in cells.items()])


def _outside(spans: Column, around, dropped) -> Column:
    """Sorted ``spans`` without those ``dropped`` ones that lie inside an earlier one for which ``around`` holds."""
    reach = lambda s: _before(F.transform(s, lambda x: F.when(around(x), -x["back"]).otherwise(0)), F.greatest, F.lit(0))
    inside = lambda x, reach, i: dropped(x) & (F.get(reach, i) >= -x["back"])
    return _let(spans, lambda s: _let(reach(s), lambda reach: F.filter(s, lambda x, i: ~inside(x, reach, i))))


def with_secrets(docs: DataFrame, text: str = "text", classes: tuple[EntropyClass, ...] = ENTROPY + NARROW, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``(start, rank, kind, end, value, entropy)`` ordered by start, then kind.

    Starts and ends count code points, ends are exclusive. ``assign``, ``access`` and ``hex`` are spans of the known
    forms and are never suppressed; ``entropy`` is null for them. Classes add candidates of their alphabet that pass
    their limit and lie in no known span; ``allow`` cuts candidates, and suppresses nothing beside what it matches. Null texts, and texts without secrets, have an empty
    array. A column named ``secrets`` gives way; others are left alone.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    gates = {"assign": ASSIGN_WORD, "access": "AKIA", "hex": "[0-9a-f]{16}"}
    none = F.lit(None).cast("double")

    def base(rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
        hits = F.when(whole.rlike(gates[kind]), _matches(whole, pattern, group)).otherwise(F.array().cast(_HIT))
        return F.transform(F.filter(hits, lambda hit: F.length(hit["part"]) >= least), lambda hit: _span(hit, hit["start"], F.lit(rank), F.lit(kind), none))

    def candidates(piece: Column, c: Column) -> Column:
        hits = F.filter(_matches(piece["whole"], c["pattern"], 0), lambda hit: F.rlike(hit["whole"], c["must"]))
        found = F.transform(hits, lambda hit: _span(hit, piece["start"] + hit["start"], c["rank"], c["kind"], none))
        return F.when(F.rlike(piece["whole"], c["pattern"]), found).otherwise(F.array().cast(_SPAN))

    new = lambda s: s["rank"] >= len(KNOWN)

    def scored(s: Column) -> Column:
        """The span with its entropy, null where it stays below its class's limit."""
        entropy = lambda c: _let(highest_entropy(s["value"], c["width"], max(x.width for x in classes)), lambda e: F.when(e >= c["bits"], e))
        return s.withField("entropy", _let(F.get(known_classes, s["rank"] - len(KNOWN)), entropy))

    spans = F.concat(*[base(rank, *known) for rank, known in enumerate(KNOWN)]).cast(_SPAN)
    if classes:
        signs = "".join(c.characters.rstrip("-") for c in classes) + RUN
        pattern = f"[{signs}]{{{min(c.width for c in classes)},}}"
        known_classes = F.array(*[_literals(c, len(KNOWN) + i) for i, c in enumerate(classes)])
        of_piece = lambda piece: F.flatten(F.transform(known_classes, lambda c: candidates(piece, c)))
        extra = F.flatten(F.transform(_matches(whole, pattern, 0), lambda run: F.flatten(F.transform(_rest(run, allow), of_piece)))).cast(_SPAN)
        narrow = [len(KNOWN) + i for i, c in enumerate(classes) if c in NARROW]
        both = F.array_sort(F.concat(spans, F.when(whole.rlike(pattern), extra).otherwise(F.array().cast(_SPAN))))
        free = _outside(both, lambda s: ~new(s), new)
        kept = F.filter(F.transform(free, lambda s: F.when(new(s), scored(s)).otherwise(s)), lambda s: ~new(s) | s["entropy"].isNotNull())
        spans = _outside(kept, new, lambda s: s["rank"].isin(narrow)) if narrow else kept

    def out(s: Column) -> Column:
        cells = {"start": s["start"], "rank": s["rank"], "kind": s["kind"], "end": -s["back"], "value": s["value"], "entropy": s["entropy"]}
        return F.struct(*[c.alias(n) for n, c in cells.items()])

    return docs.select(*[docs[c] for c in docs.columns if c != "secrets"], F.array_sort(F.transform(spans, out)).alias("secrets"))
