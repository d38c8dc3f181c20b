"""Secret scans: patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._work import name, others

# The base patterns and the least length of their matches (of group 2 for `assign`).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
# Runs shorter than the least length are no matches, so it stands in the pattern itself.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


@dataclass(frozen=True)
class CharClass:
    """A class of characters, the shortest candidate, and the entropy in bits a character from
    which a window is taken for random. `needs` are patterns a candidate must contain."""

    name: str
    alphabet: str
    chars: str
    least: int
    window: int
    bits: float
    needs: Sequence[str] = ()


_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()

#: Candidates are whole runs of a class. Words lack digits, so each class asks for mixed characters.
CLASSES = (
    CharClass("hexadecimal", _DIGITS + "abcdefABCDEF", "0-9a-fA-F", 16, 16, 2.8, ("[0-9]", "[a-fA-F]")),
    CharClass("alphanumeric", _DIGITS + _LOWER + _UPPER, "A-Za-z0-9", 20, 20, 3.4, ("[0-9].*[0-9]", "[A-Za-z]")),
    CharClass("base64", _DIGITS + _LOWER + _UPPER + "+/_=-", "A-Za-z0-9+/_=-", 24, 24, 3.8, ("[0-9].*[0-9]", "[a-z]", "[A-Z]")),
)

#: The longest strings that candidates are part of, which the allow-list is held against.
WHOLE = "[A-Za-z0-9+/_=-]{16,}"

#: Strings that look random and are no secrets: UUIDs, placeholders, runs of the alphabet, checksums
#: of packages, dates.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|xxxx",
    r"(?i)abcdefgh|01234567|12345678",
    r"^sha(1|256|384|512)-",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",
)


def _zipped(text: Column, pattern: str) -> Column:
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The pieces between matches have one element more than the matches; the last has no match.
    return F.arrays_zip(F.split(text, pattern, -1).alias("piece"), hits.alias("hit"))


#: Rows that one fold gathers.
PIECE = 64


def _with(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _gathered(rows: Column, start: dict[str, Column], step, item: str) -> Column:
    """The non-null items of a fold over `rows`, in time proportional to them.

    `start` holds the state by name, `step(state, row)` gives its next columns by name and the item.
    A fold copies its state in each step, so no state may hold all items. One fold finds the state before
    each piece of `PIECE` rows, and then each piece is folded by itself.
    """
    none = F.array().cast(f"array<{item}>")

    def state(columns: dict[str, Column], *more: Column) -> Column:
        return F.struct(*[column.alias(key) for key, column in columns.items()], *more)

    def numbers(known, piece):
        return F.sequence(piece * PIECE, F.least((piece + 1) * PIECE, F.size(known)) - 1)

    def whole(known):
        pieces = F.sequence(F.lit(0), F.floor((F.size(known) - 1) / PIECE).cast("int"))

        def past(before, piece):
            after = F.aggregate(numbers(known, piece), before["now"], lambda s, i: state(step(s, F.get(known, i))[0]))
            return F.struct(after.alias("now"), F.concat(before["seen"], F.array(before["now"])).alias("seen"))

        zero = state(start)
        nothing = F.filter(F.array(zero), lambda s: F.lit(False))
        befores = F.aggregate(pieces, F.struct(zero.alias("now"), nothing.alias("seen")), past, lambda s: s["seen"])

        def put(s, i):
            after, new = step(s, F.get(known, i))
            items = _with(new, lambda n: F.when(n.isNull(), s["items"]).otherwise(F.concat(s["items"], F.array(n))))
            return state(after, items.alias("items"))

        def of_piece(before, piece):
            first = state({key: before[key] for key in start}, none.alias("items"))
            return F.aggregate(numbers(known, piece), first, put, lambda s: s["items"])

        return F.flatten(F.transform(befores, of_piece))

    return _with(rows, lambda known: F.when(F.size(known) > 0, whole(known)).otherwise(none))


SPAN = "struct<first:int,kind:int,until:int,hit:string>"


def _spans(text: Column, pattern: str, kind: int, guard: Column, passes) -> Column:
    """Spans (first, kind, until, hit) of the matches that pass, in code points.

    Text between and inside matches adds up to the positions, so one fold over the matches gives
    all of them, and a text without `guard` is not scanned.
    """

    def step(state, pair):
        first = state["at"] + F.length(pair["piece"])
        until = first + F.coalesce(F.length(pair["hit"]), F.lit(0))
        span = F.struct(
            first.alias("first"), F.lit(kind).alias("kind"), until.alias("until"), pair["hit"].alias("hit")
        )
        return {"at": until}, F.when(pair["hit"].isNotNull(), span)

    found = _gathered(_zipped(text, pattern), {"at": F.lit(0)}, step, SPAN)
    empty = F.array().cast(f"array<{SPAN}>")
    return F.when(guard, F.filter(found, lambda s: passes(s["hit"]))).otherwise(empty)


def _uncovered(covers: Column, spans: Column, kinds: int) -> Column:
    """The spans that lie within none of `covers` and within no span of a smaller kind (from 3 on) that does not either.

    A sweep by start: a span lies within an earlier one exactly if some earlier one ends no sooner.
    At one start, covers come first and then smaller kinds, so the furthest end of each is all the state.
    """
    fields = [f"end{kind}" for kind in range(2, 3 + kinds)]

    def step(state, span):
        rank = F.greatest(span["kind"], F.lit(2))
        inside = F.lit(False)
        for kind, field in enumerate(fields, start=2):
            inside = inside | ((F.lit(kind) < rank) & (state[field] >= span["until"]))
        is_cover = span["kind"] < 0
        seen = is_cover | (state["end2"] < span["until"])
        after = {
            field: F.when((rank == kind) & seen, F.greatest(state[field], span["until"])).otherwise(state[field])
            for kind, field in enumerate(fields, start=2)
        }
        return after, F.when(~is_cover & ~inside, span)

    marked = F.transform(
        covers,
        lambda s: F.struct(s["first"].alias("first"), F.lit(-1).alias("kind"), s["until"].alias("until"), F.lit("").alias("hit")),
    )
    return _gathered(F.array_sort(F.concat(marked, spans)), {field: F.lit(-1) for field in fields}, step, SPAN)


def window_entropy(candidate: Column, cls: CharClass) -> Column:
    """The largest Shannon entropy, in bits a character, of a window sliding over the candidate.

    The state holds the count of every character of the class and S, the sum of c log2 c over them.
    A step adds the incoming character and takes out the outgoing one, and corrects S by the two
    counts it changes: the entropy of a window of w characters is log2(w) - S / w. Characters
    outside the class are not counted.
    """
    w = cls.window
    codes = F.transform(
        F.split(candidate, ""), lambda c: F.instr(F.lit(cls.alphabet), c).cast("int")
    )
    codes = F.filter(codes, lambda c: c > 0)
    log = F.array(*[F.lit(0.0), *[F.lit(float(c * log2(c))) for c in range(1, w + 2)]])

    def term(count):
        return F.element_at(log, (count + 1).cast("int"))

    def step(state, pair):
        into, out, counts = pair["into"], pair["out"], state["counts"]
        gains = F.element_at(counts, into)
        s = state["s"] + term(gains + 1) - term(gains)
        # One pass over the counts takes in the one and puts out the other.
        counts1 = F.transform(
            counts, lambda c, i: c + F.when(i + 1 == into, 1).otherwise(0) - F.when(i + 1 == out, 1).otherwise(0)
        )
        before = F.element_at(counts, F.greatest(out, F.lit(1))) + F.when(out == into, 1).otherwise(0)
        s = s + F.when(out > 0, term(before - 1) - term(before)).otherwise(F.lit(0.0))
        seen = state["seen"] + 1
        bits = F.when(seen >= w, F.lit(log2(w)) - s / w).otherwise(F.lit(0.0))
        return F.struct(
            counts1.alias("counts"),
            s.alias("s"),
            seen.alias("seen"),
            F.greatest(state["best"], bits).alias("best"),
        )

    pairs = F.zip_with(
        codes,
        F.concat(F.array_repeat(F.lit(0), w), codes),
        lambda i, o: F.struct(i.alias("into"), o.alias("out")),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(0).alias("seen"),
        F.lit(0.0).alias("best"),
    )
    return F.aggregate(F.filter(pairs, lambda p: p["into"].isNotNull()), start, step, lambda s: s["best"])


def _random(cls: CharClass):
    def test(hit):
        mixed = F.lit(True)
        for needed in cls.needs:
            mixed = mixed & hit.rlike(needed)
        # The entropy is only computed where the cheap tests pass.
        return F.when(mixed, window_entropy(hit, cls) >= cls.bits).otherwise(F.lit(False))

    return test


def _allowed(hit: Column, patterns: Sequence[str]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | hit.rlike(pattern)
    return found


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """`docs` with `secrets`: an array of (first, kind, until, hit), by start and then kind.

    Kinds: 0 an assignment to a secret's name, 1 an access key, 2 a hexadecimal run; from 3 on one per
    class of `classes`: a run of the class with a window of high entropy, unless the whole string
    that it is part of matches a pattern of `allowed`, or it lies within a span already found. Positions are code points from 0,
    `until` is exclusive. Base kinds are leftmost and do not overlap within a kind, and the
    allow-list does not touch them.

    Map-only: each text is scanned whole in its own row, in time proportional to its length but for the
    sort of its spans. Null and empty texts have no spans, an empty table gives an empty table, and repeated
    rows get the same spans. Spans that tie in start and kind are one span. The output column replaces an
    input column of that name, and columns of other names stay as they are.
    """
    rest = others(docs, "secrets")
    t = F.coalesce(name(text), F.lit(""))
    frame = docs.select(*rest, t.alias("_llm_t"))
    t = F.col("_llm_t")
    long_enough = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LEAST
    every = lambda hit: F.lit(True)
    frame = frame.select(
        "*",
        _spans(t, ASSIGN, 0, t.contains(":") | t.contains("="), long_enough).alias("_llm_k0"),
        _spans(t, ACCESS, 1, t.contains("AKIA"), every).alias("_llm_k1"),
        _spans(t, HEX, 2, t.rlike(HEX), every).alias("_llm_k2"),
    )
    base = F.concat("_llm_k0", "_llm_k1", "_llm_k2")
    frame = frame.withColumn("_llm_found", base).drop("_llm_k0", "_llm_k1", "_llm_k2")
    news = []
    for kind, cls in enumerate(classes, start=3):
        run = f"[{cls.chars}]{{{cls.least},}}"
        # Held against starts of runs only: from each character, a long run without a digit would be read to its end.
        near = f"(?<![{cls.chars}])(?=[{cls.chars}]*[0-9]){run}"
        frame = frame.withColumn(f"_llm_c{kind}", _spans(t, run, kind, t.rlike(near), _random(cls)))
        news.append(F.col(f"_llm_c{kind}"))
    frame = frame.withColumn("_llm_new", F.concat(*news)).drop(*[f"_llm_c{k}" for k in range(3, 3 + len(classes))])
    is_allowed = lambda hit: _allowed(hit, allowed)
    frame = frame.withColumn("_llm_allowed", _spans(t, WHOLE, 0, F.size("_llm_new") > 0, is_allowed))
    # A string of two classes is listed for the first.
    fresh = F.when(
        F.size("_llm_new") > 0, _uncovered(F.concat("_llm_allowed", "_llm_found"), F.col("_llm_new"), len(classes))
    ).otherwise(F.col("_llm_new"))
    frame = frame.withColumn("_llm_found", F.concat("_llm_found", fresh))
    return frame.select(*rest, F.array_sort("_llm_found").alias("secrets"))


def kind_names(classes: Sequence[CharClass] = CLASSES) -> list[str]:
    return ["assign", "access", "hex", *[c.name for c in classes]]


def spans_text(spans: Column, names: Sequence[str]) -> Column:
    """`kind:start:end` of spans, comma-joined in their order."""
    label = F.array(*[F.lit(n) for n in names])
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(label, s["kind"] + 1), s["first"].cast("string"), s["until"].cast("string"))
    )
    return F.array_join(parts, ",")
