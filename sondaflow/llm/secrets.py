"""Secrets in texts: fixed patterns, and candidate strings whose characters look random.

Everything is SQL expressions on the row's own text, so nothing is shuffled. The
places of matches follow from the pieces between them: ``split`` and
``regexp_extract_all`` cut at the same matches.

A candidate is a run of at least 20 characters of ``[A-Za-z0-9+/_=-]`` outside the fixed
spans; of one that they cut, each rest of at least 20 characters is a candidate. A window
slides over it; the counts of its characters are updated by the one that enters and the
one that leaves, and with them the sum of c log2 c, from which the Shannon entropy
follows. The candidate is a secret when a window reaches the limit of its character class,
unless the allow list names it or it is made of words and numbers, as identifiers and
paths are.

Texts may be long and full of matches: sums along an array go by blocks, pieces of texts
are cut by their places in bytes, and no pattern repeats a group, which the engine would
match by recursion.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The kinds of spans in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of fewer than 24 never holds a longer one

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Character class: pattern of the whole candidate, least entropy in bits of a window.
CLASSES = (("hexadecimal", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
           ("letters of one case", r"^([a-z_=/+-]+|[A-Z]?[a-z]*|[A-Z_=/+-]+)$", 3.2),  # random letters: 99 % reach it
           ("mixed", r"", 3.6))
# A name: parts between separators that are letters with a short number, or a number; words of some length; and
# letters as words have them: enough vowels, few rare letters, no long run of consonants.
SEPARATORS = r"[/_+=-]"
PART = r"^[A-Za-z]*[0-9]{0,4}$"
NUMBER = r"^[0-9]{1,8}$"
WORDS = r"[A-Z]+[a-z]*|[a-z]+"
WORD_LETTERS = 3
VOWELS, RARE, CONSONANTS = "aeiou", "jqxzwkvy", r"[b-df-hj-np-tv-xz]{8}"
VOWEL_PERCENT, RARE_PERCENT = 25, 15
# Identifiers and documentation samples that look random and are no secrets.
ALLOWED = (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"(?i)example")

# Places in code points, then in bytes.
SPAN = "array<struct<start:int,kind:int,end:int,value:string,first_byte:int,end_byte:int>>"
BLOCK = 1024


def _none() -> Column:
    return F.array().cast(SPAN)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each element what those before it combine to; blocks keep an appended array short."""
    def along(some: Column, start: Column) -> Column:
        return F.aggregate(
            some, F.struct(start.alias("at"), F.array_repeat(start, 0).alias("out")),
            lambda acc, v: F.struct(combine(acc["at"], v).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
            lambda acc: acc["out"])

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda some: F.aggregate(some, zero, combine))
        return F.flatten(F.zip_with(blocks, along(totals, zero), along))

    def of_values(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        return _let(F.transform(numbers, lambda b: F.slice(all_, b * BLOCK + 1, BLOCK)), of_blocks)

    return _let(values, lambda all_: F.when(F.size(all_) > 0, of_values(all_)).otherwise(F.slice(all_, 1, 0)))


def _spans(text: Column, kind: str, pattern: str, possible: Column, group: int = 0) -> Column:
    """All matches of the pattern, leftmost first and not overlapping, with their group as value."""
    def length(s: Column) -> Column:
        return F.struct(F.length(s).alias("chars"), F.octet_length(s).alias("bytes"))

    def sum_(a: Column, b: Column) -> Column:
        return F.struct((a["chars"] + b["chars"]).alias("chars"), (a["bytes"] + b["bytes"]).alias("bytes"))

    def placed(rows: Column) -> Column:
        steps = F.transform(rows, lambda r: sum_(r["before"], r["length"]))
        zero = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("bytes"))
        return F.zip_with(rows, _before(steps, zero, sum_), lambda r, at: F.struct(
            (at["chars"] + r["before"]["chars"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
            (at["chars"] + r["before"]["chars"] + r["length"]["chars"]).alias("end"), r["value"].alias("value"),
            (at["bytes"] + r["before"]["bytes"]).alias("first_byte"),
            (at["bytes"] + r["before"]["bytes"] + r["length"]["bytes"]).alias("end_byte")))

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(
        F.slice(F.transform(F.split(text, pattern, -1), length), F.lit(1), F.size(whole)).alias("before"),
        F.transform(whole, length).alias("length"),
        (whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("value"))
    return F.when(possible, F.when(text.rlike(pattern), _let(rows, placed))).otherwise(F.lit(None))


def window_entropy(candidate: Column, window: int = WINDOW, enough: Column | None = None) -> Column:
    """The largest entropy in bits of ``window`` successive characters of the alphabet, or the first that
    is ``enough``."""
    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))

    def slide(chars: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters = F.instr(F.lit(ALPHABET), F.get(chars, i)) - 1
            leaves = F.when(i >= window, F.instr(F.lit(ALPHABET), F.get(chars, i - window)) - 1).otherwise(-1)
            up = F.get(acc["counts"], enters)
            # The one that enters is counted before the one that leaves; they may be the same.
            down = F.get(acc["counts"], leaves) + F.when(leaves == enters, 1).otherwise(0)
            counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == enters, 1).otherwise(0)
                                 - F.when(k == leaves, 1).otherwise(0))
            total = (acc["total"] + weight(up + 1) - weight(up)
                     + F.when(i >= window, weight(down - 1) - weight(down)).otherwise(F.lit(0.0)))
            moved = F.struct(counts.alias("counts"), total.alias("total"), F.when(
                i >= window - 1, F.greatest(acc["most"], F.log2(F.lit(float(window))) - total / window))
                .otherwise(acc["most"]).alias("most"))
            return moved if enough is None else F.when(acc["most"] >= enough, acc).otherwise(moved)

        begin = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
                         F.lit(0.0).alias("total"), F.lit(0.0).alias("most"))
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), begin, step, lambda acc: acc["most"])

    return F.get(F.transform(F.array(F.split(candidate, "")), slide), F.lit(0))


def _name_like(value: Column) -> Column:
    """Whether a candidate is made of words and numbers."""
    def of_letters(letters: Column) -> Column:
        def count(some: str) -> Column:
            return F.length(letters) - F.length(F.translate(letters, some, ""))

        return ((count(VOWELS) * 100 >= VOWEL_PERCENT * F.length(letters))
                & (count(RARE) * 100 <= RARE_PERCENT * F.length(letters)) & ~letters.rlike(CONSONANTS)
                & (F.length(letters) >= WORD_LETTERS * F.size(F.regexp_extract_all(value, F.lit(WORDS), F.lit(0)))))

    parts = F.forall(F.split(value, SEPARATORS, -1), lambda p: p.rlike(PART) | p.rlike(NUMBER))
    return F.when(parts, _let(F.regexp_replace(F.lower(value), "[^a-z]", ""), of_letters)).otherwise(F.lit(False))


def _outside(candidates: Column, fixed: Column) -> Column:
    """The parts of the candidates outside the fixed spans, as spans like them.

    One sweep over the places where anything starts or ends, with how many fixed spans and how many
    candidates (0 or 1) have begun and not ended there.
    """
    def ends(spans: Column, field: str) -> list[Column]:
        marks = [F.transform(spans, lambda s: F.struct(
            s[at].alias("at"), *(F.lit(step if f == field else 0).alias(f) for f in ("cover", "inside", "number")),
        )) for at, step in (("start", 1), ("end", -1))]
        return marks

    def number(spans: Column) -> Column:
        """A candidate is known by how many have started."""
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("at"), F.lit(0).alias("cover"), F.lit(1).alias("inside"), F.lit(1).alias("number")))

    def sum_(a: Column, b: Column) -> Column:
        return F.struct(b["at"].alias("at"), *((a[f] + b[f]).alias(f) for f in ("cover", "inside", "number")))

    zero = F.struct(*(F.lit(0).alias(f) for f in ("at", "cover", "inside", "number")))

    def swept(events: Column, all_: Column) -> Column:
        # The state before an event holds from the event before it to this one.
        found = F.zip_with(events, _before(events, zero, sum_), lambda e, b: F.struct(
            b["at"].alias("first"), e["at"].alias("end"), b["cover"].alias("cover"), b["inside"].alias("inside"),
            b["number"].alias("number")))
        open_ = F.filter(found, lambda f: (f["cover"] == 0) & (f["inside"] == 1) & (f["end"] - f["first"] >= WINDOW))
        return F.transform(open_, lambda f: _let(F.get(all_, f["number"] - 1), lambda c: _part(c, f["first"], f["end"])))

    def merged(all_: Column) -> Column:
        events = F.sort_array(F.concat(*ends(fixed, "cover"), number(all_), ends(all_, "inside")[1]))
        return _let(events, lambda e: swept(e, all_))

    raw = F.transform(candidates, lambda c: F.struct(
        *(c[f].alias(f) for f in ("start", "kind", "end")), c["value"].cast("binary").alias("value"), c["first_byte"].alias("first_byte")))
    return F.when(F.size(fixed) == 0, candidates).otherwise(_let(raw, merged))


def _part(candidate: Column, first: Column, end: Column) -> Column:
    """Characters of a candidate are bytes, so a part is cut from its bytes."""
    skip = first - candidate["start"]
    return F.struct(
        first.alias("start"), candidate["kind"].alias("kind"), end.alias("end"),
        F.substring(candidate["value"], skip + 1, end - first).cast("string").alias("value"),
        (candidate["first_byte"] + skip).alias("first_byte"), (candidate["first_byte"] + skip + end - first).alias("end_byte"))


def _looks_random(value: Column, window: int) -> Column:
    """Whether a window reaches the limit of the candidate's class. No window has more bits than
    the logarithm of the distinct characters, which spares most candidates the windows."""
    limit = F.lit(CLASSES[-1][2])
    for _, pattern, bits in reversed(CLASSES[:-1]):
        limit = F.when(value.rlike(pattern), F.lit(bits)).otherwise(limit)
    distinct = F.log2(F.size(F.array_distinct(F.split(value, ""))).cast("double"))
    return _let(limit, lambda bits: F.when(distinct >= bits, window_entropy(value, window, bits) >= bits)
                .otherwise(F.lit(False)))


def with_spans(docs: DataFrame, text: str = "text", window: int = WINDOW,
               allowed: Sequence[str] = ALLOWED, out: str = "spans") -> DataFrame:
    """Adds ``out``: the spans (start, kind, end, value) of all secrets by start, then kind.

    Places are code points, the end is exclusive, ``kind`` is an index into KINDS.
    Spans of the fixed patterns always stay and may overlap each other; an entropy
    span overlaps none of them. A null or empty text has no spans, spans that start at
    one place go by kind. Repeated rows get the same spans; no rows give no rows. A very
    long text, word or number of matches costs in proportion, but for sums along blocks of
    1024 matches. Every other column stays as it is.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    marks = F.contains(whole, F.lit("=")) | F.contains(whole, F.lit(":"))
    assign = F.filter(_spans(whole, "assign", ASSIGN, marks, 1), lambda s: F.length(s["value"]) >= 6)
    access = F.filter(_spans(whole, "access", ACCESS, F.contains(whole, F.lit("AKIA"))),
                      lambda s: s["end"] - s["start"] >= 20)
    fixed = F.concat(*(F.coalesce(s, _none()) for s in (assign, access, _spans(whole, "hex", HEX, F.lit(True)))))

    def is_allowed(value: Column) -> Column:
        hit = F.lit(False)
        for pattern in allowed:
            hit = hit | value.rlike(pattern)
        return hit

    candidates = _outside(_spans(whole, "entropy", CANDIDATE, F.lit(True)), F.col("__fixed"))
    random = F.filter(candidates, lambda s: ~is_allowed(s["value"]) & ~_name_like(s["value"])
                      & _looks_random(s["value"], window))
    return (docs.withColumn("__fixed", fixed).withColumn("__random", F.coalesce(random, _none()))
            .withColumn(out, F.sort_array(F.concat("__fixed", "__random"))).drop("__fixed", "__random"))


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with the mask in place of each span; overlapping spans become one mask."""
    def cut(all_: Column, whole: Column) -> Column:
        def piece(first: Column, end: Column) -> Column:
            return F.substring(whole, first + 1, end - first).cast("string")

        # What has been covered before a span; one that starts inside it is no mask of its own.
        covered = _before(F.transform(all_, lambda s: s["end_byte"]), F.lit(0), lambda a, b: F.greatest(a, b))
        masks = F.zip_with(all_, covered, lambda s, at: F.when(
            s["first_byte"] >= at, F.concat(piece(at, s["first_byte"]), F.lit(mask))).otherwise(F.lit("")))
        return F.concat(F.array_join(masks, ""), piece(F.array_max(F.transform(all_, lambda s: s["end_byte"])),
                                                       F.octet_length(whole)))

    whole = F.coalesce(text, F.lit("")).cast("binary")
    return F.when(F.size(spans) > 0, _let(whole, lambda w: _let(spans, lambda all_: cut(all_, w)))).otherwise(text)
