"""Secret scan, with DataFrame and SQL functions only; row-local, no shuffle.

Two detectors share one span list per document:

* base patterns (assigned passwords and tokens, access keys, long hex runs);
  the offsets of a pattern's matches come from its matches and the gaps
  between them, both found by one regular expression in the JVM;
* the entropy detector: candidate strings (whole runs of token characters
  with a digit in them) are cut into characters once and read with a sliding
  window per character class. The window's counts are a string of 128 bytes,
  changed in two places per step (one character in, one out), and sum(c log2 c)
  changes by two table entries; it gives the Shannon entropy
  ``log2(w) - sum / w``. Windows at or above the class's threshold are merged
  to spans. Candidates that match an allow-list pattern, and spans inside a
  base span, are suppressed. All steps are linear in the text's length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_names

# fixed values: the base patterns
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: (class, pattern of a whole candidate, window, bits per character)
CLASSES = (("entropy_hex", r"^[0-9a-fA-F-]+$", 32, 3.2),
           ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 20, 3.9))
#: candidates that are known to be harmless: UUIDs, one repeated character,
#: documentation placeholders, counters
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^(.)\1*$",
         r"(?i)(example|placeholder|changeme|xxxxx|01234567|abcdefgh)", r"^[0-9_=+/-]+$")
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
_RUN = "A-Za-z0-9+/_="
_CANDIDATE = rf"(?<![{_RUN}-])(?=[A-Za-z+/_=-]*+[0-9])[{_RUN}-]{{20,}}+"
_STEP = 256


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not in every step of the
    higher-order functions within ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _offsets(matches: Column, gaps: Column) -> Column:
    """Code-point offset of each match. Offsets are gathered in chunks, so a
    text with very many matches costs no quadratic copying."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("now"),
                     F.expr("cast(array() as array<array<int>>)").alias("done"))

    def all_of(x):
        def step(a, i):
            at = a["at"] + F.get(x["gap"], i)
            now, done = _append(a, at)
            return F.struct((at + F.get(x["size"], i)).alias("at"), now.alias("now"), done.alias("done"))

        every = F.when(F.size(x["size"]) > 0, F.sequence(F.lit(0), F.size(x["size"]) - 1)).otherwise(
            F.expr("cast(array() as array<int>)"))
        return F.aggregate(every, start, step, lambda a: F.flatten(F.array_append(a["done"], a["now"])))

    return _bound(F.struct(F.transform(matches, lambda m: F.char_length(m)).alias("size"),
                           F.transform(gaps, lambda g: F.char_length(g)).alias("gap")), all_of)


def _spans(text: Column, pattern: str, kind: str, least: int, group: int = 0) -> Column:
    """Spans of the matches whose ``group`` has ``least`` characters or more."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(found.alias("m"), _offsets(found, F.split(text, pattern, -1)).alias("at"), sized.alias("g"))
    rank = KINDS.index(kind)
    spans = F.transform(F.filter(rows, lambda r: F.char_length(r["g"]) >= least), lambda r: F.struct(
        r["at"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
        (r["at"] + F.char_length(r["m"])).alias("end")))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.lit(None)).cast(SPAN)


_BYTES = bytes(range(128))
_CLOG = [c * math.log2(c) if c else 0.0 for c in range(129)]


def _count(counts: Column, code: Column) -> Column:
    return F.ascii(F.substr(counts, code + 1, F.lit(1)).cast("string"))


def _with_count(counts: Column, code: Column, n: Column) -> Column:
    return F.overlay(counts, F.substr(F.lit(_BYTES), n + 1, F.lit(1)), code + 1, F.lit(1))


def _append(a: Column, item: Column) -> tuple[Column, Column]:
    """``now`` and ``done`` of a state with one more item; chunks of _STEP, so
    that a long list costs no quadratic copying."""
    full = F.size(a["now"]) >= _STEP
    return (F.when(full, F.array(item)).otherwise(F.array_append(a["now"], item)),
            F.when(full, F.array_append(a["done"], a["now"])).otherwise(a["done"]))


def _windows(word: Column, size: int, bits: float) -> Column:
    """Merged spans (b, e) of the windows (of up to 127 characters) of an
    ASCII ``word`` with enough entropy."""
    # what one more of a character adds to sum(c log2 c), by its count
    more = F.array(*[F.lit(y - x) for x, y in zip(_CLOG, _CLOG[1:size + 1])])
    bound = F.lit(size * (math.log2(size) - bits + 1e-9))
    span = "struct<b:int,e:int>"
    zero = F.struct(F.lit(bytes(128)).alias("c"), F.lit(0.0).alias("s"), F.lit(-1).alias("b"), F.lit(-1).alias("e"),
                    F.expr(f"cast(array() as array<{span}>)").alias("now"),
                    F.expr(f"cast(array() as array<array<{span}>>)").alias("done"))

    def read(codes: Column) -> Column:
        def enter(a, i):
            came = F.get(codes, i - 1)
            n = _count(a["c"], came)
            return _with_count(a["c"], came, n + 1), a["s"] + F.get(more, n)

        def move(a, i):
            came, went = F.get(codes, i - 1), F.get(codes, i - 1 - size)
            n_in, n_out = _count(a["c"], came), _count(a["c"], went)
            same = came == went
            return (F.when(same, a["c"]).otherwise(_with_count(_with_count(a["c"], came, n_in + 1), went, n_out - 1)),
                    F.when(same, a["s"]).otherwise(a["s"] + F.get(more, n_in) - F.get(more, n_out - 1)))

        def step(a, i):
            (first, first_sum), (later, later_sum) = enter(a, i), move(a, i)
            return F.struct(F.when(i <= size, first).otherwise(later).alias("c"),
                            F.when(i <= size, first_sum).otherwise(later_sum).alias("s"),
                            *[a[x].alias(x) for x in ("b", "e", "now", "done")])

        def note(a, i):
            hit = (i >= size) & (a["s"] <= bound)
            opens = hit & (a["e"] < i - size)
            closes = opens & (a["e"] >= 0)
            now, done = _append(a, F.struct(a["b"].alias("b"), a["e"].alias("e")))
            return F.when(hit, F.struct(
                a["c"].alias("c"), a["s"].alias("s"), F.when(opens, i - size).otherwise(a["b"]).alias("b"), i.alias("e"),
                F.when(closes, now).otherwise(a["now"]).alias("now"),
                F.when(closes, done).otherwise(a["done"]).alias("done"))).otherwise(a)

        def end(a):
            every = F.flatten(F.array_append(a["done"], a["now"]))
            return F.when(a["e"] >= 0, F.array_append(every, F.struct(a["b"].alias("b"), a["e"].alias("e")))).otherwise(every)

        # the state after a step is bound once, for the note that is taken of it
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, lambda a, i: _bound(step(a, i), lambda b: note(b, i)), end)

    codes = F.transform(F.filter(F.split(word, ""), lambda x: x != ""), lambda x: F.ascii(x))
    return F.when(F.char_length(word) >= size, _bound(codes, read))


def _class_spans(candidate: Column, found_class) -> Column:
    name, _, size, bits = found_class
    rank, at = KINDS.index(name) if name in KINDS else len(KINDS), candidate["at"]
    return F.transform(_windows(candidate["m"], size, bits), lambda x: F.struct(
        (at + x["b"]).alias("start"), F.lit(rank).alias("rank"), F.lit(name).alias("kind"), (at + x["e"]).alias("end")))


def _entropy_spans(text: Column, classes, allow) -> Column:
    found = F.regexp_extract_all(text, F.lit(_CANDIDATE), F.lit(0))
    rows = F.arrays_zip(found.alias("m"), _offsets(found, F.split(text, _CANDIDATE, -1)).alias("at"))

    def of(r):
        free = F.lit(True)
        for p in allow:
            free = free & ~F.regexp_like(r["m"], F.lit(p))
        spans = F.lit(None)
        for found_class in reversed(classes):
            spans = F.when(F.regexp_like(r["m"], F.lit(found_class[1])), _class_spans(r, found_class)).otherwise(spans)
        return F.coalesce(F.when(free, spans), F.array().cast(SPAN))

    spans = F.flatten(F.transform(rows, of))
    return F.when(F.regexp_like(text, F.lit(_CANDIDATE)), spans).otherwise(F.lit(None)).cast(SPAN)


def _uncovered(base: Column, found: Column) -> Column:
    """The spans of ``found`` that no span of ``base`` contains: both are read
    in order of start, with the furthest end of a base span so far."""
    one = "struct<start:int,mine:int,rank:int,kind:string,end:int>"
    start = F.struct(F.lit(-1).alias("reach"), F.expr(f"cast(array() as array<{one}>)").alias("now"),
                     F.expr(f"cast(array() as array<array<{one}>>)").alias("done"))

    def marked(spans, mine):
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(mine).alias("mine"),
                                                     x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))

    def step(a, x):
        now, done = _append(a, x)
        free = (x["mine"] == 1) & (x["end"] > a["reach"])
        return F.struct(F.when(x["mine"] == 0, F.greatest(a["reach"], x["end"])).otherwise(a["reach"]).alias("reach"),
                        F.when(free, now).otherwise(a["now"]).alias("now"),
                        F.when(free, done).otherwise(a["done"]).alias("done"))

    kept = F.aggregate(F.array_sort(F.concat(marked(base, 0), marked(found, 1))), start, step,
                       lambda a: F.flatten(F.array_append(a["done"], a["now"])))
    return F.transform(kept, lambda x: F.struct(*[x[c].alias(c) for c in ("start", "rank", "kind", "end")]))


def scan_secrets(docs: DataFrame, text_col: str = "text", classes=CLASSES, allow=ALLOW) -> DataFrame:
    """All columns of ``docs`` plus ``base_spans`` and ``spans`` (base and
    entropy), arrays of (start, rank, kind, end) in order of start and kind;
    code points, end exclusive.

    Base matches are leftmost and do not overlap within a kind: assignments
    whose value has 12 or more characters, access keys of 18 or more, hex runs
    of 16 or more. Null and empty texts have no spans; repeated rows are
    scanned alike; input columns named like the two added ones are replaced."""
    empty = F.array().cast(SPAN)
    work = docs.drop(*[c for c in ("base_spans", "spans") if c != text_col])
    text = F.coalesce(work[text_col].cast("string"), F.lit(""))
    kinds = (_spans(text, ASSIGN, "assign", 12, 2), _spans(text, ACCESS, "access", 18),
             # a hex run of 16 or more is a whole run, so shorter ones need no match
             _spans(text, r"[0-9a-f]{16,}", "hex", 16), _entropy_spans(text, classes, allow))
    names = free_names(work, *("found%d" % i for i in range(len(kinds))))
    work = work.select("*", *[c.alias(k) for k, c in zip(names, kinds)])
    base = F.array_sort(F.concat(*[F.coalesce(F.col(k), empty) for k in names[:-1]]))
    work = work.withColumn("base_spans", base)
    some = F.size(F.coalesce(F.col(names[-1]), empty)) > 0
    spans = F.when(some, F.array_sort(F.concat("base_spans", _uncovered(F.col("base_spans"), F.col(names[-1])))))
    return work.withColumn("spans", F.coalesce(spans, F.col("base_spans"))).drop(*names)


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
