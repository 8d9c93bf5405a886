"""Secret scans. DataFrame functions only.

Base kinds, leftmost and not overlapping per kind: ``assign`` (a credential
name, a sign and a value of 12 or more characters), ``access`` (``AKIA`` keys
of 18 or more) and ``hex`` (runs of 16 or more).  ``entropy`` spans are added:
maximal runs of key characters are scanned with a window of ``WINDOW``
characters.  The counts of the characters in the window are carried from one
position to the next, and with them sum c * log2(c), so the Shannon entropy
log2(w) - sum / w follows from the two characters that enter and leave.  The
span runs from the first to the last window whose entropy reaches the
threshold of the character class.

The allow-list: a run in UUID form is not scanned, and words of documentation
samples (``ALLOWED``) cut a run, so that no window holds one and a key beside
such a word is still found.  Parts without a digit are scanned in their
stretches of letters only, by a threshold of their own.  Base spans are never
suppressed.

A step costs the same wherever it is: the characters of a run are looked up
once, ``CHUNK`` at a time, and the counts of a window are ``COUNT_BITS`` bits
each of a few long integers.  So a run of a million characters takes seconds
and the memory of a chunk.

Defined results: spans are in code points, end exclusive, over the whole text;
a null text is empty; texts without spans give zero counts and empty strings;
rows are scanned one by one, so repeated rows and null keys stay; an empty
table gives no rows; only the key and the text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns, and the least lengths of what they find
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "entropy")

RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
LETTER_RUN = r"(?<![A-Za-z])[A-Za-z]{20,}+"
WINDOW = 20
LETTERS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
# character class: (pattern of a run, least entropy in bits)
CLASSES = (
    ("^[0-9]+$", 3.1),
    ("^[0-9a-fA-F]+$", 3.0),
    ("^[0-9a-zA-Z]+$", 3.6),
    (".", 3.8),
)
LETTERS_LEAST = 3.8              # of stretches of letters in parts without a digit
ALLOWED = "(?i)example|sample|dummy|placeholder|changeme|0123456789abcdef|abcdefghijklmnop"
UUID = "(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
SPAN = "array<struct<start:int,kind:int,end:int>>"

CHUNK = 1 << 15                  # windows of a run that are scanned together
COUNT_BITS = 5                   # a count is at most WINDOW
COUNTS = 12                      # of a long integer
BLOCK = 256                      # numbers whose running sums are taken together


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(lengths: Column) -> Column:
    """The sum of what stands before each number of an array; block by block, since an array
    that grows by one costs its whole length."""
    def sums(numbers: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(numbers, begin, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def of_blocks(blocks: Column) -> Column:
        tops = sums(F.transform(blocks, lambda b: b["at"]))["out"]
        return F.flatten(F.zip_with(blocks, tops, lambda b, top: F.transform(b["out"], lambda at: at + top)))

    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(BLOCK))
    return _let(F.transform(firsts, lambda k: sums(F.slice(lengths, k, F.lit(BLOCK)))), of_blocks)


def _cut(text: Column, pattern: str) -> Column:
    """(gap, found, start of the gap) of a text cut by a pattern; the last gap has no find."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(gaps, found, lambda g, f: F.struct(g.alias("gap"), F.coalesce(f, F.lit("")).alias("found")))
    return _let(pairs, lambda p: F.zip_with(
        p, _starts(F.transform(p, lambda x: F.length(x["gap"]) + F.length(x["found"]))),
        lambda x, at: F.struct(x["gap"].alias("gap"), x["found"].alias("found"), at.alias("start"))))


def _placed(text: Column, pattern: str) -> Column:
    """(start, piece) of each match."""
    cut = _cut(text, pattern)
    return F.transform(F.slice(cut, 1, F.size(cut) - 1), lambda x: F.struct(
        (x["start"] + F.length(x["gap"])).alias("start"), x["found"].alias("piece")))


def _spans(text: Column, kind: int, pattern: str, keep: Column | None = None) -> Column:
    placed = _placed(text, pattern)
    if keep is not None:
        placed = F.transform(F.filter(F.arrays_zip(placed.alias("span"), keep.alias("keep")),
                                      lambda x: x["keep"]), lambda x: x["span"])
    spans = F.transform(placed, lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"),
        (x["start"] + F.length(x["piece"])).alias("end")))
    # texts without a match, nearly all of them, are read once and left
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.expr(f"cast(array() as {SPAN})"))


def _windows(run: Column, least: Column) -> Column:
    """(first, last) start of the windows of ``run`` that reach ``least`` bits, else -1."""
    term = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 2)]
    growth = F.array(*[F.lit(b - a) for a, b in zip(term, term[1:])])       # of the sum, by the count before
    # where the count of a character stands: (number of the long, bits below it, one)
    spot = lambda k: F.struct(F.lit(k // COUNTS).alias("slot"), F.lit(COUNT_BITS * (k % COUNTS)).alias("below"),
                              F.lit(1 << COUNT_BITS * (k % COUNTS)).cast("bigint").alias("one"))
    spots = F.array(*[spot(max(0, LETTERS.find(chr(c)))) for c in range(128)])
    slots = range(-(-len(LETTERS) // COUNTS))

    def count(acc: Column, at: Column) -> Column:
        held = F.lit(0).cast("bigint")
        for k in slots:
            held = F.when(at["slot"] == k, acc[f"n{k}"]).otherwise(held)
        return F.call_function("shiftright", held, at["below"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def step(acc: Column, x: Column) -> Column:
        come, gone = x["come"], x["gone"]
        full = gone.isNotNull()
        less = F.when(full, F.get(growth, count(acc, gone) - 1)).otherwise(0.0)
        same = full & (come["slot"] == gone["slot"]) & (come["below"] == gone["below"])
        total = acc["sum"] - less + F.get(growth, count(acc, come) - same.cast("int"))

        def moved(total: Column) -> Column:
            def ended(hit: Column) -> Column:
                start = acc["at"] - (WINDOW - 1)
                return F.struct(
                    *[(acc[f"n{k}"] + F.when(come["slot"] == k, come["one"]).otherwise(0)
                       - F.when(full & (gone["slot"] == k), gone["one"]).otherwise(0)).alias(f"n{k}") for k in slots],
                    total.alias("sum"), (acc["at"] + 1).alias("at"),
                    F.when(hit & (acc["first"] < 0), start).otherwise(acc["first"]).alias("first"),
                    F.when(hit, start).otherwise(acc["last"]).alias("last"))
            return _let((acc["at"] >= WINDOW - 1) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= least - 1e-9), ended)
        return _let(total, moved)

    begin = F.struct(*[F.lit(0).cast("bigint").alias(f"n{k}") for k in slots], F.lit(0.0).alias("sum"),
                     F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def scanned(first: Column) -> Column:
        part = F.substring(run, first + 1, F.lit(CHUNK + WINDOW - 1))
        come = F.transform(F.split(part, ""), lambda c: F.get(spots, F.ascii(c)))
        none = F.array_repeat(F.lit(None).cast("struct<slot:int,below:int,one:bigint>"), WINDOW)
        pairs = _let(come, lambda c: F.zip_with(c, F.slice(F.concat(none, c), 1, F.size(c)), lambda a, b: F.struct(
            a.alias("come"), b.alias("gone"))))
        return F.aggregate(pairs, begin, step, lambda acc: F.struct(
            F.when(acc["first"] >= 0, acc["first"] + first).alias("first"),
            F.when(acc["last"] >= 0, acc["last"] + first).alias("last")))

    firsts = F.sequence(F.lit(0), F.length(run) - WINDOW, F.lit(CHUNK))
    return _let(F.transform(firsts, scanned), lambda found: F.struct(
        F.coalesce(F.array_min(F.transform(found, lambda x: x["first"])), F.lit(-1)).alias("first"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["last"])), F.lit(-1)).alias("last")))


def _parts(runs: Column) -> Column:
    """(start, piece, least) of what is scanned of each run: between the words of the allow-list,
    parts with a digit, and of other parts the stretches of letters."""
    digit = lambda x: F.regexp_like(x["piece"], F.lit("[0-9]"))

    def judged(x: Column) -> Column:
        least = F.lit(None).cast("double")
        for pattern, bits in reversed(CLASSES):
            least = F.when(F.regexp_like(x["piece"], F.lit(pattern)), F.lit(bits)).otherwise(least)
        return least

    def of_run(x: Column) -> Column:
        whole = F.array(F.struct(x["start"].alias("start"), x["piece"].alias("piece")))
        cut = F.transform(_cut(x["piece"], ALLOWED), lambda c: F.struct(
            (x["start"] + c["start"]).alias("start"), c["gap"].alias("piece")))
        return F.when(F.regexp_like(x["piece"], F.lit(ALLOWED)), cut).otherwise(whole)

    def letters(x: Column) -> Column:
        return F.transform(_placed(x["piece"], LETTER_RUN), lambda y: F.struct(
            (x["start"] + y["start"]).alias("start"), y["piece"].alias("piece"), F.lit(LETTERS_LEAST).alias("least")))

    runs = F.filter(runs, lambda x: ~F.regexp_like(x["piece"], F.lit(UUID)))
    parts = F.filter(F.flatten(F.transform(runs, of_run)), lambda x: F.length(x["piece"]) >= WINDOW)
    return F.concat(
        F.transform(F.filter(parts, digit), lambda x: F.struct(
            x["start"].alias("start"), x["piece"].alias("piece"), judged(x).alias("least"))),
        F.flatten(F.transform(F.filter(parts, lambda x: ~digit(x)), letters)))


def _entropy(text: Column) -> Column:
    seen = F.transform(_parts(_placed(text, RUN)), lambda x: F.struct(
        x["start"].alias("start"), _windows(x["piece"], x["least"]).alias("seen")))
    spans = F.transform(F.filter(seen, lambda x: x["seen"]["first"] >= 0), lambda x: F.struct(
        (x["start"] + x["seen"]["first"]).alias("start"), F.lit(3).alias("kind"),
        (x["start"] + x["seen"]["last"] + WINDOW).alias("end")))
    return F.when(F.regexp_like(text, F.lit(RUN)), spans).otherwise(F.expr(f"cast(array() as {SPAN})"))


def secret_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``entropy_spans``: arrays of (start, kind
    as an index of ``KINDS``, end)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    long_value = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
                             lambda v: F.length(v) >= LEAST_ASSIGN)
    base = F.concat(
        _spans(text, 0, ASSIGN, long_value),
        # runs are maximal, so the least length can stand in the pattern
        _spans(text, 1, f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"),
        _spans(text, 2, f"[0-9a-f]{{{LEAST_HEX},}}"))
    return docs.withColumns({"base_spans": F.sort_array(base), "entropy_spans": _entropy(text)})


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = secret_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("base_spans", "entropy_spans"))).alias("spans"))
