"""Secret scans in DataFrame expressions only: no Python runs on the executors.

Base kinds are regular expressions (``KINDS``). The method adds the kind ``entropy``: candidate
strings of ``CANDIDATE`` characters fall into a character class (hexadecimal or mixed); a
window of ``WINDOW`` characters slides over each, and its Shannon entropy follows from letter
counts that each step changes by one character in and one out. A string whose best window
reaches the bound of its class is a secret, unless the allow-list knows it (identifiers,
alphabets, placeholders). Base spans are blanked before candidates are looked for, so what
stands beside one is tested by itself; a candidate with an allowed word is cut at ``=`` and ``/``,
and each part of WINDOW or more characters is tested by itself.

Positions are code points: gaps between matches come from ``split``, matches from
``regexp_extract_all``, and running sums of both lengths give every start. Sums go in blocks of
``BLOCK`` matches, so a text with very many matches stays cheap. All of it is computed per row:
no shuffle, and texts without a match stop at one test per kind.

Defined cases: null and empty texts have no spans; repeated rows give repeated results; an empty
table gives an empty table. Columns of any name pass through ``redact`` untouched but for ``text``
and ``n_chars``: they travel in one struct, so no name can clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "[SECRET]"
WINDOW = 20
BLOCK = 256
#: Least entropy in bits per character of the best window, by class.
BOUNDS = {"hex": 3.0, "mixed": 3.7}


class Kind(NamedTuple):
    """``test`` says cheaply whether a text can match at all; group ``group`` needs ``least`` characters."""

    name: str
    pattern: str
    test: str
    group: int
    least: int


#: Fixed by the contract, in its order.
KINDS = [
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 0, 20),
    Kind("hex", r"[0-9a-f]+", r"[0-9a-f]{24}", 0, 24),
]
CANDIDATE = Kind("entropy", r"[A-Za-z0-9+/_=-]+", r"(?=[A-Za-z+/_=-]{0,60}[0-9])[A-Za-z0-9+/_=-]{20}", 0, WINDOW)
#: Strings that look random but are public: UUIDs, alphabets and digits in order, placeholders.
ALLOWED = r"(?i)(?:^|[=/])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?:$|[=/])|example|placeholder|changeme|x{6,}|0123456789|1234567890|abcdefgh|qwerty"
#: Code points of candidate characters run from '+' to 'z'.
FIRST, LETTERS = ord("+"), ord("z") - ord("+") + 1
_SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _running(sizes: Column) -> Column:
    """Sum of the sizes before each position, in blocks."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    before = lambda a, first: F.slice(
        F.aggregate(a, F.array(first), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x))), F.lit(1), F.size(a)
    )
    blocks = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda k: F.slice(sizes, k * BLOCK + 1, F.lit(BLOCK)))
    heads = before(F.transform(blocks, total), F.lit(0))
    return F.flatten(F.zip_with(blocks, heads, before))


def _with_matches(df: DataFrame, text: str, kind: Kind, number: int) -> DataFrame:
    """Adds ``found``: spans of all matches that are long enough. Stages keep each expression computed once."""
    hits = F.when(F.col(text).rlike(kind.test), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
    df = df.withColumn("hits", hits)
    df = df.withColumn("gaps", F.when(F.size("hits") > 0, F.transform(F.split(text, kind.pattern, -1), F.char_length)))
    df = df.withColumn("lengths", F.transform("hits", F.char_length))
    df = df.withColumn("before", F.when(F.size("hits") > 0, _running(F.zip_with(F.slice("gaps", F.lit(1), F.size("lengths")), "lengths", lambda g, n: g + n))))
    if kind.group:
        held = F.transform("hits", lambda h: F.char_length(F.regexp_extract(h, "^(?:" + kind.pattern + ")$", kind.group)))
    else:
        held = F.col("lengths")
    df = df.withColumn("held", held)
    spans = F.transform(
        F.sequence(F.lit(1), F.size("hits")),
        lambda k: F.struct(
            (F.element_at("before", k) + F.element_at("gaps", k)).cast("int").alias("start"),
            F.lit(number).alias("kind"),
            (F.element_at("before", k) + F.element_at("gaps", k) + F.element_at("lengths", k)).cast("int").alias("stop"),
            F.element_at("held", k).alias("held"),
            F.element_at("hits", k).alias("hit"),
        ),
    )
    found = F.when(F.size("hits") > 0, F.filter(spans, lambda s: s["held"] >= kind.least))
    return df.withColumn("found", F.coalesce(found, F.array().cast("array<struct<start:int,kind:int,stop:int,held:int,hit:string>>"))).drop("hits", "gaps", "lengths", "before", "held")


def best_entropy(text: Column, enough: Column | None = None) -> Column:
    """The highest Shannon entropy of a window of WINDOW candidate characters, from incremental counts.

    The characters are numbered once; each step then changes two counts, so the cost is linear in the text.
    With ``enough`` the counting rests once a window reaches it: the result is then at least that.
    """
    numbers = F.transform(F.split(text, ""), lambda c: F.ascii(c) - (FIRST - 1))
    leaving = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), numbers), F.lit(1), F.char_length(text))
    steps = F.zip_with(numbers, leaving, lambda e, g: F.struct(e.alias("enters"), g.alias("leaves")))
    weigh = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def step(state: Column, move: Column) -> Column:
        enters, leaves = move["enters"], move["leaves"]
        more = F.element_at(state["counts"], enters)
        less = F.when((leaves > 0) & (leaves != enters), F.element_at(state["counts"], F.greatest(leaves, F.lit(1))))
        mass = state["mass"] + F.when(leaves == enters, F.lit(0.0)).otherwise(weigh(more + 1) - weigh(more) + F.coalesce(weigh(less - 1) - weigh(less), F.lit(0.0)))
        counts = F.when(leaves == enters, state["counts"]).otherwise(
            F.transform(state["counts"], lambda n, i: n + (i + 1 == enters).cast("double") - (i + 1 == leaves).cast("double"))
        )
        bits = F.lit(WINDOW).cast("double")
        best = F.when(state["at"] + 1 >= WINDOW, F.greatest(state["best"], F.log2(bits) - mass / bits)).otherwise(state["best"])
        moved = F.struct(state["enough"].alias("enough"), (state["at"] + 1).alias("at"), counts.alias("counts"), mass.alias("mass"), best.alias("best"))
        return F.when(state["best"] >= state["enough"], state).otherwise(moved)

    limit = F.lit(float("inf")) if enough is None else enough  # in the state, so that it is computed once
    start = F.struct(limit.alias("enough"), F.lit(0).alias("at"), F.array_repeat(F.lit(0.0), LETTERS).alias("counts"), F.lit(0.0).alias("mass"), F.lit(0.0).alias("best"))
    return F.aggregate(steps, start, step, lambda s: s["best"])


def _random(hit: Column) -> Column:
    mixed = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & ~hit.rlike(ALLOWED)
    bound = F.when(hit.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(BOUNDS["hex"])).otherwise(F.lit(BOUNDS["mixed"]))
    return mixed & (best_entropy(hit, bound) >= bound)


def _parts(hit: Column) -> Column:
    """(at, part) of a candidate: whole, or cut at = and / if it holds an allowed word."""
    kept = "array<struct<at:int,part:string>>"

    def step(state: Column, part: Column) -> Column:
        more = F.concat(state["parts"], F.array(F.struct(state["at"].alias("at"), part.alias("part"))))
        parts = F.when(F.char_length(part) >= WINDOW, more).otherwise(state["parts"])
        return F.struct((state["at"] + F.char_length(part) + 1).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kept).alias("parts"))
    cut = F.aggregate(F.split(hit, "[=/]", -1), start, step, lambda s: s["parts"])
    return F.when(hit.rlike(ALLOWED), cut).otherwise(F.array(F.struct(F.lit(0).alias("at"), hit.alias("part"))).cast(kept))


def _replaced(text: str, spans: str, fill) -> Column:
    """The text with ``fill(state, span)`` in place of each span; ``fill`` is null where an overlap adds nothing."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        parts = F.concat(state["parts"], F.array(gap, fill(state, span)))
        return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), parts.alias("parts"))

    finish = lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.aggregate(spans, empty, step, finish)


def _own(docs: DataFrame) -> DataFrame:
    """The caller's columns in one struct, the text (null: empty) beside it."""
    row = F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in docs.columns])
    return docs.select(row.alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_spans(df: DataFrame) -> DataFrame:
    """Adds ``base`` and ``spans`` (start, kind number, stop), both by start, then kind, to ``row`` and ``text``."""
    plain = lambda found: F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    df = df.withColumn("base", F.array().cast(_SPANS))
    for number, kind in enumerate(KINDS):
        df = _with_matches(df, "text", kind, number).withColumn("base", F.concat("base", plain(F.col("found")))).drop("found")
    df = df.withColumn("base", F.array_sort("base"))
    blank = lambda state, span: F.repeat(F.lit(" "), F.greatest(span["stop"] - F.greatest(state["at"], span["start"]), F.lit(0)))
    df = df.withColumn("blanked", F.when(F.size("base") > 0, _replaced("text", "base", blank)).otherwise(F.col("text")))
    df = _with_matches(df, "blanked", CANDIDATE, len(KINDS)).drop("blanked")
    parts = F.flatten(F.transform("found", lambda c: F.transform(_parts(c["hit"]), lambda p: F.struct(
        (c["start"] + p["at"]).alias("start"), c["kind"].alias("kind"), (c["start"] + p["at"] + F.char_length(p["part"])).alias("stop"), p["part"].alias("hit")
    ))))
    df = df.withColumn("free", F.when(F.size("found") > 0, parts)).drop("found")
    extra = F.when(F.size("free") > 0, plain(F.filter("free", lambda c: _random(c["hit"]))))
    return df.withColumn("spans", F.when(F.size("free") > 0, F.array_sort(F.concat("base", extra))).otherwise(F.col("base"))).drop("free")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in [*KINDS, CANDIDATE]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and all spans of every document."""
    df = with_spans(_own(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    number = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    counts = [number(n).alias(f"n_{kind.name}") for n, kind in enumerate(KINDS)]
    return df.select("row.doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """All documents with every secret span replaced by MARK (overlapping spans by one); n_chars follows the text."""
    df = with_spans(_own(docs))
    mark = lambda state, span: F.when((span["start"] >= state["at"]) | (F.size(state["parts"]) == 0), F.lit(MARK))
    df = df.withColumn("clean", F.when(F.size("spans") > 0, _replaced("text", "spans", mark)))
    changed = F.col("clean").isNotNull()
    columns = []
    for name in docs.columns:
        held = F.col("row").getField(name)
        if name == "text":
            held = F.when(changed, F.col("clean")).otherwise(held)
        elif name == "n_chars":
            held = F.when(changed, F.char_length("clean")).otherwise(held).cast(docs.schema["n_chars"].dataType)
        columns.append(held.alias(name))
    return df.select(*columns)
