"""Personal data by candidate gradient boosting (native).

Generators: wide regexes per kind (e-mail, IP address, card number, phone number)
propose spans with high recall - spelt-out e-mail signs, other separators, numbers
without the plus sign. The contract's base spans are found beside them and always stay.

Boosted trees: every candidate has a few small integer features of its format
(digits, groups, check digit, length of the parts) and its context (neighbouring
characters, cue words before it). Candidates of the whole corpus are counted by
feature cell and weak label: positive if the candidate meets a base span of its
kind, else negative. The cells (at most the product of the features' values, in
practice some hundreds) are all the driver sees. Depth-two trees are fitted on them by
Newton steps of the logistic loss, over cells of one half of the documents; the
other half calibrates: per kind the lowest score above which at least ``PRECISION`` of
its candidates are positive becomes the threshold.

Selection: the trees are compiled into one Column expression over the candidate's
features. Finding, scoring and selecting is a projection of the document; nothing is
shuffled, so sources and copies need no care. Regexes have possessive runs with a
check of what stands before them, so very long runs cost linear time.

Defined results: a null text counts as empty and has no spans; offsets are code
points, end exclusive; spans are ordered by start, then kind as listed, then end; a
chosen candidate that meets a base span or an earlier kind's candidate is left out;
rows are judged one by one; without candidates nothing is added; an empty table
gives an empty table; clashing extra columns are harmless (only id and text are read).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import let, stored, text_of

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, leftmost and non-overlapping. Possessive runs and the
# look-behind (or "right after the last match", \G) change no match, only the cost.
# The card pattern takes only whole runs of 12 to 19 digits; others would be dropped.
_LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# High-recall generators.
WIDE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++[.,][0-9]++[.,][0-9]++[.,][0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20./-])[0-9](?:[\x20./-]?[0-9]){10,20}+(?![\x20./-]?[0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9][\x20().0-9/-]{6,}[0-9]",
}
# A text without this has no candidate and skips the costly passes: what every match
# of BASE and of WIDE holds (a card's digits may all stand apart).
NEEDED = {"email": r"@|[\[(]at[\])]", "ip": "[0-9]", "card": r"[0-9][\x20./-]?[0-9]", "phone": "[0-9]"}

CUE = r"(?i)(mail|write|contact|phone|tel|call|fax|mobile|card|visa|master|credit|pay|ip|host|server|addr|kontakt|anruf|carte|tarjeta)[a-z]*[\x20:=.#-]*$"
BEFORE = 24
PRECISION = 0.95
TREES, RATE, RIDGE = 24, 0.3, 1.0
FOLDS = 2


_MATCH = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches with their offsets and neighbours: what lies between them (split)
    and the matches themselves give the offsets as running sums; the context is
    taken from the gaps, so no text is searched for an offset again."""
    empty = F.array().cast(_MATCH)
    step = lambda acc, x: let(acc["at"] + x["gap"], lambda s: F.struct(
        (s + x["size"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct(
            s.alias("start"), (s + x["size"]).alias("end"), x["match"].alias("match"),
            x["before"].alias("before"), x["after"].alias("after")))).alias("out")))

    def located(ms, gaps):
        around = F.transform(ms, lambda m, i: F.struct(
            F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), m.alias("match"),
            F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after")))
        return F.aggregate(around, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda ms: F.when(
        F.size(ms) == 0, empty).otherwise(let(F.split(text, pattern, -1), lambda gaps: located(ms, gaps))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check-digit sum of a digit string is a multiple of ten."""
    each = lambda i: let(F.substring(F.reverse(digits), i, F.lit(1)).cast("int"), lambda d: F.when(
        i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), each),
                        F.lit(0), lambda a, x: a + x)
    return (F.length(digits) > 0) & (total % 10 == 0)


def _octets(m: Column) -> Column:
    return F.forall(F.split(m, "[.,]"), lambda x: x.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))


def valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {"email": F.lit(True), "ip": _octets(m), "card": n.between(12, 19) & luhn(_digits(m)),
            "phone": n.between(9, 15)}[kind]


def _base_of(text: Column, kind: str, rank: int) -> Column:
    found = F.transform(
        F.filter(matches(text, BASE[kind]), lambda x: valid(kind, x["match"])),
        lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))
    return F.coalesce(F.when(text.rlike(NEEDED[kind]), found),
                      F.array().cast("array<struct<start:int,rank:int,end:int>>"))


def base_spans(text: Column) -> Column:
    """array<struct<start,rank,end>> of the base spans, in order."""
    return F.sort_array(F.concat(*(_base_of(text, k, r) for r, k in enumerate(KINDS))))


# ------------------------------------------------------------------ features

FEATURES = ("kind", "digits", "groups", "even_groups", "check", "octets", "tail", "head", "before", "after", "cue")


def _char_class(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"[\x20\x09-\x0D]"), 1).when(c.rlike(r"[A-Za-z0-9]"), 2).otherwise(3)


def features(x: Column, kind: str, rank: int) -> Column:
    """Small integers; each has at most a dozen values."""
    m = x["match"]
    digits = _digits(m)
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    n = F.length(digits)
    before = x["before"]
    zero = F.lit(0)
    numeric = kind != "email"
    return F.struct(
        F.lit(rank).alias("kind"),
        (F.when(n <= 7, 0).when(n <= 9, 1).when(n <= 11, 2).when(n <= 13, 3).when(n <= 15, 4).when(n <= 16, 5)
         .when(n <= 19, 6).otherwise(7) if numeric else zero).alias("digits"),
        (F.least(F.size(groups), F.lit(6)) if kind in ("card", "phone") else zero).alias("groups"),
        ((F.size(F.array_distinct(F.transform(groups, lambda g: F.length(g)))) == 1).cast("int")
         if kind in ("card", "phone") else zero).alias("even_groups"),
        (luhn(digits).cast("int") if kind == "card" else zero).alias("check"),
        (_octets(m).cast("int") if kind == "ip" else zero).alias("octets"),
        (F.least(F.length(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)), F.lit(7)) if kind == "email" else zero).alias("tail"),
        (F.least(F.length(F.regexp_extract(m, r"^([A-Za-z0-9._%+-]+)", 1)), F.lit(4)) if kind == "email" else zero).alias("head"),
        _char_class(F.right(before, F.lit(1))).alias("before"),
        _char_class(x["after"]).alias("after"),
        before.rlike(CUE).cast("int").alias("cue"))


_SHAPE = ("array<struct<start:int,rank:int,end:int,f:struct<"
          + ",".join(f"{f}:int" for f in FEATURES) + ">,label:int>>")


def _candidates_of(text: Column, base: Column, kind: str, rank: int) -> Column:
    def row(x, starts):
        meets = lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])
        own = F.exists(base, lambda b: meets(b) & (b["rank"] == rank))
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
                        features(x, kind, rank).alias("f"),
                        # most candidates start where a base span does
                        F.when(F.array_contains(starts, x["start"]) | own, 1).when(F.exists(base, meets), 2).otherwise(0).alias("label"))

    own_starts = F.transform(F.filter(base, lambda b: b["rank"] == rank), lambda b: b["start"])
    found = let(own_starts, lambda starts: F.transform(matches(text, WIDE[kind]), lambda x: row(x, starts)))
    return F.coalesce(F.when(text.rlike(NEEDED[kind]), found).cast(_SHAPE), F.array().cast(_SHAPE))


def candidates(text: Column, base: Column) -> Column:
    """array<struct<start,rank,end,f,label>>: label 1 meets a base span of its kind, 2
    one of another kind, 0 none. The context is what stands since the last match."""
    return F.concat(*(_candidates_of(text, base, k, r) for r, k in enumerate(KINDS)))


# ------------------------------------------------------------------ boosting

@dataclass(frozen=True)
class Tree:
    """Split on ``feature <= cut``, then each side once more; a split may be None."""

    feature: str | None
    cut: int
    low: "Tree | None"
    high: "Tree | None"
    value: float

    def of(self, cell: dict) -> float:
        if self.feature is None:
            return self.value
        return (self.low if cell[self.feature] <= self.cut else self.high).of(cell)

    def column(self, f: Column) -> Column:
        if self.feature is None:
            return F.lit(float(self.value))
        return F.when(f[self.feature] <= self.cut, self.low.column(f)).otherwise(self.high.column(f))


def _leaf(g: float, h: float) -> Tree:
    return Tree(None, 0, None, None, RATE * g / (h + RIDGE))


def _grow(cells: list[dict], grads: list[tuple[float, float]], depth: int) -> Tree:
    g, h = sum(x for x, _ in grads), sum(x for _, x in grads)
    if depth == 0 or len(cells) < 2:
        return _leaf(g, h)
    best = (1e-6, None, 0)
    for f in FEATURES:
        sums: dict[int, list[float]] = {}
        for c, (a, b) in zip(cells, grads):
            s = sums.setdefault(c[f], [0.0, 0.0])
            s[0] += a
            s[1] += b
        gl = hl = 0.0
        for cut in sorted(sums)[:-1]:
            gl, hl = gl + sums[cut][0], hl + sums[cut][1]
            gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
            if gain > best[0]:
                best = (gain, f, cut)
    if best[1] is None:
        return _leaf(g, h)
    _, f, cut = best
    sides = [[(c, x) for c, x in zip(cells, grads) if (c[f] <= cut) == low] for low in (True, False)]
    low, high = (_grow([c for c, _ in s], [x for _, x in s], depth - 1) for s in sides)
    return Tree(f, cut, low, high, 0.0)


def boost(cells: list[dict]) -> list[Tree]:
    """Newton boosting on weighted cells (``pos`` and ``neg`` counts)."""
    trees: list[Tree] = []
    score = [0.0] * len(cells)
    for _ in range(TREES if cells else 0):
        grads = []
        for c, z in zip(cells, score):
            p = 1 / (1 + math.exp(-z))
            n = c["pos"] + c["neg"]
            grads.append((c["pos"] - n * p, n * p * (1 - p)))
        tree = _grow(cells, grads, 2)
        trees.append(tree)
        score = [z + tree.of(c) for c, z in zip(cells, score)]
    return trees


def calibrate(trees: list[Tree], cells: list[dict]) -> list[float]:
    """Per kind the lowest score above which PRECISION of the candidates are
    positive (infinite where none is)."""
    out = []
    for rank in range(len(KINDS)):
        own = sorted(((sum(t.of(c) for t in trees), c["pos"], c["neg"]) for c in cells if c["kind"] == rank), reverse=True)
        limit, pos, total = math.inf, 0, 0
        for i, (z, p, n) in enumerate(own):
            pos, total = pos + p, total + p + n
            if (i + 1 == len(own) or own[i + 1][0] < z) and total and pos >= PRECISION * total:
                limit = z
        out.append(limit)
    return out


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, fold, base spans and candidates of every row; texts stay behind."""
    t = docs.select("doc_id", text_of(docs).alias("t"))
    b = t.select("doc_id", F.pmod(F.xxhash64("t"), F.lit(FOLDS)).alias("fold"), "t", base_spans(F.col("t")).alias("base"))
    return b.select("doc_id", "fold", "base", candidates(F.col("t"), F.col("base")).alias("candidates"))


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, ``base`` and ``spans`` (base and added), both
    array<struct<start,rank,end>> in order; rank indexes KINDS."""
    found = stored(_found(docs), "personal-found")
    # candidates that meet another kind's base span are settled by it
    each = found.select("fold", F.explode("candidates").alias("c")).where("c.label < 2")
    cells = [r.asDict() for r in each.groupBy("fold", *(F.col(f"c.f.{f}").alias(f) for f in FEATURES)).agg(
        F.sum(F.col("c.label")).alias("pos"), F.sum(1 - F.col("c.label")).alias("neg")).collect()]
    trees = boost([c for c in cells if c["fold"] == 0])
    limits = calibrate(trees, [c for c in cells if c["fold"] == 1])

    def chosen(c: Column) -> Column:
        score = sum((t.column(c["f"]) for t in trees), F.lit(0.0))
        limit = F.element_at(F.array(*(F.lit(x) for x in limits)), c["rank"] + 1)
        return (c["label"] == 0) & (score >= limit)

    span = lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"))
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    picked = F.filter(F.col("candidates"), chosen)
    more = let(picked, lambda ps: F.transform(F.filter(ps, lambda c: ~F.exists(
        ps, lambda d: (d["rank"] < c["rank"]) & meets(c, d))), span))
    return found.select("doc_id", "base", F.sort_array(F.concat("base", more)).alias("spans"))
