"""Personal data: base patterns, and further spans chosen by boosted trees.

Everything runs on columns. A pattern's matches and the text between them come
from ``regexp_extract_all`` and ``split``; sums of their lengths are the spans'
positions. Generators with high recall propose overlapping candidates:
address-like strings, and number-like ones at three levels (a whole run of
digits and separators, its pieces without slashes and wide gaps, its groups
without spaces), so that a number beside another is a candidate of its own.

The trees learn what the patterns cannot match. Base findings are positives as
they stand and in altered forms (separators changed, plus removed, check digit
broken, sign of an address spelled out); the same digits written as dates,
decimals and ranges, and addresses cut before their dot, are negatives, as are
candidates that touch no base finding. A candidate that covers a base finding
only in part teaches nothing. Every row of known label is used: the trees are
fitted to all those of three values in four, and those of the others are held
out of the fit (by their value, so that copies stay together). On all held-out
findings, the lowest score at which the wanted share of
the rows of known label is positive becomes the kind's threshold. Candidates
above it that touch no base finding are added, the longest of nested ones. Base
findings always stay.

The patterns are the given ones with possessive quantifiers and run starts, so
that the time for a text grows with its length only; they match the same.
"""

from __future__ import annotations

from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.llm.common import stored, text_or_empty, without

#: Base kinds in their order, each with its pattern and what a text with a match must contain.
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]"),
    "card": (r"[0-9](?:[\x20-]?+[0-9]){12,}+", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
#: Candidate kinds in their order, each with the patterns that propose it and what a text with a match must contain.
CANDIDATES = {
    "contact": ((r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?+(?:@|\(at\)|\[at\])\x20?+[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",),
                r"@|\(at\)|\[at\]"),
    "number": ((r"(?<![0-9A-Za-z])[+(]?+[0-9](?:[().\x20/-]*+[0-9])++",
                r"(?<![0-9A-Za-z])[+(]?+[0-9](?:[().\x20-]{0,2}+[0-9])++",
                r"(?<![0-9A-Za-z])[+(]?+[0-9](?:[().-]*+[0-9])++"), "[0-9]"),
}
#: Code points of a candidate at least.
LEAST_LENGTH = 6
#: The candidate kind that a base kind's findings teach.
TEACHES = {"email": "contact", "ip": "number", "card": "number", "phone": "number"}
#: Rows that a leaf of a tree stands for at least: few alike candidates are not learned by heart.
LEAST_ROWS = 10
#: Share of positives among held-out candidates that a threshold must reach.
PRECISION = 0.95
#: Words before a value that speak of personal data.
KEYWORDS = r"(?i)\b(tel|phone|mobile|cell|fax|call|card|visa|iban|ssn|passport|account|mail|contact|ip)\b"
#: Characters of context before a candidate.
CONTEXT = 32
_BLOCK = 256


def _length_expr(pieces: str, matches: str) -> dict[str, str]:
    """SQL for the running positions of matches: sums within blocks of matches, and of whole blocks before."""
    lens = f"transform({matches}, (m, i) -> length({pieces}[i]) + length(m))"
    return {
        "lens": lens,
        "blocks": f"transform(sequence(0, greatest(size({matches}) - 1, 0) div {_BLOCK}), "
                  f"b -> aggregate(slice($lens, CAST(b * {_BLOCK} + 1 AS INT), {_BLOCK}), 0, (a, x) -> a + x))",
        "before": "transform($blocks, (x, b) -> aggregate(slice($blocks, 1, b), 0, (a, y) -> a + y))",
        "ends": f"transform($lens, (x, i) -> $before[CAST(i div {_BLOCK} AS INT)] + "
                f"aggregate(slice($lens, CAST(i div {_BLOCK} * {_BLOCK} + 1 AS INT), CAST(i % {_BLOCK} + 1 AS INT)), 0, (a, y) -> a + y))",
    }


def with_matches(df: DataFrame, name: str, pattern: str, hint: str, extra: str = "", text: str = "text") -> DataFrame:
    """Adds ``name``: an array of (start, end, value, left, right) of the pattern's
    leftmost non-overlapping matches; ``left`` and ``right`` are what surrounds them."""
    has = F.col(text).rlike(hint)
    none = F.array().cast("array<string>")
    t = df.withColumns({
        f"{name}_p": F.when(has, F.split(text, pattern, -1)).otherwise(none),
        f"{name}_m": F.when(has, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none),
    })
    for step, e in _length_expr(f"{name}_p", f"{name}_m").items():
        t = t.withColumn(f"{name}_{step}", F.expr(e.replace("$", f"{name}_")))
    out = F.expr(f"""transform({name}_m, (m, i) -> named_struct('start', {name}_ends[i] - length(m), 'end', {name}_ends[i],
        'value', m, 'left', right({name}_p[i], {CONTEXT}), 'right', left({name}_p[i + 1], 2)))""")
    return t.withColumn(name, out).drop(*[f"{name}_{s}" for s in ("p", "m", "lens", "blocks", "before", "ends")])


def _valid(kind: str, s: Column) -> Column:
    """The base rule's check of a match."""
    digits = F.regexp_replace(s["value"], "[^0-9]", "")
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
        return s["value"].rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        n = F.length(digits)
        digit = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")  # noqa: E731  from the right
        luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + F.when(
            i % 2 == 0, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)))
        return n.between(13, 19) & F.when(n.between(13, 19), luhn % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def found(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``findings``, arrays of (kind, start, end, value, left, right) by kind as listed, then start, and
    ``candidates`` of the same form, each span once; drops the text. Null texts are empty."""
    levels = {f"{k}{i}": (p, hint) for k, (patterns, hint) in CANDIDATES.items() for i, p in enumerate(patterns)}
    made = [f"pii_{k}" for k in (*BASE, *CANDIDATES, *levels, "text")]
    t = df.select(*without(df, ["findings", "candidates", "base", "spans", "added", "row", text_col, *made]), text_or_empty(f"`{text_col}`").alias("pii_text"))
    for kind, (pattern, hint) in {**BASE, **levels}.items():
        t = with_matches(t, f"pii_{kind}", pattern, hint, text="pii_text")

    def named(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            F.lit(kind).alias("kind"), *[s[c].alias(c) for c in ("start", "end", "value", "left", "right")]))

    for kind, (patterns, _) in CANDIDATES.items():  # equal spans of several levels follow each other when sorted
        every = F.concat(*[F.filter(f"pii_{kind}{i}", lambda s: F.length(s["value"]) >= LEAST_LENGTH) for i in range(len(patterns))])
        t = t.withColumn(f"pii_{kind}", F.array_sort(every))
        t = t.withColumn(f"pii_{kind}", F.expr(f"""filter(pii_{kind}, (s, i) -> i = 0
            OR s.start != pii_{kind}[i - 1].start OR s.end != pii_{kind}[i - 1].end)"""))
    def valid(kind: str) -> Column:
        return F.filter(f"pii_{kind}", lambda s: _valid(kind, s))

    findings = F.concat(*[named(k, valid(k)) for k in BASE])
    proposed = F.concat(*[named(k, F.col(f"pii_{k}")) for k in CANDIDATES])
    return t.withColumn("findings", findings).withColumn("candidates", proposed).drop(*made)


def _taught(kind: Column, value: Column) -> Column:
    """What a base finding teaches: an array of (value, label, altered)."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    row = lambda v, label, altered=True: F.struct(
        v.alias("value"), F.lit(float(label)).alias("label"), F.lit(altered).alias("altered"))
    bare = F.regexp_replace(value, r"^\+", "")
    national = F.regexp_replace(bare, "^[0-9]{1,3}[^0-9]+", "")  # without the country's number
    parts = lambda v, sep: F.regexp_replace(F.regexp_replace(v, "^[^0-9]+", ""), "[^0-9]+", sep)
    last = F.substring(digits, -1, 1).cast("int")
    broken = F.concat(F.expr("left(value, length(value) - 1)"), ((last + 1) % 10).cast("string"))
    fours = lambda sep: F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}")
    year = F.concat(F.lit("19"), F.substring(digits, 1, 2))
    two = lambda at, most: F.lpad((F.substring(digits, at, 2).cast("int") % most + 1).cast("string"), 2, "0")
    plain = [F.concat_ws("-", year, two(3, 12), two(5, 28)), F.concat_ws("/", two(5, 28), two(3, 12), year),
             F.concat_ws("-", year, F.concat(F.lit("20"), F.substring(digits, 3, 2))),
             F.concat_ws(".", F.substring(digits, 1, 3), F.substring(digits, 4, 2)),
             F.concat_ws(".", F.substring(digits, 1, 1), F.substring(digits, 2, 1), F.substring(digits, 3, 2))]
    at = lambda sign: F.regexp_replace(value, "@", sign)
    cut = F.regexp_extract(value, "^([^@]+@[^.]+)", 1)
    own = row(value, 1, False)
    negatives = [row(v, 0) for v in plain]
    return (F.when(kind == "email", F.array(own, *[row(at(s), 1) for s in (" @ ", "(at)", " (at) ", "[at]")],
                                            row(cut, 0), row(F.regexp_replace(cut, "@", " @"), 0)))
            .when(kind == "phone", F.array(own, row(bare, 1), row(national, 1), *[
                row(parts(v, s), 1) for v, s in ((bare, " "), (bare, "-"), (national, "-"), (national, "."))], *negatives))
            .when(kind == "card", F.array(own, row(broken, 1), *[row(fours(s), 1) for s in ("", " ", "-", ".")], *negatives))
            .otherwise(F.array(own)))


def features() -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    value, left, right = F.col("value"), F.col("left"), F.col("right")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    groups = F.array_remove(F.split(value, "[^0-9]+", -1), "")
    return {
        "n_digits": count(value, "[0-9]"),
        "n_letters": count(value, "[A-Za-z]"),
        "n_other": count(value, "[^0-9A-Za-z]"),
        "n_groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        "n_dots": count(value, r"\."),
        "n_spaces": count(value, r"\x20"),
        "has_plus": count(value, r"\+"),
        "has_paren": count(value, r"\("),
        "has_at": count(value, "@"),
        "n_years": F.size(F.filter(groups, lambda g: g.rlike("^(19|20)[0-9]{2}$"))).cast("double"),
        "after_space": F.when(left.rlike(r"(^|\s)$"), 1.0).otherwise(0.0),
        "before_space": F.when(right.rlike(r"^(\s|$|[.,;]\s)"), 1.0).otherwise(0.0),
        "keyword": F.when(left.rlike(KEYWORDS), 1.0).otherwise(0.0),
        "digits_before": count(left, "[0-9]"),
        "words_before": count(left, r"[^\W\d_]{2,}"),
    }


def examples(rows: DataFrame) -> DataFrame:
    """Features of every candidate and of every form of a base finding, stored once.

    ``label`` is 1 or 0, or null for a candidate that teaches nothing; ``known``
    tells forms of base findings from candidates, ``altered`` those that were
    changed; ``free`` candidates touch no base finding; forms that no generator
    would propose in their place are not ``proposed`` (negatives among them are left out).
    """
    overlaps = lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))
    made = features()
    seen = rows.where(F.size("candidates") > 0).select("row", "findings", F.inline("candidates")).select(
        "row", "kind", "start", "end", (~F.exists("findings", overlaps)).alias("free"), F.col("value").alias("origin"),
        F.lit(False).alias("known"), F.lit(False).alias("altered"), F.lit(True).alias("proposed"), *[c.alias(n) for n, c in made.items()])
    seen = seen.withColumn("label", F.when(F.col("free"), 0.0))
    kinds = F.create_map(*[F.lit(x) for pair in TEACHES.items() for x in pair])
    proposes = F.lit(False)  # whether a generator proposes the altered form where the finding stood
    for kind, (patterns, _) in CANDIDATES.items():
        whole = F.col("value").rlike(f"^(?:{patterns[0]})$") & (F.length("value") >= LEAST_LENGTH)
        proposes = F.when(F.col("kind") == kind, whole & ~F.col("left").rlike("[0-9A-Za-z]$")).otherwise(proposes)
    forms = rows.where(F.size("findings") > 0).select("row", F.inline("findings")).select(
        "row", kinds[F.col("kind")].alias("kind"), "start", "end", F.col("value").alias("origin"),
        F.explode(F.array(F.struct("left", "right"), *[  # in its place, and without context, so that the form must tell
            F.struct(F.lit(" ").alias("left"), F.lit(" ").alias("right"))])).alias("place"),
        _taught(F.col("kind"), F.col("value")).alias("forms")).select(
        "row", "kind", "start", "end", "origin", "place.*", F.inline("forms")).select(
        "row", "kind", "start", "end", F.lit(False).alias("free"), "origin", F.lit(True).alias("known"), "altered",
        F.coalesce(proposes, F.lit(False)).alias("proposed"), *[c.alias(n) for n, c in made.items()], "label").where("proposed OR label = 1")
    held = F.pmod(F.xxhash64("origin", F.lit(5)), F.lit(4)) == 0
    return stored(seen.unionByName(forms).withColumn("held", held).drop("origin"), "pii-examples")


def _bins(rows: int) -> int:
    """Bins at most, so that every row has a say in the splits: MLlib places them from ``maxBins`` squared rows, or 10,000 if
    those are more. A feature has as many bins as it has values."""
    return 32 if rows <= 10_000 else min(isqrt(rows) + 1, 46_340)  # the square is a 32-bit number


def fitted(table: DataFrame, precision: float = PRECISION) -> dict[str, tuple]:
    """Fits to every row of known label. Per candidate kind (trees, threshold, recall): ``recall`` is the share of the altered
    forms of held-out findings that a generator proposes and the trees accept (None without any).
    A kind without rows of both labels, or without a score of the wanted precision, is left out."""
    sizes = {r["kind"]: r["n"] for r in table.groupBy("kind").agg(F.count("label").alias("n")).collect()}
    out = {}
    for kind in CANDIDATES:
        if not sizes.get(kind):
            continue
        own = VectorAssembler(inputCols=list(features()), outputCol="features").transform(
            table.where((F.col("kind") == kind) & F.col("label").isNotNull()))
        learn = own.where("NOT held AND proposed").select("features", "label")
        by_label = [r["count"] for r in learn.groupBy("label").count().collect()]
        if len(by_label) < 2:
            continue
        trees = GBTClassifier(maxIter=10, maxDepth=4, maxBins=_bins(sum(by_label)), stepSize=0.3, minInstancesPerNode=LEAST_ROWS, seed=7, maxMemoryInMB=64).fit(learn)
        score = F.when(F.col("proposed"), F.round(vector_to_array("probability")[1], 2)).otherwise(-1.0)
        steps = trees.transform(own.where("held AND known")).withColumn("score", score).groupBy("score").agg(
            F.count_if(F.col("label") == 1).alias("good"), F.count("*").alias("n"),
            F.count_if((F.col("label") == 1) & F.col("altered")).alias("altered")).orderBy(F.desc("score")).collect()  # at most 102 rows
        good = total = 0
        threshold = None
        for s, lower in zip(steps, [*(s["score"] for s in steps[1:]), 0.0]):
            good, total = good + s["good"], total + s["n"]
            if s["score"] >= 0.5 and good / total >= precision:
                threshold = max(0.5, (s["score"] + lower) / 2)  # halfway to the next score seen
        if threshold is not None:
            altered = sum(s["altered"] for s in steps)
            taken = sum(s["altered"] for s in steps if s["score"] >= threshold)
            out[kind] = trees, threshold, taken / altered if altered else None
    return out


def added_spans(rows: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``row, added``: the spans the trees add, per row of ``(row, findings, candidates)`` that gets any."""
    table, scored = examples(rows), None
    for kind, (trees, threshold, _) in fitted(table, precision).items():
        own = VectorAssembler(inputCols=list(features()), outputCol="features").transform(
            table.where((F.col("kind") == kind) & F.col("free") & ~F.col("known")))
        part = trees.transform(own).where(F.round(vector_to_array("probability")[1], 2) >= threshold).select(
            "row", "kind", "start", "end")
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        return rows.select("row", F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("added")).limit(0)
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    outer = scored.withColumn("reached", F.max("end").over(before)).where("reached IS NULL OR reached < end")
    return outer.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without the text, with ``base`` and ``spans``: arrays of
    (kind, start, end) in code points, end exclusive, by kind as listed, then start.

    What the patterns find is stored once, without texts. Null texts are empty;
    repeated rows each get their row; columns of these names are replaced; a
    table without base findings gets none added; an empty table gives none.
    """
    rows = stored(found(df, text_col).withColumn("row", F.monotonically_increasing_id()), "pii")
    kinds = F.array(*[F.lit(k) for k in (*BASE, *CANDIDATES)])
    both = rows.drop("candidates").join(added_spans(rows.select("row", "findings", "candidates")), "row", "left")
    base = F.transform("findings", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    every = F.concat(base, F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    ranked = F.array_sort(F.transform(every, lambda s: F.struct(
        F.array_position(kinds, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    spans = F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return both.select(*without(both, ["row", "findings", "added"]), base.alias("base"), spans.alias("spans"))


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
