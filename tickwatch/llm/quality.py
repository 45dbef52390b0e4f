"""Quality rules combined by weak supervision.

Rules look at a text's measures and vote good, bad or abstain. No rule must
pass: expectation-maximisation over the vote patterns of the whole corpus
estimates how often each rule casts each vote on good and on bad texts, and a
text's posterior probability of being good decides. A pattern is one of
``3 ** len(RULES)``, which bounds the table of pattern counts that reaches the
driver; the counts behind it cover every row. The posterior is a sum of
per-rule terms, so scoring is a column expression with the fitted numbers as
literals: no join, no shuffle of texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import fresh_name, stored, text_or_empty, without, words

#: Fixed values of the base rule.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Rule: (number x as SQL over the measures, bad if, good if); between the two it abstains.
RULES = {
    "length": ("n_words", "x < 50", "x >= 80"),
    "repetition": ("n_repeat_words / n", "x > 0.3", "x < 0.1"),
    "symbols": ("n_symbols / n", "x > 0.1", "x < 0.02"),
    "symbol_runs": ("n_symbol_runs / n", "x > 0.1", "x < 0.02"),
    "letters": ("n_letters / greatest(word_chars, 1)", "x < 0.8", "x > 0.9"),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", "x > 0.3", "x < 0.1"),
    "word_length": ("word_chars / n", "x < 2.5 OR x > 12", "x BETWEEN 3 AND 9"),
    "capitals": ("n_upper / greatest(word_chars, 1)", "x > 0.3", "x < 0.1"),
    "marks": ("n_marks / n", "x > 0.1", "x < 0.02"),
    "variety": ("n_distinct / sqrt(n)", "x < 2", "x >= 4"),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
            "n_distinct", "n_symbol_runs", "n_letters"]


def measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds :data:`MEASURES` of every text (null: empty), replacing columns of these names.

    Repeated words, those in a 3-word window that occurs twice or more: the
    windows' hashes are packed with their positions into 64-bit numbers (as
    many low bits as positions need) and sorted, which brings equal windows
    together. The words of neighbours are compared; should different windows
    share a hash, that text's windows are sorted by their words instead.
    """
    mark = fresh_name(df, "q")
    while any(c.lower().startswith(mark.lower()) for c in df.columns):
        mark += "_"
    own = without(df, MEASURES)
    step = lambda t, **made: t.withColumns({f"{mark}{k}": F.expr(e.replace("$", mark)) for k, e in made.items()})
    t = df.select(*own, text_or_empty(f"`{text_col}`").alias(f"{mark}t"))
    t = t.withColumn(f"{mark}w", words(f"{mark}t"))
    t = step(t, n="size($w)", lines=r"filter(split($t, '\n', -1), l -> l RLIKE '[^\\x20\\x09-\\x0D]')")
    t = step(t, b="coalesce(CAST(ceil(log2($n + 1)) AS INT), 0)")
    t = step(t, s="""CASE WHEN $n < 3 THEN array() ELSE sort_array(transform(sequence(0, $n - 3),
        i -> coalesce(shiftleft(xxhash64($w[i], $w[i + 1], $w[i + 2]), $b) | CAST(i AS BIGINT), 0L))) END""")
    t = step(t, d="""filter($s, (x, i) -> (i > 0 AND shiftright(x, $b) = shiftright($s[i - 1], $b))
        OR (i + 1 < $n - 2 AND shiftright(x, $b) = shiftright($s[i + 1], $b)))""")
    t = step(t, p="transform($d, x -> CAST(x & (shiftleft(1L, $b) - 1) AS INT))")
    t = step(t, c="""exists(sequence(1, greatest(size($p), 2) - 1), i -> i < size($p)
        AND shiftright($d[i], $b) = shiftright($d[i - 1], $b)
        AND NOT ($w[$p[i]] = $w[$p[i - 1]] AND $w[$p[i] + 1] = $w[$p[i - 1] + 1] AND $w[$p[i] + 2] = $w[$p[i - 1] + 2]))""")
    t = step(t, x="""CASE WHEN $c THEN array_sort(transform(sequence(0, $n - 3),
        i -> named_struct('a', $w[i], 'b', $w[i + 1], 'c', $w[i + 2], 'p', i))) END""")
    alike = lambda j: f"(x.a = $x[{j}].a AND x.b = $x[{j}].b AND x.c = $x[{j}].c)"
    t = step(t, at=f"""sort_array(CASE WHEN $c THEN transform(filter($x, (x, i) -> (i > 0 AND {alike("i - 1")})
        OR (i + 1 < $n - 2 AND {alike("i + 1")})), x -> x.p) ELSE $p END)""")
    return step(t, r="transform($at, (x, i) -> if(i + 1 < size($at), least(3, $at[i + 1] - x), 3))").select(
        *own,
        *[F.expr(e.replace("$", mark)).cast("long").alias(m) for m, e in {
            "n_words": "$n",
            "word_chars": "length(array_join($w, ''))",
            "n_symbols": r"size(split($t, '[#*\\x24%&|<>]', -1)) - 1",
            "n_dup_lines": "size($lines) - size(array_distinct($lines))",
            "n_repeat_words": "aggregate($r, 0L, (a, x) -> a + x)",
            "n_lines": "size($lines)",
            "n_upper": r"size(split($t, '\\p{Lu}', -1)) - 1",
            "n_marks": "size(split($t, '[!?]{2,}', -1)) - 1",
            "n_distinct": "size(array_distinct($w))",
            "n_symbol_runs": r"size(split($t, '[#*\\x24%&|<>]+', -1)) - 1",
            "n_letters": r"length(regexp_replace($t, '\\P{L}+', ''))",
        }.items()],
    )


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words")


def vote(rule: str) -> Column:
    """1 good, -1 bad, 0 abstain."""
    number, bad, good = RULES[rule]
    number = f"({number.replace('/ n', '/ greatest(n_words, 1)').replace('sqrt(n)', 'sqrt(greatest(n_words, 1))')})"
    use = lambda test: test.replace("x ", number + " ")
    return F.expr(f"CASE WHEN {use(bad)} THEN -1 WHEN {use(good)} THEN 1 ELSE 0 END")


def with_votes(measured: DataFrame) -> DataFrame:
    """Adds ``votes``, one character per rule: ``+`` good, ``-`` bad, ``0`` abstain."""
    sign = lambda rule: F.when(vote(rule) > 0, "+").when(vote(rule) < 0, "-").otherwise("0")
    return measured.withColumn("votes", F.concat(*map(sign, RULES)))


@dataclass
class LabelModel:
    """How often each rule votes +, 0 and - on good and on bad texts, and the share of good texts."""

    good_share: float = 0.8
    on_good: list[dict[str, float]] = field(default_factory=lambda: [{"+": 0.8, "0": 0.15, "-": 0.05} for _ in RULES])
    on_bad: list[dict[str, float]] = field(default_factory=lambda: [{"+": 0.45, "0": 0.15, "-": 0.4} for _ in RULES])

    def log_odds(self, votes: str) -> float:
        terms = (math.log(g[v] / b[v]) for g, b, v in zip(self.on_good, self.on_bad, votes))
        return math.log(self.good_share / (1 - self.good_share)) + sum(terms)

    def posterior(self, votes: str) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.log_odds(votes)))))

    def posterior_column(self, votes: str = "votes") -> Column:
        """The posterior as a column expression over the vote string."""
        odds = F.lit(math.log(self.good_share / (1 - self.good_share)))
        for i, (g, b) in enumerate(zip(self.on_good, self.on_bad)):
            v = F.substring(votes, i + 1, 1)
            odds = odds + F.when(v == "+", math.log(g["+"] / b["+"])).when(v == "-", math.log(g["-"] / b["-"])).otherwise(
                math.log(g["0"] / b["0"]))
        return 1 / (1 + F.exp(-odds))


def fit(patterns: dict[str, int], rounds: int = 50, prior: float = 0.05) -> LabelModel:
    """Expectation-maximisation over counts of vote patterns (no labels).

    The starting values, which say that rules tend to be right, also act as a
    prior worth ``prior`` of all rows, so that classes keep their meaning and a
    vote never seen on a class keeps a positive rate, alike at every size.
    """
    start = model = LabelModel()
    total = sum(patterns.values())
    if not total:
        return model
    weight = prior * total
    for _ in range(rounds):
        good = {p: n * model.posterior(p) for p, n in patterns.items()}
        n_good = sum(good.values())
        share = (n_good + weight * start.good_share) / (total + weight)

        def rates(mass: dict[str, float], first: list[dict[str, float]]) -> list[dict[str, float]]:
            whole = sum(mass.values()) + weight
            out = []
            for i, rate in enumerate(first):
                sums = {v: weight * r for v, r in rate.items()}
                for p, m in mass.items():
                    sums[p[i]] += m
                out.append({v: x / whole for v, x in sums.items()})
            return out

        model = LabelModel(share, rates(good, start.on_good), rates({p: n - good[p] for p, n in patterns.items()}, start.on_bad))
    return model


def fit_on(voted: DataFrame) -> LabelModel:
    """Fit on all rows of a table with ``votes``; at most ``3 ** len(RULES)`` counts reach the driver."""
    counts = voted.groupBy("votes").agg(F.count("*").alias("n"))
    return fit({r["votes"]: r["n"] for r in counts.collect()})


def decide(voted: DataFrame, model: LabelModel, least: float = 0.5) -> DataFrame:
    """Adds ``base_failed``, ``posterior`` and ``kept``: not base_failed, and posterior of ``least`` or more."""
    out = voted.withColumns({"base_failed": base_failed(), "posterior": F.round(model.posterior_column(), 6)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))


def quality_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, votes, posterior and verdict of every row, with its id.

    The measured rows (numbers only) are stored once, for the fit and the
    verdicts. Null texts are empty and fail the base rule; repeated rows each
    get their row; an empty table gives an empty one.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    voted = stored(with_votes(measures(rows).drop("text")), "quality")
    return decide(voted, fit_on(voted)).withColumnRenamed("id", id_col)


def kept_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, in its columns.

    The fit reads all texts once, the filter once more: no text is shuffled or stored.
    """
    model = fit_on(with_votes(measures(df.select(F.col(f"`{text_col}`").alias("text")))))
    own = fresh_name(df, "quality_row")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(own), F.col(f"`{text_col}`").alias("text"))
    # A filter is not pushed below a row number; pushed into the measures it would compute them many times over.
    judged = decide(with_votes(measures(rows).drop("text")), model).select(own, "kept", F.monotonically_increasing_id().alias("at"))
    return judged.where("kept AND at >= 0").select(f"{own}.*")
