"""Secret scan with multipart credential linking.

Strong patterns are reported alone. Other parts of a credential are too common
to report alone: an access identifier (a user or client id), a secret (a short
or unlabelled random string), an endpoint (a URL or host). They are reported
when complementary parts co-occur in a scope; the wider the scope, the stricter
the condition:

* a paragraph, at most ``WINDOW`` characters apart: any parts;
* a section (up to a heading or ruled line), at any distance: identifiers and
  unlabelled random-looking strings;
* the document, at any distance: identifiers and labelled values of at least
  ``STRICT_LENGTH`` characters with letters and digits.

In the wider scopes a secret without an identifier in its paragraph is linked to
the nearest one (ties: the one before). Scopes lie inside one document, so
documents are the unit Spark deals out, and the interval join of a scope's parts
is a sorted sweep over them; there is no shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.llm.common import ship_code, text_or_empty, without

#: The kinds of base findings, in the order in which ties are listed.
BASE_KINDS = ("assign", "access", "hex")
#: Kinds the linking adds, in the order in which ties are listed.
LINKED_KINDS = ("linked_access", "linked_secret", "linked_endpoint")
#: Characters between linked parts of a paragraph at most.
WINDOW = 240
#: Characters of a labelled value at least that is linked anywhere in its document.
STRICT_LENGTH = 9

#: The base patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_VALUE_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX = re.compile(r"[0-9a-f]{16,}")

#: Weak patterns. A value's span is reported, or the whole match without one; values are whole runs, of any length.
LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WEAK_ACCESS = re.compile(
    r"""(?<![A-Za-z0-9])(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account)["']?"""
    r"""[\x20\t]*+[:=][\x20\t]*+["']?([A-Za-z0-9._@+-]{3,}+)""", re.ASCII | re.IGNORECASE)
WEAK_SECRET = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|auth|bearer|credential|private[_-]?key)["']?"""
    r"""[\x20\t]*+[:=][\x20\t]*+["']?([A-Za-z0-9+/_.=!@#$%^&*-]{6,}+)""", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}+"""
    r"""|(?:host|hostname|endpoint|server|url)["']?[\x20\t]*+[:=][\x20\t]*+["']?[A-Za-z0-9._:/-]{3,}+)""",
    re.ASCII | re.IGNORECASE)
#: Strings one of which every match of the patterns beside it has, in lower case.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
WEAK_HINTS = ("access", "client", "user", "login", "account", "pass", "pwd", "auth", "bearer", "credential", "private",
              "://", "host", "endpoint", "server", "url", *ASSIGN_HINTS)
PARAGRAPH = re.compile(r"\n[\x20\t\r]*\n")
SECTION = re.compile(r"^(?:#{1,6}\x20|\[[^\]\n]++\][\x20\t\r]*$|[-=_*#]{3,}+[\x20\t\r]*$)", re.MULTILINE)
#: Bits a character an unlabelled string must carry to be a candidate secret.
LEAST_ENTROPY = 3.5

Span = tuple[str, int, int]


def base_spans(text: str, runs: list[tuple[int, int]], lowered: str) -> list[Span]:
    """Leftmost non-overlapping base findings of each kind; failing matches are dropped, not retried."""
    found: list[Span] = []
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE_LENGTH]
    for start, end in runs:  # both patterns' matches lie within a long run
        found += [("access", *m.span()) for m in ACCESS.finditer(text, start, end) if m.end() - m.start() >= ACCESS_LENGTH]
        found += [("hex", *m.span()) for m in HEX.finditer(text, start, end)]
    return found


def _random_looking(value: str) -> bool:
    """Digits with letters of both cases, and spread out like random characters."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= LEAST_ENTROPY


def _strict(value: str) -> bool:
    """A value long enough, with letters and digits, to be linked anywhere in its document."""
    return len(value) >= STRICT_LENGTH and bool(re.search("[0-9]", value)) and bool(re.search("[A-Za-z]", value))


def linked_spans(text: str, base: list[Span], runs: list[tuple[int, int]], lowered: str) -> list[Span]:
    """Weak parts with a complementary part in one of their scopes, or inside their span under a label of its own."""
    weak: dict[str, list[tuple[int, int]]] = {"access": [], "secret": [], "endpoint": []}
    random = [r for r in runs if r[1] - r[0] >= 20 and _random_looking(text[slice(*r)])]
    weak["secret"] += random
    matches: dict[str, list[tuple[int, int, int]]] = {}  # by role: start of the label, span
    if any(h in lowered for h in WEAK_HINTS):
        matches["access"] = [(m.start(), *m.span(1)) for m in WEAK_ACCESS.finditer(text)]
        matches["secret"] = [(m.start(), *m.span(1)) for m in WEAK_SECRET.finditer(text)]
        matches["endpoint"] = [(m.start(), *m.span()) for m in ENDPOINT.finditer(text)]
        for role, found in matches.items():
            weak[role] += [(a, b) for _, a, b in found]
    if not any(weak.values()):
        return []
    cuts = [m.start() for m in PARAGRAPH.finditer(text)]
    scope = lambda at: bisect_right(cuts, at)
    strong = {"access": [s[1:] for s in base if s[0] == "access"],
              "secret": [s[1:] for s in base if s[0] != "access"], "endpoint": []}
    covered: list[list[int]] = []  # base findings, overlapping ones as one
    for a, b in sorted(s[1:] for s in base):
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    assigned = sorted(s[1:] for s in base if s[0] == "assign")
    starts = {role: sorted(a for a, _ in weak[role] + strong[role]) for role in weak}
    ends = {role: sorted(b for _, b in weak[role] + strong[role]) for role in weak}

    def near(role: str, a: int, b: int) -> bool:
        """Whether a part of the role lies before or after [a, b), in its scope and window."""
        at = bisect_left(starts[role], b)
        if at < len(starts[role]) and starts[role][at] - b <= WINDOW and scope(starts[role][at]) == scope(a):
            return True
        at = bisect_right(ends[role], a) - 1
        return at >= 0 and a - ends[role][at] <= WINDOW and scope(ends[role][at] - 1) == scope(a)

    unlabelled = set(random) - {(a, b) for _, a, b in matches.get("secret", [])}

    def reported(a: int, b: int) -> bool:
        """Whether base findings report all of [a, b); of an unlabelled run an assignment's own name may stand before them."""
        at = bisect_right(covered, a, key=lambda s: s[0]) - 1
        if at >= 0 and covered[at][1] >= b:
            return True
        at = bisect_left(assigned, (b,)) - 1
        return (a, b) in unlabelled and at >= 0 and assigned[at][1] >= b

    partners = {"access": ("secret",), "secret": ("access", "endpoint"), "endpoint": ("access", "secret")}
    # A long value may hold its partner: settings joined by &, the query of a URL.
    holding: set[tuple[str, int, int]] = set()
    for role, outer in matches.items():
        for partner in partners[role]:
            inner = sorted([*matches[partner], *((a, a, b) for a, b in strong[partner])])
            for _, a, b in outer:
                at = bisect_right(inner, a, key=lambda m: m[0])
                while at < len(inner) and inner[at][0] < b:
                    if inner[at][2] <= b:
                        holding |= {(role, a, b), (partner, *inner[at][1:])}
                    at += 1
    found = set()
    for role, parts in weak.items():
        for a, b in parts:
            if not reported(a, b) and ((role, a, b) in holding or any(near(p, a, b) for p in partners[role])):
                found.add((f"linked_{role}", a, b))
    # Wider scopes: strict secrets and their nearest identifier.
    by_start = sorted({*weak["access"], *strong["access"]})
    by_end = sorted((b, a) for a, b in by_start)
    heads = [m.start() for m in SECTION.finditer(text)] if by_start and unlabelled else []
    section = lambda at: bisect_right(heads, at)
    strict = {(a, b) for _, a, b in matches.get("secret", []) if _strict(text[a:b])} if by_start else set()
    for a, b in strict | (unlabelled if by_start else set()):
        if near("access", a, b):
            continue
        around = []
        if (at := bisect_right(by_end, (a, len(text))) - 1) >= 0:
            around.append((a - by_end[at][0], 0, by_end[at][::-1]))
        if (at := bisect_left(by_start, (b,))) < len(by_start):
            around.append((by_start[at][0] - b, 1, by_start[at]))
        if (a, b) not in strict:
            around = [x for x in around if section(x[2][0]) == section(a)]
        if around:
            found |= {(f"linked_{role}", *span) for role, span in (("secret", (a, b)), ("access", min(around)[2])) if not reported(*span)}
    return list(found)


def scan_text(text: str) -> tuple[list[Span], list[Span]]:
    """Base and linked findings of a whole text, each by start, then kind as listed, then end."""
    lowered = text.lower()
    runs = [m.span() for m in LONG_RUN.finditer(text)]
    order = {k: i for i, k in enumerate((*BASE_KINDS, *LINKED_KINDS))}
    by_start = lambda s: (s[1], order[s[0]], s[2])
    base = sorted(base_spans(text, runs, lowered), key=by_start)
    return base, sorted(linked_spans(text, base, runs, lowered), key=by_start)


SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.IntegerType(), False),
                     T.StructField("end", T.IntegerType(), False)])
SPANS = T.ArrayType(SPAN, False)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by ``base`` and ``linked``, arrays of (kind, start, end) in code points, end exclusive.

    A null text counts as empty; other columns pass through; columns already
    named ``base`` or ``linked`` are replaced. Whole texts are scanned, however long; repeated rows each
    get their row; an empty table gives none. No shuffle.
    """
    ship_code()
    rows = df.select(*without(df, [text_col, "base", "linked"]), text_or_empty(f"`{text_col}`").alias("base"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("base", SPANS, False), T.StructField("linked", SPANS, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(t) for t in batch.columns[-1].to_pylist()]
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], _ARROW_SPANS)
                     for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *spans], names=[*batch.schema.names[:-1], "base", "linked"])

    return rows.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed, then end."""
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, *LINKED_KINDS)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(kinds, s["kind"]).alias("rank"), s["end"], s["kind"]))
    return F.array_sort(keyed)


#: What redaction puts in a finding's place.
REDACTED = "[SECRET]"


def redact_text(text: str) -> str:
    """The text with every base finding and every linked identifier and secret replaced; overlapping ones by one mark."""
    base, linked = scan_text(text)
    spans = sorted(s[1:] for s in [*base, *linked] if s[0] != "linked_endpoint")
    out, at, covered = [], 0, -1
    for start, end in spans:
        if start >= covered:
            out += [text[at:start], REDACTED]
        covered = at = max(covered, end)
    return "".join(out) + text[at:]


def redact(df: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with the secrets in the texts redacted and
    ``n_chars_col`` (if present) following the text. Null texts stay null; texts without findings stay as they are."""
    ship_code()
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else redact_text(t) for t in batch.columns[at].to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    clean = df.mapInArrow(run, df.schema)
    if n_chars_col and n_chars_col in df.columns:
        kind = df.schema[n_chars_col].dataType
        clean = clean.withColumn(n_chars_col, F.coalesce(F.length(f"`{text_col}`").cast(kind), F.col(f"`{n_chars_col}`")))
    return clean
