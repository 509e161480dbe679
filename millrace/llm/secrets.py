"""Secret scans over a trigram inverted index, in DataFrame functions alone.

From each rule's pattern a Boolean query of trigrams follows that every match must satisfy. The index
holds, for the trigrams that any rule asks for, the documents that contain them. A rule's postings are
intersected and united as its query says, and only the documents left are searched with the pattern.
A rule whose pattern demands no trigram is searched for in every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of
from millrace.session import materialize

parser = re._parser  # type: ignore[attr-defined]

# A query is True (any text), a trigram, or ("and" | "or", queries).
Query = Any


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of the part that counts (group 0: all)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed by the contract: patterns and lengths of the three base kinds, in this order. Runs of hex
# digits are maximal, so asking for 24 in the pattern finds the same spans as dropping shorter ones.
BASE = (
    Rule(
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
# Published formats of other credentials.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("maps_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("bearer", r"(?i)bearer\x20+[A-Za-z0-9._~+/-]{20,}"),
)
RULES = BASE + ADDED
MARK = "[REDACTED]"

# Alternatives of a text that are followed up before they are turned into a query.
MOST_TEXTS = 32


def _all(queries: list[Query]) -> Query:
    real = list(dict.fromkeys(q for q in queries if q is not True))
    return True if not real else real[0] if len(real) == 1 else ("and", tuple(real))


def _any(queries: list[Query]) -> Query:
    if not queries or any(q is True for q in queries):
        return True
    real = list(dict.fromkeys(queries))
    return real[0] if len(real) == 1 else ("or", tuple(real))


def _of_texts(texts: set[str]) -> Query:
    """What a text must hold if it holds one of ``texts``.

    An alternative that asks for more than another one does adds nothing and is left out.
    """
    asked = {t: {t[i : i + 3] for i in range(len(t) - 2)} for t in texts}
    least = [t for t in sorted(texts) if not any(asked[o] < asked[t] for o in texts)]
    return _any([_all([t[i : i + 3] for i in range(len(t) - 2)]) for t in least])


def _texts(op: Any, value: Any) -> set[str] | None:
    """The lower-case texts that an element of a pattern matches, None if there are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN":
        chars: set[str] = set()
        for kind, part in value:
            if str(kind) == "LITERAL":
                chars.add(chr(part).lower())
            elif str(kind) == "RANGE" and part[1] - part[0] < MOST_TEXTS:
                chars.update(chr(c).lower() for c in range(part[0], part[1] + 1))
            else:
                return None
        return chars if len(chars) <= 8 else None
    if name == "SUBPATTERN":
        return _sequence_texts(value[3])
    if name == "BRANCH":
        parts = [_sequence_texts(branch) for branch in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if name == "MAX_REPEAT" and value[1] <= 3:
        part = _sequence_texts(value[2])
        if part is None:
            return None
        found, run = set(), {""}
        for times in range(value[1] + 1):
            if times >= value[0]:
                found |= run
            run = {a + b for a in run for b in part}
        return found if len(found) <= MOST_TEXTS else None
    return None


def _sequence_texts(sequence: Any) -> set[str] | None:
    run = {""}
    for op, value in sequence:
        part = _texts(op, value)
        if part is None or len(run) * len(part) > MOST_TEXTS:
            return None
        run = {a + b for a in run for b in part}
    return run


def _sequence_query(sequence: Any) -> Query:
    """The query of a sequence: that of each stretch of known texts, and of the elements between."""
    queries, run = [], {""}
    for op, value in sequence:
        part = _texts(op, value)
        if part is not None and len(run) * len(part) <= MOST_TEXTS:
            run = {a + b for a in run for b in part}
            continue
        queries.append(_of_texts(run))
        run = part or {""}
        name = str(op)
        if name == "SUBPATTERN":
            queries.append(_sequence_query(value[3]))
        elif name == "BRANCH":
            queries.append(_any([_sequence_query(branch) for branch in value[1]]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            queries.append(_sequence_query(value[2]))
    return _all([*queries, _of_texts(run)])


def trigram_query(pattern: str) -> Query:
    """What trigrams the lower-case form of any text that ``pattern`` matches must contain."""
    return _sequence_query(parser.parse(pattern))


def trigrams_of(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query: Query, held: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [_holds(q, held) for q in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


def index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``(trigram, doc_id)`` of the given trigrams over the lower-case texts."""
    lowered = texts.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select("doc_id", F.explode(held).alias("trigram"))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(id, rules)``: the documents that the postings leave for some rule, with those rules' kinds.

    One shuffle by document intersects all lists; nothing but trigrams and ids is moved.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    wanted = sorted(set().union(*map(trigrams_of, queries.values())))
    lists = index(texts, wanted).groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))
    kinds = [F.when(_holds(q, F.col("held")), F.lit(k)) for k, q in queries.items() if q is not True]
    found = lists.select(F.col("doc_id").alias("id"), F.array_compact(F.array(*kinds)).alias("rules"))
    return found.filter(F.size("rules") > 0)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def _spans(text: Column, rule: Rule, kind: int) -> Column:
    """``(start, kind, end)`` of the leftmost non-overlapping matches that are long enough.

    What lies between the matches, and the matches, add up to where each begins.
    """
    pattern = F.lit(rule.pattern)
    match = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.transform(F.split(text, rule.pattern, -1), lambda part: F.length(part))
    lengths = F.arrays_zip(
        F.slice(between, 1, F.size(match)).alias("gap"),
        F.transform(match, lambda m: F.length(m)).alias("length"),
        F.transform(counted, lambda c: F.length(c)).alias("counted"),
    )

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = (start + m["length"]).alias("end")
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end)
        longer = F.array_append(state["spans"], span)
        spans = F.when(m["counted"] >= rule.least, longer).otherwise(state["spans"])
        return F.struct((start + m["length"]).alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    found = F.aggregate(lengths, start, step, lambda state: state["spans"])
    return F.when(text.rlike(rule.pattern), found).otherwise(_none())


def _searched(rows: DataFrame, texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``text``) and their sorted ``spans``, searched where the index says.

    The candidates are stored, so that their measured size decides whether they are broadcast. The
    index only says where to search: rows that share an id, or have none, are each searched in their
    own text.
    """
    found = materialize(candidates(texts, rules), "candidates")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    each = []
    for number, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, number)
        if trigram_query(rule.pattern) is not True:
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(_none())
        each.append(spans)
    return joined.withColumn("spans", F.array_sort(F.concat(*each)))


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    texts = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """Per document the spans found: ``n_<kind>`` of the first ``base`` rules, their hash, and all spans.

    Null text counts as empty and has no spans; empty lists give an empty text. Repeated rows are
    scanned one by one.
    """
    texts = documents_of(docs)
    found = _searched(texts, texts, rules)
    spans = F.col("spans")

    def count(number: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")

    counts = [count(n).alias(f"n_{rule.kind}") for n, rule in enumerate(rules[:base])]
    first = F.filter(spans, lambda s: s["kind"] < base)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(first, rules).cast("binary"), 256).alias("base_sha256"),
        _joined(spans, rules).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` with every span of a secret replaced by a mark, ``n_chars`` adjusted.

    Overlapping spans become one mark. A null text stays null; texts without spans stay as they are.
    """
    names = docs.columns
    inner = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
        F.col("doc_id").alias("doc_id"),
        F.col("text").alias("text"),
    )
    spanned = _searched(inner, documents_of(docs), rules)
    text = F.col("text")

    def step(state: Column, s: Column) -> Column:
        before = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], before, F.lit(MARK)))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), out.otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        F.col("spans"),
        start,
        step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )
    # a column of its own first: the length is then that of the finished text
    found = F.size("spans") > 0
    done = spanned.withColumn("new", F.when(found, clean).otherwise(text)).withColumn("found", found)
    columns = []
    for i, name in enumerate(names):
        value = F.col(f"c{i}")
        if name == "text":
            value = F.col("new")
        elif name == "n_chars":
            value = F.when(F.col("found"), F.length("new").cast("bigint")).otherwise(value)
        columns.append(value.alias(name))
    return done.select(*columns)
