"""Secret scan by patterns and two character Markov models (operator 5), column expressions only.

Base patterns give the certain spans. Any other long token is scored by two models of the next
character given the last: one of random strings, one of ordinary identifiers. If the mean log
likelihood ratio per character is above a margin, the token is a span of kind `markov`. Both
models are counted on a sample of documents, labelled by the base patterns: what they match
is random, all other tokens are ordinary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ebbflow.llm.common import let

# Fixed values of the contract. The parts before and of the value are groups 1 and 2.
ASSIGN = r"""(?i)((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"()(AKIA[A-Z0-9]+)"
HEX = r"()([0-9a-f]{24,})"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"()([A-Za-z0-9+/_=-]{%d,})"
LONG = 20  # characters of a token that is scored
ORDINARY = 6  # characters of a token that is counted as an identifier
MARGIN = 0.7  # nats per character
SAMPLE = 20_000  # documents the models are counted on
MASK = "[SECRET]"

# Marks put into a text around what a pattern finds; the text's own are replaced first by
# another control character, which no pattern looks at.
FIRST, MIDDLE, LAST, OTHER = "\u0001", "\u0002", "\u0003", "\u0004"
SPAN = "array<struct<start:int,stop:int,value:string>>"


def clean(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    marked = F.contains(text, F.lit(FIRST)) | F.contains(text, F.lit(MIDDLE)) | F.contains(text, F.lit(LAST))
    return F.when(marked, F.translate(text, FIRST + MIDDLE + LAST, OTHER * 3)).otherwise(text)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, stop (code points) and the value in group 2."""
    marked = F.regexp_replace(text, pattern, f"{FIRST}$1{MIDDLE}$2{LAST}")

    def step(state: Column, part: Column) -> Column:
        value = F.substring_index(F.substring_index(part, LAST, 1), MIDDLE, -1)
        inside = F.length(F.substring_index(part, LAST, 1)) - 1
        span = F.struct(
            state["at"].alias("start"), (state["at"] + inside).alias("stop"), value.alias("value")
        )
        return F.struct(
            (state["at"] + F.length(part) - 2).alias("at"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    def walk(parts: Column) -> Column:
        start = F.struct(F.length(F.get(parts, F.lit(0))).alias("at"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step)["spans"]

    return F.when(
        F.contains(marked, F.lit(FIRST)), let(F.split(marked, FIRST), walk)
    ).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the base patterns with their kind's place in KINDS; failing matches are dropped
    after the search, so that what they took stays taken."""

    def found(place: int, pattern: str) -> Column:
        least = LEAST[KINDS[place]]
        enough = F.filter(matches(text, pattern), lambda m: F.length(m["value"]) >= least)
        return F.transform(enough, lambda m: _span(m, F.lit(place)))

    return F.concat(*(found(place, pattern) for place, pattern in enumerate((ASSIGN, ACCESS, HEX))))


def _span(match: Column, kind: Column) -> Column:
    return F.struct(
        match["start"].alias("start"), kind.alias("kind"), match["stop"].alias("stop"), match["value"].alias("value")
    )


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))


def train(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """Log likelihood ratio (random over ordinary) of each pair of characters, with one added to
    every count. About `sample` documents, chosen by the hash of their doc_id, are counted; the
    driver gets at most 2 x 67 x 67 counts. Without any document all ratios are 0."""
    total = docs.count()
    share = min(1.0, sample / max(total, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(share * 1_000_000))
    text = chosen.select(clean(F.col("text")).alias("text"))
    tokens = F.regexp_extract_all("text", F.lit(TOKEN % ORDINARY), 2)

    def labels(random: Column) -> Column:
        def ordinary(token: Column) -> Column:
            return ~F.exists(random, lambda v: F.contains(token, v) | F.contains(v, token))

        return F.concat(
            F.transform(random, lambda v: F.struct(F.lit(1).alias("random"), v.alias("token"))),
            F.transform(
                F.filter(tokens, ordinary), lambda t: F.struct(F.lit(0).alias("random"), t.alias("token"))
            ),
        )

    random = F.transform(base_spans(F.col("text")), lambda b: b["value"])
    labelled = text.select(F.inline(let(random, labels)))

    def pairs(codes: Column) -> Column:
        # -1 where either character is outside the alphabet, such as a full stop
        return F.transform(
            F.sequence(F.lit(0), F.size(codes) - 2),
            lambda i: F.when(
                (F.get(codes, i) >= 0) & (F.get(codes, i + 1) >= 0),
                F.get(codes, i) * len(ALPHABET) + F.get(codes, i + 1),
            ).otherwise(-1),
        )

    counted = labelled.groupBy("random", "token").agg(F.count("*").alias("n")).where(F.length("token") > 1)
    counts = (
        counted.select("random", "n", F.explode(let(_codes(F.col("token")), pairs)).alias("pair"))
        .where("pair >= 0")
        .groupBy("random", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return ratios({(r["random"], r["pair"]): r["n"] for r in counts})


def ratios(counts: dict[tuple[int, int], int]) -> list[float]:
    size = len(ALPHABET)
    logs = []
    for label in (1, 0):
        table = [counts.get((label, p), 0) + 1 for p in range(size * size)]
        rows = [sum(table[a * size : (a + 1) * size]) for a in range(size)]
        logs.append([math.log(table[p] / rows[p // size]) for p in range(size * size)])
    return [a - b for a, b in zip(*logs)]


def find_secrets(docs: DataFrame, model: list[float], margin: float = MARGIN) -> DataFrame:
    """`docs` with `secrets`: array of (start, kind, stop, value), sorted by start and then kind.

    start and stop are code points, stop exclusive; kind is the place in KINDS. The base spans
    are all there; model spans are those that touch no base span. A null text counts as empty
    and an empty text has no spans; rows are handled one by one, so repeated rows and other
    columns do not matter; a column `secrets` is replaced.
    """
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    size = len(ALPHABET)

    def mean_ratio(token: Column) -> Column:
        def score(codes: Column) -> Column:
            total = F.aggregate(
                F.sequence(F.lit(0), F.size(codes) - 2),
                F.lit(0.0),
                lambda s, i: s + F.get(weights, F.get(codes, i) * size + F.get(codes, i + 1)),
            )
            return total / (F.size(codes) - 1)

        return let(_codes(token), score)

    def all_spans(text: Column) -> Column:
        def add(base: Column) -> Column:
            scored = F.filter(
                matches(text, TOKEN % LONG),
                lambda m: _apart(m, base) & (mean_ratio(m["value"]) > margin),
            )
            return F.array_sort(F.concat(base, F.transform(scored, lambda m: _span(m, F.lit(3)))))

        return let(base_spans(text), add)

    return docs.withColumn("secrets", let(clean(F.col("text")), all_spans))


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )


def redacted(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with each span, or run of overlapping spans, replaced by a mask."""

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["stop"]).alias("at"),
            F.when(fresh, F.concat(state["done"], between, F.lit(mask))).otherwise(state["done"]).alias("done"),
        )

    def close(state: Column) -> Column:
        return F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text)))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    return F.when(F.size(spans) > 0, let(F.aggregate(spans, start, step), close)).otherwise(text)
