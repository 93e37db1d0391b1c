"""Operator 2: personal data by proposed spans, checks of their digits and the words around them.

All of it is built-in column functions. Positions come from cutting the text at the
matches: a match starts after all pieces and matches before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import let, text_of

CONTEXT = 48  # code points before a span that are searched for hints
LEAST_BLOCK = 64  # matches, of two code points at least, so that a block holds the context of the next
FINDING = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` proposes, ``check`` confirms a match, ``hints`` are words before a span
    that raise its score from ``score`` to at most 1. Spans below ``needed`` are
    dropped; the base kinds need nothing beyond their check. ``marker`` is a cheap
    necessary condition on the whole text.
    """

    name: str
    pattern: str
    check: Callable[[Column], Column]
    hints: str
    score: float
    marker: Callable[[Column], Column]
    needed: float = 0.0
    base: bool = True


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def any_match(match: Column) -> Column:
    return F.lit(True)


def octets(match: Column) -> Column:
    """Every part is at most 255, in any number of digits."""

    def small(part: Column) -> Column:
        number = F.ltrim(part, F.lit("0"))
        return (F.length(number) < 3) | ((F.length(number) == 3) & (number <= "255"))

    return F.forall(F.split(match, r"\."), small)


def luhn(digits: Column) -> Column:
    """The Luhn checksum of a string of digits is right."""

    def value(digit: Column, i: Column) -> Column:
        d = digit.cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.coalesce(value(d, i), F.lit(0)))
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def card(match: Column) -> Column:
    digits = digits_of(match)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def phone(match: Column) -> Column:
    return F.length(digits_of(match)).between(8, 15)


def iban(match: Column) -> Column:
    """Country, two check digits and account leave 1 when divided by 97."""
    code = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4))), "")

    def step(rest: Column, char: Column) -> Column:
        number = F.when(char.between("0", "9"), F.ascii(char) - 48).otherwise(F.ascii(char) - 55)
        longer = F.when(number > 9, rest * 100 + number).otherwise(rest * 10 + number)
        return F.when(char == "", rest).otherwise(longer % 97)

    remainder = F.aggregate(turned, F.lit(0), step)
    return F.when(F.length(code).between(15, 34), remainder == 1).otherwise(F.lit(False))


def has(*parts: str) -> Callable[[Column], Column]:
    """The text contains all ``parts``."""
    return lambda text: F.forall(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(text, p))


# Patterns start where a run of their first characters starts and do not give characters back, so that long runs take
# linear time; the matches are those of the plain patterns. \G lets one match follow another.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        any_match,
        r"\b(e-?mail|contact|write|reach|address)\b",
        0.85,
        has("@", "."),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        octets,
        r"\b(ip|address|host|server|login|from)\b",
        0.6,
        has("."),
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", card, r"\b(card|visa|credit|debit|amex|payment)\b", 0.75, any_match),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", phone, r"\b(phone|tel|call|mobile|cell|fax)\b", 0.7, has("+")),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20[0-9]{1,3}|[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        iban,
        r"\b(iban|account|bank|transfer|konto|compte|cuenta)\b",
        0.8,
        any_match,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        any_match,
        r"\b(ssn|social|security|insurance)\b",
        0.4,
        has("-"),
        needed=0.6,
        base=False,
    ),
)


def summed(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, n: a + n)


def in_blocks(pairs: Column) -> Column:
    """``pairs`` cut into blocks of about the square root of their number, ``LEAST_BLOCK`` at least."""
    size = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.sqrt(F.size(pairs))).cast("int"))

    def cut(width: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1)), width)
        return F.transform(first, lambda i: F.slice(pairs, i, width))

    return let(size, cut)


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in the order of the text, each with its score.

    The text is cut into gaps and matches, which are looked through block by block: what one block finds
    is copied within it alone, and it begins where the lengths of those before it end.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def paired(matches: Column) -> Column:
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(matches))
        return F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def step(state: Column, pair: Column) -> Column:
        # ``tail`` is what stands before a span, as far as hints are looked for.
        near = F.right(F.concat(state["tail"], pair["gap"]), F.lit(CONTEXT))
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        hint = F.rlike(F.lower(near), F.lit(kind.hints))
        score = F.lit(kind.score) + F.when(hint, F.lit(1.0 - kind.score) * 0.8).otherwise(F.lit(0.0))
        span = F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score"))
        more = F.when(kind.check(pair["match"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        tail = F.right(F.concat(near, pair["match"]), F.lit(CONTEXT))
        return F.struct(end.alias("at"), tail.alias("tail"), more.alias("spans"))

    def of_block(block: Column, at: Column, tail: Column) -> Column:
        start = F.struct(at.alias("at"), tail.alias("tail"), F.array().cast(FINDING).alias("spans"))
        return F.aggregate(block, start, step, lambda state: state["spans"])

    def located(blocks: Column) -> Column:
        lengths = F.transform(
            blocks, lambda block: summed(F.transform(block, lambda p: (F.length(p["gap"]) + F.length(p["match"])).cast("bigint")))
        )

        def of_blocks(lengths: Column) -> Column:
            def one(block: Column, i: Column) -> Column:
                before = F.when(i > 0, F.array_join(F.transform(F.get(blocks, i - 1), lambda p: F.concat(p["gap"], p["match"])), ""))
                tail = F.right(F.coalesce(before, F.lit("")), F.lit(CONTEXT))
                return of_block(block, summed(F.slice(lengths, F.lit(1), i)), tail)

            return F.flatten(F.transform(blocks, one))

        return let(lengths, of_blocks)

    kept = F.filter(let(let(let(found, paired), in_blocks), located), lambda s: s["score"] >= kind.needed)
    none = F.array().cast(FINDING)
    return F.when(kind.marker(text) & F.rlike(text, F.lit(kind.pattern)), kept).otherwise(none)


def personal_data(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and ``findings`` of every row: kind, start, end (code points, end exclusive) and score.

    Findings are ordered by kind, as listed, then by start. A null or empty text has
    none, the array is then empty; equal rows have equal findings; an empty table
    gives no rows; columns other than doc_id and text are not looked at. Rows are
    not shuffled.
    """
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    return texts.select("doc_id", F.concat(*[spans_of(F.col("text"), k) for k in kinds]).alias("findings"))


def joined_spans(findings: Column) -> Column:
    """kind:start:end of all ``findings``, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))),
        ",",
    )
