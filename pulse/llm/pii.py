"""Personal data: expressions propose spans, checksums confirm them, words nearby weigh them.

Kinds, in their fixed order: email, ip, card, phone, iban, tel. The first four are proposed by the
base expressions and confirmed by their checks (octets up to 255, Luhn, digit counts). `iban` is
confirmed by the remainder modulo 97. `tel`, a number grouped as in North America, France, Spain or
Germany without a country prefix, has no checksum and stands only where a context word near it lifts its
score to the threshold. Context words are English, French, German and Spanish. Words shortly before a
span that speak of another kind of number, or of an example, lower its score, so that an account number
given as an example falls below the threshold. Base spans stand whatever their score. Matches of a kind are leftmost and never overlap; a match that fails
its check is dropped and not tried again.

The expressions are written so that a long run of characters is read once: quantifiers are
possessive where giving back can't help, and an address starts only where a run of its characters
starts or the last match ended. Long runs therefore cost linear time and no stack. Arrays of matches
are folded in chunks, and stretches of text are taken from pieces of it, so that a text with very
many matches does not cost the square of their number.

Only DataFrame functions are used. Positions are code points, the end is exclusive.

Defined results: a null or empty text has no spans; overlapping spans of different kinds all stand;
repeated rows are judged each by itself; other columns pass through untouched, a column
with the name of the output is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import free_name, text_or_empty

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "tel"]
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "tel": r"(?<![A-Za-z0-9+(.-])(?:"
    r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
    r"|0[1-9](?:[\x20.-][0-9]{2}){4}"
    r"|[6-9][0-9]{2}(?:[\x20.-][0-9]{3}){2}"
    r"|[6-9][0-9]{2}(?:[\x20.-][0-9]{2}){3}"
    r"|0[1-9][0-9]{1,4}[\x20/-][0-9]{3,8}(?:[\x20-][0-9]{1,5})?"
    r")(?![A-Za-z0-9]|[.-][0-9])",
}
# Score of a confirmed proposal by itself, and the words that lift it or lower it.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "tel": 0.3}
CALL_WORDS = (
    "phone telephone tel call mobile cell fax hotline "
    "téléphone tél appelez portable numéro "
    "telefon telefonnummer anruf anrufen handy mobil rufnummer durchwahl "
    "teléfono telefono llame llamar móvil celular"
).split()
CONTEXT_WORDS = {
    "email": "email e-mail mail contact courriel adresse kontakt correo contacto".split(),
    "ip": "ip address host server adresse serveur hôte rechner dirección servidor".split(),
    "card": (
        "card visa mastercard credit debit payment carte paiement crédit "
        "karte kreditkarte zahlung tarjeta crédito pago"
    ).split(),
    "phone": CALL_WORDS,
    "iban": "iban account bank transfer compte banque virement konto überweisung cuenta banco transferencia".split(),
    "tel": CALL_WORDS,
}
EXAMPLE_WORDS = "example sample dummy exemple beispiel muster ejemplo".split()
NUMBER_WORDS = (
    "order invoice isbn issn ticket tracking serial part version "
    "commande facture référence bestellung rechnung artikelnummer seriennummer pedido factura referencia"
).split()
LOWERING_WORDS = {
    "email": EXAMPLE_WORDS,
    "ip": "version release build firmware".split(),
    "card": [*EXAMPLE_WORDS, *NUMBER_WORDS],
    "phone": [*EXAMPLE_WORDS, *NUMBER_WORDS],
    "iban": EXAMPLE_WORDS,
    "tel": [*EXAMPLE_WORDS, *NUMBER_WORDS],
}
CONTEXT_CHARS = 40
PIECE_CHARS = 1024
LOWERING_CHARS = 24
CONTEXT_LIFT = 0.35
CONTEXT_DROP = 0.35
THRESHOLD = 0.6


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def digit_list(digits: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, 1).cast("int")
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits, not empty, passes Luhn."""

    def add(total: Column, pair: Column) -> Column:
        doubled = pair["d"] * 2
        return total + F.when(
            pair["i"] % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)
        ).otherwise(pair["d"])

    pairs = F.transform(
        F.reverse(digit_list(digits)), lambda d, i: F.struct(d.alias("d"), i.alias("i"))
    )
    return F.aggregate(pairs, F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number, without spaces, leaves one modulo 97."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    codes = F.transform(
        F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, 1))
    )

    def step(rest: Column, code: Column) -> Column:
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(codes, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    digits = digits_of(match)
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(
            parts,
            lambda part: F.length(F.regexp_replace(part, "^0+", "")).between(0, 2)
            | F.regexp_replace(part, "^0+", "").rlike("^(?:1[0-9]{2}|2[0-4][0-9]|25[0-5])$"),
        )
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        plain = F.regexp_replace(match, " ", "")
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(F.lit(False))
    return F.lit(True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, also where lambdas in `use` read it often."""
    return F.transform(F.array(value), use)[0]


def in_chunks(items: Column) -> Column:
    """A non-empty array cut into about as many chunks as each has items.

    A fold that appends to an array copies it at every step. Folding chunks, and then their
    results, keeps long arrays from costing the square of their length."""

    def chunks(items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(items))).cast("int")
        last = F.floor((F.size(items) - 1) / width).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.slice(items, i * width + 1, width)
        )

    return bound(items, chunks)


def pieces_of(text: Column) -> Column:
    """The text in pieces of PIECE_CHARS, so that no stretch is looked for from the text's start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))


def stretch(pieces: Column, start: Column, length: Column) -> Column:
    """The `length` characters from `start`, or as many as there are."""
    first = F.floor(start / PIECE_CHARS).cast("int")
    last = F.floor((start + length) / PIECE_CHARS).cast("int")
    joined = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.substring(
        joined, (start - first * PIECE_CHARS + 1).cast("int"), length.cast("int")
    )


def proposals(kind: str, text: Column) -> Column:
    """Array of (start, end), in order, of what a kind's expression proposes and its check confirms.

    The text must hold a match."""
    pattern = PATTERNS[kind]
    span_type = "struct<start:bigint,end:bigint>"
    zero = F.lit(0).cast("bigint")

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        found = F.when(
            confirmed(kind, pair["match"]), F.concat(state["found"], F.array(span))
        ).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def add_chunk(state: Column, chunk: Column) -> Column:
        moved = F.struct(state["at"].alias("base"), chunk["found"].alias("found"))
        return F.struct(
            (state["at"] + chunk["at"]).alias("at"),
            F.concat(state["chunks"], F.array(moved)).alias("chunks"),
        )

    def spans(chunk: Column) -> Column:
        return F.transform(
            chunk["found"],
            lambda span: F.struct(
                (chunk["base"] + span["start"]).alias("start"),
                (chunk["base"] + span["end"]).alias("end"),
            ),
        )

    # The gap after the last match is left without one.
    pairs = F.filter(
        F.arrays_zip(
            F.split(text, pattern).alias("gap"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        ),
        lambda pair: pair["match"].isNotNull(),
    )
    none = F.array().cast(f"array<{span_type}>")
    folded = F.transform(
        in_chunks(pairs),
        lambda chunk: F.aggregate(chunk, F.struct(zero.alias("at"), none.alias("found")), add),
    )
    no_chunks = F.array().cast(f"array<struct<base:bigint,found:array<{span_type}>>>")
    return F.aggregate(
        folded,
        F.struct(zero.alias("at"), no_chunks.alias("chunks")),
        add_chunk,
        lambda state: F.flatten(F.transform(state["chunks"], spans)),
    )


def holds_word(text: Column, words: list[str]) -> Column:
    """Whether one of the words stands in a text by itself."""
    return text.rlike(rf"(?iu)(?<![\p{{L}}0-9@.])(?:{'|'.join(words)})(?![\p{{L}}0-9])")


def context_score(kind: str, pieces: Column, span: Column) -> Column:
    """The kind's score, lifted if a context word stands shortly before or after the span, lowered if
    a word right before it speaks of something else."""
    before = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    ahead = stretch(pieces, before, span["start"] - before)
    near = F.concat_ws(" ", ahead, stretch(pieces, span["end"], F.lit(CONTEXT_CHARS)))
    close = F.substring(ahead, -LOWERING_CHARS, LOWERING_CHARS)
    lift = F.when(holds_word(near, CONTEXT_WORDS[kind]), CONTEXT_LIFT).otherwise(0.0)
    drop = F.when(holds_word(close, LOWERING_WORDS[kind]), CONTEXT_DROP).otherwise(0.0)
    return F.lit(BASE_SCORE[kind]) + lift - drop


def spans_of(kind: str, text: Column, threshold: float = THRESHOLD) -> Column:
    """Confirmed spans of a kind: (start, rank, end, kind, score)."""
    found = proposals(kind, text)
    scored = bound(
        pieces_of(text),
        lambda pieces: F.transform(
            found,
            lambda span: F.struct(
                span["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                span["end"].alias("end"),
                F.lit(kind).alias("kind"),
                context_score(kind, pieces, span).alias("score"),
            ),
        ),
    )
    if kind in BASE_KINDS:
        return scored
    return F.filter(scored, lambda span: span["score"] >= threshold)


def find_pii(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Adds an array of (start, rank, end, kind, score), sorted by start, then kind."""
    column = text_or_empty(text)
    per_kind = [
        F.when(column.rlike(PATTERNS[kind]), spans_of(kind, column)).otherwise(
            F.array().cast(
                "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"
            )
        )
        for kind in KINDS
    ]
    return docs.withColumn(name, F.array_sort(F.concat(*per_kind)))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda span: F.concat_ws(
                ":", span["kind"], span["start"].cast("string"), span["end"].cast("string")
            ),
        ),
        ",",
    )


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replaces every span by <KIND>; of overlapping spans the first one names the whole stretch."""
    column, spans = F.col(text), free_name(docs, "found_spans")

    def mask_chunk(pieces: Column, chunk: Column, start: Column) -> Column:
        """The text from `start`, where the spans before the chunk end, to the end of its spans."""

        def step(state: Column, span: Column) -> Column:
            gap = stretch(pieces, state["at"], span["start"] - state["at"])
            tag = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            return F.struct(
                F.greatest(state["at"], span["end"]).alias("at"),
                F.when(
                    span["start"] >= state["at"], F.concat(state["parts"], F.array(gap, tag))
                )
                .otherwise(state["parts"])
                .alias("parts"),
            )

        nothing = F.array().cast("array<string>")
        return F.aggregate(
            chunk,
            F.struct(start.alias("at"), nothing.alias("parts")),
            step,
            lambda state: F.array_join(state["parts"], ""),
        )

    def mask_chunks(pieces: Column, chunks: Column, ends: Column) -> Column:
        zero = F.array(F.lit(0).cast("bigint"))
        parts = F.transform(
            chunks,
            lambda chunk, i: mask_chunk(
                pieces, chunk, F.array_max(F.concat(zero, F.slice(ends, 1, i)))
            ),
        )
        rest = F.substring(column, (F.array_max(ends) + 1).cast("int"), F.lit(2**31 - 1))
        return F.concat(F.array_join(parts, ""), rest)

    def chunk_ends(chunks: Column) -> Column:
        return F.transform(
            chunks, lambda chunk: F.array_max(F.transform(chunk, lambda span: span["end"]))
        )

    masked = bound(
        pieces_of(column),
        lambda pieces: bound(
            in_chunks(F.col(spans)),
            lambda chunks: bound(
                chunk_ends(chunks), lambda ends: mask_chunks(pieces, chunks, ends)
            ),
        ),
    )
    found = find_pii(docs, text, spans)
    return found.withColumn(text, F.when(F.size(spans) > 0, masked).otherwise(column)).drop(spans)
