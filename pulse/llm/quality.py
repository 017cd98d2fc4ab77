"""Line-first quality rules: judge every line, drop the failing ones, then judge what is left.

A line fails by one of four rules. `unfinished`: it ends no sentence, that is, no mark that closes one
stands at its end, quotes and brackets left aside. `navigation`: it is a row of short entries between
bars, dots or arrows, or a run of capitalised words without a sentence. `boilerplate`: it is short and
holds a phrase of page furniture, in English, French, German or Spanish. `noise`: it is mostly symbols,
shouts or stutters. A document is rejected if its words are too few, if too many of them stand in repeated
five-word windows, or if failing lines hold too large a part of its words.

Defined results: a null text counts as empty; an empty text has no words, fails the base rules and
is rejected; repeated rows are judged each by itself; other columns pass through untouched, except
that a column with the name of an output column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import free_name, in_parts, text_or_empty

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
# Phrases of page furniture that make a line boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "accept all cookies",
    "cookie policy",
    "cookie settings",
    "we use cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "enable javascript",
    "click here to",
    "read more",
    "sign up for our newsletter",
    "subscribe to our",
    "share this article",
    "follow us on",
    "skip to content",
    "powered by",
    "lorem ipsum",
    "tous droits réservés",
    "accepter les cookies",
    "accepter tous les cookies",
    "politique de confidentialité",
    "conditions d'utilisation",
    "conditions générales",
    "mentions légales",
    "activer javascript",
    "cliquez ici",
    "lire la suite",
    "inscrivez-vous à notre",
    "abonnez-vous",
    "partager cet article",
    "suivez-nous",
    "plan du site",
    "alle rechte vorbehalten",
    "alle cookies akzeptieren",
    "cookies akzeptieren",
    "cookie-einstellungen",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "allgemeine geschäftsbedingungen",
    "javascript aktivieren",
    "klicken sie hier",
    "hier klicken",
    "weiterlesen",
    "newsletter abonnieren",
    "artikel teilen",
    "folgen sie uns",
    "zum inhalt springen",
    "todos los derechos reservados",
    "aceptar cookies",
    "aceptar todas las cookies",
    "política de cookies",
    "política de privacidad",
    "condiciones de uso",
    "términos y condiciones",
    "aviso legal",
    "activar javascript",
    "haga clic aquí",
    "haz clic aquí",
    "leer más",
    "suscríbete a",
    "suscríbase a",
    "compartir este artículo",
    "síguenos en",
    "mapa del sitio",
)
MENU_SPLIT = re.compile(r"\s[|>·»›•→/]\s")
ARROWS = "«»‹›←→|•·"
# Marks that end a sentence, and what may follow them.
TERMINAL = (".", "!", "?", ":", ";", "…", "。", "！", "？", "؟", "।", "։")
CLOSING = "\"'”’»›)]}*_" + WHITE


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are of a line's words, but for `max_lost`, a share of the text's."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_share: float = 0.3
    max_bar_share: float = 0.2
    max_shout_share: float = 0.6
    max_stutter_share: float = 0.3
    max_boilerplate_words: int = 30
    min_capital_words: int = 4
    max_capital_share: float = 0.8
    max_lost: float = 0.5


RULES = ("unfinished", "navigation", "boilerplate", "noise")

FIELDS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "lost_words": "bigint",
    **{f"n_{rule}_lines": "bigint" for rule in RULES},
    "clean_text": "string",
    "base_failed": "boolean",
    "kept": "boolean",
}


def is_menu(line: str, words: list[bytes], rules: Rules) -> bool:
    """Short entries side by side, or an arrow in front of a few words."""
    n, bars = len(words), words.count(b"|")
    if bars and bars > rules.max_bar_share * n:
        return True
    if n > rules.max_boilerplate_words:
        return False
    parts = MENU_SPLIT.split(line)
    if len(parts) >= 3 and max(len(part.split()) for part in parts) <= 3:
        return True
    return line.strip(WHITE)[0] in ARROWS and not line.rstrip(CLOSING).endswith(TERMINAL)


def is_title_row(line: str, n: int, rules: Rules) -> bool:
    """Capitalised words in a row, as in a menu without bars."""
    if not rules.min_capital_words <= n <= rules.max_boilerplate_words or any(c in line for c in ".,;:"):
        return False
    return sum(word[0].isupper() for word in line.split()) > rules.max_capital_share * n


def is_noise(line: str, words: list[bytes], rules: Rules) -> bool:
    """Mostly symbols, shouting or stuttering."""
    n = len(words)
    if sum(map(line.count, SYMBOLS)) > rules.max_symbol_share * n:
        return True
    if sum(word.endswith(b"!!") for word in words) > rules.max_shout_share * n:
        return True
    if line.isupper() and line.count("!") > rules.max_shout_share * n:
        return True
    return sum(a == b for a, b in zip(words, words[1:], strict=False)) > rules.max_stutter_share * n


def failed_rule(line: str, words: list[bytes], rules: Rules) -> str | None:
    """The rule that a line with these words breaks, if any."""
    n = len(words)
    if is_menu(line, words, rules):
        return "navigation"
    if is_noise(line, words, rules):
        return "noise"
    if n <= rules.max_boilerplate_words:
        low = line.lower()
        if any(phrase in low for phrase in BOILERPLATE):
            return "boilerplate"
    if line.rstrip(CLOSING).endswith(TERMINAL):
        return None
    return "navigation" if is_title_row(line, n, rules) else "unfinished"


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a window of five words that occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + WINDOW - max(end, start)
            end = start + WINDOW
    return covered


def judge(text: str, rules: Rules) -> tuple:
    """The values of FIELDS for one text."""
    words = text.encode().split()
    n = len(words)
    seen, kept_lines, dup_lines, lost = set(), [], 0, 0
    failed_lines = dict.fromkeys(RULES, 0)
    for line in text.split("\n"):
        line_words = line.encode().split()
        if not line_words:
            kept_lines.append(line)
            continue
        dup_lines += line in seen
        seen.add(line)
        rule = failed_rule(line, line_words, rules)
        if rule:
            lost += len(line_words)
            failed_lines[rule] += 1
        else:
            kept_lines.append(line)
    repeats = repeated_words(words)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    return (
        n,
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        dup_lines,
        repeats,
        lost,
        *failed_lines.values(),
        "\n".join(kept_lines),
        failed,
        not failed and lost <= rules.max_lost * n,
    )


def quality_rules(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Adds FIELDS to every row: base counts, `clean_text` without failing lines, the verdict."""
    schema = ", ".join(f"{name}: {kind}" for name, kind in FIELDS.items())

    @F.arrow_udf(f"struct<{schema}>")
    def verdicts(texts: pa.Array) -> pa.Array:
        rows = [judge(value, rules) for part in in_parts(texts) for value in part]
        columns = list(zip(*rows, strict=True)) or [()] * len(FIELDS)
        kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        arrays = [
            pa.array(column, kinds[kind])
            for column, kind in zip(columns, FIELDS.values(), strict=True)
        ]
        return pa.StructArray.from_arrays(arrays, list(FIELDS))

    found = free_name(docs, "verdict")
    # Said to be nondeterministic, or a filter on the verdict would run it a second time.
    judged = docs.withColumn(found, verdicts.asNondeterministic()(text_or_empty(text)))
    return judged.withColumns({name: F.col(f"{found}.{name}") for name in FIELDS}).drop(found)
