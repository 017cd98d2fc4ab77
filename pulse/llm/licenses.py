"""Licence scan by canonical digest: whole texts, normalised, joined with known digests by hash.

The canonical form is lower case in A-Z, has no copyright lines and no punctuation, spells words that
licences spell in two ways in one way, and has single spaces. Two texts that differ only in those
respects have one digest.

Defined results: a null or empty text has an empty canonical form, which is no licence; a text that
holds more than the licence is none, since only whole texts count; repeated rows are looked up each
by itself; other columns pass through, ones with the name of an output column are replaced. The
known digests are a fixed list of a few dozen entries, so they are broadcast and no document is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import lower_ascii, text_or_empty
from pulse.llm.license_texts import DIGESTS, TEXTS

# A line that states a copyright: the word or sign, then a sign, a year, a placeholder or a name.
COPYRIGHT_LINE = (
    r"(?m)^[\t /*#;%-]*(?:copyright|\(c\)|©)[\t ]*"
    r"(?:\(c\)|©|[0-9]{4}|<year>|\[year\]|\[yyyy\]|by[\t ]).*$"
)
RESERVED_LINE = r"(?m)^[\t /*#;%-]*all rights reserved\.?[\t ]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
# Spellings that count as equal in licence texts, the second one canonical.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("noncommercial", "non commercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "wilfull"),
]


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    lines = F.regexp_replace(
        F.regexp_replace(lower_ascii(text), COPYRIGHT_LINE, ""), RESERVED_LINE, ""
    )
    plain = F.trim(F.regexp_replace(lines, NOT_WORD, " "))
    spelled = plain
    for other, chosen in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{other}\b", chosen)
    any_other = r"\b(?:" + "|".join(other for other, _ in SPELLINGS) + r")\b"
    return F.when(plain.rlike(any_other), spelled).otherwise(plain)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(digest, license_id) of every known text, with and without its title."""
    texts = [(name, body) for name, _, body in TEXTS]
    texts += [(name, f"{title}\n\n{body}") for name, title, body in TEXTS if title]
    texts += [
        (name, f"The {title} ({name})\n\n{body}") for name, title, body in TEXTS if title
    ]
    listed = spark.createDataFrame(texts, "license_id string, body string").select(
        F.sha2(canonical(F.col("body")), 256).alias("digest"), "license_id"
    )
    if DIGESTS:
        longer = spark.createDataFrame(list(DIGESTS.items()), "digest string, license_id string")
        listed = listed.union(longer)
    return listed.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the digest of every text's canonical form and the licence it is, or null."""
    kept = [c for c in docs.columns if c not in ("digest", "license_id")]
    digested = docs.select(*kept, F.sha2(canonical(text_or_empty(text)), 256).alias("digest"))
    known = F.broadcast(known_licenses(docs.sparkSession))
    return digested.join(known, "digest", "left").select(*kept, "digest", "license_id")
