"""Source divergence against a plain reading of the contract."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pulse.llm import divergence
from pulse.llm.queries import QUERIES

from .conftest import DOCUMENTS, SMALL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute(rows, least=30, top=50):
    counts, documents, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, terms = lang or "", TERM.findall(lower(text or ""))
        counts[lang, source or ""].update(terms)
        langs[lang].update(terms)
        documents[lang].update(set(terms))
    kept = {lang: {t for t, n in seen.items() if n >= least} for lang, seen in documents.items()}

    def shares(count, lang):
        total = sum(count[t] for t in kept[lang])
        every = total + 5 * len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 5) // every for t in kept[lang]}

    p = {group: shares(count, group[0]) for group, count in counts.items()}
    result = []
    for (lang, source), mine in p.items():
        q = shares(langs[lang], lang)
        pairs = [
            (-sum(abs(mine[t] - theirs[t]) for t in kept[lang]), other.encode(), other)
            for (other_lang, other), theirs in p.items() if other_lang == lang and other != source
        ]
        terms = [(q[t] - mine[t], t.encode(), t) for t in kept[lang] if counts[lang, source][t] and mine[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            result += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(result)


def found(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, source, 0) for i, (text, lang, source) in enumerate(rows)], DOCUMENTS)


def random_rows(seed, n=400):
    pick = random.Random(seed)
    words = ["alpha", "Beta", "été", "ÉTÉ", "日本", "x", "naïve", "\x80", "z-z", "9a", "_b", "don't", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for _ in range(n):
        lang = pick.choice(["en", "en", "fr", None, "", "rare"])
        source = pick.choice([None, "", "a", "b", "é", "Z", "s1", "s2", "hot", "hot", "hot"])
        text = pick.choice([None, "", " \t", " ".join(pick.choices(words, k=pick.randint(1, 30)))])
        rows.append((text, lang, source))
    rows += [("alpha beta " * 2000 + "A" * 100_000, "en", "long"), ("1 2 3", "de", "only"), (None, "de", None)]
    return rows + rows[:50]


@pytest.mark.parametrize("tile_rows, blocks, top", [(None, 1024, 50), (7, 3, 5), (50, 1, 1)])
def test_against_brute_force(spark, tile_rows, blocks, top):
    rows = random_rows(top)
    expected = brute(rows, least=8, top=top)
    result = divergence.audit(
        table(spark, rows), min_documents=8, top=top, tile_rows=tile_rows, block_sources=blocks
    )
    assert {row[2] for row in expected} == {"pair", "term"}
    assert found(result) == expected


def test_ties_at_the_last_rank_go_by_utf8(spark):
    words = ["é", "z", "a", "日", "\U00010000", "\uffff", "b"]
    rows = [(word, "en", "one") for word in words] + [("other", "en", "two")]
    result = found(divergence.audit(table(spark, rows), min_documents=1, top=4))
    terms = [row[3] for row in sorted(result, key=lambda r: r[5]) if row[1] == "one" and row[2] == "term"]
    assert terms == sorted(words, key=str.encode)[:4]
    assert result == brute(rows, least=1, top=4)


def test_empty_tables_and_clashing_names(spark):
    assert found(divergence.audit(table(spark, []))) == []
    rows = random_rows(9, 60)
    names = ["term", "n", "documents", "place", "value", "bucket", "total", "lang_n"]
    more = table(spark, rows).selectExpr("*", *(f"'x' as {name}" for name in names))
    assert found(divergence.audit(more, min_documents=3)) == brute(rows, least=3)


def test_query(spark):
    rows = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found(QUERIES["op13_source_divergence"](spark, SMALL)) == brute(rows)


def test_terms_are_cut_in_stretches():
    text = "Aa bB\x00ç_É " * 500_000
    chunks = list(divergence.term_chunks(text))
    assert len(chunks) > 3
    assert Counter(t for chunk in chunks for t in chunk) == Counter(t.encode() for t in TERM.findall(lower(text)))
    assert list(divergence.term_chunks("")) == []


def test_counts_are_flushed(monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
    counts, totals = divergence.TermCounts(), Counter()
    for i in range(20):
        counts.add(("en", "s"), f"common {chr(97 + i)}")
        if counts.full():
            for batch in counts.flush():
                totals.update(dict(zip(batch.column("term").to_pylist(), batch.column("n").to_pylist(), strict=True)))
    for batch in counts.flush():
        totals.update(dict(zip(batch.column("term").to_pylist(), batch.column("n").to_pylist(), strict=True)))
    assert totals["common"] == 20
    assert counts.groups == {}
