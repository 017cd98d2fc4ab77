"""Quality rules: base counts by the book, verdicts on labelled documents and by hand."""

import re
from collections import Counter

import pytest

from pulse.llm import quality
from pulse.llm.common import WORD
from pulse.llm.queries import QUERIES

from .conftest import SMALL


def base(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in lines
            lines.add(line)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        dup,
        len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(make_docs, odd_texts, docs):
    odd = make_docs([(i, text, "s") for i, text in enumerate(odd_texts)])
    for row in quality.quality_rules(odd.union(docs)).collect():
        assert tuple(row[name] for name in NAMES) == base(row["text"])
        assert not (row["base_failed"] and row["kept"])


def kept(make_docs, *texts):
    rows = quality.quality_rules(make_docs([(i, t, "s") for i, t in enumerate(texts)]))
    return [row["kept"] for row in rows.orderBy("doc_id").collect()]


CLEAN = [
    "The river rose in spring, and nobody in the village was surprised.",
    "Old boats were tied to the trees until the water fell again.",
    "Children counted the days; their teachers counted the dry desks.",
    "In May the fields were green, as they had always been.",
]


def test_verdicts(make_docs):
    menu = ["Home | About | Contact", "Accept all cookies", "Log in"]
    assert kept(
        make_docs,
        "\n".join(CLEAN),
        "\n".join(CLEAN + menu),
        "\n".join(CLEAN[:1] + [f"Home{i} | News{i} | Shop{i} | More{i}" for i in range(5)]),
        " ".join(f"word{i}###" for i in range(40)),
        " ".join(f"WORD{i}!!" for i in range(40)),
        " ".join(f"w{i} w{i} w{i}" for i in range(20)),
        "too short.",
        "",
    ) == [True, True, False, False, False, False, False, False]


def test_failing_lines_are_removed(make_docs):
    text = "\n".join([CLEAN[0], "Home | About | Contact", "", CLEAN[1]])
    row = quality.quality_rules(make_docs([(1, text, "s")])).first()
    assert row["clean_text"] == "\n".join([CLEAN[0], "", CLEAN[1]])


@pytest.mark.parametrize(
    "line, rule",
    [
        ("The boats were tied up until the water fell.", None),
        ('She asked, "Will it rain?"', None),
        ("(The desks were dry.)", None),
        ("これは文です。", None),
        ("He listed three reasons:", None),
        ("Yes!", None),
        ("eight words of a line that never ends", "unfinished"),
        ("Chapter two", "unfinished"),
        ("ein Satz ohne Ende, der hier einfach aufhört", "unfinished"),
        ("Home About Us Products Contact Careers Press", "navigation"),
        ("Home > Garden > Tools.", "navigation"),
        ("Accueil · Nos produits · Contact", "navigation"),
        ("« Previous article", "navigation"),
        ("Next | Back", "navigation"),
        ("Alle Rechte vorbehalten, Verlag am Fluss 2020.", "boilerplate"),
        ("Tous droits réservés.", "boilerplate"),
        ("© 2021 Todos los derechos reservados.", "boilerplate"),
        ("Please read our Privacy Policy before you go on.", "boilerplate"),
        ("word### of### symbols### here.", "noise"),
        ("BUY!! NOW!! OR!! NEVER!!", "noise"),
        ("go go go go go go.", "noise"),
    ],
)
def test_rules_per_line(line, rule):
    assert quality.failed_rule(line, line.encode().split(), quality.Rules()) == rule


def test_documents_of_failing_lines_go(make_docs):
    endless = "\n".join(f"line {i} has eight words and no mark" for i in range(30))
    menu = "\n".join(f"Home{i} Shop{i} Press{i} About{i} Login{i}" for i in range(30))
    notices = "\n".join(f"Alle Rechte vorbehalten, Heft Nummer {i} vom Verlag." for i in range(30))
    mixed = "\n".join(CLEAN * 1) + "\n" + "Home About Us Products Contact"
    assert kept(make_docs, endless, menu, notices, mixed) == [False, False, False, True]


def test_counts_by_rule_and_clashing_names(make_docs):
    text = "\n".join([*CLEAN, "Home | About | Contact", "no end here", "go go go go go.", "Cookie policy."])
    docs = make_docs([(1, text, "s")]).selectExpr("*", "'x' as verdict", "'y' as _verdict", "'z' as kept")
    row = quality.quality_rules(docs).first()
    assert [row[f"n_{rule}_lines"] for rule in quality.RULES] == [1, 1, 1, 1]
    assert (row["verdict"], row["_verdict"], row["kept"]) == ("x", "y", True)
    assert row["clean_text"] == "\n".join(CLEAN)


def test_labels_of_a_larger_table(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    rows = judged.select("quality", "kept", "base_failed").collect()
    good = [row["kept"] for row in rows if row["quality"] == 1 and not row["base_failed"]]
    junk = [row["kept"] for row in rows if row["quality"] == 0]
    assert len(good) > 3000 and sum(good) >= 0.998 * len(good)
    assert len(junk) > 500 and sum(junk) <= 0.02 * len(junk)


def test_labelled_documents(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.quality_rules(docs).join(labels, "doc_id").collect()
    assert all(row["kept"] for row in rows if row["quality"] == 1 and not row["base_failed"])
    junk = [row["kept"] for row in rows if row["quality"] == 0]
    assert junk and sum(junk) <= 0.1 * len(junk)


def test_a_filter_on_the_verdict_judges_once(docs):
    judged = quality.quality_rules(docs).where("kept").select("text", "clean_text", "lost_words")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_empty_table(make_docs):
    assert quality.quality_rules(make_docs([])).collect() == []


def test_query(spark, docs):
    text = {row["doc_id"]: row["text"] for row in docs.collect()}
    for row in QUERIES["op10_quality"](spark, SMALL).collect():
        assert tuple(row[name] for name in NAMES) == base(text[row["doc_id"]])
