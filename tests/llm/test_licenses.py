"""Licence scan: equal and unequal texts, and every row against its SQL."""

import duckdb
import pytest

from pulse.llm import licenses
from pulse.llm.license_texts import DIGESTS, TEXTS
from pulse.llm.queries import ORACLES, QUERIES

from .conftest import SMALL


def scan(make_docs, *texts):
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    return [r["license_id"] for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()]


MIT = TEXTS[0][2]


def test_equal_texts(make_docs):
    shout = MIT.upper().replace("\n", "  ")
    commented = "\n".join("// " + line for line in ["Copyright (c) 2020 A. Person", *MIT.split("\n")])
    headed = f"The MIT License (MIT)\n\nCopyright © 2001-2020 Some Body\nAll rights reserved.\n\n{MIT}"
    spelled = next(row[2] for row in TEXTS if row[0] == "Zlib")
    spelled = spelled.replace("acknowledgment", "acknowledgement").replace("'as-is'", "“as is”")
    assert scan(make_docs, MIT, shout, commented, headed, spelled) == ["MIT"] * 4 + ["Zlib"]
    assert scan(make_docs, TEXTS[6][2].replace("License", "Licence"))[0] == "MIT"


def test_other_texts(make_docs, odd_texts):
    changed = MIT.replace("free of charge", "for a fee")
    found = scan(make_docs, changed, MIT + " And more.", MIT[:-20], *odd_texts)
    assert found == [None] * len(found)
    assert scan(make_docs) == []


def test_texts_are_distinct(spark):
    known = licenses.known_licenses(spark).collect()
    assert len({r["digest"] for r in known}) == len(known)
    assert {r["license_id"] for r in known} == {row[0] for row in TEXTS} | set(DIGESTS.values())


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, MIT, "x", "y")], "doc_id long, text string, digest string, license_id string")
    row = licenses.scan_licenses(df).first()
    assert (row["license_id"], len(row["digest"])) == ("MIT", 64)


@pytest.mark.parametrize("name", ["op1_mix_sources", "op2_url_filters", "op5_licenses"])
def test_queries_match_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    df = QUERIES[name](spark, SMALL)
    ours = sorted(tuple(r) for r in df.toPandas().astype(str).itertuples(index=False))
    theirs = duck.execute(ORACLES[name]).df()[df.columns].astype(str)
    assert ours == sorted(tuple(r) for r in theirs.itertuples(index=False))


def test_no_document_is_shuffled(spark):
    plan = QUERIES["op5_licenses"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    documents = plan[: plan.index("BroadcastExchange")]
    assert "Exchange" not in documents.replace("BroadcastExchange", "") and "SortMergeJoin" not in plan


def test_clashing_names(make_docs):
    docs = make_docs([(1, MIT, "s")]).selectExpr("*", "'x' as digest", "'y' as body", "'z' as plain")
    row = licenses.scan_licenses(docs).first()
    assert (row["license_id"], row["body"], row["plain"]) == ("MIT", "y", "z")
