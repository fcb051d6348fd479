"""The divergence of sources against DuckDB and against counting in plain Python."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from docweir.llm import entry
from docweir.llm.source_divergence import source_divergence

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, part int, n double, `a b` string"


def counted(docs, min_docs, top):
    """The same in loops over documents, groups and terms."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in held.keys() | {k[0] for k in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= min_docs)
        own = {s: c for (x, s), c in groups.items() if x == lang}

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        for s in own:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    ours = entry.QUERIES["op11_source_divergence"](spark, SF)
    theirs = con.sql(entry.ORACLE_SQL["op11_source_divergence"])
    assert ours.columns == theirs.columns
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


@pytest.mark.parametrize("min_docs, top", [(1, 3), (2, 50), (99, 50)])
def test_odd_rows_against_plain_python(spark, min_docs, top):
    rows = [
        ("a B b É é É ß_x2y", "en", "s"), ("b b c", "en", "t"), ("", "en", "u"), (None, "en", None), ("b é", None, None), ("zz", None, "s"), ("日本 日本", "en", "é"),
        ("b b c", "en", "t"), ("b b c", "en", "t"), ("x\0y\x7fz İ ſ 😀a", "de", "s"), ("word " * 200_000, "de", "long"), ("!!", "fr", "alone"),
    ]
    docs = spark.createDataFrame([(k % 4, *r, "x", 1, 2.0, "y") for k, r in enumerate(rows)], SCHEMA).repartition(3)
    assert sorted(map(tuple, source_divergence(docs, min_docs, top).collect())) == counted(rows, min_docs, top)


def test_empty_table(spark):
    found = source_divergence(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_counts_that_a_long_product_cannot_hold(spark):
    from docweir.llm.source_divergence import dense_shares, kept_terms

    huge = 10**13
    schema = "lang string, source string, term string, n long, docs long"
    counts = spark.createDataFrame([("en", "s", "a", huge, 40), ("en", "s", "b", 3 * huge + 7, 40)], schema)
    shares = dense_shares(counts.select("lang", "source").distinct(), counts.drop("docs"), kept_terms(counts, 30))
    got = {r.term: r.p for r in shares.collect()}
    assert got == {t: 1 + 10**9 * (n + 5) // (4 * huge + 7 + 10) for t, n in (("a", huge), ("b", 3 * huge + 7))}
