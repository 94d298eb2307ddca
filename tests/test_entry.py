import os

import pytest

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["p", "n"]


def test_every_query_has_oracle_or_is_documented():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 25


QUICK = ("page_text", "html_articles", "doc_entities_main", "doc_term_hits", "reply_articles", "bioc_articles", "docs_cascade", "json_ld_values",
         "document_triples", "publication_rows", "page_identifiers", "routed_mentions", "custom_rules", "graph_entity_lists")


@pytest.mark.parametrize("name", QUICK)
def test_queries_match_their_sql(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    assert os.path.isdir(sf), "the given tables are missing"
    con = duckdb.connect()
    for t in ("pages", "documents", "orders", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = entry.queries()[name](spark, sf)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    plain = lambda x: repr(round(x, 9)) if isinstance(x, float) else str(x)
    have = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert have == sorted(tuple(map(plain, r)) for r in res.fetchall())
