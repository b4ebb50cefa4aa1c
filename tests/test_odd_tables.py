"""Queries against their SQL twins over small tables that the test data does not have."""

from collections import Counter

import duckdb

from quillfold import registry


def same(spark, path, name, **tables):
    """Write each table (a schema, and rows) under path; name's rows there, which must be those of its SQL."""
    con = duckdb.connect()
    for table, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS FROM '{path}/{table}.parquet/*.parquet'")
    df = registry.queries()[name](spark, str(path))
    columns = ",".join(f'"{c}"' for c in df.columns)
    got = Counter(map(tuple, df.collect()))
    assert got == Counter(con.sql(f"SELECT {columns} FROM ({registry.oracles()[name]}) t").fetchall())
    return got


def test_route_thresholds_without_a_threshold(spark, tmp_path):
    """a: five errors share the top score; b: four; c: no score; null: no category; d: scores null after the ninth."""
    docs, labels = [], []

    def add(lang, n_chars, toxic):
        docs.append((len(docs), lang, "s", n_chars))
        labels.append((len(labels), 1, toxic))

    for lang, n in (("a", 5), ("b", 4), (None, 1)):
        for k in range(12):
            add(lang, 96 if k < n else k, int(k < n))
    add("c", None, None)
    for k in range(12):
        add("d", 10 * k if k < 9 else None, k % 2 if k else None)
    got = same(spark, tmp_path, "route_thresholds", documents=("doc_id long, lang string, source string, n_chars long", docs), labels=("doc_id long, quality int, toxic int", labels))
    assert sorted(r[0] for r in got) == ["b", "d"]


def test_reading_order_past_the_recursion_limit(spark, tmp_path):
    """Whole trees, gaps, repeated ids, ids below 1, deep chains and ids of more digits than are padded."""
    def chain(k):
        return [k // 3**n for n in range(40) if k >= 3**n]

    ids = [*range(1, 60), *range(90, 130), 500, *chain(2**63 - 1), *chain(10**12 - 1), 10**12, 10**12 + 1, *range(3 * 10**12 - 3, 3 * 10**12 + 6)]
    ids = [k for k in sorted(set(ids)) if k not in (5, 31)] + [2, 13, 13, 40, 10**12, 0, 0, -1, -2, -3, -9, None]
    spark.conf.set("spark.sql.cteRecursionRowLimit", "20")
    try:
        got = same(spark, tmp_path, "reading_order", part=("p_partkey long", [(k,) for k in ids]))
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert max(r[2] for r in got) == 39
    assert not {5, 15, 31, 93, 500} & {r[1] for r in got}


def test_reading_order_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quillfold.operators.geometry.BROADCAST_ROWS", 0)
    ids = [k for k in range(1, 400) if k % 7] + list(range(1, 400, 11))
    same(spark, tmp_path, "reading_order", part=("p_partkey long", [(k,) for k in ids]))


PASSAGES = ["", " ", "a", "ab", "zz", "b c", "c d", "a b c", "xa b cd", "c  d", "c   e", "one two three four", "two three four five", "wo three fou", "four one", "ber die", "über die Straße ging", "ber die Straße g", "die strasse ging", "one\ntwo three", "ne\ntwo three four", " lead", "trail ", "r r r x", "r r r r r", "r q r r s", None]
TEXTS = ["xa b cd", "c  d  e", "one two three four one two three", "one\ntwo three four five", "wir über die Straße gingen", " lead and trail ", "r r r q r r r s " * 50, "", None]


def benchmark_and_documents(texts=TEXTS):
    items = [(k, text) for k, text in enumerate(PASSAGES)] + [(3, "no such text at all"), (3, "a b c"), (None, "nor this one here"), (None, "xa b cd")]
    return {"benchmark": ("item_id long, text string", items), "documents": ("doc_id long, text string", list(enumerate(texts)))}


def test_substring_audit_of_short_and_ragged_passages(spark, tmp_path):
    same(spark, tmp_path / "a", "substring_audit", **benchmark_and_documents())
    same(spark, tmp_path / "b", "substring_audit", **benchmark_and_documents([None]))


def test_substring_audit_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quillfold.operators.text.BLOCK_BYTES", 300)
    same(spark, tmp_path, "substring_audit", **benchmark_and_documents())


def test_substring_audit_splits_a_document_once(spark, tmp_path):
    """200,000 words of one text: splitting it again for each word would take hours."""
    text = " ".join(f"w{k % 5000}" for k in range(200_000))
    items = [(1, "w10 w11 w12 w13 w14"), (2, "w10 w11 w12 w14 w15"), (3, "4999 w0 w1 w2 w")]
    got = same(spark, tmp_path, "substring_audit", benchmark=("item_id long, text string", items), documents=("doc_id long, text string", [(1, text)]))
    assert list(got) == [(2,)]
