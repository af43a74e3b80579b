"""Reconciliation, profiles, fingerprints, diffs, quality gate, document contracts,
search and run-log parsing on literal rows; BM25 against a plain-Python oracle."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators import contracts, quality, runlog, search

# -- reconciliation (status rules) ------------------------------------------------------------


def _counts(spark, d):
    return spark.createDataFrame(list(d.items()), "table string, rows long")


@pytest.mark.parametrize(
    ("bronze", "source", "status"),
    [(50, 50, "OK"), (60, 50, "APPEND"), (30, 50, "DIFF")],
)
def test_reconcile_status(spark, bronze, source, status):
    rep = quality.reconcile(_counts(spark, {"t": bronze}), _counts(spark, {"t": source})).collect()
    assert [(r["table"], r["source"], r["bronze"], r["status"]) for r in rep] == [("t", source, bronze, status)]


def test_reconcile_missing_side_counts_zero_and_bronze_only(spark):
    rep = {r["table"]: r for r in quality.reconcile(_counts(spark, {"a": 5}), _counts(spark, {"b": 3})).collect()}
    assert (rep["a"]["source"], rep["a"]["status"]) == (0, "APPEND")
    assert (rep["b"]["bronze"], rep["b"]["status"]) == (0, "DIFF")
    only = quality.reconcile(_counts(spark, {"a": 5}), None)
    assert only.columns == ["table", "bronze"]


# -- profile, fingerprint, diff ------------------------------------------------------------------


def test_profile_and_samples(spark):
    df = spark.createDataFrame([(i, f"v{i}", i * 1.5, 1, 2, 3, 4) for i in range(10)], "id int, v string, x double, a int, b int, c int, d int")
    t = {"t": quality.ProfiledTable(df, ("id",), ("a",))}
    [p] = quality.profile(t).collect()
    assert (p["rows"], p["cols"], p["partition_columns"], p["version"]) == (10, 7, "a", None)
    s = quality.samples(t).collect()
    assert len(s) == 3
    assert json.loads(s[0]["sample"]).keys() == {"id", "v", "x", "a", "b", "c"}
    assert sorted(json.loads(r["sample"])["id"] for r in s) == [0, 1, 2]


def test_fingerprint_is_order_insensitive_and_value_sensitive(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(100)], "id int, v string")
    fp = quality.fingerprint(df).first()
    fp_shuffled = quality.fingerprint(df.repartition(7).orderBy(F.rand(3))).first()
    changed = quality.fingerprint(df.withColumn("v", F.when(F.col("id") == 5, "x").otherwise(F.col("v")))).first()
    assert fp == fp_shuffled
    assert fp["rows"] == changed["rows"] and fp["hash_sum"] != changed["hash_sum"]
    assert quality.fingerprint(df, portable=True).first() == quality.fingerprint(df.repartition(3), portable=True).first()


def test_fingerprint_distinguishes_null_positions(spark):
    a = spark.createDataFrame([(None, "a")], "x string, y string")
    b = spark.createDataFrame([("a", None)], "x string, y string")
    assert quality.fingerprint(a, portable=True).first() != quality.fingerprint(b, portable=True).first()


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    out = {r["k"]: r["change"] for r in quality.snapshot_diff(before, after, ["k"]).collect()}
    assert out == {2: "changed", 4: "added"}
    gone = {r["k"]: r["change"] for r in quality.snapshot_diff(after, before, ["k"]).collect()}
    assert gone == {2: "changed", 4: "removed"}


def test_quality_gate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (2, 99)], "id int, q int")
    rules = [
        quality.Rule("q_not_null", "not_null", "q"),
        quality.Rule("q_range", "range", "q", low=0, high=10),
        quality.Rule("id_unique", "unique", "id"),
        quality.Rule("enough", "min_rows", threshold=2),
        quality.Rule("cols", "schema", threshold="id,q"),
    ]
    rep = {r["rule"]: (r["failures"], r["passed"]) for r in quality.quality_report(df, rules).collect()}
    assert rep == {
        "q_not_null": (1, False),
        "q_range": (1, False),
        "id_unique": (1, False),
        "enough": (0, True),
        "cols": (0, True),
    }
    with pytest.raises(quality.QualityGateError, match="q_not_null"):
        quality.enforce(quality.quality_report(df, rules))


# -- contracts -----------------------------------------------------------------------------------


def _doc_row(**over):
    row = {
        "order_line_id": 1, "order_id": 100, "customer_id": 7, "salesperson_person_id": 2,
        "stock_item_id": 67, "description": "USB rocket launcher", "quantity": 10,
        "picked_quantity": 10, "unit_price": 25.0, "tax_rate": 15.0, "extended_price": 250.0,
        "tax_amount": 37.5, "line_total": 287.5, "order_date": date(2013, 1, 2),
        "order_year": 2013, "order_month": 1,
    }
    row.update(over)
    return row


DOC_SCHEMA = (
    "order_line_id long, order_id long, customer_id long, salesperson_person_id long, "
    "stock_item_id long, description string, quantity long, picked_quantity long, "
    "unit_price double, tax_rate double, extended_price double, tax_amount double, "
    "line_total double, order_date date, order_year int, order_month int"
)


def test_contract_accepts_valid_rows_and_serialises_iso_dates(spark):
    df = spark.createDataFrame([_doc_row()], DOC_SCHEMA)
    docs = contracts.to_documents(contracts.validate(df, contracts.FACT_SALES_DOC), contracts.FACT_SALES_DOC)
    [r] = docs.collect()
    assert r["doc_id"] == 1
    doc = json.loads(r["doc"])
    assert doc["order_date"] == "2013-01-02"
    assert list(doc) == contracts.FACT_SALES_DOC.names


def test_contract_rejects_extra_missing_and_mistyped_fields(spark):
    df = spark.createDataFrame([_doc_row()], DOC_SCHEMA)
    assert contracts.schema_violations(df.withColumn("unexpected", F.lit(1)), contracts.FACT_SALES_DOC) == ["extra:unexpected"]
    assert contracts.schema_violations(df.drop("quantity"), contracts.FACT_SALES_DOC) == ["missing:quantity"]
    mistyped = df.withColumn("description", F.lit(5))
    assert contracts.schema_violations(mistyped, contracts.FACT_SALES_DOC) == ["type:description"]
    with pytest.raises(contracts.ContractError, match="extra:unexpected"):
        contracts.validate(df.withColumn("unexpected", F.lit(1)), contracts.FACT_SALES_DOC)


def test_contract_row_rules_null_and_lossy(spark):
    schema = DOC_SCHEMA.replace(" quantity long,", " quantity decimal(10,2),")
    rows = [_doc_row(), _doc_row(order_line_id=2, customer_id=None), _doc_row(order_line_id=3, quantity=2.5)]
    from decimal import Decimal

    rows = [dict(r, quantity=Decimal(str(r["quantity"]))) for r in rows]
    df = spark.createDataFrame(rows, schema)
    valid, invalid = contracts.quarantine(df, contracts.FACT_SALES_DOC)
    assert [r["order_line_id"] for r in valid.collect()] == [1]
    bad = {r["order_line_id"]: r["violations"] for r in invalid.collect()}
    assert bad == {2: ["null:customer_id"], 3: ["lossy:quantity"]}
    summary = {r["rule"]: r["violations"] for r in contracts.violation_summary(df, contracts.FACT_SALES_DOC).collect()}
    assert summary["invalid:customer_id"] == 1 and summary["invalid:quantity"] == 1
    assert summary["duplicate_key"] == 0
    with pytest.raises(contracts.ContractError, match="invalid:customer_id"):
        contracts.validate(df, contracts.FACT_SALES_DOC)


def test_string_dates_with_a_time_of_day_are_lossy(spark):
    schema = DOC_SCHEMA.replace("order_date date", "order_date string")
    df = spark.createDataFrame([_doc_row(order_date="2020-01-01"), _doc_row(order_line_id=2, order_date="2020-01-01 10:00:00")], schema)
    valid, invalid = contracts.quarantine(df, contracts.FACT_SALES_DOC)
    assert [r["order_line_id"] for r in valid.collect()] == [1]
    assert [r["violations"] for r in invalid.collect()] == [["lossy:order_date"]]


def test_publishing_checks_while_it_writes(spark, tmp_root):
    good = spark.createDataFrame([_doc_row(), _doc_row(order_line_id=2)], DOC_SCHEMA)
    m = contracts.publish(good, contracts.FACT_SALES_DOC, f"{tmp_root}/d")
    assert m["rows"] == 2 and spark.read.parquet(f"{tmp_root}/d").count() == 2
    bad = spark.createDataFrame([_doc_row(customer_id=None)], DOC_SCHEMA)
    for rows, what in ((bad, "invalid:customer_id"), (good.union(good), "repeated keys"), (good.drop("quantity"), "missing:quantity")):
        with pytest.raises(contracts.ContractError, match=what):
            contracts.publish(rows, contracts.FACT_SALES_DOC, f"{tmp_root}/d")
    assert spark.read.parquet(f"{tmp_root}/d").count() == 2  # still the last good ones


def test_duplicate_document_keys_are_caught(spark):
    df = spark.createDataFrame([_doc_row(), _doc_row(), _doc_row(order_line_id=5)], DOC_SCHEMA)
    assert [(r["order_line_id"], r["copies"]) for r in contracts.duplicate_keys(df, ["order_line_id"]).collect()] == [(1, 2)]
    with pytest.raises(contracts.ContractError, match="duplicate_key"):
        contracts.validate(df, contracts.FACT_SALES_DOC)


@settings(max_examples=15, deadline=None)
@given(ids=st.lists(st.integers(min_value=1, max_value=1_000_000), min_size=1, max_size=20, unique=True))
def test_document_ids_round_trip(spark, ids):
    df = spark.createDataFrame([_doc_row(order_line_id=i) for i in ids], DOC_SCHEMA)
    docs = contracts.to_documents(df, contracts.FACT_SALES_DOC).collect()
    assert sorted(r["doc_id"] for r in docs) == sorted(ids)
    assert all(json.loads(r["doc"])["order_line_id"] == r["doc_id"] for r in docs)


# -- search ----------------------------------------------------------------------------------------

CORPUS = [
    (1, "USB rocket launcher", 10, 120.0),
    (2, "USB cable", 10, 15.0),
    (3, "Rocket fuel, rocket parts", 11, 300.0),
    (4, "Desk lamp", 11, 40.0),
    (5, "usb USB usb hub", 12, 90.0),
]


def _docs(spark):
    return spark.createDataFrame(CORPUS, "doc_id long, text string, customer_id long, line_total double")


def _bm25_oracle(corpus, query, k1=1.2, b=0.75):
    tok = lambda s: re.findall(r"[^\W_]+", s.lower())  # noqa: E731 - letters/digits
    docs = {d: Counter(tok(t)) for d, t, *_ in corpus}
    n = len(docs)
    avgdl = sum(sum(c.values()) for c in docs.values()) / n
    scores = {}
    for term, qtf in Counter(tok(query)).items():
        df = sum(1 for c in docs.values() if term in c)
        if not df:
            continue
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for d, c in docs.items():
            if term in c:
                dl = sum(c.values())
                w = idf * (c[term] * (k1 + 1)) / (c[term] + k1 * (1 - b + b * dl / avgdl))
                scores[d] = scores.get(d, 0.0) + qtf * w
    return {d: round(s, 6) for d, s in scores.items()}


@pytest.mark.parametrize("query", ["USB", "rocket usb", "rocket rocket", "lamp", "nothing here"])
def test_bm25_matches_python_oracle(spark, query):
    q = spark.createDataFrame([(0, query)], "query_id long, q string")
    out = search.search_text(_docs(spark), q, k=10).collect()
    expected = _bm25_oracle(CORPUS, query)
    assert {r["doc_id"]: r["score"] for r in out} == pytest.approx(expected)
    ranked = sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["rank"])] == [d for d, _ in ranked]
    assert all(r["total"] == len(expected) for r in out)


def test_search_batch_with_filters_and_limit(spark):
    queries = spark.createDataFrame(
        [(1, "usb", None, None), (2, "usb", 10, None), (3, "usb rocket", None, 100.0), (4, "usb", 0, None)],
        "query_id long, q string, customer_id long, min_total double",
    )
    out = search.search_text(
        _docs(spark).withColumnsRenamed({"customer_id": "doc_customer", "line_total": "doc_total"}), queries, k=1,
        filters=[("customer_id", "eq", "doc_customer"), ("min_total", "gte", "doc_total")],
    )
    got = {r["query_id"]: (r["doc_id"], r["total"]) for r in out.collect()}
    assert got[1][1] == 3 and got[2][1] == 2 and got[3][1] == 2
    assert 4 not in got  # customer 0 is a given filter that matches nothing


def test_search_one_modes(spark):
    docs = _docs(spark)
    total, rows = search.search_one(docs, "doc_id", "text", q="usb", limit=2)
    assert total == 3 and len(rows.collect()) == 2
    total, rows = search.search_one(docs, "doc_id", "text", equals={"customer_id": 11})
    assert total == 2 and [r["doc_id"] for r in rows.collect()] == [3, 4]
    total, _ = search.search_one(docs, "doc_id", "text", at_least={"line_total": 100.0})
    assert total == 2
    total, _ = search.search_one(docs, "doc_id", "text", q="", equals={"customer_id": None})
    assert total == len(CORPUS)
    with pytest.raises(ValueError):
        search.search_one(docs, "doc_id", "text", limit=0)


def test_get_by_ids_and_facets(spark):
    docs = _docs(spark)
    ids = spark.createDataFrame([(1,), (99,), (1,)], "doc_id long")
    out = {r["doc_id"]: r["found"] for r in search.get_by_ids(ids, docs, "doc_id").collect()}
    assert out == {1: True, 99: False}
    f = {r["customer_id"]: r["docs"] for r in search.facets(docs, "customer_id").collect()}
    assert f == {10: 2, 11: 2, 12: 1}


def test_written_postings_are_sorted_and_give_the_same_results(spark, tmp_root):
    docs = spark.createDataFrame([(i, f"usb part{i % 50} {CORPUS[i % 5][1]}") for i in range(400)], "doc_id long, text string")
    search.write_postings(docs, "doc_id", "text", f"{tmp_root}/p")
    stored = search.read_postings(spark, f"{tmp_root}/p")
    q = spark.createDataFrame([(0, "usb rocket part7")], "query_id long, q string")
    expected = {r["doc_id"]: (r["score"], r["total"]) for r in search.search_text(docs, q, k=20).collect()}
    total, top = search.search_one(docs, "doc_id", q="usb rocket part7", limit=20, index=stored)
    assert {r["doc_id"]: (r["score"], total) for r in top.collect()} == expected
    # Every file is sorted by (term, doc_id), and files do not overlap.
    files = stored.postings.select("term", "doc_id", F.input_file_name().alias("f")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r["f"], []).append((r["term"], r["doc_id"]))
    assert all(rows == sorted(rows) for rows in by_file.values())
    ends = sorted((rows[0], rows[-1]) for rows in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    plan = stored.postings.filter(F.col("term").isin("usb"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan or "PushedFilters: [IsNotNull(term), EqualTo(term" in plan


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.sampled_from(["usb hub", "usb", "rocket usb", "", "lamp rocket"]), min_size=1, max_size=40), k=st.integers(1, 4))
def test_search_over_distinct_texts_equals_search_over_documents(spark, texts, k):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    q = spark.createDataFrame([(0, "usb rocket"), (1, "lamp"), (2, "none")], "query_id long, q string")
    a = sorted(map(tuple, search.search_texts(docs, q, "doc_id", "text", k=k).select("query_id", "rank", "doc_id", "score", "total").collect()))
    b = sorted(map(tuple, search.search_text(docs, q, k=k).collect()))
    assert a == b


# -- run log -----------------------------------------------------------------------------------


def test_parse_run_events_and_metrics(spark):
    lines = [
        json.dumps({"ts": "2024-01-01T00:00:00+00:00", "level": "INFO", "logger": "x", "msg": "silver table written",
                    "correlation_id": "abc", "table": "t1", "rows": 5, "destination": "s3://b/t1", "extra": "e"}),
        json.dumps({"ts": "2024-01-01T00:01:00+00:00", "level": "INFO", "logger": "x", "msg": "gold table written",
                    "correlation_id": "abc", "table": "t1", "rows": 7}),
        json.dumps({"ts": "2024-01-01T00:02:00+00:00", "level": "INFO", "logger": "x", "msg": "m",
                    "correlation_id": "def", "table": "t2", "rows": 1}),
    ]
    ev = runlog.parse_run_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    first = ev.orderBy("ts").first()
    assert first["extras"] == {"extra": "e"} and first["rows"] == 5
    m = {(r["correlation_id"], r["table"]): (r["events"], r["rows"]) for r in runlog.run_metrics(ev).collect()}
    assert m == {("abc", "t1"): (2, 12), ("def", "t2"): (1, 1)}
    dest = {r["correlation_id"]: r["destination"] for r in runlog.run_metrics(ev).collect()}
    assert dest == {"abc": "s3://b/t1", "def": None}


@settings(max_examples=10, deadline=None)
@given(
    docs=st.lists(
        st.tuples(st.integers(1, 4), st.floats(0, 100, allow_nan=False, width=32)),
        min_size=1, max_size=30,
    ),
    min_total=st.one_of(st.none(), st.floats(0, 100, allow_nan=False, width=32)),
    k=st.integers(1, 4),
)
def test_search_filtered_matches_brute_force(spark, docs, min_total, k):
    rows = [(i, c, float(t)) for i, (c, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, cust long, line_total double")
    queries = spark.createDataFrame(
        [(c, c, min_total) for c in range(1, 5)], "query_id long, customer_id long, min_total double"
    )
    out = search.search_filtered(
        df, queries, "doc_id", ("customer_id", "cust"), filters=[("min_total", "gte", "line_total")], k=k
    ).collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["total"]))
    for c in range(1, 5):
        match = sorted(i for i, cc, t in rows if cc == c and (min_total is None or t >= min_total))
        if not match:
            assert c not in got
            continue
        assert sorted(got[c]) == [(n + 1, d, len(match)) for n, d in enumerate(match[:k])]


def test_quality_gate_freshness(spark):
    df = spark.createDataFrame([(1, "2024-01-05 00:00:00")], "id int, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    fresh = quality.Rule("fresh", "freshness", "ts", threshold="2024-01-01 00:00:00")
    stale = quality.Rule("stale", "freshness", "ts", threshold="2024-02-01 00:00:00")
    rep = {r["rule"]: r["passed"] for r in quality.quality_report(df, [fresh, stale]).collect()}
    assert rep == {"fresh": True, "stale": False}


def test_search_per_query_limit_column(spark):
    index = _docs(spark)
    queries = spark.createDataFrame(
        [(1, "usb rocket", 1), (2, "usb rocket", 3)], "query_id long, q string, lim int"
    )
    out = search.search_text(index, queries, k="lim").collect()
    got = {}
    for r in out:
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    full = [r["doc_id"] for r in sorted(search.search_text(index, queries.drop("lim"), k=10).collect(), key=lambda r: r["rank"]) if r["query_id"] == 2]
    assert len(got[1]) == 1 and len(got[2]) == 3
    assert got[1] == full[:1] and sorted(got[2]) == sorted(full[:3])
    with pytest.raises(ValueError):
        search.search_text(index, queries.withColumn("lim", F.lit(0)), k="lim")
