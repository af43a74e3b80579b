"""Full-text search as Spark jobs: BM25 ranking, filters, top-k, lookup, facets.

Queries are a DataFrame (one row per query), so a batch of searches is one job:

* documents are tokenised in the task that holds them, and only tokens that some query uses (a
  semi-join with the query words) go on; texts are shuffled once by id, in place of one row
  per posting, and never stored. Corpus statistics (documents, words) are one aggregate row;
* where many documents share few texts (``search_texts``), distinct texts are scored, each
  with its number of documents and its k smallest ids; totals add the numbers up and the
  ranking expands the best texts;
* the join of postings and query words carries no hint: adaptive execution broadcasts the
  smaller side by its measured bytes, or splits a hot word;
* filters are applied to postings before scoring; the top ``k`` per query comes
  from ``row_number() <= k``, which Catalyst plans as a partial top-k before the
  shuffle; totals are partial counts.

``write_postings`` keeps the postings as an ordinary table, range-clustered by (term, doc_id),
for single requests: a term is a pushed-down predicate that skips row groups. Ranking: BM25
with k1 = 1.2, b = 0.75 and idf = ln(1 + (N - df + 0.5) / (df + 0.5)); score rounded to 6
decimals; ties by document id ascending.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions.expressions import TOKEN_PATTERN, tokenize  # noqa: F401 - re-exported
from terrace.session import materialize

# BM25 constants.
K1 = 1.2
B = 0.75


@dataclass(frozen=True)
class Index:
    """Written postings (term, doc_id, tf, dl), document frequencies and corpus statistics."""

    postings: DataFrame
    terms: DataFrame
    doc_count: int
    total_length: int


def _tokenised(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    toks = docs.select(F.col(id_col).alias("doc_id"), *carry, tokenize(F.col(text_col)).alias("__toks"))
    return toks.withColumn("dl", F.coalesce(F.size("__toks"), F.lit(0)))


def _by_id(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """Texts shuffled by id before they are taken apart: postings are counted where they arise, and
    a document's stay together, so scores are nearly summed before they are shuffled. The number
    keeps tasks: texts are small beside their postings."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(*dict.fromkeys((id_col, text_col, *carry))).repartition(tasks, id_col)


def _stats(tokenised: DataFrame, weight: Column | None = None) -> tuple[int, int]:
    """(documents, words) of a tokenised corpus: one row from a map-side aggregate."""
    w = F.lit(1) if weight is None else weight
    row = tokenised.agg(F.coalesce(F.sum(w), F.lit(0)).alias("n"), F.coalesce(F.sum(w * F.col("dl")), F.lit(0)).alias("t")).first()
    return int(row["n"]), int(row["t"])


def _postings(tokenised: DataFrame, words: DataFrame | None, keep: Sequence[str] = ()) -> DataFrame:
    """``term, doc_id, tf, dl, *keep``; with ``words`` only of those terms."""
    each = tokenised.select("doc_id", "dl", *keep, F.explode("__toks").alias("term"))
    if words is not None:
        each = each.join(words, "term", "left_semi")
    return each.groupBy("doc_id", "term", "dl", *keep).agg(F.count(F.lit(1)).alias("tf"))


def write_postings(docs: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """Write postings, document frequencies and corpus statistics under ``path``.

    Postings are range-partitioned by (term, doc_id), so a frequent word is spread over as
    many files as its postings need, and sorted inside each file.
    """
    spark = docs.sparkSession
    tokenised = _tokenised(docs, id_col, text_col)
    (
        _postings(_tokenised(_by_id(docs, id_col, text_col), id_col, text_col), None).select("term", "doc_id", "tf", "dl")
        .repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
        .write.mode("overwrite").parquet(f"{path}/postings")
    )
    written = spark.read.parquet(f"{path}/postings")
    frequencies = written.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    frequencies.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
    spark.createDataFrame([_stats(tokenised)], "doc_count long, total_length long").write.mode("overwrite").parquet(
        f"{path}/stats"
    )


def read_postings(spark: SparkSession, path: str) -> Index:
    stats = spark.read.parquet(f"{path}/stats").first()
    return Index(
        spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), stats["doc_count"], stats["total_length"]
    )


def query_terms(queries: DataFrame, query_id: str = "query_id", q: str = "q") -> DataFrame:
    """``query_id, term, qtf``: analysed query text; a repeated word counts twice."""
    return (
        queries.select(F.col(query_id).alias("query_id"), F.explode(tokenize(F.col(q))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def bm25_weight(tf: Column, dl: Column, df: Column, n: int, total: int) -> Column:
    """BM25 weight of one (term, document) posting in a corpus of ``n`` documents with
    ``total`` words; a query multiplies it by the number of times it repeats the term."""
    avgdl = total / n if n else 0.0
    idf = F.log(F.lit(1.0) + (F.lit(n) - df + F.lit(0.5)) / (df + F.lit(0.5)))
    norm = tf + F.lit(K1) * (F.lit(1.0) - F.lit(B) + F.lit(B) * dl / F.lit(avgdl))
    return idf * (tf * F.lit(K1 + 1.0)) / norm


def _query_filter_cols(queries: DataFrame, query_id: str, filters: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``query_id`` plus the filter values, renamed so they never clash with the
    document columns they are compared with."""
    return queries.select(
        F.col(query_id).alias("query_id"), *[F.col(qc).alias(f"__fq{i}") for i, (qc, _, _) in enumerate(filters)]
    )


def _filter_postings(matched: DataFrame, filters: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Apply per-query filters ``(query column, op, document column)``; a NULL query
    value means the filter was not given (0 counts as given)."""
    for i, (_, op, dcol) in enumerate(filters):
        q, d = F.col(f"__fq{i}"), F.col(dcol)
        cond = {"eq": d == q, "gte": d >= q, "lte": d <= q}[op]
        matched = matched.filter(q.isNull() | cond)
    return matched


def rank(scored: DataFrame, k: int | str, order: Sequence[Column]) -> DataFrame:
    """Top ``k`` per query plus ``total`` (all matches). ``scored`` has
    ``query_id, doc_id, score``; ``k`` is a literal or a column name."""
    # ``count(score)`` keeps the scored subtree identical to the ranking branch, so
    # its exchanges are reused instead of recomputing the matches.
    totals = scored.groupBy("query_id").agg(F.count("score").alias("total"))
    w = Window.partitionBy("query_id").orderBy(*order)
    limit = F.col(k) if isinstance(k, str) else F.lit(k)
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    return top.join(totals, on="query_id", how="inner")


def _scored(posts: DataFrame, qside: DataFrame, n: int, total: int, filters=(), keep: Sequence[str] = ()) -> DataFrame:
    """``query_id, doc_id, score, *keep`` of every match; ``qside`` has query_id, term, qtf, df
    and filter values."""
    matched = _filter_postings(posts.join(qside, "term"), filters)
    w = bm25_weight(F.col("tf"), F.col("dl"), F.col("df"), n, total)
    return matched.groupBy("query_id", "doc_id", *keep).agg(F.round(F.sum(F.col("qtf") * w), 6).alias("score"))


def search_text(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int | str = 10,
    filters: Sequence[tuple[str, str, str]] = (),
    query_id: str = "query_id",
    q: str = "q",
) -> DataFrame:
    """Ranked OR-match of each query's terms: ``query_id, rank, doc_id, score, total``.

    ``k`` is a number, or the name of a per-query limit column of ``queries`` (each
    query keeps its own top-k; ranking uses the largest limit as a literal so the
    partial top-k before the shuffle still applies).
    """
    k_max = k
    if isinstance(k, str):
        limits = queries.agg(F.max(F.col(k)).alias("high"), F.min(F.col(k)).alias("low")).first()
        if limits["low"] is None or limits["low"] < 1:
            raise ValueError("every query limit must be at least 1")
        k_max = limits["high"]
    elif k < 1:
        raise ValueError("k must be at least 1")
    carry = sorted({d for _, _, d in filters})
    n, total = _stats(_tokenised(docs, id_col, text_col, carry))
    qt = query_terms(queries, query_id, q)
    # Written once: document frequencies, totals and scores all read it.
    posts = materialize(_postings(_tokenised(_by_id(docs, id_col, text_col, carry), id_col, text_col, carry), qt.select("term").distinct(), carry))
    qside = qt.join(posts.groupBy("term").agg(F.count("tf").alias("df")), "term")
    if filters:
        qside = qside.join(_query_filter_cols(queries, query_id, filters), "query_id")
    scored = _scored(posts, qside, n, total, filters)
    ranked = rank(scored, k_max, [F.col("score").desc(), F.col("doc_id").asc()])
    if isinstance(k, str):
        limits = queries.select(F.col(query_id).alias("query_id"), F.col(k).alias("__limit"))
        ranked = ranked.join(limits, "query_id").filter(F.col("rank") <= F.col("__limit"))
    return ranked.select("query_id", "rank", "doc_id", "score", "total")


def search_texts(
    docs: DataFrame, queries: DataFrame, id_col: str, text_col: str, k: int = 10, query_id: str = "query_id", q: str = "q"
) -> DataFrame:
    """``search_text`` for documents that share texts: the score depends on the text alone, so
    the work is one row per (query, distinct text) instead of per (query, document).

    A text outside the best k (by score, then smallest id) has k documents before its first,
    so the k best texts with their k smallest ids hold the k best documents.
    """
    by_id = Window.partitionBy("__text").orderBy("doc_id")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    first = (
        slim.withColumn("__n", F.row_number().over(by_id)).filter(F.col("__n") <= k)
        .groupBy("__text").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))  # at most k ids
    )
    texts = slim.groupBy("__text").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    tokenised = _tokenised(texts, "first_id", "__text", ("copies",))
    n, total = _stats(tokenised, F.col("copies"))
    qt = query_terms(queries, query_id, q)
    posts = _postings(tokenised, qt.select("term").distinct(), ("copies",))
    qside = qt.join(posts.groupBy("term").agg(F.sum("copies").alias("df")), "term")
    scored = _scored(posts, qside, n, total, keep=("copies",))
    totals = scored.groupBy("query_id").agg(F.sum("copies").alias("total"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    best = scored.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k).select("query_id", "doc_id", "score")
    ids = first.select(F.get("ids", F.lit(0)).alias("doc_id"), "ids")
    expanded = best.join(ids, "doc_id").select("query_id", "score", F.explode("ids").alias("doc_id"))
    top = expanded.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(totals, "query_id").select("query_id", "rank", "doc_id", "score", "total")


def search_filtered(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str,
    equal_on: tuple[str, str],
    filters: Sequence[tuple[str, str, str]] = (),
    k: int = 10,
    query_id: str = "query_id",
) -> DataFrame:
    """Match-all queries narrowed by filters, joined on one equality filter
    ``(query column, document column)``; constant score 1.0, ties by id."""
    qcol, dcol = equal_on
    q = queries.select(
        F.col(query_id).alias("query_id"),
        F.col(qcol).alias("__eq"),
        *[F.col(qc).alias(f"__fq{i}") for i, (qc, _, _) in enumerate(filters)],
    )
    matched = q.join(docs, F.col("__eq") == F.col(dcol), "inner")
    matched = _filter_postings(matched, filters)
    scored = matched.select("query_id", F.col(id_col).alias("doc_id"), F.lit(1.0).alias("score"))
    ranked = rank(scored, k, [F.col("doc_id").asc()])
    return ranked.select("query_id", "rank", "doc_id", "score", "total")


def search_one(
    docs: DataFrame,
    id_col: str,
    text_col: str | None = None,
    q: str | None = None,
    equals: dict[str, object] | None = None,
    at_least: dict[str, object] | None = None,
    limit: int = 10,
    index: Index | None = None,
) -> tuple[int, DataFrame]:
    """One request, as the serving API takes it: ``(total, top rows)``.

    Truthy ``q`` -> BM25 over ``text_col`` or a written ``index`` (corpus statistics over all
    documents, filters do not change scores); empty -> match all with score 1.0. ``equals``
    and ``at_least`` are non-scoring filters, each applied only when given (0 counts).
    The filters and the query's terms are literals, so they reach the scans.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be within 1..100")
    cond = F.lit(True)
    for c, v in (equals or {}).items():
        if v is not None:
            cond = cond & (F.col(c) == F.lit(v))
    for c, v in (at_least or {}).items():
        if v is not None:
            cond = cond & (F.col(c) >= F.lit(v))
    hits = docs.filter(cond)
    if not q:
        total = hits.count()
        top = hits.orderBy(F.col(id_col).asc()).limit(limit).withColumn("score", F.lit(1.0))
        return total, top
    spark = docs.sparkSession
    words = query_terms(spark.createDataFrame([(0, q)], "query_id long, q string"))
    counts = {r["term"]: r["qtf"] for r in words.collect()}  # the request's few words
    used = F.col("term").isin(list(counts))
    if index is not None:
        posts, terms, n, total_length = index.postings.filter(used), index.terms.filter(used), index.doc_count, index.total_length
    else:
        tokenised = _tokenised(docs, id_col, text_col)
        n, total_length = _stats(tokenised)
        posts = _postings(tokenised, None).filter(used)
        terms = posts.groupBy("term").agg(F.count("tf").alias("df"))
    df = {r["term"]: r["df"] for r in terms.collect()}  # a row per word of the request
    rows = [(0, t, counts[t], d) for t, d in df.items()]
    qside = spark.createDataFrame(rows, "query_id long, term string, qtf long, df long")
    scored = _scored(posts, qside, n, total_length).drop("query_id")
    scored = scored.join(hits.select(F.col(id_col).alias("doc_id")), "doc_id", "left_semi")
    total = scored.count()
    top = scored.orderBy(F.col("score").desc(), F.col("doc_id").asc()).limit(limit)
    rows = top.join(hits.withColumnRenamed(id_col, "doc_id"), "doc_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc()
    )
    return total, rows


def get_by_ids(ids: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Batch get-by-id: every requested id once, with ``found`` and the document
    columns (NULL when not found).

    The documents are first cut down to the requested ids by an inner join, whose small side
    adaptive execution can broadcast; only the hits are joined to the list of ids again.
    """
    req = ids.select(F.col(id_col)).distinct()
    hits = docs.join(req, id_col).withColumn("__found", F.lit(True))
    out = req.join(hits, on=id_col, how="left")
    return out.withColumn("found", F.coalesce(F.col("__found"), F.lit(False))).drop("__found")


def facets(docs: DataFrame, column: str) -> DataFrame:
    """Exact-value buckets: ``(value, docs)`` per distinct value of ``column``."""
    return docs.groupBy(column).agg(F.count(F.lit(1)).alias("docs"))
