"""Registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import table
from terrace.llm.line_dedup import MIN_SITES, MIN_WORDS
from terrace.llm.mixing import BLOCK_WORDS, SEED

PII_KEY = "terrace-example-key"  # a deployment passes its own secret


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sainte-Laguë mix of all documents: words taken of every document."""
    from terrace.llm.mixing import mix_decisions

    return mix_decisions(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Tool-call messages derived from a conversation: a user turn asks, the next turn answers.

    A user turn becomes an assistant message with one call, the assistant turn after it the
    result. Calls need the result of the call before them; every third one needs that of the
    call after it instead. By the turn, some lack an argument or have one of a wrong type.
    """
    turn, before = F.col("turn"), F.concat(F.lit("$result:c"), F.col("turn") - 2)
    needs = F.when(turn % 6 == 2, F.concat(F.lit("$result:c"), turn + 2)).when((turn >= 2) & (turn % 6 != 4), before)
    arguments = F.struct(
        F.col("text").alias("query"),
        F.when(turn % 5 != 3, F.length("text")).alias("limit"),
        F.when(turn % 7 == 6, F.length("text").cast("string")).alias("lang"),
        needs.alias("after"),
    )
    name = F.get(F.array(F.lit("search"), F.lit("lookup"), F.lit("forecast")), F.length("text") % 3)
    call = F.struct(F.concat(F.lit("c"), turn).alias("id"), name.alias("name"), F.to_json(arguments).alias("arguments"))
    result = F.struct(F.concat(F.lit("c"), turn - 1).alias("tool_call_id"), F.col("text").alias("content"))
    asked = conversations.filter("role = 'user'").select(
        "conv_id", "turn", F.lit("assistant").alias("role"), F.to_json(F.struct(F.array(call).alias("tool_calls"))).alias("text")
    )
    answered = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.lit("tool").alias("role"), F.to_json(result).alias("text")
    )
    return asked.union(answered)


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls of all conversations linked, ordered, validated and serialised."""
    from terrace.llm.tool_calls import format_calls

    schemas = spark.sql(
        "select * from values ('search', 'query', 'string', true), ('search', 'limit', 'integer', true),"
        " ('search', 'after', 'string', false), ('lookup', 'query', 'string', true), ('lookup', 'after', 'string', false),"
        " ('lookup', 'limit', 'number', false), ('lookup', 'lang', 'integer', false)"
        " as schemas(name, parameter, type, required)"
    )
    out = format_calls(tool_messages(table(spark, sf_dir, "conversations")), schemas)
    return out.withColumn("errors", F.array_join("errors", ",")).drop("unknown")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of every document with the forest's verdict; values as hashes."""
    from terrace.llm.secret_scan import scan

    found = scan(table(spark, sf_dir, "documents"), path=F.concat_ws("/", "source", "lang"))
    return found.select(
        "doc_id", "place", "part", F.sha2("value", 256).alias("value_sha256"), "length", "transitions", "coverage",
        "probability", "is_secret",
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document, with its edit distance."""
    from terrace.llm.decontaminate import matches

    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "edits", "item_chars"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document from adaptive thresholds per language and source."""
    from terrace.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document over 2-word shingles."""
    from terrace.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data exchanged for surrogates."""
    from terrace.llm.pii import pseudonymised

    return pseudonymised(table(spark, sf_dir, "documents"), PII_KEY).select(
        "doc_id", F.col("_text").alias("text"), "n_mentions"
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document as cross-site boilerplate, and what remains."""
    from terrace.llm.line_dedup import cleaned

    return cleaned(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("_text").cast("long").alias("n_chars"), F.md5("_text").alias("text_md5")
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page under the wrapper inferred for its host."""
    from terrace.llm.html_extraction import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that are not held out."""
    from terrace.llm.toxicity import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and exact errors of every vector, and the digest of the codebooks."""
    from terrace.llm.vector_codes import book_digest, compress

    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        "vec_id", F.col("_code").alias("code"), F.col("_error").alias("error"), F.col("_label_error").alias("label_error"),
        F.lit(book_digest(books)).alias("codebooks_sha256"),
    )


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document covered by windows that start elsewhere too, and what is left."""
    from terrace.llm.substring_dedup import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, seeded score and rank of every document towards the benchmark's text."""
    from terrace.llm.resampling import importance

    found = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_tool_calls": op2_tool_calls,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_pii": op6_pii,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_near_dedup": op10_near_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_importance": op13_importance,
}

_WORDS = r"len(regexp_extract_all({}, '[^\x20\x09-\x0D]+'))"

def _lloyd_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every distance of every round: entries start as the first vectors' parts, means are floored."""
    steps = [f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM v, range({parts}) AS r(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM s QUALIFY e < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS (SELECT vec_id, label, s.p, x, e, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d
  FROM s JOIN b{k} USING (p)),
a{k} AS (SELECT * FROM d{k} QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT p, e, i, CAST(floor(CAST(sum(x[i]) AS BIGINT) / count(*)) AS BIGINT) AS c FROM a{k}, range(1, (SELECT max(len(x)) FROM s) + 1) AS r(i) GROUP BY p, e, i),
l{k} AS (SELECT p, e, list(c ORDER BY i) AS c FROM m{k} GROUP BY p, e),
b{k + 1} AS (SELECT b.p, b.e, coalesce(l.c, b.c) AS c FROM b{k} b LEFT JOIN l{k} l ON l.p = b.p AND l.e = b.e)""")
    return ",\n".join(steps) + f""",
r AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h.h AS codebooks_sha256 FROM r, h"""


ORACLES: dict[str, str] = {
    "op11_vector_codes": _lloyd_sql(),
    # All quotients are listed and ranked here, where the operator lists the contested ones only.
    "op1_mixing": f"""
WITH d AS (SELECT doc_id, source, coalesce(CAST({_WORDS.format("text")} AS BIGINT), 0) AS size,
                  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs,
             row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM t),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT source, source_size, docs, place, least(cap, (SELECT max(level) FROM l) * weight) AS target FROM l),
n AS (SELECT CAST(floor(sum(target) / {BLOCK_WORDS} + 0.5) AS BIGINT) AS blocks FROM g),
q AS (SELECT source, place, target / (2 * k + 1) AS quotient, k
      FROM (SELECT *, unnest(range(0, CAST(ceil(target / {BLOCK_WORDS} * 1.2) AS BIGINT) + 40)) AS k FROM g)),
s AS (SELECT place, count(*) AS seats FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, place, k) AS r FROM q WHERE quotient > 0)
      WHERE r <= (SELECT blocks FROM n) GROUP BY place),
e AS (SELECT d.*, g.place, g.source_size, g.target, coalesce(s.seats, 0) AS seats,
             CAST('0x' || substr(d.k, 25, 8) AS BIGINT) % CAST(ceil(sqrt(g.docs)) AS BIGINT) AS shard
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN s ON s.place = g.place),
h AS (SELECT place, shard, CAST(sum(size) AS BIGINT) AS tape, any_value(seats) AS seats FROM e GROUP BY ALL),
hq AS (SELECT *, unnest(range(0, CAST(ceil(1.2 * seats * tape / sum_tape) AS BIGINT) + 40)) AS k
       FROM (SELECT *, greatest(sum(tape) OVER (PARTITION BY place), 1) AS sum_tape FROM h)),
hs AS (SELECT place, shard, count(*) AS won FROM (
         SELECT *, row_number() OVER (PARTITION BY place ORDER BY tape / (2 * k + 1) DESC, shard, k) AS r FROM hq WHERE tape > 0)
       WHERE r <= seats GROUP BY ALL),
c AS (SELECT h.place, h.shard, h.tape, least(coalesce(hs.won, 0) * {BLOCK_WORDS}, 2 * h.tape) AS words
      FROM h LEFT JOIN hs USING (place, shard)),
f AS (SELECT e.*, c.tape, c.words,
             coalesce(sum(e.size) OVER (PARTITION BY e.place, e.shard ORDER BY e.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM e JOIN c USING (place, shard))
SELECT doc_id, size, source_size, target,
       CASE WHEN tape = 0 THEN CAST(0 AS BIGINT)
            ELSE CAST((words // tape) * size + greatest(0, least(size, words % tape - start)) AS BIGINT) END AS taken
FROM f""",
    # Exact distinct counts for every line, where the operator estimates away from the threshold.
    "op7_line_dedup": rf"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, CASE WHEN {_WORDS.format("line")} >= {MIN_WORDS}
                     THEN trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) END AS key FROM l),
s AS (SELECT key, count(DISTINCT coalesce('s:' || source, 'null')) AS sites FROM k WHERE key IS NOT NULL GROUP BY key),
r AS (SELECT k.*, coalesce(s.sites >= {MIN_SITES}, false)
             AND row_number() OVER (PARTITION BY k.key ORDER BY doc_id NULLS FIRST, pos) > 1 AS gone FROM k LEFT JOIN s ON s.key = k.key),
t AS (SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
       CAST(length(t.text) AS BIGINT) AS n_chars, md5(t.text) AS text_md5
FROM documents d LEFT JOIN t ON t.doc_id IS NOT DISTINCT FROM d.doc_id""",
    # Every pair of documents that share a shingle, and the closure of the links.
    "op10_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                          ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1])) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT a, min(b) AS low FROM c GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(m.low, s.doc_id)) AS kept
FROM s LEFT JOIN m ON m.a = s.doc_id""",
    # Every window of every document written out and counted.
    "op12_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT s.doc_id, s.i, sha256(array_to_string(d.w[s.i : s.i + 34], ' ')) AS h FROM s JOIN d ON d.doc_id = s.doc_id),
r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
x AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT x.doc_id, count(g.i) AS n_removed, string_agg(x.x, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS kept
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    # The CRC-32 of each distinct word, bit by bit; every feature of every document counted.
    "op13_importance": r"""
WITH w AS (
  SELECT true AS own, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT false, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
u AS (SELECT own, id, unnest(w) AS x FROM w),
v AS (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM u)),
c AS (SELECT x, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
                                lambda c, b: list_reduce(range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, b)),
                                CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM v),
f AS (SELECT own, id, bucket FROM u JOIN c USING (x)),
n AS (SELECT bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t FROM f GROUP BY bucket),
z AS (SELECT count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t FROM f),
g AS (SELECT bucket, CAST(floor(1000 * ln((n.t + 1.0::DOUBLE) * (z.s + 10000) / ((n.s + 1.0::DOUBLE) * (z.t + 10000)))) AS BIGINT) AS gain FROM n, z),
d AS (SELECT id, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN g USING (bucket) WHERE own GROUP BY id),
r AS (SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_features, coalesce(d.weight, 0) AS weight,
             CAST('0x' || substr(sha256('2024:' || w.id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN d ON d.id = w.id WHERE w.own),
k AS (SELECT doc_id, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM r),
o AS (SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM k)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= n * 10 // 100 THEN place END AS rank FROM o""",
}
