"""Secret scanning: candidates by pattern, false positives removed by a random forest.

Candidates are long runs of key characters with a digit in them, and whole values assigned
to a credential word with ``=`` or ``:``: quoted ones of 4 characters and more on a line, with any characters in them
(white space is read as one space), and unquoted ones of 4 characters and more up to white
space, a quote, a comma or a semicolon. Each is described by its length, character transitions, classes and
variety, by how much of it dictionary words cover (the dictionary is the corpus' own
frequent words), by its path, and by the words around it. Spark's random forest is trained
on labelled findings and scores every candidate.

``labelled`` takes findings somebody has judged. Where there are none, ``rule_labels`` gives
labels to the findings whose format or setting leaves no doubt, and the forest judges the
rest by what those have in common. Training reads at most ``max_rows`` findings per class,
by hash; scoring covers all.

Defined cases. NULL or empty text: no candidate. NULL path: an empty one. NULL doc_id:
carried. Labels of one class only, or none: no forest; the probability is 1 or 0 as the rules
say and 0.5 where they do not. Several candidates in a word, repeated candidates or rows:
each is a finding. Empty input: empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged

RUN = r"[A-Za-z0-9+/=_-]{16,}"
CREDENTIAL = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api_?key|apikey|access_?key|auth|credential|private_?key)"
# The value is marked by characters that stand in no text after ``candidates`` has taken them out.
START, END = "\x01", "\x02"
GAP = "\x03"  # white space inside a marked value
ASSIGNED = (
    r"(?i)(" + CREDENTIAL + r"""(?:[_-][a-z0-9]{1,20}){0,2}['"]?[ \t]{0,3}(?::=|=>|={1,2}|:)[ \t]{0,3}["'`]?)"""
    r"""((?<=")[^"\n]{4,}+(?=")|(?<=')[^'\n]{4,}+(?=')|(?<=`)[^`\n]{4,}+(?=`)"""
    r"""|[^\x09-\x0D "'`,;]{3,}[^\x09-\x0D "'`,;.)\]}>])"""
)
SPACE_RUN = r"[\x20\x09-\x0D]+"
KNOWN = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})$"
HARMLESS = r"^(?:[0-9-]+|[A-Za-z]+|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(.)\1+|.*(?i:example|placeholder|changeme|xxxx|dummy).*)$"
CHECKSUM = r"(?i)^(?:sha\d*|md5|commit|checksum|revision|digest|etag)[:=]?$"
TEST_PATH = r"(?i)(?:test|example|sample|mock|fixture|doc)"
DICTIONARY_WORDS = 2_000
MAX_ROWS = 10_000
TREES, DEPTH, SEED = 20, 6, 7
NUMERIC = ["length", "transitions", "digits", "variety", "hex", "coverage", "depth", "test_path", "assigned", "quoted"]


def candidates(docs: DataFrame, path: Column | None = None) -> DataFrame:
    """doc_id, path, place, part, value, before, before2, after of every candidate."""
    path = F.coalesce(path if path is not None else F.lit(""), F.lit("")).cast("string")
    marked = F.regexp_replace(F.translate("text", START + END + GAP, "..."), ASSIGNED, f"$1{START}$2{END}")
    # Every second part is a marked value; without white space in it, it stays in one word.
    whole = F.array_join(
        F.transform(
            F.split(marked, f"[{START}{END}]"),
            lambda x, i: F.when(i % 2 == 1, F.concat(F.lit(START), F.regexp_replace(x, SPACE_RUN, GAP), F.lit(END))).otherwise(x),
        ),
        "",
    )
    words = docs.filter(F.col("text").rlike(RUN) | F.col("text").rlike(ASSIGNED)).select(
        "doc_id", path.alias("path"), F.split(whole, SPACE_RUN).alias("_words")
    )
    at = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.get("_words", i).rlike(f"{RUN}|{START}"))
    plain = lambda w: F.translate(F.coalesce(w, F.lit("")), GAP + START + END, " ")
    given_in = lambda w: F.regexp_extract_all(F.translate(w, GAP, " "), F.lit(f"{START}([^{START}{END}]+){END}"), F.lit(1))
    near = F.transform(
        at,
        lambda i: F.struct(
            i.alias("place"),
            plain(F.get("_words", i)).alias("word"),
            plain(F.get("_words", i - 1)).alias("before"),
            plain(F.get("_words", i - 2)).alias("before2"),
            plain(F.get("_words", i + 1)).alias("after"),
            F.regexp_replace(F.get("_words", i), f"{START}[^{END}]*{END}", " ").alias("rest"),
            given_in(F.get("_words", i)).alias("given"),
        ),
    )
    each = words.select("doc_id", "path", F.explode(near).alias("n")).select("doc_id", "path", "n.*")
    # A run that an assigned value takes in is no finding of its own.
    runs = F.regexp_extract_all(F.translate("rest", END, ""), F.lit(f"({RUN})"), F.lit(1))
    found = each.select("*", F.posexplode(F.concat("given", runs)).alias("part", "value"))
    assigned = F.array_contains("given", F.col("value")) | F.concat_ws(" ", "before2", "before", "word").rlike(
        CREDENTIAL + r"['\"]? ?(?:=|:|:=) ?['\"]?"
    )
    return found.withColumn("assigned", assigned.cast("double")).withColumn(
        "quoted", F.col("word").rlike("['\"]").cast("double")
    ).filter((F.col("value").rlike("[0-9]") | (F.col("assigned") > 0)) & F.col("value").rlike(r"[\p{L}\p{N}]")).drop("given", "rest")


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """One row with the ``size`` most frequent words of three letters and more."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^a-z]+"))).alias("word"))
    top = (
        words.filter(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word").limit(size)
    )
    return top.agg(F.collect_list("word").alias("_dictionary"))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with their features; ``words`` is the one-row dictionary."""
    value = F.col("value")
    kind = F.translate(
        value, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", "A" * 26 + "a" * 26 + "0" * 10 + "-" * 5
    )
    changes = F.length(F.regexp_replace(kind, r"(.)\1*", "x")) - 1
    runs = F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit("([a-z]{3,})"), F.lit(1)))
    known = F.array_intersect(runs, "_dictionary")
    covered = F.aggregate(known, F.lit(0), lambda s, w: s + F.length(w))
    clean = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}=:]", ""))
    return found.join(F.broadcast(words)).select(  # one row of a fixed number of words
        *found.columns,
        F.length(value).cast("double").alias("length"),
        (changes / F.greatest(F.length(value) - 1, F.lit(1))).alias("transitions"),
        (F.length(F.regexp_replace(value, "[^0-9]", "")) / F.length(value)).alias("digits"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("variety"),
        value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        F.least(covered / F.length(value), F.lit(1.0)).alias("coverage"),
        F.size(F.split("path", "/")).cast("double").alias("depth"),
        F.col("path").rlike(TEST_PATH).cast("double").alias("test_path"),
        clean(F.col("before")).alias("w_before"),
        clean(F.col("before2")).alias("w_before2"),
        clean(F.col("after")).alias("w_after"),
    )


def rule_labels(found: DataFrame) -> Column:
    """1.0, 0.0 or NULL: what format and setting say about a finding beyond doubt."""
    value = F.col("value")
    return (
        F.when(value.rlike(KNOWN), 1.0)
        .when(value.rlike(HARMLESS) | F.col("before").rlike(CHECKSUM) | (F.col("coverage") >= 0.8), 0.0)
        .when((F.col("assigned") > 0) & (F.col("quoted") > 0) & (F.col("variety") > 0.2) & ~value.contains(" "), 1.0)
    )


def scan(
    docs: DataFrame,
    path: Column | None = None,
    labelled: DataFrame | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Every candidate with probability and is_secret. ``labelled``: value, label (1.0 / 0.0)."""
    found = staged(candidates(docs, path), "secret-candidates")
    facts = staged(described(found, staged(dictionary(docs), "secret-dictionary")), "secret-features")
    if labelled is None:
        known = facts.withColumn("label", rule_labels(facts)).filter("label is not null")
    else:
        judged = labelled.groupBy("value").agg(F.max("label").cast("double").alias("label"))
        known = facts.join(judged, "value")
    by_hash = F.xxhash64("value", "doc_id", "place")
    parts = [known.filter(F.col("label") == y).orderBy(by_hash, "value").limit(max_rows) for y in (1.0, 0.0)]
    train = staged(parts[0].union(parts[1]), "secret-training")
    hasher = FeatureHasher(inputCols=["w_before", "w_before2", "w_after"], outputCol="around", numFeatures=64)
    assembler = VectorAssembler(inputCols=[*NUMERIC, "around"], outputCol="features")
    if train.select("label").distinct().count() < 2:
        out = facts.withColumn("probability", F.coalesce(rule_labels(facts), F.lit(0.5)))
    else:
        forest = RandomForestClassifier(
            numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", cacheNodeIds=False
        ).fit(assembler.transform(hasher.transform(train)).select("label", "features"))
        scored = forest.transform(assembler.transform(hasher.transform(facts)))
        out = scored.withColumn("probability", vector_to_array("probability")[1])
    # Written here, so that the forest's closures are not carried into the caller's plan.
    return staged(out.withColumn("is_secret", F.col("probability") >= 0.5).select(
        "doc_id", "path", "place", "part", "value", "length", "transitions", "coverage", "probability", "is_secret"
    ), "secret-scored")
