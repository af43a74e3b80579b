"""Cross-site boilerplate: remove lines by the number of distinct sites they occur on.

1. Lines are hashed once in a pass over the texts; from here on a line is (document key,
   position, hash, site) and texts are not shuffled for counting.
2. A line on ``min_sites`` sites occurs at least that often, so a plain count (combined
   before the shuffle) leaves only lines that can qualify. Their rows are dealt by line and salt,
   so a line that stands everywhere is spread over ``SALTS`` tasks until sketches combine it.
3. HyperLogLog sketches of the sites of those lines are built per map task and merged. An
   estimate outside the error band around the threshold decides; lines inside the band get
   an exact distinct count.
4. A boilerplate line stays in its first place (smallest doc_id, then position) and goes
   everywhere else, so removal never destroys the only copy of a passage.

``remove_passages`` is for what a rule over sites leaves: a line of more than 50 words does not
meet by chance, so it goes from its second document on, whatever the sources.

A line is compared without its leading and trailing white space; lines of fewer than
``min_words`` words are left alone, as short lines meet by chance.

Defined cases. NULL text stays NULL; an empty text stays empty. NULL site: a site of its
own. NULL doc_id: sorts before all ids. Repeated rows (same doc_id and text): one document,
the same decision for each. Several equal lines inside one document: one first place.
Empty input: empty result. Extra columns: passed through by ``remove_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import packed, staged, word_count

MIN_SITES = 4
MIN_WORDS = 3
PASSAGE_WORDS = 51
LG_K = 12
SALTS = 32
TRIMMED = " \t\r\x0b\x0c"


def lines(docs: DataFrame, site: str | Column = "source", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, version (hash of the text), site, position, line (hash) of every line long enough."""
    each = docs.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        (F.col(site) if isinstance(site, str) else site).cast("string").alias("site"),
        F.posexplode(F.split("text", "\n")).alias("position", "_line"),
    )
    return each.filter(word_count(F.col("_line")) >= min_words).select(
        "doc_id", "version", "site", "position", F.xxhash64(F.btrim("_line", F.lit(TRIMMED))).alias("line")
    )


def _only(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The ``rows`` of the chosen lines with what ``chosen`` says of them (a row per line), dealt
    by line and salt."""
    salt = F.pmod(F.xxhash64("doc_id", "position"), F.lit(SALTS)).cast("int")
    salted = chosen.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", salt).join(salted, ["line", "salt"]).drop("salt")


def spread_lines(each: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Hashes of the lines that occur on at least ``min_sites`` distinct sites."""
    often = each.groupBy("line").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_sites).select("line")
    # A site is one string per row; NULL gets a name that no concatenation of a real one has.
    named = each.select(
        "line", "doc_id", "position",
        F.when(F.col("site").isNull(), "null").otherwise(F.concat(F.lit("s:"), "site")).alias("site"),
    )
    some = _only(named, often)
    estimated = staged(
        some.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites")),
        "lines-estimated",
    )
    margin = 4 * 1.04 / 2 ** (lg_k / 2)  # four standard errors
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    sure = estimated.filter(F.col("sites") > high).select("line")
    near = estimated.filter((F.col("sites") >= low) & (F.col("sites") <= high)).select("line")
    exact = (
        _only(named, near).groupBy("line").agg(F.countDistinct("site").alias("sites"))
        .filter(F.col("sites") >= min_sites).select("line")
    )
    return sure.union(exact)


def boilerplate(
    docs: DataFrame, site: str | Column = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS
) -> DataFrame:
    """doc_id, version, positions: the lines to remove from every document that has any."""
    each = staged(lines(docs, site, min_words), "lines")
    hits = staged(
        _only(each, spread_lines(each, min_sites)).select("line", "doc_id", "version", "position"), "lines-spread"
    )
    place = F.struct("doc_id", "version", "position")
    first = hits.groupBy("line").agg(F.min(place).alias("first"))
    return (
        _only(hits, first).filter(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "version").agg(F.collect_set("position").alias("positions"))
    )


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``docs`` packed, with _text (lines removed), n_lines and n_removed."""
    gone = staged(boilerplate(docs, **options), "lines-removed")
    d = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"), version=F.xxhash64("text")).alias("d")
    # Shuffled by hash at every size: a plan that broadcasts small lists would turn into another
    # one, with other needs, as the corpus grows.
    g = gone.hint("shuffle_hash").alias("g")
    joined = d.join(
        g, F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.version") == F.col("g.version")), "left"
    ).select("d._row", "d.doc_id", "d.text", F.split("d.text", "\n").alias("_lines"), "g.positions")
    n = F.size("_lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "positions")
    text = F.when(F.col("positions").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array_sort(kept), lambda i: F.get("_lines", i)), "\n")
    )
    return joined.select(
        "_row", "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("positions").isNull(), 0).otherwise(F.size("positions")).cast("long").alias("n_removed"),
        text.alias("_text"),
    )


def remove_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without boilerplate lines; n_chars, where there is one, follows the text.

    A document that consisted of nothing but lines kept elsewhere is left out; one that had
    no words before stays.
    """
    out = cleaned(docs, **options).filter((F.col("n_removed") == 0) | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("_text")}
    if "n_chars" in kinds:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("_text")).otherwise(F.col("_row.n_chars")).cast(kinds["n_chars"])
    return out.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def remove_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` without the lines of ``min_words`` words and more that stand in an earlier document.

    For documents that are no near copies of each other: of a pair of those, it would leave a
    rest of one. Rows of the same doc_id and text are one document, as everywhere here.
    """
    document = F.struct("doc_id", F.xxhash64("text"))
    return remove_boilerplate(docs, site=document, min_sites=2, min_words=min_words)
