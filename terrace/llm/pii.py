"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

1. One pattern finds e-mail addresses, IPv4 addresses, phone, social security and card
   numbers, and names after a form of address. A mention's canonical form (lower case, digits
   only) is the entity; all mentions of an entity get the same surrogate.
2. Every entity is given a surrogate derived from SHA-256 of (key, type, entity, attempt):
   an address keeps its length, its top-level domain and its kinds of characters; an IP stays
   private or public; a number keeps its length, its country code and whether its check digit
   is right; a name follows the gender of the form of address and the script it is written in.
3. Entities whose surrogate another entity has, or which is itself an entity of the corpus,
   try again with the next attempt; the one with the smallest canonical form keeps it. The
   rounds work on entities, not on documents, and end when no two are alike. Where attempts
   keep failing the target grows, as its free values must outnumber the entities: a private
   address may get one of 10.0.0.0/8 and then of the reserved 240.0.0.0/4, which has more than
   there are private ones, and an e-mail address a longer local part. Numbers keep their length,
   so more than half of all phone, social security or card numbers of a length have no answer.
4. Each mention is rendered in its own layout and case, and texts are put together again from
   the pieces between the mentions. Only texts that hold a mention are shuffled.

Defined cases. NULL or empty text: unchanged, no entity. NULL doc_id: handled like any other.
Repeated rows: the same surrogates. Overlapping kinds: the order above decides. Empty input:
empty result. Extra columns: passed through by ``pseudonymise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import packed, staged

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMS = (
    "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Mlle|Señora|Sra|Señorita|Srta|Signora|Госпожа|г-жа",
    "Mr|Sir|Herr|Monsieur|Señor|Sr|Signor|Господин|г-н",
)
NAME_WORD = r"\p{Lu}[\p{L}'’-]+"
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9])(?!\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
    r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{FORMS[0]}|{FORMS[1]})\.? {NAME_WORD}(?: {NAME_WORD}){{0,2}}",
}
PATTERN = "|".join(KINDS.values())
# A text without any of these cannot hold a mention; the test is much cheaper than the pattern.
HINT = rf"[0-9@]|(?:{FORMS[0]}|{FORMS[1]})\.? \p{{Lu}}"

FIRST_NAMES = {
    ("latin", "f"): "Anna Clara Elena Helen Irene Julia Laura Maria Nora Paula Rosa Sara Teresa Vera Wanda Yvonne".split(),
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Oscar Peter Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Клара Мария Нина Ольга Полина Раиса София Тамара Ульяна Юлия Яна".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Тимур Фёдор".split(),
}
# From this attempt on, surrogates come from a wider space.
WIDER = 10
SYLLABLES = {
    "latin": "bal cor dan fel gar hol jan kel lor mar nes pol ren sal tor van".split(),
    "cyrillic": "бал вор гар дан зор кал лен мар нов пол рен сал тор фед хол чер".split(),
}


def _number(digest: Column, place: Column | int) -> Column:
    """A number below 2**16 from four hex digits of a digest, at a place counted from 0 (cyclic)."""
    place = F.lit(place) if isinstance(place, int) else place
    return F.conv(F.substr(digest, place % 15 * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(choices: list[str], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, choices)), number % len(choices))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _letters(text: Column, seed: Column) -> Column:
    """Letters and digits exchanged for others of their kind and script; the rest stays."""

    def swap(c: Column, i: Column) -> Column:
        # One digest serves 15 characters.
        n = _number(F.sha2(F.concat(seed, (i / 15).cast("int").cast("string")), 256), i)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), n % 27 + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substr(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), n % 24 + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(text), swap), "")


def _digits(count: Column, seed: Column) -> Column:
    one = lambda i: (_number(F.sha2(F.concat(seed, (i / 15).cast("int").cast("string")), 256), i) % 10).cast("string")
    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a digit string; 0 where its last digit checks."""
    values = F.transform(F.reverse(_chars(digits)), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v - F.when(v > 9, 9).otherwise(0)) % 10


def surrogate(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """Surrogate of a canonical entity (of the kinds in KINDS)."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"))
    digest = F.sha2(seed, 256)
    top = F.regexp_extract(entity, r"(\.[^.@]+)$", 1)
    longer = F.repeat(F.lit("x"), F.greatest(attempt - (WIDER - 1), F.lit(0)))
    email = F.concat(_letters(longer, F.concat(seed, F.lit("\x1flonger"))), _letters(F.substr(entity, F.lit(1), F.length(entity) - F.length(top)), seed), top)

    octet = lambda i, low, n: (_number(digest, i) % n + low).cast("string")
    private = entity.rlike(r"^(?:10|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    ip = F.when(
        private & (attempt >= WIDER),
        F.concat_ws(
            ".", F.when(attempt < 2 * WIDER, F.lit("10")).otherwise(octet(0, 240, 15)), octet(1, 0, 256), octet(2, 0, 256), octet(3, 0, 256)
        ),
    ).otherwise(F.concat_ws(
        ".",
        F.when(entity.rlike(r"^10\."), F.lit("10"))
        .when(entity.rlike(r"^192\.168\."), F.lit("192.168"))
        .when(entity.rlike(r"^172\.(1[6-9]|2[0-9]|3[01])\."), F.concat(F.lit("172."), octet(1, 16, 16)))
        .otherwise(F.concat_ws(".", octet(0, 11, 89), octet(1, 0, 256))),
        F.when(entity.rlike(r"^10\."), octet(1, 0, 256)),
        octet(2, 0, 256),
        octet(3, 0, 256),
    ))

    country = F.regexp_extract(entity, r"^(\+[0-9]{0,3}?)(?=[0-9]{10}$|[0-9]{7,9}$)", 1)
    fresh = F.concat(country, _digits(F.length(entity) - F.length(country), seed))
    body = _digits(F.length(entity) - 1, seed)
    right = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    card = F.concat(body, F.when(_luhn(entity) == 0, right).otherwise((right + 1 + _number(digest, 9) % 9) % 10).cast("string"))

    gender, script = F.substring_index(entity, ":", 1), F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    words = F.size(F.split(entity, " "))
    name = None
    for s in ("latin", "cyrillic"):
        family = F.initcap(
            F.concat(
                *(_pick(SYLLABLES[s], _number(digest, 4 + i)) for i in range(3)),
                # Later attempts have longer names, so that the rounds end however many names there are.
                F.array_join(F.slice(F.array(*(_pick(SYLLABLES[s], _number(digest, 8 + i)) for i in range(6))), F.lit(1), F.least(attempt, F.lit(6))), ""),
            )
        )
        for g in ("f", "m"):
            first = _pick(FIRST_NAMES[s, g], _number(digest, 2))
            whole = F.when(words > 1, F.concat_ws(" ", first, family)).otherwise(family)
            condition = (script == s) & (gender == g)
            name = F.when(condition, whole) if name is None else name.when(condition, whole)
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
        .when(kind == "name", name).otherwise(fresh)
    )


def _kind(mention: Column) -> Column:
    out = None
    for kind, pattern in KINDS.items():
        whole = mention.rlike(rf"^(?:{pattern})$")
        out = F.when(whole, kind) if out is None else out.when(whole, kind)
    return out.otherwise("card")


_FORM = rf"^((?:{FORMS[0]}|{FORMS[1]})\.? )"


def _canonical(kind: Column, mention: Column) -> Column:
    gender = F.when(mention.rlike(rf"^(?:{FORMS[0]})[. ]"), "f").otherwise("m")
    return (
        F.when(kind == "name", F.concat_ws(":", gender, F.lower(F.regexp_replace(mention, _FORM, ""))))
        .when(kind.isin("phone", "ssn", "card"), F.regexp_replace(mention, "[^0-9+]", ""))
        .otherwise(F.lower(mention))
    )


def _rendered(kind: Column, mention: Column, value: Column) -> Column:
    """A surrogate in the layout and case of a mention."""
    numbers = F.filter(F.split(F.regexp_replace(value, "[^0-9]", ""), ""), lambda c: c != "")
    laid_out = F.array_join(
        F.zip_with(F.split(mention, "[0-9]"), numbers, lambda gap, d: F.concat(gap, F.coalesce(d, F.lit("")))), ""
    )
    cased = F.when((F.upper(mention) == mention) & (F.lower(mention) != mention), F.upper(value)).otherwise(value)
    return (
        F.when(kind == "name", F.concat(F.regexp_extract(mention, _FORM, 1), value))
        .when(kind.isin("phone", "ssn", "card"), laid_out)
        .otherwise(cased)
    )


def _holds(text: Column) -> Column:
    return F.coalesce(text.rlike(HINT) & text.rlike(PATTERN), F.lit(False))


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text), place, kind, mention, entity of every mention."""
    found = docs.filter(_holds(F.col("text"))).select(
        "doc_id", F.xxhash64("text").alias("version"),
        F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("place", "mention"),
    )
    return found.withColumn("kind", _kind(F.col("mention"))).withColumn(
        "entity", _canonical(F.col("kind"), F.col("mention"))
    ).distinct()


def dictionary(found: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate: one row per entity, all surrogates distinct and none an entity."""
    entities = staged(found.select("kind", "entity").distinct(), "pii-entities")
    fill = lambda df: df.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("entity"), F.col("attempt")))
    # What a surrogate occupies: its canonical form among all kinds.
    occupied = F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate"))
    real = entities.select(F.when(F.col("kind") == "name", F.substring_index("entity", ":", -1)).otherwise(F.col("entity")).alias("taken"))
    settled, waiting, attempt = None, entities, 0
    while True:
        tried = staged(fill(waiting.withColumn("attempt", F.lit(attempt))).withColumn("taken", occupied), "pii-tried")
        free = tried.join(real.distinct(), "taken", "left_anti")
        if settled is not None:
            free = free.join(settled.select("taken"), "taken", "left_anti")
        first = free.groupBy("taken").agg(F.min(F.struct("kind", "entity")).alias("first")).select("taken", "first.kind", "first.entity")
        won = staged(tried.join(first, ["taken", "kind", "entity"]).select("kind", "entity", "surrogate", "taken"), "pii-settled")
        settled = won if settled is None else settled.union(won)
        waiting = tried.join(won, ["kind", "entity"], "left_anti").select("kind", "entity")
        if waiting.isEmpty():
            return settled.select("kind", "entity", "surrogate")
        attempt += 1


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` packed with doc_id, _text (mentions replaced) and n_mentions."""
    found = staged(mentions(docs), "pii-mentions")
    book = dictionary(found, key)
    per_text = (
        found.join(book, ["kind", "entity"])
        .select("doc_id", "version", "place", _rendered(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("new"))
        .groupBy("doc_id", "version").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("news"))
    )
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    # Shuffled by hash at every size: a plan that broadcasts small lists would turn into another
    # one, with other needs, as the corpus grows.
    p = staged(per_text, "pii-replacements").hint("shuffle_hash").alias("p")
    d = rows.filter(_holds(F.col("text"))).withColumn("version", F.xxhash64("text")).alias("d")
    joined = d.join(p, F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.version") == F.col("p.version")))
    text = F.array_join(
        F.zip_with(F.split("d.text", PATTERN), "p.news", lambda gap, n: F.concat(gap, F.coalesce(n["new"], F.lit("")))), ""
    )
    changed = joined.select("d._row", "d.doc_id", text.alias("_text"), F.size("p.news").cast("long").alias("n_mentions"))
    same = rows.filter(~_holds(F.col("text"))).select(
        "_row", "doc_id", F.col("text").alias("_text"), F.lit(0).cast("long").alias("n_mentions")
    )
    return changed.union(same)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``; all other columns unchanged."""
    out = pseudonymised(docs, key)
    return out.select(*(F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
